"""Conversation repair, byte-level BPE and whitening against brute force, the library and a dense eigensolver."""

import base64
import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm.common import clashing, frame, odd_rows
from merchlens.llm import byte_pairs, merges, queries_tokens, queries_vectors, registry, turn_repair, whitening
from pyspark.sql import functions as F

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
BLANKS = " \t\n\x0b\x0c\r"
TURN = "conv_id bigint, turn bigint, role string, text string"


def cheapest(turns):
    """(cost, audit) over the grammar's automaton; turns are (initial, truncated, must go)."""

    @lru_cache(None)
    def go(i, state, inserted):
        found = [(0, "")] if i == len(turns) and state in (0, 3) else []
        for r in "ua" if inserted < 2 else "":
            if (state, r) in NEXT and (rest := go(i, NEXT[state, r], inserted + 1)):
                found.append((rest[0] + 5, "I" + rest[1]))
        if i < len(turns):
            role, truncated, gone = turns[i]
            if rest := go(i + 1, state, 0):
                found.append((rest[0] + 2, "D" + rest[1]))
            for r in "" if gone else "sua":
                if (state, r) in NEXT and (r == role or r != "s") and (rest := go(i + 1, NEXT[state, r], 0)):
                    found.append((rest[0] + (r != role) + 5 * truncated, ("K" if r == role else "R") + rest[1]))
        return min(found) if found else None

    return go(0, 0, 0)


def brute(rows):
    """The contract, straight: rows of one conversation as (conv_id, turn, role, text)."""
    turns = []
    for conv, turn, role, text in rows:
        number = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if number == 0:
            continue
        text = "" if number == 1 else "".join(c for c in text if c not in ".!?") if number == 2 else text
        turns += [(turn, "user" if number == 4 else role, text)] * (2 if number == 3 else 1)
    turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
    seen, fault = set(), []
    for _, role, text in turns:
        left = text.strip(BLANKS)
        fault.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    first = [r[:1] for _, r, _ in turns]
    cost, audit = cheapest(tuple((f, x == "truncated", x in ("blank", "duplicate")) for f, x in zip(first, fault)))
    out, i, odd = [], 0, (len(audit) - audit.count("D")) % 2
    for letter in audit:
        role = "assistant" if (len(out) - odd) % 2 else "user"
        if letter == "I":
            out.append(f"{role}:")
            continue
        if letter != "D":
            out.append(f"{turns[i][1] if letter == 'K' else role}:{turns[i][2]}")
        i += 1
    numbers = {t for t, _, _ in turns if t is not None}
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, **{x: fault.count(x) for x in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def conversations(spark, rows, folder):
    spark.createDataFrame(rows, TURN).write.parquet(f"{folder}/conversations.parquet")
    by = {}
    for row in rows:
        by.setdefault(row[0], []).append(row)
    return by


@pytest.mark.parametrize("piece", [64, 3])
def test_alignment_is_cheapest_and_least(monkeypatch, piece):
    monkeypatch.setattr(turn_repair, "PIECE", piece)
    rng = random.Random(5)
    for _ in range(600):
        turns = [(rng.choice("sua?uauaua"), rng.random() < 0.15, rng.random() < 0.15) for _ in range(rng.randrange(13))]
        given = [("x" if gone else (r.upper() if r != "?" else "!") if cut else r, 0) for r, cut, gone in turns]
        want = cheapest(tuple(turns))
        assert turn_repair._best(turn_repair.ways(given, True)) == want
        assert turn_repair._best(turn_repair.ways(given, False)) == want


def test_repair_query_on_tables(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").orderBy("conv_id", "turn").collect()]
    by = {}
    for row in rows:
        by.setdefault(row[0], []).append(row)
    got = {r["conv_id"]: r.asDict() for r in registry.QUERIES["op11_turn_repair"](spark, folder).collect()}
    assert got == {c: {"conv_id": c, **brute(mine)} for c, mine in by.items()}


def test_repair_of_odd_and_long_conversations(spark, tmp_path):
    rng = random.Random(7)
    texts = [None, "", " \n", "Yes.", "Yes.", "No", "Why?", "漢字。", "x" * 5000 + "!"]
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, *range(6)]), rng.choice([None, "", "user", "assistant", "system", "User", "other"]), rng.choice(texts)) for _ in range(500)]
    rows += rows[:40]
    # One conversation with a third of all rows, and one with repeated rows only.
    rows += [(99, k // 2, rng.choice(["user", "assistant", "assistant"]), rng.choice([f"turn {k}.", f"turn {k}", "again."])) for k in range(300)]
    rows += [(98, 1, "user", "again and again.")] * 120
    by = conversations(spark, rows, tmp_path)
    got = {r["conv_id"]: r.asDict() for r in registry.QUERIES["op11_turn_repair"](spark, str(tmp_path)).collect()}
    assert set(got) == set(by)
    for conv, mine in by.items():
        assert got[conv] == {"conv_id": conv, **brute(mine)}, conv


def test_hot_conversation_spreads_over_slices(spark):
    turns = spark.range(6000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = turn_repair._pieces(turn_repair._light(turns, F.lit(1))).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(pieces) > 4 and max(p["numbers"] for p in pieces) < 3000
    whole = turn_repair._combined(1, [p.asDict(recursive=True) for p in sorted(pieces, key=lambda p: p["slice"])])
    assert (whole["cost"], whole["audit"]) == turn_repair._best(turn_repair.ways([("u" if k % 3 == 0 else "a", 0) for k in range(6000)], True))


def test_repaired_turns_keep_extra_rows_apart(spark):
    rows = [(1, 0, "assistant", "A."), (1, 1, "user", "B."), (2, 0, "user", ""), (2, 1, "user", "")]
    turns = spark.createDataFrame(rows, TURN).withColumns({c: F.lit("!") for c in ("key", "mark", "copies", "code", "audit", "slice", "place", "_conv")})
    found = turn_repair.audits(turns)
    assert {(r["conv_id"], r["cost"], r["audit"]) for r in found.collect()} == {(1, 2, "RR"), (2, 4, "DD")}
    assert [tuple(r) for r in turn_repair.repaired(turns, found).orderBy("place").collect()] == [(1, 0, "R", "user", "A."), (1, 1, "R", "assistant", "B.")]


@pytest.fixture(scope="module")
def ranks():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}), byte_pairs.BytePairs(path, public_tokenizers.PATTERN)


def odd_texts():
    rng = random.Random(1)
    wide = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(4000))
    return ["", " ", "\n\n  x", "a" * 3000, "=-" * 2000, "漢字かな交じり文" * 300, wide, "don't I'LL 12345 ①½ é́", "   x　", "\x00\x1f\x85 y", "<|endoftext|>", *[t or "" for _, t in odd_rows()]]


def test_byte_pairs_equal_the_library(ranks):
    library, coder = ranks
    texts = odd_texts()
    ids, offsets = coder.encode(texts)
    for k, t in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == library.encode_ordinary(t)
        assert coder.decode(library.encode_ordinary(t)) == t.encode()


def test_every_way_through_the_buckets(ranks, monkeypatch):
    library, coder = ranks
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeinorst") for _ in range(n)) for n in range(1, merges.LONG + 40) for _ in range(2)]
    flat, length = coder.merge([w.encode() for w in words])
    parts = np.split(flat, np.cumsum(length)[:-1])
    for w, p in zip(words, parts):
        if w.encode() not in coder.token:
            assert p.tolist() == library.encode_ordinary(w)
    monkeypatch.setattr(byte_pairs, "WORDS_AT_ONCE", 50)
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 20)
    text = " ".join(words[:300])
    assert coder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_byte_pairs_query(spark, folder, ranks):
    library, _ = ranks
    got = {r["doc_id"]: r.asDict() for r in queries_tokens.op12_byte_pairs(spark, folder).collect()}
    for doc_id, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        assert got.pop(doc_id) == {
            "doc_id": doc_id, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256((text or "").encode()).hexdigest(),
        }
    assert not got


def test_byte_pairs_on_odd_rows(spark, ranks):
    library, _ = ranks
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_pairs.encode(clashing(frame(spark, odd_rows())), path, public_tokenizers.PATTERN)
    back = byte_pairs.decode(coded, path, public_tokenizers.PATTERN).collect()
    key = lambda x: (str(x[0]), x[1])
    assert sorted(((r["doc_id"], r["bytes"].decode()) for r in back), key=key) == sorted(((i, t or "") for i, t in odd_rows()), key=key)


def dense(matrix):
    """n, deviations, projections and shares by an eigensolver of the whole covariance."""
    x = np.floor(matrix * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    off = ((x - s // n) - (s % n) / n)
    v = off.T @ off / n
    value, vector = np.linalg.eigh(v)
    value, vector = value[::-1], vector[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), off @ vector / np.sqrt(np.maximum(value, 1e-300)), value / np.trace(v)


def holds(rows, matrix, ids, components):
    n, deviation, whitened, share = dense(matrix)
    got = {}
    for r in rows:
        got.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(got) == list(range(1, components + 1))
    for c, mine in got.items():
        one = np.array([mine[i]["whitened"] for i in ids])
        want = whitened[:, c - 1] * np.sign(one @ whitened[:, c - 1])
        assert np.abs(one - want).max() < 1e-9
        assert [mine[i]["deviation"] for i in ids] == deviation.tolist()
        assert all(m["n"] == n and abs(m["explained"] / share[c - 1] - 1) < 1e-9 and m["identity_error"] < 1e-9 for m in mine.values())


def test_whitening_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    matrix = np.array([r["embedding"] for r in rows], np.float64)
    holds(queries_vectors.op13_whitening(spark, folder).collect(), matrix, [r["vec_id"] for r in rows], 32)


def test_filter_finds_few_components_of_many(spark):
    rng = np.random.default_rng(4)
    matrix = (rng.standard_normal((400, 90)) * np.linspace(3, 0.2, 90)) @ np.linalg.qr(rng.standard_normal((90, 90)))[0]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id bigint, embedding array<double>").repartition(5)
    blocks, d = whitening.packed(vectors)
    model = whitening.fit(blocks, d, 5)
    assert d == 90 and model.passes > 10 and model.residual < 1e-12  # a block of 29 columns needs the filter
    holds(whitening.whiten(vectors, 5).collect(), matrix, list(range(400)), 5)


def test_whitening_of_odd_vectors(spark):
    kind = "vec_id bigint, embedding array<double>, label int, key string, entries string, x string"
    rng = np.random.default_rng(1)
    good = [[float(v) for v in rng.integers(-9, 9, 3)] for _ in range(40)]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 1.0], [float("inf"), 0.0, 1.0], [1.0, 2.0]]
    rows = [(i, v, 0, "k", "e", "x") for i, v in enumerate(good + bad)] + [(0, good[0], 0, "k", "e", "x"), (None, good[1], 1, "k", "e", "x")]
    got = whitening.whiten(spark.createDataFrame(rows, kind), 32).collect()
    assert len(got) == 42 * 3 and {r["n"] for r in got} == {42} and {r["vec_id"] for r in got} == {None, *range(40)}
    assert dense(np.array(good + good[:2]))[1].tolist()[:40] == [next(r["deviation"] for r in got if r["vec_id"] == i) for i in range(40)]
    # Without variance nothing can be whitened; huge entries don't overflow.
    assert whitening.whiten(spark.createDataFrame(rows[:1] * 3, kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id bigint, embedding array<double>")).collect()
    assert {(r["vec_id"], r["deviation"]) for r in huge} == {(1, None), (2, None), (3, 576**2)}
