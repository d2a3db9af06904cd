"""Dedup operators against brute force, at limits low enough for their rare paths."""

import hashlib
import itertools
import random
import re

from llm.common import frame, lower, odd_rows, roots, variants, words
from merchlens.llm import components, exact_dedup, line_dedup, minhash, queries_dedup, substring_dedup


def test_fingerprints_compose():
    import numpy as np

    rng = random.Random(3)
    data = bytes(rng.randrange(256) for _ in range(3000))
    base, prime = exact_dedup.BASES[0], exact_dedup.PRIME
    plain = sum((b + 1) * pow(base, i, prime) for i, b in enumerate(data)) % prime
    whole = exact_dedup.fingerprints(np.frombuffer(data, np.uint8), np.array([0, 3000]), base, chunk=64)
    assert whole[0] == plain
    cut = [exact_dedup.fingerprints(np.frombuffer(p, np.uint8), np.array([0, len(p)]), base)[0] for p in (data[:777], data[777:])]
    assert exact_dedup.combine((int(cut[0]), 777), (int(cut[1]), 2223), base) == (plain, 3000)


def exact_truth(rows):
    return [re.sub("[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]


def test_exact_dedup_with_colliding_fingerprints(spark):
    rng = random.Random(5)
    rows = odd_rows() + [(100 + i, rng.choice(["aa", "bb", "ab", "a b", "a\tb", "ba"]) * rng.randint(1, 2)) for i in range(60)]
    norm = exact_truth(rows)
    for prime in (exact_dedup.PRIME, 3):  # 3: nearly all texts of a length collide
        got = exact_dedup.dedup(frame(spark, rows), prime).collect()
        assert len(got) == len(rows)
        by = {}
        for (i, _), t in zip(rows, norm):
            by.setdefault(t, []).append(i)
        want = {hashlib.sha256(t.encode()).hexdigest(): (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in by.items()}
        assert all((r.keep_id, r.group_size) == want[r.text_sha256] for r in got)
        assert sum(r.kept for r in got) == len(by)
        kept = exact_dedup.keep_first(frame(spark, rows)).collect()
        assert len(kept) == len(by)


def test_substring_dedup_with_hot_minimisers(spark):
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(20)]
    rows = odd_rows()[:12]
    for i in range(40):
        w = [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(30)]
        if i % 3 == 0:
            w[10:10] = passage
        rows.append((200 + i, " ".join(w) if i % 7 else "same same same same same same same same same same same same"))
    window = 8
    count = {}
    every = [words(t) for _, t in rows]
    for w in every:
        for k in range(len(w) - window + 1):
            count[tuple(w[k : k + window])] = count.get(tuple(w[k : k + window]), 0) + 1
    want = []
    for (i, _), w in zip(rows, every):
        gone = {j for k in range(len(w) - window + 1) if count[tuple(w[k : k + window])] > 1 for j in range(k, k + window)}
        want.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    for hot in (substring_dedup.HOT, 2):
        got = [tuple(r) for r in substring_dedup.dedup(frame(spark, rows), window, hot).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_colliding_word_hashes_do_not_count():
    import pyarrow as pa
    from merchlens.llm.text import words_of

    w = words_of(pa.array(["a b c d", "a b c e"]))
    w.hash[:] = 1  # every word collides
    assert substring_dedup.exact_ids(w).tolist() == [0, 1, 2, 3, 0, 1, 2, 4]
    assert substring_dedup.repeated_windows(w, 3).tolist() == [0, 4]


def test_line_dedup(spark):
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))) for i in range(60)] + [(100, None), (101, ""), (None, "a\nb\nc"), (102, "x\ny\nz\nx\ny\nz")]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    for least in (1, 2, 3, 5):
        seen, want = set(), []
        for i, t in order:
            lines = [] if t is None else t.split("\n")
            gone = set()
            for k in range(len(lines) - least + 1):
                run = tuple(lines[k : k + least])
                if run in seen:
                    gone |= set(range(k, k + least))
                seen.add(run)
            want.append((i, len(lines), sorted(gone)))
        got = [(r.doc_id, r.n_lines, list(r.removed)) for r in line_dedup.marks(frame(spark, rows), least).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), least
    texts = {r.doc_id: r.text for r in line_dedup.dedup(frame(spark, rows), 3).collect()}
    assert texts[102] == "x\ny\nz" and texts[100] is None


def test_repeated_lines_without_repeated_neighbours(spark):
    long, other, short = "one two three four five six seven eight", "a b  c d e f g\th i", "too short to count"
    rows = [(1, long), (2, long), (3, f"x1\n{long}\ny1"), (4, f"{short}\nx2"), (5, f"x3\n{short}"), (6, f"x4\n\n{other}\n{other}"), (7, f"p\nq\n\n{other}"), (8, "p\nq\nx5"), (None, other), (9, None)]
    got = {r.doc_id: list(r.removed) for r in line_dedup.marks(frame(spark, rows), 2, 8).collect()}
    # 8: two short lines are a run together; 4 and 5: one short line is none.
    assert got == {1: [], 2: [0], 3: [1], 4: [], 5: [], 6: [3], 7: [2, 3], 8: [0, 1], None: [0], 9: []}
    assert line_dedup.dedup(frame(spark, rows), 2, 8).where("doc_id = 3").first().text == "x1\ny1"


def test_op4_removes_later_copies_of_long_lines(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    gone = {r.doc_id: {int(x) for x in r.removed.split(",") if x} for r in queries_dedup.op4_line_dedup(spark, folder).collect()}
    seen, lines = set(), {i: docs[i].split("\n") for i in sorted(docs) if docs[i] is not None}
    for i, own in lines.items():
        for n, line in enumerate(own):
            if len(words(line)) >= 8:
                assert (n in gone[i]) == (line in seen), (i, n)
            seen.add(line)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 299), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = roots({x for l in links for x in l}, links)
    assert got == {n: r for n, r in want.items()}


def shingles(text, n):
    w = words(lower(text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)  # many blocks in a bucket
    base = [f"w{i}" for i in range(90)]
    other = [f"v{i}" for i in range(40)]
    texts = variants(base, 120, 1) + variants(other, 20, 2, 0.1) + [" ".join(base), "Solo", "solo", "", "two words", None]
    rows = list(enumerate(texts)) + [(None, " ".join(base))]
    for n in (2, 5):
        sets = {i: shingles(t, n) for i, t in rows if i is not None}
        links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and sets[a] and sets[b]]
        want = roots(sets, links)
        got = minhash.near_duplicates(frame(spark, rows), n).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in got if r.doc_id is not None} == {i: (want[i], len(sets[i]), want[i] == i) for i in sets}
        assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_near_duplicates_of_rows_that_share_an_id(spark):
    import corpus_pipeline
    from llm.common import clashing

    base, other = [f"w{i}" for i in range(90)], " ".join(f"v{i}" for i in range(50))
    near = " ".join(base[:-1] + ["zz"])
    rows = [(20, " ".join(base)), (21, near), (21, other), (21, other), (30, other)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect())
    assert got == [(20, 86, 20, True), (21, 46, 21, True), (21, 46, 21, True), (21, 86, 20, False), (30, 46, 21, False)]
    left = corpus_pipeline.drop_near_copies(spark, clashing(frame(spark, rows)), "").collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted([rows[0], rows[2], rows[3]])


def test_huge_texts_are_hashed_in_parts(spark, monkeypatch):
    rng = random.Random(8)
    long = ["".join(rng.choice("abc dé漢") for _ in range(n)) for n in (700, 1000, 1024, 3000)]
    rows = [(k, t) for k, t in enumerate(long + long[::-1] + [long[3][:-1] + "x", "", None])] + [(3, long[3])] * 30 + [(None, long[1])] * 25
    for size in (1 << 20, 64):
        monkeypatch.setattr(exact_dedup, "PART", size)
        monkeypatch.setattr(exact_dedup, "COMPARED", size)
        monkeypatch.setattr(exact_dedup, "COPIES", 1 << 12 if size > 64 else 7)
        prints = {(r["doc_id"], r["text_sha256"]): (r["fp1"], r["fp2"], r["n_bytes"], r["repeated"]) for r in exact_dedup.fingerprinted(frame(spark, rows)).collect()}
        if size > 64:
            whole = prints
        assert prints == whole
        got = exact_dedup.dedup(frame(spark, rows)).collect()
        key = lambda t: " ".join(re.split("[\x20\x09-\x0D]+", t or ""))
        of = {}
        for i, t in rows:
            of.setdefault(key(t), []).append(i)
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["keep_id"], r["group_size"]) for r in got) == sorted((i is None, i or 0, min(j for j in of[key(t)] if j is not None), len(of[key(t)])) for i, t in rows)
        assert sum(r["kept"] for r in got) == len(of)


def test_only_members_with_a_likely_partner_need_their_sets():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(8)
    sketch = rng.integers(0, 256, (6, minhash.HASHES), dtype=np.uint8)
    bands = np.tile(np.arange(minhash.BANDS), (6, 1)) + 1000 * np.arange(6)[:, None]
    bands[:, 7] = 77  # the bucket, the first band that members share
    sketch[4], sketch[3] = sketch[1], sketch[2]
    bands[[2, 3], 0] = 5  # these two share an earlier band, so another bucket has them
    table = pa.table({
        "bucket": [77] * 6, "i": [0] * 6, "j": [0] * 6, "single": [True] * 6, "asks": [False] + [True] * 5, "id": list(range(6)), "component": list(range(6)),
        "size": [100] * 6, "sketch": [x.tobytes() for x in sketch], "bands": bands.tolist(),
    })
    assert minhash._marked(80)(table).column("id").to_pylist() == [1, 4]
    same = table.set_column(table.column_names.index("component"), "component", pa.array([1] * 6))
    assert minhash._marked(80)(same).num_rows == 0


def test_only_rows_that_meet_another_reach_the_joins(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(300)]
    same = [f"v{k}" for k in range(80)]
    rows += [(500, " ".join(same)), (501, " ".join([*same, "end"])), (502, " ".join(["start", *same]))]
    left = []

    def counted(some, wanted, *keys, perhaps=minhash.perhaps):
        out = perhaps(some, wanted, *keys)
        asked = {tuple(r) for r in wanted.select(*keys).collect()}
        kept = {tuple(r) for r in out.select(*keys).collect()}
        assert asked <= kept and out.columns == some.columns
        left.append((len(asked), len(kept), some.count()))
        return out

    monkeypatch.setattr(minhash, "perhaps", counted)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows), words=2).collect()}
    assert {got[500], got[501], got[502]} == {500} and len(left) == 2
    assert all(asked == 3 and kept < 10 and every == 303 for asked, kept, every in left)
    none = minhash.perhaps(frame(spark, rows), frame(spark, rows).limit(0), "doc_id")
    assert none.count() == 0


def test_settled_positions_are_told_without_joins(spark):
    rows = [(i, "a\nb\nc\nd\ne\na\nb\nc") for i in range(3)] + [(7, "a\nb\nx"), (8, "a\nb\nc\ny"), (9, "z")]
    final, levels = line_dedup.suffix_ranks(frame(spark, rows))
    assert len(levels) > 2 and "Join" not in final._jdf.queryExecution().analyzed().toString()
    suffixes = {(i, n): t.split("\n")[n:] for i, t in rows for n in range(t.count("\n") + 1)}
    ranked = {(r.o, r.n): r.r for r in final.collect()}
    assert set(ranked) == {p for p, s in suffixes.items() if s[0] in "abcde"}  # each settles once
    assert all((ranked[p] == ranked[q]) == (suffixes[p] == suffixes[q]) for p in ranked for q in ranked)


def test_few_rows_make_a_small_filter(spark, tmp_path):
    from merchlens.llm import text

    assert [text.spots(n) for n in (0, 1, 512, 513, 1 << 20, 1 << 40)] == [1 << 15, 1 << 15, 1 << 15, 1 << 16, 1 << 26, 1 << 26]
    rows = [(i, f"text {i}") for i in range(2000)] + [(None, "no id")]
    docs = frame(spark, rows)
    docs.where("doc_id % 2 = 0").select("doc_id").write.parquet(f"{tmp_path}/wanted")
    wanted = spark.read.parquet(f"{tmp_path}/wanted")
    few = text.perhaps(docs, wanted, "doc_id")
    assert {r.doc_id for r in few.collect()} >= set(range(0, 2000, 2)) and few.count() < 1100
    assert "65536" in few._jdf.queryExecution().analyzed().toString()  # 1,000 rows: 2^16 bits, not 2^26
