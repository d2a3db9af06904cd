"""The tokenizer against its library, language-model scores against brute force, the classifier against held-out rows, the pipeline as a whole."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from llm.common import frame, lower, odd_rows, roots, words
from merchlens.llm import interpolation, queries_tokens, sentence_pieces, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts():
    rng = random.Random(2)
    alphabet = list(" ▁ aabbc theinger\n\t\r\x00éèñ①漢字あ👍🏽́<s>/▁▁  0123..,,--==__((")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [" " * k + x for k in range(1, 60) for x in ("", "a", "①"," ", "the")]
    return texts + ["a" * 600, "hellohellohello" * 40, "ababab" * 300, "=" * 77, " " * 5000 + "x", "</s><s><0x41>", "", None] + [t for _, t in odd_rows()]


def test_pieces_equal_the_library(library):
    coder, texts = sentence_pieces.Pieces(MODEL), odd_texts()
    ids, offsets = coder.encode(pa.array(texts, pa.string()))
    want = [library.encode(t or "", add_eos=True) for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want
    assert [coder.decode(w) for w in want] == [library.decode(w) for w in want]
    coder.run = 0  # without the shortcut for runs of spaces
    coder.begin()
    some = [t for t in texts if t is None or len(t) < 200]
    ids, offsets = coder.encode(pa.array(some, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode(t or "", add_eos=True) for t in some]


def test_any_ids_decode_like_the_library(library):
    rng, coder = random.Random(6), sentence_pieces.Pieces(MODEL)
    for _ in range(2000):
        ids = [rng.randrange(0, 400) for _ in range(rng.randint(0, 8))]
        assert coder.decode(ids) == library.decode(ids)


def test_encoding_in_spark(spark, library):
    import hashlib

    rows = odd_rows()
    got = queries_tokens.digests(sentence_pieces.encode(frame(spark, rows), MODEL)).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, got)) == want


@pytest.mark.parametrize("per_partition", [interpolation.PER_PARTITION, 2])  # 2: far more partitions than distinct words
def test_interpolation_against_brute_force(spark, monkeypatch, per_partition):
    monkeypatch.setattr(interpolation, "PER_PARTITION", per_partition)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["the", "a", "Of", "x", "yÉ", "z"]) + rng.choice(["", "", "1"]) for _ in range(rng.randint(0, 40)))) for i in range(120)] + [(500, None)]
    monkeypatch.setattr(interpolation, "BLOCK_BYTES", 600)  # many blocks
    weights = {}

    def remember(table, weigh=interpolation.weigh):
        weights["w"], weights["table"] = weigh(table), table
        return weights["w"]

    monkeypatch.setattr(interpolation, "weigh", remember)
    got = {r.doc_id: r for r in interpolation.score(frame(spark, rows)).collect()}
    tokens = {i: [*words(lower(t or "")), None] for i, t in rows}
    part = {i: zlib.crc32(str(i).encode()) % 7 for i in tokens}
    one, two = collections.Counter(), collections.Counter()
    for i, w in tokens.items():
        if part[i] != 2:
            one.update(w)
            two.update(zip(["<", *w], w))
    total, types = sum(one.values()), len(one)
    seen = lambda h, c=one: c[None] if h == "<" else c[h]
    for i, w in tokens.items():
        base = sum(math.log10((one[x] + 1) / (total + types + 1)) for x in w)
        score = 0.0
        for h, x in zip(["<", *w], w):
            a, b, c = weights["w"][int(interpolation._bucket(np.array([seen(h)]))[0])]
            score += math.log10(a * (two[h, x] / seen(h) if seen(h) else 0) + b * one[x] / total + c / (types + 1))
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.part) == (len(w), sum(one[x] > 0 for x in w), total, part[i])
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    # The held-out table: every token of its documents once, with the document's own counts deleted.
    held = [i for i in tokens if part[i] == interpolation.HELD]
    want = collections.Counter()
    for i in held:
        w, own, pairs = tokens[i], collections.Counter(tokens[i]), collections.Counter(zip(["<", *tokens[i]], tokens[i]))
        for h, x in zip(["<", *w], w):
            context = seen(h) - seen(h, own)
            second = (two[h, x] - pairs[h, x]) / context if context else 0
            first = (one[x] - own[x]) / (total - len(w))
            levels = interpolation._bin(np.array([second, first]) * (types + 1)).tolist()
            want[(int(interpolation._bucket(np.array([context]))[0]), *levels)] += 1
    assert {tuple(r[:3]): r[3] for r in weights["table"].tolist()} == dict(want)


def test_messages_of_a_block_are_bounded_by_its_words(spark):
    rows = [(i, f"the of w{i % 50} x{i}") for i in range(400)]
    packed = interpolation.blocks(frame(spark, rows).repartition(4)).cache()
    distinct = {}
    for r in packed.collect():
        t = interpolation.tokens_of(np.array(r["size"], np.int64), r["blob"])
        distinct[r["block"]] = len(t.words) + len(t.pairs)
    for log_parts in (0, 3, 8, 20, 30):
        asked = interpolation.questions(packed, log_parts).collect()
        sent = collections.Counter(r["block"] for r in asked)
        assert set(sent) == set(distinct) and all(n <= min(distinct[b], 1 << log_parts) for b, n in sent.items())
        assert sum(r["nw"] + r["np"] for r in asked) == sum(distinct.values())


def test_frequent_contexts_have_buckets_of_their_own():
    context = 2 ** np.arange(63, dtype=np.int64)
    assert interpolation._bucket(np.r_[0, context]).tolist() == list(range(64))


def test_weights_by_expectation_maximisation():
    table = np.array([[3, 60, 0, 900], [3, 0, 50, 100], [5, 0, 0, 10]])
    w = interpolation.weigh(table)
    assert np.allclose(w.sum(axis=1), 1) and w[3, 0] > 0.8 and w[3, 1] > 0.05 and w[5, 2] > 0.99 and np.allclose(w[4], w[3])


def planted(seed, n):
    rng = random.Random(seed)
    common = [a + b for a in ("the", "an", "re", "st", "on", "ti") for b in ("", "er", "ing", "ed", "ou", "ha")]
    bad = ["idiot", "moron", "scum", *("grub" + x for x in ("le", "ly", "est", "ish", "ous", "ing", "ed", "er"))]
    texts, toxic = [], []
    for _ in range(n):
        w = [rng.choice(common) for _ in range(rng.randint(5, 120))]
        y = rng.random() < 0.3
        for _ in range(3 * y):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts.append(" ".join(w))
        toxic.append(int(y))
    return texts, np.array(toxic)


def test_classifier_on_held_out_rows():
    texts, toxic = planted(1, 900)
    model = toxicity.fit(texts[:700], toxic[:700], epochs=6)
    got = toxicity.logits(model, pa.array(texts[700:]))[0] >= 0
    assert (got == toxic[700:]).mean() > 0.97
    unseen = pa.array(["the an er grubbier on stha the ti", "", "the an er on stha the ti", None])
    scores = toxicity.logits(model, unseen)[0]
    assert scores[0] > 0 > scores[2] and np.isfinite(scores).all() and scores[1] == scores[3]
    # A text's score does not depend on its neighbours.
    alone = [toxicity.logits(model, pa.array([t]))[0][0] for t in texts[:20]]
    assert np.allclose(alone, toxicity.logits(model, pa.array(texts[:20]))[0], atol=1e-4)


def test_sample_is_bounded_and_never_held_out(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(300)])
    labels = spark.createDataFrame([(i, 1, i % 3 // 2) for i in range(300)], "doc_id bigint, quality int, toxic int")
    texts, toxic, weight = toxicity.sample(docs, labels, per_label=30)
    assert np.bincount(toxic).tolist() == [30, 30]
    able = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    assert all(int(t.split()[1]) in able for t in texts.to_pylist()) and round(weight.sum()) == len(able)


def test_all_labelled_rows_are_learned_from(spark):
    """The words that tell are few in the sample's rows, and one of them stands in texts too long for it."""
    texts, toxic = planted(1, 1500)
    toxic = np.where(np.arange(1500) % 4 == 0, 1, toxic)
    texts = [t + " zorgle" * (i % 4 == 0) + " the an on" * 40 * (i % 2 == 0) for i, t in enumerate(texts)]
    docs = frame(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(toxic)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels, per_label=25, longest=600)
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 == 0]
    got = toxicity.logits(model, pa.array([texts[i] for i in held]))[0] >= 0
    assert (got == toxic[held]).mean() > 0.95
    lone = toxicity.logits(model, pa.array(["the an on thing the ti zorgle", "the an on thing the ti"]))[0]
    assert lone[0] > 0 > lone[1]
    again = toxicity.train(docs, labels, per_label=25, longest=600)
    assert (again.table == model.table).all() and (again.thresholds == model.thresholds).all()
    # Rows that all fit the sample are fitted as before.
    few, marks = docs.where("doc_id < 100"), labels.where("doc_id < 100")
    one, two = toxicity.train(few, marks), toxicity.fit(*toxicity.sample(few, marks))
    assert (one.table == two.table).all() and (one.thresholds == two.thresholds).all()


def test_thresholds_count_every_row_set_apart(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(toxicity, "_best_threshold", lambda logit, toxic, weight, best=toxicity._best_threshold: counted.append(weight.sum()) or best(logit, toxic, weight))
    texts, toxic = planted(2, 600)
    docs = frame(spark, list(enumerate(texts)))
    toxicity.train(docs, spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(toxic)], "doc_id bigint, quality int, toxic int"), per_label=20)
    apart = docs.where(~toxicity.held_out() & toxicity._apart()).count()
    assert counted[0] == apart > 50


def test_pipeline_against_brute_force(spark, folder):
    """Every decision again, outside Spark, on the classifier's own scores."""
    import re

    import corpus_pipeline

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    toxic = {r.doc_id for r in toxicity.score(spark.read.parquet(f"{folder}/documents.parquet"), toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))).where("predicted = 1").collect()}
    left = {i: t for i, t in docs.items() if i not in toxic}
    first = {}
    for i in sorted(left):
        first.setdefault(re.sub("[\x20\x09-\x0D]+", " ", left[i] or ""), i)
    left = {i: left[i] for i in first.values()}
    sets = {}
    for i, t in left.items():
        w = words(lower(t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = roots(sets, links)
    left = {i: t for i, t in left.items() if root[i] == i}
    token = re.compile(r"[^\W_]+")
    grams = [token.findall(x.lower()) for x in items]

    def leaked(text):
        w = token.findall((text or "").lower())
        for g in grams:
            n = min(20, len(g))
            for s in range(len(g) - n + 1):
                for k in range(len(w) - n + 1):
                    if w[k] == g[s] or w[k + 1] == g[s + 1] or w[k + 2] == g[s + 2]:
                        if 100 * sum(x == y for x, y in zip(w[k : k + n], g[s : s + n])) >= 80 * n:
                            return True
        return False

    left = {i: t for i, t in left.items() if not leaked(t)}
    got = {r.doc_id: (list(r.ids), r.text) for r in corpus_pipeline.run(spark, folder).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert got == {i: (library.encode(t or "", add_eos=True), t or "") for i, t in left.items()}
