"""Small frames and brute-force helpers of these tests."""

import random
import re
import string

BLANK = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return BLANK.findall(text or "")


def frame(spark, rows):
    """Documents from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, odd characters."""
    long = " ".join(f"w{i % 997} x{i % 31}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (5, "one"), (None, "no id"), (None, None), (6, long), (7, long + " tail"),
        (8, "Ünïcode ①漢字 👍🏽 \x00 end"), (9, "a\r\nb\n\nc\n"), (10, "a  b   c"), (11, "a b c"), (11, "another text with the same id"), (12, "x" * 5000),
    ]


def clashing(docs):
    """The same documents with extra columns named like columns that operators use inside."""
    from pyspark.sql import functions as F

    names = ["id", "n", "k", "o", "a", "b", "k1", "k2", "bucket", "score", "predicted", "seed", "at", "_id", "_k", "_key", "_digest", "_gone", "_leaked", "kept", "component", "_toxic", "_toxicity", "toxic", "digest", "_removed", "_gone_text", "removed", "text_key", "tok", "spans", "block", "part", "size"]
    return docs.select("*", *[F.lit(f"{c}!").alias(c) for c in names])


def variants(base, count, seed, most=0.2):
    """Copies of a list of words with some of them replaced."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(int(len(w) * rng.random() * most)):
            w[rng.randrange(len(w))] = "".join(rng.choices(string.ascii_lowercase, k=6))
        out.append(" ".join(w))
    return out


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
