"""License scans: fixed phrases, and notices found through a positional index of their rare words.

Words are runs of digits, letters (A-Z lower-cased) and non-ASCII characters. A base place is where the words of a phrase stand one behind
the other.

The method adds notices. The document frequency of every word of the notices is counted over all documents. Each notice is indexed
by its rarest words (highest IDF), with their places in it. A file's words are looked up there; a word at place p of the file that stands at
place j of a notice votes, with its IDF, for the notice starting at p - j. Votes that differ by at most `SLACK` places are taken
together, each place of the notice once. Where at least `COVERED` of the indexed IDF is met, the notice's key phrase must stand, word by
word, near its expected place; the share of the notice's whole IDF that is met there is the coverage.

Nulls: a null text is an empty text without words. Rows with a null doc_id are scanned like others. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Words, prepare, separators, slices, words_of

BETWEEN = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
INDEXED, COVERED, SLACK = 8, 0.75, 3
# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Label, notice, key phrase that must stand in it.
NOTICES = [
    ("gpl", "licensed under the GNU General Public License version 3", "gnu general public license"),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gnu general public license"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gnu lesser general public license"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "gnu affero general public license"),
    ("apache-2.0", "Licensed under the Apache License Version 2.0", "apache license version 2 0"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License", "mozilla public license"),
    ("cc-by", "Licensed under CC BY 4.0", "cc by 4 0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution 4 0"),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication", "cc0 1 0 universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "free and unencumbered software"),
]


def file_words(column: pa.Array) -> Words:
    return words_of(column, lower=True, between=BETWEEN)


def _split(text: str) -> list[str]:
    w = file_words(pa.array([text]))
    return [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end)]


VOCABULARY = sorted({w for _, notice, _ in NOTICES for w in _split(notice)} | {w for p in PHRASES for w in p.split()} | {w for _, _, key in NOTICES for w in key.split()})


def _numbered(w: Words) -> np.ndarray:
    """Number of every word in VOCABULARY, -1 for others; equal hashes are checked byte by byte."""
    known = file_words(pa.array([" ".join(VOCABULARY)]))
    by = np.argsort(known.hash)
    at = by[np.minimum(np.searchsorted(known.hash[by], w.hash), len(by) - 1)]
    out = np.full(len(w.hash), -1, np.int32)
    for i in np.flatnonzero(known.hash[at] == w.hash).tolist():
        j = at[i]
        if bytes(w.data[w.start[i] : w.end[i]]) == bytes(known.data[known.start[j] : known.end[j]]):
            out[i] = j
    return out


@dataclass
class Index:
    """idf by VOCABULARY number; postings: word -> (notice, place); need: IDF to be met for each notice."""

    idf: list[float]
    notices: list[tuple[str, list[int], list[int]]]  # label, words, key phrase
    postings: dict[int, list[tuple[int, int]]]
    need: list[float]


def build(frequency: dict[str, int], documents: int) -> Index:
    number = {w: i for i, w in enumerate(VOCABULARY)}
    idf = [math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 0.01 for w in VOCABULARY]
    notices = [(label, [number[w] for w in _split(notice)], [number[w] for w in key.split()]) for label, notice, key in NOTICES]
    postings, need = defaultdict(list), []
    for t, (_, words, _) in enumerate(notices):
        rare = sorted(range(len(words)), key=lambda j: (-idf[words[j]], j))[: min(INDEXED, -(-len(words) * 3 // 5))]
        for j in rare:
            postings[words[j]].append((t, j))
        need.append(COVERED * sum(idf[words[j]] for j in rare))
    return Index(idf, notices, dict(postings), need)


def count(docs: DataFrame) -> tuple[dict[str, int], int]:
    """Document frequency of every word of VOCABULARY, and the number of documents."""
    prepare(docs.sparkSession)

    def run(batches):
        total = np.zeros(len(VOCABULARY) + 1, np.int64)
        for part in slices(batches, "text"):
            w = file_words(part.column("text"))
            word, doc = _numbered(w), w.doc
            seen = np.unique(doc[word >= 0] * len(VOCABULARY) + word[word >= 0]) % len(VOCABULARY)
            total[:-1] += np.bincount(seen, minlength=len(VOCABULARY))
            total[-1] += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}  # as many rows as VOCABULARY has words
    return {w: found.get(i, 0) for i, w in enumerate(VOCABULARY)}, found.get(len(VOCABULARY), 0)


def notices_in(index: Index, places: list[int], words: list[int], length: int) -> list[tuple[str, int, int, float]]:
    """(label, start, end, coverage) of the notices in one file, given the places of its VOCABULARY words."""
    at = dict(zip(places, words))
    votes: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for p, w in zip(places, words):
        for t, j in index.postings.get(w, ()):
            votes[t].append((p - j, j, w))
    out = []
    for t, cast in votes.items():
        label, notice, key = index.notices[t]
        cast.sort()
        low = 0
        best: tuple[float, int] | None = None
        spans = []
        for high in range(len(cast)):
            while cast[high][0] - cast[low][0] > SLACK:
                low += 1
            met = {j: w for _, j, w in cast[low : high + 1]}
            weight = sum(index.idf[w] for w in met.values())
            if weight >= index.need[t]:
                if best and cast[high][0] - best[1] > len(notice):
                    spans.append(best)
                    best = None
                if best is None or weight > best[0]:
                    best = (weight, cast[low][0])
        if best:
            spans.append(best)
        for _, shift in spans:
            expected = next(i for i in range(len(notice)) if notice[i : i + len(key)] == key)
            around = range(max(0, shift + expected - SLACK), shift + expected + 2 * SLACK + 1)
            if any(all(at.get(p + i) == k for i, k in enumerate(key)) for p in around):
                met = sum(index.idf[w] for j, w in enumerate(notice) if any(at.get(shift + j + d) == w for d in range(SLACK + 1)))
                total = sum(index.idf[w] for w in notice)
                out.append((label, max(0, shift), min(length, shift + len(notice)), min(1.0, met / total)))
    return sorted(out, key=lambda x: (x[1], x[0]))


def scan(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, n_words, base, notices): base has (label, start) of phrases, notices has (label, start, end, coverage); places count words."""
    prepare(docs.sparkSession)
    number = {w: i for i, w in enumerate(VOCABULARY)}
    phrases = [([number[w] for w in p.split()], label) for p, label in PHRASES.items()]
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))

    def run(batches):
        for part in slices(batches, "text"):
            w = file_words(part.column("text"))
            word = _numbered(w)
            some = np.flatnonzero(word >= 0)
            cut = np.searchsorted(some, w.first)
            base, notices = [], []
            for d in range(part.num_rows):
                here = some[cut[d] : cut[d + 1]]
                places, words = (here - w.first[d]).tolist(), word[here].tolist()
                at = dict(zip(places, words))
                base.append([{"label": label, "start": p} for p in places for ws, label in phrases if all(at.get(p + i) == k for i, k in enumerate(ws))])
                found = notices_in(index, places, words, int(w.first[d + 1] - w.first[d]))
                notices.append([{"label": a, "start": b, "end": c, "coverage": v} for a, b, c, v in found])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(w.first)), pa.array(base, place), pa.array(notices, span)], ["doc_id", "n_words", "base", "notices"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, base array<struct<label:string,start:bigint>>, notices array<struct<label:string,start:bigint,end:bigint,coverage:double>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
