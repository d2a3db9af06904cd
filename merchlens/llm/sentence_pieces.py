"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

The merges run in numpy over all new words of a slice at once: symbols lie in one flat array; each round looks up the rank of every
neighbouring pair, takes the smallest rank of each word, merges all its leftmost non-overlapping occurrences and compacts, until no word
has a pair left. That equals the library's one-merge-at-a-time order except where a merged symbol could at once take part in a pair
of equal or better rank; the model tells which symbols these are, and words at such a pair merge only its leftmost occurrence in that round.

Words end before a space mark, which no piece contains behind another character, so words are encoded on their own and remembered in a
bounded table. A word beyond merges.LONG characters, as in text without spaces, would need as many rounds as it has distinct ranks, each over all
of it; it is merged by a heap in the same order. Runs of space marks are cut by length: their pieces rank behind all others, so they merge last and from the left.

A null text is an empty text: it has the end id only. Other columns are not read. The model's path is a parameter.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from .merges import LONG, NONE, PairTable, merge_long
from .text import prepare, slices

SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
REMEMBERED, REMEMBERED_CHARS = 150_000, 4 << 20  # words that a worker keeps encoded, and their characters


class Pieces:
    """Vocabulary, pair ranks and the encoder of one model file."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.end = sp.vocab_size(), sp.eos_id()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(self.size)]
        if any(sp.is_unused(i) for i in range(self.size)) or sp.encode("① a")[0] != sp.piece_to_id(SPACE):
            raise ValueError("only BPE models without unused pieces and with identity normalisation are supported")
        self.id = {n: i for i, n in enumerate(names) if not special[i]}
        if any(SPACE in n.lstrip(SPACE) for n in self.id):
            raise ValueError("a piece holds a space mark behind another character")
        self.byte = {int(n[1:-1], 16): i for i, n in enumerate(names) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.control = frozenset(i for i in range(self.size) if sp.is_control(i))
        scores = {n: sp.get_score(i) for n, i in self.id.items()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        found = [(self.id[n[:k]] * self.size + self.id[n[k:]], order[scores[n]], i) for n, i in self.id.items() for k in range(1, len(n)) if n[:k] in self.id and n[k:] in self.id]
        keys, rank, merged = (np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        self.pairs = PairTable(keys, rank.astype(np.int32), merged.astype(np.int32))
        # The best rank at which a piece takes part in a merge; not safe if that is not behind the piece's own rank.
        best = np.full(self.size, NONE, np.int64)
        np.minimum.at(best, keys // self.size, rank)
        np.minimum.at(best, keys % self.size, rank)
        own = np.full(self.size, -1, np.int64)
        for n, i in self.id.items():
            own[i] = order[scores[n]]
        self.safe = best > own
        self.char = np.full(0x110000, -1, np.int64)
        for n, i in self.id.items():
            if len(n) == 1:
                self.char[ord(n)] = i
        # Runs of space marks rank behind all other merges, so they are cut from the left into the longest piece and a rest.
        runs = [n for n in self.id if not n.strip(SPACE) and len(n) > 1]
        others = max((r for n, s in scores.items() if n.strip(SPACE) and len(n) > 1 for r in [order[s]]), default=-1)
        alone = all(order[scores[n]] > others for n in runs) and not any(n.startswith(SPACE * 2) and n.strip(SPACE) for n in self.id)
        self.run, longest = 0, max(map(len, runs), default=0)  # 0: runs are merged like other words
        if longest and alone:
            self.rest = [np.zeros(0, np.int32)] + [self._merged([SPACE * k]) for k in range(1, longest)]
            whole = self.id[SPACE * longest]
            if all(self._merged([SPACE * (2 * longest + k)]).tolist() == [whole, whole, *self.rest[k].tolist()] for k in range(longest)):
                self.run = longest
        self.text = [b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else bytes([int(n[1:-1], 16)]) if sp.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.begin()

    def begin(self) -> None:
        """An empty table of words; entry 0 is the end id."""
        self.known: dict[str | None, int] = {None: 0}
        self.held = 0
        self.flat = np.array([self.end], np.int32)
        self.at, self.length = np.zeros(1, np.int64), np.ones(1, np.int64)

    def _merged(self, words: list[str]) -> np.ndarray:
        return self.merge(words)[0]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words and their number for each word; no word is empty. Words beyond LONG characters merge by a heap."""
        long = [k for k, w in enumerate(words) if len(w) > LONG]
        if long:
            short = [w for w in words if len(w) <= LONG]
            flat, times = self.merge(short) if short else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            ids = np.split(flat, np.cumsum(times)[:-1]) if short else []
            for k in long:  # in order, so the places of later ones hold
                ids.insert(k, self._long(words[k]))
            return np.concatenate(ids), np.array([len(i) for i in ids])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        length = np.array([len(w) for w in words])
        symbol = self.char[points]
        symbol = np.where(symbol < 0, -1 - points, symbol)  # a character that is no piece never merges
        word = np.repeat(np.arange(len(words)), length)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, merged = self._ranks(symbol, word)
        while len(symbol):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(word)])
            least = np.minimum.reduceat(rank, start)
            ended = least == NONE
            if ended.any():
                stay = np.repeat(~ended, size)
                done.append((symbol[~stay], word[~stay]))
                symbol, word, rank, merged = symbol[stay], word[stay], rank[stay], merged[stay]
                size, least = size[~ended], least[~ended]
                if not len(symbol):
                    break
                start = np.cumsum(size) - size
            here = np.flatnonzero(rank == np.repeat(least, size))
            fresh = np.r_[True, np.diff(here) != 1]  # overlapping occurrences: every second one
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(here)), 0))
            take = (np.arange(len(here)) - run) % 2 == 0
            unsafe = ~self.safe[merged[here]]
            if unsafe.any():
                careful = np.zeros(word[-1] + 1, bool)
                careful[word[here[unsafe]]] = True
                first = np.r_[True, word[here[1:]] != word[here[:-1]]]
                take &= first | ~careful[word[here]]
            here = here[take]
            symbol[here] = merged[here]
            stay = np.ones(len(symbol), bool)
            stay[here + 1] = False
            moved = np.cumsum(stay) - 1
            symbol, word, rank, merged = symbol[stay], word[stay], rank[stay], merged[stay]
            here = moved[here]
            near = np.zeros(len(symbol), bool)
            near[here] = near[np.maximum(here - 1, 0)] = True
            changed = np.flatnonzero(near)
            rank[changed], merged[changed] = self._ranks(symbol, word, changed)
        symbol, word = (np.concatenate(x) for x in zip(*done))
        by = np.argsort(word, kind="stable")
        return self._spell(symbol[by], np.bincount(word, minlength=len(words)))

    def _long(self, word: str) -> np.ndarray:
        """Ids of one long word, merged pair by pair."""
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbol = self.char[points]
        symbol = np.where(symbol < 0, -1 - points, symbol)
        rank, _ = self._ranks(symbol, np.zeros(len(symbol), np.int64))
        made = self.pairs.one_by_one()

        def look_up(left: int, right: int) -> tuple[int, int]:
            return made.get(left * self.size + right, (int(NONE), 0)) if left >= 0 and right >= 0 else (int(NONE), 0)

        left = np.array(merge_long(symbol.tolist(), rank.tolist(), int(NONE), look_up), np.int64)
        return self._spell(left, np.array([len(left)]))[0]

    def _ranks(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(len(symbol)) if at is None else at
        after = np.minimum(at + 1, len(symbol) - 1)
        left, right = symbol[at], symbol[after]
        pair = (at + 1 < len(symbol)) & (word[at] == word[after]) & (left >= 0) & (right >= 0)
        rank, merged = np.full(len(at), NONE, np.int32), np.zeros(len(at), np.int32)
        rank[pair], merged[pair] = self.pairs.look_up(left[pair] * self.size + right[pair])
        return rank, merged

    def _spell(self, symbol: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become byte pieces, or one unknown id for each row of them."""
        odd = np.flatnonzero(symbol < 0)
        if not len(odd):
            return symbol.astype(np.int32), length
        word = np.repeat(np.arange(len(length)), length)
        if not self.byte:
            row = (symbol < 0) & (np.r_[0, symbol[:-1]] < 0) & (word == np.r_[-1, word[:-1]])
            symbol, word = np.where(symbol < 0, self.unknown, symbol)[~row], word[~row]
            return symbol.astype(np.int32), np.bincount(word, minlength=len(length))
        spelt = [[self.byte[b] for b in chr(-1 - s).encode("utf-8", "surrogatepass")] for s in symbol[odd].tolist()]
        times = np.ones(len(symbol), np.int64)
        times[odd] = [len(x) for x in spelt]
        out = np.repeat(symbol, times)
        out[np.repeat(symbol < 0, times)] = [b for x in spelt for b in x]
        return out.astype(np.int32), np.bincount(np.repeat(word, times), minlength=len(length))

    def _learn(self, words: list[str]) -> None:
        """Encode words, given without the space mark in front, and put them into the table."""
        runs = [w for w in words if w.startswith(SPACE)] if self.run else []
        if runs:
            long = set(runs)
            words = [w for w in words if w not in long]
            cores = [w.lstrip(SPACE) for w in runs]
            self._learn([c for c in set(cores).union(words) if c not in self.known])
            flat, length = [], []
            for w, c in zip(runs, cores):
                ids, extra = self.flat[self.at[self.known[c]] :][: self.length[self.known[c]]], len(w) - len(c)
                if ids[0] == self.id[SPACE]:
                    extra, ids = extra + 1, ids[1:]
                whole, rest = divmod(extra, self.run)
                flat += [np.full(whole, self.id[SPACE * self.run], np.int32), self.rest[rest], ids]
                length.append(whole + len(self.rest[rest]) + len(ids))
            self._put(runs, np.concatenate(flat), np.array(length))
        elif words:
            self._put(words, *self.merge([SPACE + w for w in words]))

    def _put(self, words: list[str], flat: np.ndarray, length: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.length), len(self.length) + len(words))))
        self.held += sum(map(len, words))
        self.at = np.r_[self.at, len(self.flat) + np.cumsum(length) - length]
        self.length = np.r_[self.length, length]
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids with an end id behind each text, and the offsets of the texts."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_CHARS:
            self.begin()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # One space between words and no space mark: Arrow splits and numbers the words. Else, or for an empty text: the pattern.
        odd = pc.match_substring_regex(texts, f"^$|^ | $|  |{SPACE}").to_numpy(zero_copy_only=False)
        plain, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
        split = pc.split_pattern(texts.take(pa.array(plain)), " ")
        numbered = split.flatten().dictionary_encode()
        per_doc = np.diff(split.offsets.to_numpy()) if len(plain) else np.zeros(0, np.int64)
        spaced = [[w[1:] for w in _WORD.findall(SPACE + t.replace(" ", SPACE))] if t else [] for t in texts.take(pa.array(rest)).to_pylist()]
        words = [w for doc in spaced for w in doc]
        unique = numbered.dictionary.to_pylist()
        if new := [w for w in {*unique, *words} if w not in self.known]:
            self._learn(new)
        by_number = np.fromiter(map(self.known.__getitem__, unique), np.int64, len(unique))
        parts = [by_number[numbered.indices.to_numpy()], np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)), np.zeros(len(texts), np.int64)]
        owners = [np.repeat(plain, per_doc), np.repeat(rest, [len(d) for d in spaced]).astype(np.int64), np.arange(len(texts))]
        owner = np.concatenate(owners)
        by = np.argsort(owner, kind="stable")
        index = np.concatenate(parts)[by]
        length = self.length[index]
        to = np.cumsum(length)
        ids = self.flat[np.repeat(self.at[index] - to + length, length) + np.arange(to[-1] if len(to) else 0)]
        return ids, np.r_[0, to][np.r_[0, np.cumsum(np.bincount(owner, minlength=len(texts)))]]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces make up characters, and the space in front goes."""
        if ids and ids[-1] == self.end:
            ids = ids[:-1]
        if not self.control.isdisjoint(ids):  # they end a run of byte pieces and have no text
            parts, at = [], [-1, *(k for k, i in enumerate(ids) if i in self.control), len(ids)]
            for a, b in zip(at, at[1:]):
                parts.append(_utf8(b"".join(map(self.text.__getitem__, ids[a + 1 : b]))))
            text = "".join(parts)
        else:
            text = _utf8(b"".join(map(self.text.__getitem__, ids)))
        first = next((i for i in ids if self.text[i]), self.unknown)
        return text[1:] if first in self._spaced else text

    @property
    def _spaced(self) -> frozenset[int]:
        if "spaced" not in self.__dict__:
            self.spaced = frozenset(i for n, i in self.id.items() if n[0] == SPACE)
        return self.spaced


def _utf8(raw: bytes) -> str:
    """UTF-8 with a replacement character for every single byte that doesn't fit."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids array<int>): the ids of every whole text, the end id last."""
    prepare(docs.sparkSession)

    def run(batches):
        coder = pieces(model)
        for part in slices(batches, "text"):
            ids, offsets = coder.encode(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text) from (doc_id, ids); null ids give an empty text."""
    prepare(coded.sparkSession)

    def run(batches):
        coder = pieces(model)
        for part in batches:
            text = [coder.decode(x.values.to_numpy().tolist() if x.is_valid else []) for x in part.column("ids")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(text, pa.string())], ["doc_id", "ids", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {coded.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")
