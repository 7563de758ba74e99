"""The merge rule of the byte-pair encoder inside one word, and its use on Arrow batches."""

from __future__ import annotations

from collections.abc import Container, Iterator, Mapping
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .segments import every_second, from_starts, split_words
from .text import END_OF_WORD

# Words of so many characters are merged one by one with a heap; shorter ones are merged together, a round for all.
_LONG = 64
# Symbols of long words that a task keeps; the table starts anew when it is full.
_MEMO = 1 << 20
# Occurrences whose distinct words are encoded at once, and those that are turned into rows at once.
_ENCODED = 1 << 20
_CHUNK = 1 << 17


def merge_symbols(symbols: list[str], known: Container[str]) -> list[str]:
    """While an adjacent pair's concatenation is ``known``, merge the leftmost such pair at all its places.

    Symbols are a linked list; pairs wait in a heap by place and are looked up by content, so each merge costs its
    places and not the word: n symbols take O(n log n) steps.
    """
    n = len(symbols)
    sym: list[str | None] = [*symbols]
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    places: dict[tuple[str, str], list[int]] = {}
    for i in range(n - 1):
        if symbols[i] + symbols[i + 1] in known:
            places.setdefault((symbols[i], symbols[i + 1]), []).append(i)
    waiting = [i for at in places.values() for i in at]
    heapify(waiting)
    while waiting:
        i = heappop(waiting)
        left = sym[i]
        if left is None or after[i] < 0:
            continue
        right = sym[after[i]]
        at = places.pop((left, right), None)
        if at is None:  # a pair that isn't known, or whose places are merged
            continue
        touched = []
        for p in sorted(at):
            q = after[p]
            if sym[p] != left or q < 0 or sym[q] != right:
                continue  # gone, or overlaps a place further left
            sym[p], sym[q] = left + right, None
            after[p] = after[q]
            if after[q] >= 0:
                before[after[q]] = p
            touched.append(p)
        for p in touched:
            for a in (before[p], p):
                if a >= 0 and after[a] >= 0 and sym[a] is not None:
                    pair = (sym[a], sym[after[a]])
                    if pair[0] + pair[1] in known:
                        places.setdefault(pair, []).append(a)
                        heappush(waiting, a)
    return [s for s in sym if s is not None]


def encode_word(word: str, ids: Mapping[str, int]) -> tuple[list[str], list[int]]:
    """Tokens and ids of a word: a lone end mark at the end is dropped, unknown tokens have id -1."""
    tokens = merge_symbols([*word, END_OF_WORD], ids)
    if tokens[-1] == END_OF_WORD:
        tokens.pop()
    return tokens, [ids.get(t, -1) for t in tokens]


class WordCoder:
    """The rule of :func:`merge_symbols` for many words at once, symbols being numbers.

    The pairs that can ever merge are the tokens cut in two symbols. A round merges, in every word that still has such a
    pair, the word's leftmost one at all its places; a word takes part only as long as it has one.
    """

    def __init__(self, ids: Mapping[str, int]) -> None:
        tokens = [t for t in ids if t is not None]
        symbols = list(dict.fromkeys([*tokens, END_OF_WORD, *(c for t in tokens for c in t)]))
        self.ids, self.symbols = ids, symbols
        self.code = code = {s: i for i, s in enumerate(symbols)}
        self.end, self.other = code[END_OF_WORD], len(symbols)  # other characters: their code point is added to that
        self.span = self.other + 0x110000
        self.of_char = np.arange(self.other, self.span)
        for s, i in code.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        cuts = ((t, t[:i], t[i:]) for t in tokens for i in range(1, len(t)))
        merged = {code[left] * self.span + code[right]: code[t] for t, left, right in cuts if left in code and right in code}
        self.keys = np.array(sorted(merged), np.int64)
        self.merged = np.array([merged[k] for k in sorted(merged)], np.int64)
        self.id_of = np.array([ids.get(s, -1) for s in symbols], np.int64)
        self.memo: dict[str, np.ndarray] = {}
        self.kept = 0

    def _apart(self, word: str) -> np.ndarray:
        """The symbols of a long word."""
        if word not in self.memo:
            out = merge_symbols([*word, END_OF_WORD], self.ids)
            if self.kept + len(word) > _MEMO:
                self.memo.clear()
                self.kept = 0
            self.memo[word] = np.array([self.code[s] if s in self.code else self.other + ord(s) for s in out], np.int64)
            self.kept += len(word)
        return self.memo[word]

    def _merge(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and the words they are in, words in order, when no pair is left to merge."""
        done = []
        lead = np.zeros(int(word[-1]) + 1 if len(word) else 0, np.int64)
        while len(sym) > 1 and len(self.keys):
            key = sym[:-1] * self.span + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            places = np.flatnonzero((self.keys[at] == key) & (word[:-1] == word[1:]))
            if not len(places):
                break
            of = word[places]
            leftmost = places[np.concatenate(([True], of[1:] != of[:-1]))]
            lead[word[leftmost]] = key[leftmost]
            places = places[key[places] == lead[of]]
            places = every_second(places)
            sym[places] = self.merged[at[places]]
            going = np.zeros(len(lead), bool)
            going[of] = True
            stays, keep = going[word], np.ones(len(sym), bool)
            keep[places + 1] = False
            done.append((sym[~stays], word[~stays]))
            sym, word = sym[keep & stays], word[keep & stays]
        sym, word = (np.concatenate(x) for x in zip(*done, (sym, word)))
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def encode(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(first token of each word, n+1 of them; all tokens; all ids) of an array of words, as :func:`encode_word`."""
        codes, sizes, pool, id_of = self.codes(words)
        return np.concatenate(([0], np.cumsum(sizes))), pool.take(pa.array(codes)), id_of[codes]

    def codes(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """(all tokens as places in a pool, tokens of each word, the pool's tokens, the pool's ids)."""
        texts = words.to_pylist()
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        short = n < _LONG
        long = np.flatnonzero(~short)
        text = "".join(t for t in texts if len(t) < _LONG) if len(long) else "".join(texts)
        chars = self.of_char[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        size = np.where(short, n + 1, 0)
        sym = np.full(size.sum(), self.end, np.int64)
        ends = np.cumsum(size)[short] - 1
        inner = np.ones(len(sym), bool)
        inner[ends] = False
        sym[inner] = chars
        sym, word = self._merge(sym, np.repeat(np.arange(len(texts)), size))
        if len(long):
            apart = [self._apart(texts[i]) for i in long]
            sym = np.concatenate([sym, *apart])
            word = np.concatenate([word, np.repeat(long, [len(x) for x in apart])])
            order = np.argsort(word, kind="stable")
            sym, word = sym[order], word[order]
        last = np.concatenate((word[1:] != word[:-1], [True]))[: len(word)]
        keep = ~(last & (sym == self.end))  # a lone end mark at the end is dropped
        sym, word = sym[keep], word[keep]
        sizes = np.bincount(word, minlength=len(texts))
        other = sym >= self.other
        rare = np.unique(sym[other])
        sym[other] = self.other + np.searchsorted(rare, sym[other])
        pool = pa.array([*self.symbols, *(chr(c - self.other) for c in rare.tolist())], pa.string())
        return sym, sizes, pool, np.concatenate((self.id_of, np.full(len(rare), -1, np.int64)))


def encode_batches(ids: Mapping[str, int]):
    """Task: ``word`` -> ``word, tokens, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(ids)
        for b in batches:
            words = b.column("word")
            ends, tokens, numbers = coder.encode(words)
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, tokens), pa.ListArray.from_arrays(ends, pa.array(numbers))]
            yield pa.RecordBatch.from_arrays([words, *lists], ["word", "tokens", "ids"])

    return run


def merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: ``word, hits array<struct<token, id>>`` -> ``word, tokens, ids``, the hits being all that is known."""
    for b in batches:
        out = [encode_word(w, {h["token"]: h["id"] for h in hits}) for w, hits in zip(b.column("word").to_pylist(), b.column("hits").to_pylist())]
        lists = [pa.array([t for t, _ in out], pa.list_(pa.string())), pa.array([i for _, i in out], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([b.column("word"), *lists], ["word", "tokens", "ids"])


def tokenize_batches(ids: Mapping[str, int]):
    """Task: ``doc_id, words`` (a text, a space between words) -> a row per token: ``doc_id, pos, tpos, token, id``.

    Occurrences are numbers of the batch's distinct words, so each distinct word is encoded once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(ids)
        for b in batches:
            size, flat = split_words(b.column("words"))
            row = np.repeat(np.arange(b.num_rows), size)
            pos = from_starts(np.zeros(len(size), np.int64), size)
            for lo in range(0, len(flat), _ENCODED):
                coded = pc.dictionary_encode(flat.slice(lo, _ENCODED))
                codes, sizes, pool, id_of = coder.codes(coded.dictionary)
                starts, words = np.cumsum(sizes) - sizes, coded.indices.to_numpy(zero_copy_only=False)
                for at in range(0, len(words), _CHUNK):
                    word = words[at : at + _CHUNK]
                    n = sizes[word]
                    code = codes[from_starts(starts[word], n)]
                    tpos = from_starts(np.zeros(len(n), np.int64), n)
                    of = lo + at + np.repeat(np.arange(len(word)), n)
                    doc_id = b.column("doc_id").take(pa.array(row[of]))
                    columns = [doc_id, pa.array(pos[of], pa.int32()), pa.array(tpos, pa.int32()), pool.take(pa.array(code)), pa.array(id_of[code])]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "pos", "tpos", "token", "id"])

    return run
