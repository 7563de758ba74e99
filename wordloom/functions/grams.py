"""Blocks of n-grams, their words being numbers: what tasks of n-gram counting do with Arrow batches.

A task counts the n-grams of some millions of words at once and gives a row per block: the n-grams of one slot, the words
that are in them listed once. Such a row has about a third of the bytes that a row per n-gram has in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that are counted at once, and n-grams that are merged at once.
HELD = 2_500_000
#: Rows of a batch that goes out.
_OUT = 1 << 16
_NEVER = np.iinfo(np.int64).max

BLOCK = "slot int, block binary"


@dataclass
class Grams:
    """N-grams: their words by place in ``words``, how often each was met, and where first (document and place; the
    document is a place in ``docs``, or its length: unknown)."""

    words: pa.Array
    codes: list[np.ndarray]
    cnt: np.ndarray
    docs: np.ndarray
    doc: np.ndarray
    pos: np.ndarray


def _ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the distinct words in order, the place of every word in it)."""
    coded = pc.dictionary_encode(words)
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), rank[coded.indices.to_numpy(zero_copy_only=False)]


def _keys(codes: Sequence[np.ndarray], size: int) -> np.ndarray:
    """One number for every row of codes below ``size``; their order is that of the rows."""
    size = max(size, 1)
    key, span = codes[0], size
    for c in codes[1:]:
        if span > (1 << 62) // size:
            distinct, key = np.unique(key, return_inverse=True)
            span = max(len(distinct), 1)
        key, span = key * size + c, span * size
    return key


def _starts(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])


def _counted(words: pa.Array, codes: list[np.ndarray], cnt: np.ndarray | None, docs: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[Grams, np.ndarray]:
    """(every n-gram once, in the order of its words; a row of each); ``docs`` are in order."""
    key = _keys(codes, len(words))
    order = np.argsort(key)
    starts = _starts(key[order])
    span = int(pos.max(initial=0)) + 1
    place = np.where(doc == len(docs), _NEVER, doc * span + pos)
    first = np.minimum.reduceat(place[order], starts) if len(starts) else place
    unknown = first == _NEVER
    total = np.diff(np.append(starts, len(order))) if cnt is None else np.add.reduceat(cnt[order], starts) if len(starts) else cnt
    one = order[starts]
    return Grams(words, [c[one] for c in codes], total, docs, np.where(unknown, len(docs), first // span), np.where(unknown, 0, first % span)), one


def _cell(a: np.ndarray) -> list[bytes]:
    """Numbers from 0 on in as few bytes as the largest needs, which come first; by their lowest bytes, then by the next ones."""
    top = int(a.max(initial=0))
    wide = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    planes = a.astype(f"<u{wide}").view(np.uint8).reshape(len(a), wide)
    return [bytes([wide]), *(planes[:, k].tobytes() for k in range(wide))]


class _Reader:
    def __init__(self, data: memoryview) -> None:
        self.data, self.at = data, 0

    def raw(self, size: int) -> memoryview:
        self.at += size
        return self.data[self.at - size : self.at]

    def numbers(self, n: int) -> np.ndarray:
        wide = self.raw(1)[0]
        planes = np.empty((n, wide), np.uint8)
        for k in range(wide):
            planes[:, k] = np.frombuffer(self.raw(n), np.uint8)
        return planes.view(f"<u{wide}").reshape(n).astype(np.int64)


def write_block(g: Grams, codec: pa.Codec) -> bytes:
    """N-grams in the order of their words."""
    _, ends, data = g.words.buffers()  # of a large string array that begins at place 0
    ends = np.frombuffer(ends, np.int64, len(g.words) + 1)
    chars = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes() if data else b""
    plain = [np.array([len(g.words), len(chars), len(g.cnt), len(g.docs)], np.int64).tobytes(), g.docs.tobytes(), chars]
    for a in (np.diff(ends), np.diff(g.codes[0], prepend=0), *g.codes[1:], g.cnt, g.doc, g.pos):
        plain += _cell(a)
    plain = b"".join(plain)
    return len(plain).to_bytes(8, "little") + codec.compress(plain, asbytes=True)


def read_block(block: pa.Buffer, n: int, codec: pa.Codec) -> Grams:
    data = _Reader(memoryview(codec.decompress(block.slice(8), int.from_bytes(block.slice(0, 8).to_pybytes(), "little"), asbytes=True)))
    n_words, n_chars, rows, n_docs = np.frombuffer(data.raw(32), np.int64).tolist()
    docs, chars = np.frombuffer(data.raw(8 * n_docs), np.int64), data.raw(n_chars)
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(data.numbers(n_words))))
    words = pa.LargeStringArray.from_buffers(n_words, pa.py_buffer(ends), pa.py_buffer(chars))
    codes = [np.cumsum(data.numbers(rows)), *(data.numbers(rows) for _ in range(n))]
    return Grams(words, codes, data.numbers(rows), docs, data.numbers(rows), data.numbers(rows))


def _blocks(g: Grams, slot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per slot."""
    codec = pa.Codec("zstd", 3)
    order = np.argsort(slot, kind="stable")
    slot, codes, cnt, doc, pos = slot[order], [c[order] for c in g.codes], g.cnt[order], g.doc[order], g.pos[order]
    starts = _starts(slot)
    word_at, doc_at = np.zeros(len(g.words), np.int64), np.zeros(len(g.docs) + 1, np.int64)
    used, seen = np.zeros(len(g.words), bool), np.zeros(len(g.docs) + 1, bool)
    for begin, end in zip(starts, np.append(starts[1:], len(slot))):
        s = slice(begin, end)
        for c in codes:
            used[c[s]] = True
        seen[doc[s]] = True
        seen[-1] = False
        words, docs = np.flatnonzero(used), np.flatnonzero(seen)
        used[words], seen[docs] = False, False
        word_at[words], doc_at[docs], doc_at[-1] = np.arange(len(words)), np.arange(len(docs)), len(docs)
        some = Grams(g.words.take(pa.array(words)), [word_at[c[s]] for c in codes], cnt[s], g.docs[docs], doc_at[doc[s]], pos[s])
        yield pa.RecordBatch.from_arrays([pa.array([slot[begin]], pa.int32()), pa.array([write_block(some, codec)], pa.binary())], ["slot", "block"])


def count_grams(n: int):
    """Task: ``doc_id, pos, word, slot`` (a row per word, in the order of the texts; slot: of the n-gram that begins there,
    null where the text has not n more words) -> :data:`BLOCK`, ``pos`` being that of the n-gram's last word."""

    def some(held: pa.Table, rows: int) -> Iterator[pa.RecordBatch]:
        words, code = _ranked(held.column("word").combine_chunks().cast(pa.large_string()))
        slots = held.column("slot").slice(0, rows).combine_chunks()
        at = np.flatnonzero(pc.is_valid(slots).to_numpy(zero_copy_only=False))
        ids = held.column("doc_id").slice(0, rows).combine_chunks()
        docs, rank = np.unique(pc.fill_null(ids, 0).to_numpy(), return_inverse=True)
        rank = np.where(pc.is_valid(ids).to_numpy(zero_copy_only=False), rank, len(docs))
        pos = held.column("pos").slice(0, rows).combine_chunks().to_numpy()
        slot = pc.fill_null(slots, 0).to_numpy()[at]
        g, one = _counted(words, [code[at + k] for k in range(n + 1)], None, docs, rank[at], pos[at] + n)
        yield from _blocks(g, slot[one])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= HELD:
                whole = pa.Table.from_batches(held)
                yield from some(whole, size - n)  # the last ones may go on
                held, size = whole.slice(size - n).to_batches(), n
        if size:
            yield from some(pa.Table.from_batches(held), size)

    return run


def _merged(parts: list[Grams]) -> Grams:
    words, code = _ranked(pa.concat_arrays([p.words for p in parts]))
    docs, rank = np.unique(np.concatenate([p.docs for p in parts]), return_inverse=True)
    codes, doc, word_at, doc_at = [], [], 0, 0
    for p in parts:
        codes.append([code[word_at + c] for c in p.codes])
        doc.append(np.append(rank[doc_at : doc_at + len(p.docs)], len(docs))[p.doc])
        word_at, doc_at = word_at + len(p.words), doc_at + len(p.docs)
    cnt, pos = (np.concatenate([getattr(p, c) for p in parts]) for c in ("cnt", "pos"))
    return _counted(words, [np.concatenate(c) for c in zip(*codes)], cnt, docs, np.concatenate(doc), pos)[0]


def _texts(g: Grams, codes: list[np.ndarray]) -> pa.Array:
    """Words joined by one space."""
    columns = [g.words.take(pa.array(c)).cast(pa.string()) for c in codes]
    return pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]


def _count_rows(g: Grams) -> Iterator[pa.RecordBatch]:
    known = g.doc < len(g.docs)
    ids = np.append(g.docs, 0)[g.doc]
    for i in range(0, len(g.cnt), _OUT):
        s = slice(i, i + _OUT)
        codes = [c[s] for c in g.codes]
        cells = [_texts(g, codes[:-1]), _texts(g, codes[-1:]), pa.array(g.cnt[s]), pa.array(ids[s], mask=~known[s]), pa.array(g.pos[s])]
        yield pa.RecordBatch.from_arrays(cells, ["context", "word", "cnt", "doc_id", "pos"])


def _contexts(g: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(where each context begins, its total, the context of every n-gram, its place: an unknown one comes before the others)."""
    starts = _starts(_keys(g.codes[:-1], len(g.words)))
    context = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(g.cnt))))
    place = np.where(g.doc == len(g.docs), -1, g.doc * (int(g.pos.max(initial=0)) + 1) + g.pos)
    return starts, np.add.reduceat(g.cnt, starts) if len(starts) else g.cnt, context, place


def _top_rows(g: Grams) -> Iterator[pa.RecordBatch]:
    """Of each context the most frequent word, the first seen on ties."""
    starts, total, context, place = _contexts(g)
    one = np.lexsort((place, -g.cnt, context))[starts]  # contexts stay where they are
    for i in range(0, len(one), _OUT):
        s = one[i : i + _OUT]
        cells = [_texts(g, [c[s] for c in g.codes[:-1]]), _texts(g, [g.codes[-1][s]]), pa.array(g.cnt[s]), pa.array(total[i : i + _OUT])]
        yield pa.RecordBatch.from_arrays(cells, ["context", "word", "cnt", "total"])


def _interval_rows(g: Grams) -> Iterator[pa.RecordBatch]:
    """Each word's ``[lo, lo + cnt)`` slice of its context's total, in first-seen order."""
    starts, total, context, place = _contexts(g)
    order = np.lexsort((place, context))
    before = np.cumsum(g.cnt[order]) - g.cnt[order]
    lo = before - before[starts][context] if len(starts) else before
    words = np.diff(np.append(starts, len(order)))
    for i in range(0, len(order), _OUT):
        s, c = order[i : i + _OUT], context[i : i + _OUT]
        cells = [_texts(g, [x[s] for x in g.codes[:-1]]), _texts(g, [g.codes[-1][s]]), *map(pa.array, (g.cnt[s], lo[i : i + _OUT], total[c], words[c]))]
        yield pa.RecordBatch.from_arrays(cells, ["context", "word", "cnt", "lo", "total", "nwords"])


#: What a merge gives; all but counts where a slot has all n-grams of its contexts.
ROWS = {
    "counts": ("context string, word string, cnt bigint, doc_id bigint, pos bigint", _count_rows),
    "top": ("context string, word string, cnt bigint, total bigint", _top_rows),
    "intervals": ("context string, word string, cnt bigint, lo bigint, total bigint, nwords bigint", _interval_rows),
}


def merge_grams(n: int, kind: str = "counts"):
    """Task: all :data:`BLOCK` rows of some slots, slot by slot -> the rows of a kind in :data:`ROWS`. What is held are
    the distinct n-grams of one slot and as many rows again."""
    rows = ROWS[kind][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        slot, held, more = None, [], 0
        for b in batches:
            for at, block in zip(b.column("slot").to_pylist(), b.column("block")):
                if held and at != slot:
                    yield from rows(_merged(held))
                    held, more = [], 0
                slot = at
                held.append(read_block(block.as_buffer(), n, codec))
                more += len(held[-1].cnt)
                if len(held) > 1 and more >= max(HELD, len(held[0].cnt)):
                    held, more = [_merged(held)], 0
        if held:
            yield from rows(_merged(held))

    return run
