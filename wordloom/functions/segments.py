"""Blocks of word types, their symbols being numbers: what tasks of byte-pair training do with Arrow batches.

A character is its code point, every other symbol a number from ``FIRST_NAME`` on, by its place in a list of names that
begins with the end mark. A block's types are in the order in which they were met.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import END_OF_WORD

FIRST_NAME = 0x110000
_ARRAYS = {"sym": np.int32, "size": np.int32, "freq": np.int64, "doc": np.int64, "pos": np.int32, "seen": np.bool_}
_CHANGE = pa.list_(pa.struct([("l", pa.int32()), ("r", pa.int32()), ("w", pa.int64())]))

# A row per block: symbols of all its types, symbols of each type, occurrences, where first met (``seen``: known), and
# what the last step adds to the pair counts.
BLOCK = "sym binary, size binary, freq binary, doc binary, pos binary, seen binary, change array<struct<l:int,r:int,w:bigint>>"


def from_starts(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start .. start + size - 1`` of every piece, one piece after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def every_second(places: np.ndarray) -> np.ndarray:
    """Places of a pair without those that overlap one further left: side by side, they are one symbol repeated."""
    if not len(places):
        return places
    n = np.arange(len(places))
    begins = np.concatenate(([True], np.diff(places) != 1))
    return places[(n - np.maximum.accumulate(np.where(begins, n, 0))) % 2 == 0]


def split_words(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(words of each row, all words) of texts whose words have one space between them."""
    texts = column.cast(pa.large_string())
    lists = pc.split_pattern(pc.if_else(pc.equal(texts, ""), pa.scalar(None, pa.large_string()), texts), " ")
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: ``doc_id, words`` (a text) -> a row per distinct word of a batch: ``word, freq`` and its first ``doc_id, pos``."""
    for b in batches:
        size, flat = split_words(b.column("words"))
        coded = pc.dictionary_encode(flat)
        code = coded.indices.to_numpy(zero_copy_only=False)
        ids, known = pc.fill_null(b.column("doc_id"), 0).to_numpy(), pc.is_valid(b.column("doc_id")).to_numpy(zero_copy_only=False)
        docs, rank = np.unique(ids, return_inverse=True)
        span, never = int(size.max(initial=0)) + 1, np.iinfo(np.int64).max
        place = np.repeat(rank * span, size) + from_starts(np.zeros(len(size), np.int64), size)
        place[~np.repeat(known, size)] = never
        first = np.full(len(coded.dictionary), never)
        np.minimum.at(first, code, place)
        unknown = first == never
        at = np.where(unknown, 0, first)
        yield pa.RecordBatch.from_arrays(
            [
                coded.dictionary.cast(pa.string()),
                pa.array(np.bincount(code, minlength=len(first))),
                pa.array(docs[at // span] if len(docs) else at, mask=unknown),
                pa.array((at % span).astype(np.int32), mask=unknown),
            ],
            ["word", "freq", "doc_id", "pos"],
        )


def _pairs(sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjacent symbols of the same type: their key, type and place."""
    word = np.repeat(np.arange(len(size)), size)
    at = np.flatnonzero(word[:-1] == word[1:])
    return sym[at].astype(np.int64) << 32 | sym[at + 1], word[at], at


def _counts(sym: np.ndarray, size: np.ndarray, weight: np.ndarray) -> pa.Array:
    """The pairs with the sum of their types' weights, as one list."""
    key, word, _ = _pairs(sym, size)
    order = np.argsort(key, kind="stable")
    key, w = key[order], weight[word[order]]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])
    total = np.add.reduceat(w, starts) if len(starts) else w
    key, total = key[starts][total != 0], total[total != 0]
    items = [pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(total)]
    return pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), pa.StructArray.from_arrays(items, fields=list(_CHANGE.value_type)))


def _row(block: dict[str, np.ndarray], change: pa.Array) -> pa.RecordBatch:
    cells = [pa.array([np.ascontiguousarray(block[c], t).tobytes()], pa.binary()) for c, t in _ARRAYS.items()]
    return pa.RecordBatch.from_arrays([*cells, change], [*_ARRAYS, "change"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for b in batches:
        for i in range(b.num_rows):
            yield {c: np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in _ARRAYS.items()}


def form_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: ``word, freq, doc_id, pos`` -> a block per batch, its change being all its pairs."""
    for b in batches:
        seen = pc.is_valid(b.column("doc_id")).to_numpy(zero_copy_only=False)
        doc, pos = (pc.fill_null(b.column(c), 0).to_numpy() for c in ("doc_id", "pos"))
        order = np.lexsort((pos, doc, seen))
        words = b.column("word").take(pa.array(order)).to_pylist()
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        sym = np.full(size.sum(), FIRST_NAME, np.int32)
        inner = np.ones(len(sym), bool)
        inner[np.cumsum(size) - 1] = False
        sym[inner] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        freq = b.column("freq").to_numpy()[order]
        yield _row({"sym": sym, "size": size, "freq": freq, "doc": doc[order], "pos": pos[order], "seen": seen[order]}, _counts(sym, size, freq))


def merge_blocks(merges: Sequence[tuple[int, int, int]]):
    """Task: blocks -> blocks after the merges ``left, right, new``, of which no two share a symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            sym, size, freq = block["sym"], block["size"], block["freq"]
            ends = np.cumsum(size)
            inner = np.ones(len(sym), bool)
            inner[ends - 1] = False
            new, keep, changed = sym.copy(), np.ones(len(sym), bool), []
            for left, right, name in merges:
                places = np.flatnonzero((sym[:-1] == left) & (sym[1:] == right) & inner[:-1])
                if left == right:
                    places = every_second(places)
                new[places], keep[places + 1] = name, False
                changed.append(np.searchsorted(ends, places, "right"))
            less = np.bincount(np.concatenate(changed), minlength=len(size))
            of = np.flatnonzero(less)
            new, smaller = new[keep], size - less
            parts = [s[from_starts((np.cumsum(n) - n)[of], n[of])] for s, n in ((sym, size), (new, smaller))]
            change = _counts(np.concatenate(parts), np.concatenate([size[of], smaller[of]]), np.concatenate([-freq[of], freq[of]]))
            yield _row(block | {"sym": new, "size": smaller}, change)

    return run


def first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: blocks -> each block's distinct pairs and where each was met first: ``l, r, doc_id, pos, i``."""
    for block in _blocks(batches):
        key, word, at = _pairs(block["sym"], block["size"])
        i = at - (np.cumsum(block["size"]) - block["size"])[word]
        seen = block["seen"][word]
        order = np.lexsort((i, np.where(seen, word, -1), key))
        one = order[np.concatenate(([True], key[order][1:] != key[order][:-1]))[: len(key)]]
        key, word, unseen = key[one], word[one], ~seen[one]
        columns = [(key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)]
        where = [pa.array(block[c][word], mask=unseen) for c in ("doc", "pos")]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *where, pa.array(i[one].astype(np.int32))], ["l", "r", "doc_id", "pos", "i"])


def symbol_text(code: int, names: Sequence[str]) -> str:
    return chr(code) if code < FIRST_NAME else names[code - FIRST_NAME]


def block_tokens(names: Sequence[str]):
    """Task: blocks -> the distinct symbols of each: ``token``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            tokens = [symbol_text(c, names) for c in np.unique(block["sym"]).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string())], ["token"])

    return run


def block_types(names: Sequence[str]):
    """Task: blocks -> their types: ``word, freq, doc_id, pos, symbols``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            used, code = np.unique(block["sym"], return_inverse=True)
            symbols = pa.array([symbol_text(c, names) for c in used.tolist()], pa.string()).take(pa.array(code))
            ends = np.concatenate(([0], np.cumsum(block["size"])))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), symbols)
            words = [s[: -len(END_OF_WORD)] for s in pc.binary_join(lists, "").to_pylist()]
            where = [pa.array(block[c], mask=~block["seen"]) for c in ("doc", "pos")]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(block["freq"]), *where, lists], ["word", "freq", "doc_id", "pos", "symbols"])

    return run
