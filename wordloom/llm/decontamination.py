"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into item-sized windows: ``window`` consecutive words,
or the whole item where it has fewer. A window counts as contained only if all
its shingles are, so its *necessary prefix* under any global order of shingles
is one shingle; ordering by rarity in the corpus makes that the rarest one.

1. Windows are made distinct and numbered in Spark; which items hold a window is a table of its own.
2. Every word shingle of the benchmark is counted in the documents (one scan per block).
3. Each window is indexed under its rarest shingle and that shingle's position.
4. Document shingles that meet the index give candidate windows; the position
   bound fixes where the window would start, the length bound drops those that
   leave the text, and the rest are verified word by word.
5. Where items are asked for, the distinct sets of windows found meet the table of items by a salted join.

The benchmark is processed in blocks of at most about ``BLOCK`` distinct windows,
whose index is broadcast. ``LIVE`` blocks are chained in one stage over the same
rows; then the rows are written, the indexes given back, and the next blocks
follow, so that driver and workers hold at most ``LIVE * BLOCK`` windows whatever
the benchmark's size. A window that many items share is one entry. Rows of the
documents are not shuffled, and nothing depends on how often a passage or a source
occurs; only distinct sets of window numbers are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C

WINDOW = 13
SHINGLE = 3
BLOCK = 100_000  # windows: about 15 MB in a worker
LIVE = 10  # blocks whose indexes are held at once: about 150 MB
SALTS = 8  # parts of the items of a window
_BITS = 20


def _shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on (the last ``size - 1`` have none)."""
    out = h[: max(0, len(h) - size + 1)]
    for k in range(1, size):
        out = C.pair(out, h[k : len(h) - size + 1 + k])
    return out


def benchmark_windows(bench: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item string, win list of word hashes, text list of the words), one row per distinct window of an item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, wins, texts = [], [], []
            for part in C.slices(batch, "text"):
                data, off = C.text_bytes(part.column("text"))
                h, s, e, b = C.words(data, off, C.ALNUM_LOWER)
                raw = data.tobytes()
                for i, item in enumerate(part.column("item").to_pylist()):
                    n = int(b[i + 1] - b[i])
                    seen = set()
                    for at in range(b[i], b[i] + (max(1, n - window + 1) if n else 0)):
                        to = min(at + window, b[i + 1])
                        if (key := h[at:to].tobytes()) not in seen:
                            seen.add(key)
                            items.append(item)
                            wins.append(h[at:to].astype(np.int64))
                            texts.append(b" ".join(raw[s[k] : e[k]].lower() for k in range(at, to)))
            yield pa.record_batch([pa.array(items, pa.string()), pa.array(wins, pa.list_(pa.int64())), pa.array(texts, pa.binary())], ["item", "win", "text"])

    rows = bench.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "item string, win array<bigint>, text binary")


class _Block:
    """The windows of one block, their shingles by size, and the index on the rarest."""

    def __init__(self, rows: list) -> None:
        self.ids = [r["id"] for r in rows]
        self.texts = [bytes(r["text"]) for r in rows]
        self.wins = [np.array(r["win"], np.int64).view(np.uint64) for r in rows]
        self.sizes = sorted({min(SHINGLE, len(w)) for w in self.wins})
        self.vocab = {k: np.unique(np.concatenate([_shingles(w, k) for w in self.wins if min(SHINGLE, len(w)) == k])) for k in self.sizes}

    def order(self, counts: dict[int, np.ndarray]) -> "_Block":
        """Index each window under its rarest shingle (on a tie the leftmost)."""
        key, at = {k: [] for k in self.sizes}, {k: [] for k in self.sizes}
        for i, w in enumerate(self.wins):
            k = min(SHINGLE, len(w))
            sh = _shingles(w, k)
            p = int(np.argmin(counts[k][np.searchsorted(self.vocab[k], sh)]))
            key[k].append(sh[p])
            at[k].append((i, p, len(w)))
        self.index = {}
        for k in self.sizes:
            keys, rows = np.array(key[k], np.uint64), np.array(at[k], np.int64)
            o = np.argsort(keys, kind="stable")
            self.index[k] = (keys[o], rows[o], self.bitmap(keys))
        return self

    @staticmethod
    def bitmap(keys: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << _BITS, bool)
        out[(keys & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
        return out

    @staticmethod
    def meets(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(bitmap[(h & np.uint64((1 << _BITS) - 1)).astype(np.int64)])

    def occurrences(self, h: np.ndarray, s: np.ndarray, e: np.ndarray, b: np.ndarray, raw: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, first word, word after the last) of every verified occurrence."""
        for k in self.sizes:
            keys, rows, bitmap = self.index[k]
            sh = _shingles(h, k)
            pos = self.meets(sh, bitmap)
            lo, hi = np.searchsorted(keys, sh[pos]), np.searchsorted(keys, sh[pos], "right")
            pos, lo, n = pos[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            cand = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
            pos = np.repeat(pos, n)
            win, p, size = rows[cand].T if len(cand) else np.zeros((3, 0), np.int64)
            first = pos - p  # positional bound: the only place where the window can start
            doc = np.searchsorted(b, pos, "right") - 1
            ok = (first >= b[doc]) & (first + size <= b[doc + 1])  # length bound
            for w, at in zip(win[ok], first[ok]):
                own = self.wins[w]
                to = at + len(own)
                if np.array_equal(h[at:to], own) and b" ".join(raw[s[x] : e[x]].tobytes().lower() for x in range(at, to)) == self.texts[w]:
                    yield int(w), int(at), int(to)


def _count(docs: DataFrame, block: _Block) -> dict[int, np.ndarray]:
    """How often each shingle of the block occurs in all documents; at most |vocabulary| numbers reach the driver."""
    vocab = docs.sparkSession.sparkContext.broadcast(block.vocab)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocab.value
        sums = {k: np.zeros(len(v), np.int64) for k, v in own.items()}
        maps = {k: _Block.bitmap(v) for k, v in own.items()}
        for batch in batches:
            for part in C.slices(batch, "text"):
                h, _, _, b = C.words(*C.text_bytes(part.column("text")), C.ALNUM_LOWER)
                for k, v in own.items():
                    sh = _shingles(h, k)
                    at = _Block.meets(sh, maps[k])
                    at = at[C.find(v, sh[at]) >= 0]
                    doc = np.searchsorted(b, at, "right") - 1
                    at = at[at + k <= b[doc + 1]]
                    sums[k] += np.bincount(np.searchsorted(v, sh[at]), minlength=len(v))
        for k, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(n[at])], ["k", "at", "n"])

    out = {k: np.zeros(len(v), np.int64) for k, v in block.vocab.items()}
    for r in docs.select("text").mapInArrow(scan, "k int, at bigint, n bigint").groupBy("k", "at").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["k"]][r["at"]] = r["n"]
    vocab.unpersist()
    return out


_HITS = "struct<wins:array<bigint>,spans:array<struct<a:bigint,b:bigint>>>"


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document row: ``id_col``, n_words, n_hit, items (sorted strings), spans (merged word
    ranges [a, b) that are hit), contaminated (some word hit, and at least a twentieth of all).

    Null and empty texts have no words and are clean; null or repeated ids keep a row each; an empty
    benchmark hits nothing; items without words and items with a null id give no item (a null id's
    windows still hit words). Other columns of the inputs are not read.
    """
    scratch = C.Scratch(docs.sparkSession, "decontamination")
    windows = _Windows(scratch, bench, item_col, window)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hit = _hits(rows, "text", windows, block)
    n_hit = _n_hit()
    each = hit.select(
        F.col("id").alias(id_col),
        F.col(_WORDS).alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce(f"{_FOUND}.wins", F.array().cast("array<bigint>")).alias("wins"),
        F.coalesce(f"{_FOUND}.spans", F.array().cast("array<struct<a:bigint,b:bigint>>")).alias("spans"),
        _contaminated(n_hit).alias("contaminated"),
    )
    each = scratch.table(each, "hits")  # no texts: read twice below
    some = F.size("wins") > 0
    hit_items = each.where(some).join(windows.items_of(each.where(some).select("wins").distinct()), "wins", "left")
    items = F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("items")
    cols = [id_col, "n_words", "n_hit", "items", "spans", "contaminated"]
    clean = each.where(~some).withColumn("items", F.array().cast("array<string>"))
    return clean.select(*cols).unionByName(hit_items.select(*[items if c == "items" else c for c in cols]))


def clean_rows(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns; no row is shuffled or joined.

    A column may have any name but that of the text column; one that clashes with a helper column is set aside meanwhile.
    """
    docs, back = C.set_aside(docs, {_WORDS, _FOUND})
    windows = _Windows(C.Scratch(docs.sparkSession, "decontamination"), bench, item_col, window)
    hit = _hits(docs, text_col, windows, block)
    return hit.where(~_contaminated(_n_hit())).select(*back)


_WORDS, _FOUND = "__dc_words", "__dc_hits"


def _n_hit() -> Column:
    return F.coalesce(F.aggregate(f"{_FOUND}.spans", F.lit(0).cast("bigint"), lambda a, x: a + x["b"] - x["a"]), F.lit(0).cast("bigint"))


def _contaminated(n_hit: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= F.col(_WORDS))


class _Windows:
    """The benchmark's distinct windows with a number, and the table of (window number, item)."""

    def __init__(self, scratch: C.Scratch, bench: DataFrame, item_col: str, window: int) -> None:
        C.ship(scratch.spark)
        self.scratch = scratch
        self.per_item = scratch.table(benchmark_windows(bench, item_col, "text", window), "windows")
        # one row per window and task is shuffled, however many items share it; numbered once, in what is written
        own = self.per_item.select("win", "text").distinct()
        self.distinct = scratch.table(own.select(F.monotonically_increasing_id().alias("id"), "win", "text"), "distinct")

    def block(self, k: int, n: int) -> list:
        """The windows of block ``k`` of ``n``."""
        return self.distinct.where(F.pmod(F.xxhash64("id"), F.lit(n)) == k).collect()

    def items_of(self, sets: DataFrame) -> DataFrame:
        """``wins``, items: the sorted items (null ones left out) that hold any window of each set. A window's items
        are met in ``SALTS`` parts, and joined with what was found only."""
        met = sets.select("wins", F.explode("wins").alias("id"))
        found = met.select("id").distinct().join(self.distinct, "id").select("id", "win", "text")
        named = self.per_item.where("item IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)).cast("int"))
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        items = named.join(found.select("*", salts), ["win", "text", "salt"]).select("id", "salt", "item")
        pairs = met.select("*", salts).join(items, ["id", "salt"])
        return pairs.groupBy("wins", "item").agg(F.lit(1)).groupBy("wins").agg(F.array_sort(F.collect_list("item")).alias("items"))


def _hits(rows: DataFrame, text_col: str, windows: _Windows, block: int) -> DataFrame:
    """Add the number of words, and the windows and spans found, to every row."""
    context = rows.sparkSession.sparkContext
    n_blocks = max(1, -(-windows.distinct.count() // block))
    texts = rows.select(F.col(text_col).alias("text"))
    hit = rows.withColumn(_WORDS, F.lit(0).cast("bigint")).withColumn(_FOUND, F.lit(None).cast(_HITS))
    live: list = []
    for k in range(n_blocks):
        if len(live) == LIVE:
            hit = windows.scratch.table(hit, f"pass{k // LIVE}")
            while live:
                live.pop().unpersist()
            if k > LIVE:
                windows.scratch.drop(f"pass{k // LIVE - 1}")
        own = _Block(windows.block(k, n_blocks))  # about BLOCK windows
        live.append(context.broadcast(own.order(_count(texts, own))))
        hit = _with_hits(hit, text_col, live[-1])
    return hit


def _with_hits(rows: DataFrame, text_col: str, block) -> DataFrame:
    """Add one block's windows and spans to those found so far."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        for batch in batches:
            for part in C.slices(batch, text_col):
                data, off = C.text_bytes(part.column(text_col))
                h, s, e, b = C.words(data, off, C.ALNUM_LOWER)
                found: dict[int, tuple[set, set]] = {}
                for w, at, to in own.occurrences(h, s, e, b, data):
                    d = int(np.searchsorted(b, at, "right")) - 1
                    wins, spans = found.setdefault(d, (set(), set()))
                    wins.add(own.ids[w])
                    spans.add((at - int(b[d]), to - int(b[d])))
                hits = part.column(_FOUND).to_pylist()
                for d, (wins, spans) in found.items():
                    old = hits[d] or {"wins": [], "spans": []}
                    wins.update(old["wins"])
                    spans.update((x["a"], x["b"]) for x in old["spans"])
                    hits[d] = {"wins": sorted(wins), "spans": [{"a": a, "b": z} for a, z in merged(spans)]}
                last = part.num_columns - 1  # the two columns that were added last
                cols = [*part.columns[: last - 1], pa.array(np.diff(b)), pa.array(hits, part.schema.field(last).type)]
                yield pa.record_batch(cols, part.schema.names)

    return rows.mapInArrow(scan, rows.schema)


def merged(spans) -> list[tuple[int, int]]:
    """Union of [a, b) ranges as disjoint ranges in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def items_digest(items: Column | str) -> Column:
    """Lower-case SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.concat_ws(",", items), 256)
