"""Language-model scoring: an interpolated modified Kneser-Ney bigram model.

Counted in Spark, kept in full (no pruning, no sampling), stored as sorted hash
arrays in the shared folder and memory-mapped by the workers that score.

* Counting. Each task sorts the word and bigram hashes of its rows, adds up
  equal ones and emits one binary block per bucket, so a row that is shuffled
  is a block of distinct n-grams, not a token. Words are dealt by hash; bigrams
  by their first word, and by both words where the first one is so frequent
  that it would fill a bucket alone (at most one such word per bucket can
  exist, which bounds the list). A bucket's size follows ``BUCKET_TOKENS``.
* Statistics. Buckets give, for every bigram, its count; for every first word
  the number of followers seen once, twice, three times or more; for every word
  the number of distinct predecessors. The last two are added up over buckets
  in the same way as counts.
* Files. One sorted ``.npy`` array per bucket and field. A repeated task writes
  the same bytes under the same name.
* Scoring. Look-ups go to the arrays in sorted order; only pages that are
  touched are read. Nothing of the model is broadcast or sent to the driver but
  the bucket layout and the discounts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C

BUCKET_TOKENS = 2_000_000
TASK_TOKENS = 2_000_000  # hashes that a counting task holds before it sorts and adds them up
END = C.mix(np.array([0x5EED0E0D], np.uint64))[0]  # the end token; its hash stands beside those of words
START = C.mix(np.array([0x5EED0B05], np.uint64))[0]
_BLOCK = "bucket int, kind int, n bigint, data binary"


@dataclass
class Layout:
    """What scoring needs besides the files; ``hot`` has one word per bucket at most."""

    root: str
    buckets: int
    hot: np.ndarray
    tokens: int  # N
    types: int  # V
    bigrams: int  # distinct
    texts: int
    d2: tuple[float, float, float]  # discounts of bigrams and, below, of predecessor counts
    d1: tuple[float, float, float]
    before: tuple[int, int, int]  # words with one, two, more distinct predecessors
    words: list[int]  # buckets that have files
    pairs: list[int]

    def bigram_bucket(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        h = np.where(C.find(self.hot, u) >= 0, C.pair(u, w), u)
        return (h >> np.uint64(33)).astype(np.int64) % self.buckets

    def word_bucket(self, w: np.ndarray) -> np.ndarray:
        return (w >> np.uint64(33)).astype(np.int64) % self.buckets


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(a.tobytes() for a in arrays)


def _unpack(data: bytes, n: int, *types: type) -> list[np.ndarray]:
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _blocks(bucket: np.ndarray, buckets: int, kind: int, *arrays: np.ndarray) -> pa.RecordBatch:
    """One row per bucket that has entries; arrays keep their order within a bucket."""
    o = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[o], np.arange(buckets + 1))
    arrays = tuple(a[o] for a in arrays)
    rows = [(b, cut[b + 1] - cut[b], _pack(*(a[cut[b] : cut[b + 1]] for a in arrays))) for b in range(buckets) if cut[b + 1] > cut[b]]
    b, n, data = zip(*rows) if rows else ((), (), ())
    return pa.record_batch([pa.array(b, pa.int32()), pa.array([kind] * len(b), pa.int32()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["bucket", "kind", "n", "data"])


def _sequence(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens with START before and END after each, and the texts' offsets therein."""
    h, _, _, b = C.words(*C.text_bytes(part.column("text")), C.NONSPACE_LOWER)
    n = len(b) - 1
    off = b + 2 * np.arange(n + 1)
    out = np.full(off[-1], START, np.uint64)
    at = np.arange(len(h)) + 2 * np.repeat(np.arange(n), np.diff(b)) + 1
    out[at] = h
    out[off[1:] - 1] = END
    return out, off


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sequences and a mask of where texts begin, in runs of about TASK_TOKENS tokens."""
    seqs, total = [], 0
    for batch in batches:
        for part in C.slices(batch, "text"):
            seqs.append(_sequence(part))
            total += len(seqs[-1][0])
            if total >= TASK_TOKENS:
                yield _joined(seqs)
                seqs, total = [], 0
    if seqs:
        yield _joined(seqs)


def _joined(seqs: list) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([s for s, _ in seqs]), np.concatenate([_marks(len(s), o[:-1]) for s, o in seqs])


def _marks(n: int, at: np.ndarray) -> np.ndarray:
    out = np.zeros(n, bool)
    out[at] = True
    return out


def _add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    o = np.argsort(k, kind="stable")
    k, c = k[o], c[o]
    at = C.runs(k)
    return k[at], np.add.reduceat(c, at) if len(at) else c


def _distinct_pairs(u: np.ndarray, w: np.ndarray, c: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (u, w) in the order of their pair hash, with counts added up."""
    key = C.pair(u, w)
    o = np.argsort(key)
    key = key[o]
    at = C.runs(key)
    n = np.diff(np.append(at, len(key))) if c is None else (np.add.reduceat(c[o], at) if len(at) else c)
    return u[o][at], w[o][at], n


def train(docs: DataFrame, text_col: str = "text", bucket_tokens: int = BUCKET_TOKENS) -> "Model":
    """Model of all rows of ``docs``; a null text counts as an empty one (its end is a token).

    An empty table gives a model that knows nothing: every token gets the uniform probability 1.
    """
    spark = docs.sparkSession
    C.ship(spark)
    scratch = C.Scratch(spark, "lm")
    root = C.mounted(scratch.root)
    rows = docs.select(F.col(text_col).alias("text"))
    # the bucket number is the only thing that this pass decides, so a size in bytes is enough
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("b"), F.count(F.lit(1)).alias("n")).first()
    buckets = max(4, int((size["b"] or 0) / 6 / bucket_tokens) + 1)

    def count_words(batches):
        for seq, _ in _held(batches):
            k, n = C.sorted_unique(seq)
            yield _blocks((k >> np.uint64(33)).astype(np.int64) % buckets, buckets, 0, k, n)

    def merge_words(key, table):
        parts = [_unpack(d.as_py(), n.as_py(), np.uint64, np.int64) for d, n in zip(table["data"], table["n"])]
        k, n = _add_up([p[0] for p in parts], [p[1] for p in parts])
        b = key[0].as_py()
        C.write_file(f"{root}/words-{b:05d}/key.npy", lambda f: np.save(f, k))
        C.write_file(f"{root}/words-{b:05d}/count.npy", lambda f: np.save(f, n))
        known = k != START
        top = np.argsort(n)[::-1][:64]
        return pa.table({"bucket": pa.array([b], pa.int32()), "tokens": [int(n[known].sum())], "types": [int(known.sum())], "key": pa.array([k[top].view(np.int64)], pa.list_(pa.int64())), "n": pa.array([n[top]], pa.list_(pa.int64()))})

    got = scratch.table(rows.mapInArrow(count_words, _BLOCK).groupBy("bucket").applyInArrow(merge_words, "bucket int, tokens bigint, types bigint, key array<bigint>, n array<bigint>"), "word-stats")
    total = got.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"), F.collect_list("bucket").alias("have")).first()
    tokens, types = int(total["tokens"] or 0), int(total["types"] or 0)
    # fewer than 4 * buckets words can have more than a quarter of a bucket's share each
    top = got.select(F.explode(F.arrays_zip("key", "n")).alias("x")).where(F.col("x.n") > max(1, tokens // (4 * buckets))).select("x.key").collect()
    hot = np.sort(np.array([r["key"] for r in top], np.int64).view(np.uint64))
    layout = Layout(root, buckets, hot, tokens, types, 0, int(size["n"]), (0, 0, 0), (0, 0, 0), (0, 0, 0), total["have"], [])

    def count_pairs(batches):
        for seq, first in _held(batches):
            inner = ~first[1:]  # a text's first token follows nothing
            u, w, n = _distinct_pairs(seq[:-1][inner], seq[1:][inner])
            yield _blocks(layout.bigram_bucket(u, w), buckets, 0, u, w, n.astype(np.uint32))

    def merge_pairs(key, table):
        parts = [_unpack(d.as_py(), n.as_py(), np.uint64, np.uint64, np.uint32) for d, n in zip(table["data"], table["n"])]
        u, w, n = _distinct_pairs(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
        b = key[0].as_py()
        C.write_file(f"{root}/pairs-{b:05d}/key.npy", lambda f: np.save(f, C.pair(u, w)))
        C.write_file(f"{root}/pairs-{b:05d}/count.npy", lambda f: np.save(f, n.astype(np.uint32)))
        of_count = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        o = np.argsort(u, kind="stable")
        at = C.runs(u[o])
        cls = np.minimum(n[o], 3)
        follow = [(np.add.reduceat((cls == k).astype(np.int64), at) if len(at) else np.zeros(0, np.int64)) for k in (1, 2, 3)]
        uk = u[o][at]
        wk, before = C.sorted_unique(w)
        a = _blocks(layout.word_bucket(uk), buckets, 1, uk, *follow)
        z = _blocks(layout.word_bucket(wk), buckets, 2, wk, before)
        out = pa.Table.from_batches([a, z])
        for name, x in zip(("n1", "n2", "n3", "n4", "pairs", "of"), (*of_count, len(u), b)):
            fill = b if name == "of" else 0
            out = out.append_column(name, pa.array([x] + [fill] * (len(out) - 1), pa.int64()))
        return out

    sides = scratch.table(rows.mapInArrow(count_pairs, _BLOCK).groupBy("bucket").applyInArrow(merge_pairs, _BLOCK + ", n1 bigint, n2 bigint, n3 bigint, n4 bigint, pairs bigint, of bigint"), "sides")
    s = sides.agg(*(F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "pairs")), F.collect_set("of").alias("have")).first()
    layout.d2, layout.bigrams, layout.pairs = discounts(s["n1"], s["n2"], s["n3"], s["n4"]), int(s["pairs"] or 0), s["have"]

    def merge_sides(key, table):
        b = key[0].as_py()
        word = np.load(f"{root}/words-{b:05d}/key.npy")
        out = np.zeros((4, len(word)), np.int64)
        for d, n, kind in zip(table["data"], table["n"], table["kind"]):
            k, *fields = _unpack(d.as_py(), n.as_py(), np.uint64, *([np.int64] * (3 if kind.as_py() == 1 else 1)))
            at = np.searchsorted(word, k)
            for row, x in zip(out[:3] if kind.as_py() == 1 else out[3:], fields):
                np.add.at(row, at, x)
        C.write_file(f"{root}/words-{b:05d}/sides.npy", lambda f: np.save(f, out))
        return pa.table({f"n{k}": pa.array([int((out[3] == k).sum() if k < 5 else (out[3] > 2).sum())], pa.int64()) for k in range(1, 6)})

    s = sides.select("bucket", "kind", "n", "data").groupBy("bucket").applyInArrow(merge_sides, "n1 bigint, n2 bigint, n3 bigint, n4 bigint, n5 bigint").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(1, 6))).first()
    layout.d1 = discounts(s["n1"], s["n2"], s["n3"], s["n4"])
    layout.before = (int(s["n1"] or 0), int(s["n2"] or 0), int(s["n5"] or 0))
    scratch.drop("sides", "word-stats")
    return Model(layout)


def discounts(n1: int | None, n2: int | None, n3: int | None, n4: int | None) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; 0.5, 1 and 1.5 where too few counts of counts exist."""
    n1, n2, n3, n4 = (float(x or 0) for x in (n1, n2, n3, n4))
    if not (n1 and n2 and n3 and n4):
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))  # type: ignore[return-value]


class Model:
    """A trained model: its layout and the files under ``layout.root``."""

    def __init__(self, layout: Layout) -> None:
        self.layout = layout

    def save(self) -> str:
        """Write the layout beside the arrays; returns the folder that ``load`` takes."""
        x = self.layout
        text = json.dumps(x.__dict__ | {"hot": x.hot.view(np.int64).tolist()})
        C.write_file(f"{x.root}/layout.json", lambda f: f.write(text.encode()))
        return x.root

    @staticmethod
    def load(root: str) -> "Model":
        with open(f"{root}/layout.json") as f:
            x = json.load(f)
        return Model(Layout(**x | {"root": root, "hot": np.array(x["hot"], np.int64).view(np.uint64)}))

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col``, n_tokens, n_known, base_score, score, perplexity of every row (ids are not looked at)."""
        C.ship(docs.sparkSession)
        layout = self.layout

        def scan(batches):
            reader = _Reader(layout)
            for batch in batches:
                for part in C.slices(batch, "text", 6 << 20):
                    seq, off = _sequence(part)
                    n, known, base, score = reader.score(seq, off)
                    yield pa.record_batch([part.column("id"), pa.array(n), pa.array(known), pa.array(base), pa.array(score), pa.array(10 ** np.minimum(-score / n, 300.0))], ["id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double"
        return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_col)


class _Reader:
    """Look-ups in the memory-mapped arrays."""

    def __init__(self, layout: Layout) -> None:
        self.l = layout
        self.maps: dict[str, np.ndarray] = {}

    def array(self, name: str) -> np.ndarray:
        if name not in self.maps:
            self.maps[name] = np.load(f"{self.l.root}/{name}.npy", mmap_mode="r")
        return self.maps[name]

    def _by_bucket(self, have: list[int], bucket: np.ndarray, key: np.ndarray):
        o = np.lexsort((key, bucket))
        cut = np.searchsorted(bucket[o], np.arange(self.l.buckets + 1))
        for b in have:
            if cut[b + 1] > cut[b]:
                yield b, o[cut[b] : cut[b + 1]]

    def words(self, w: np.ndarray) -> np.ndarray:
        """Rows: count, followers seen once, twice, more often, distinct predecessors."""
        out = np.zeros((5, len(w)), np.int64)
        for b, at in self._by_bucket(self.l.words, self.l.word_bucket(w), w):
            p = C.find(self.array(f"words-{b:05d}/key"), w[at])
            at, p = at[p >= 0], p[p >= 0]
            out[0, at] = self.array(f"words-{b:05d}/count")[p]
            out[1:, at] = self.array(f"words-{b:05d}/sides")[:, p]
        return out

    def pairs(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        key, out = C.pair(u, w), np.zeros(len(u), np.int64)
        for b, at in self._by_bucket(self.l.pairs, self.l.bigram_bucket(u, w), key):
            p = C.find(self.array(f"pairs-{b:05d}/key"), key[at])
            out[at[p >= 0]] = self.array(f"pairs-{b:05d}/count")[p[p >= 0]]
        return out

    def score(self, seq: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        x = self.l
        types, inv = np.unique(seq, return_inverse=True)
        c, f1, f2, f3, before = self.words(types).astype(np.float64)
        first = _marks(len(seq), off[:-1])
        token = ~first
        base = np.log10((c + 1) / (x.tokens + x.types + 1))
        # unigrams: distinct predecessors, discounted, with the uniform distribution over V + 1 words
        d = np.array([0.0, *x.d1])
        total = max(1, x.bigrams)
        left = (d * np.array([0.0, *x.before])).sum() / total if x.bigrams else 1.0
        p1 = np.maximum(before - d[np.minimum(before, 3).astype(int)], 0) / total + left / (x.types + 1)
        # bigrams; a first word that was never followed by anything leaves all to the unigram
        at = np.flatnonzero(token)
        iu, iw = inv[at - 1], inv[at]
        key = iu.astype(np.int64) * len(types) + iw
        uniq, back = np.unique(key, return_inverse=True)
        ku, kw = uniq // max(1, len(types)), uniq % max(1, len(types))
        n2 = self.pairs(types[ku], types[kw]).astype(np.float64)
        d2 = np.array([0.0, *x.d2])
        ctx = c[ku]
        seen = ctx > 0
        safe = np.maximum(ctx, 1)
        gamma = np.where(seen, (d2[1] * f1 + d2[2] * f2 + d2[3] * f3)[ku] / safe, 1.0)
        p = np.where(seen, np.maximum(n2 - d2[np.minimum(n2, 3).astype(int)], 0) / safe, 0.0) + gamma * p1[kw]
        logp = np.zeros(len(seq))
        logp[at] = np.log10(p)[back]
        add = lambda v: np.add.reduceat(v, off[:-1]) if len(off) > 1 else np.zeros(0)
        return np.diff(off) - 1, add((token & (c[inv] > 0)).astype(np.int64)), add(np.where(token, base[inv], 0.0)), add(logp)


def lm_score(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every row by a model of the rows for which ``train_on`` holds; adds train_tokens and model_dir."""
    model = train(docs.where(train_on), text_col)
    root = model.save()
    return model.score(docs, id_col, text_col).withColumn("train_tokens", F.lit(model.layout.tokens).cast("bigint")).withColumn("model_dir", F.lit(root))
