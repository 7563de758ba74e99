"""Near-duplicate detection with BagMinHash signatures.

Documents are multisets of five-word shingles; two are near duplicates if the
multisets' Jaccard similarity (sum of minima over sum of maxima) is 0.8 or more.

* Signature. Every shingle carries Poisson processes over its weight axis, cut
  into the intervals (0,1], (1,2], (2,4], (4,8], ...; an interval whose first
  point can still matter is halved, down to units, and halves beyond the weight
  are left out. A point of a process is at a random time and belongs to a
  random register; a register keeps its earliest point. Two registers agree with the weighted Jaccard similarity as
  probability. Points later than the latest register are never drawn.
* Bands of ``ROWS`` registers are hashed; documents that share a band meet in a
  bucket. Equal texts are one node from the start.
* First every node is compared with the most popular node (the one that meets
  most others) that it shares a bucket with; links are verified on the texts
  and components are contracted. A bucket whose members are one component is
  done.
* In other buckets, shingles that no other node there has bound a node's best
  possible similarity: nodes that cannot reach the threshold with any member
  leave the bucket. The members outside a bucket's largest component meet the
  other components there, inside a join whose condition holds the bounds of
  both sides and an estimate from four bits per register; a pair comes out in
  the first band that it shares only. What comes out is verified. No partner is
  capped, and no bucket's pairs are emitted as such.
* A pair at the threshold fails the estimate, five standard deviations below
  it, with a probability of 1.2e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C
from wordloom.llm.decontamination import _shingles

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 40  # a pair at 0.8 shares none of 40 bands of 6 registers with a probability of 5e-6
ROWS = 6
MARGIN = 5  # standard deviations by which an estimate may fall short: 1.2e-6 of pairs at 0.8 do so further
_NIBBLES = 0x1111111111111111


def shingles_of(data: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every shingle; a text with fewer words, but not none, is one shingle of all its words."""
    h, _, _, b = C.words(data, off, C.ALNUM_LOWER)
    n = np.diff(b)
    sh, doc = _shingles(h, size), np.repeat(np.arange(len(n)), n)
    ok = np.arange(len(sh)) + size <= b[1:][doc[: len(sh)]]
    parts, docs = [sh[ok]], [doc[: len(sh)][ok]]
    for k in range(1, size):
        short = np.flatnonzero(n == k)
        if len(short):
            own = h[b[short]]
            for j in range(1, k):
                own = C.pair(own, h[b[short] + j])
            parts.append(own)
            docs.append(short)
    return np.concatenate(parts), np.concatenate(docs)


def weighted(sh: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, document) with the number of occurrences."""
    o = np.lexsort((sh, doc))
    sh, doc = sh[o], doc[o]
    first = np.flatnonzero(np.concatenate(([True], (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])))) if len(sh) else np.zeros(0, np.int64)
    return sh[first], doc[first], np.diff(np.append(first, len(sh)))


def bag_min_hash(sh: np.ndarray, doc: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """docs x registers hashes of the earliest points; zeros for a document without shingles.

    The draws depend on the shingle, the interval and the number of the draw only, so equal weights of equal
    shingles give equal points in every document.
    """
    time = np.full(docs * registers, np.inf)
    name = np.zeros(docs * registers, np.uint64)
    # one process per shingle and doubling interval (lo, hi] that the weight reaches into
    lo_, hi_, sh_, doc_, w_ = [], [], [], [], []
    k, lo, hi = np.arange(len(sh)), 0, 1
    while len(k):
        lo_.append(np.full(len(k), lo))
        hi_.append(np.full(len(k), hi))
        sh_.append(sh[k])
        doc_.append(doc[k])
        w_.append(weight[k])
        k = k[weight[k] > hi]
        lo, hi = hi, hi * 2
    lo, hi, sh, doc, w = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lo_, hi_, sh_, doc_, w_))
    state = C.pair(sh.astype(np.uint64), hi.astype(np.uint64))
    j = np.ones(len(state), np.uint64)  # points of the process that were drawn
    x = _wait(state, j, hi - lo)
    latest = np.full(docs, np.inf)
    while len(x):
        part = hi - lo > 1
        if part.any():
            # halve what is longer than a unit, covered or not, so that all documents see the same points: the point
            # goes to one half, the other half's first point comes later; a half beyond the weight is left out
            s, mid = state[part], (lo[part] + hi[part]) // 2
            left = (C.mix(s ^ np.uint64(0xA5A5A5A5)) & np.uint64(1)).astype(bool)
            later = x[part] + _wait(s ^ np.uint64(0x5A5A5A5A5A), np.uint64(0), mid - lo[part])
            right = mid < w[part]
            cat = lambda full, a, b: np.concatenate((full[~part], a, b[right]))
            halves = [C.pair(s, np.full(len(s), side, np.uint64)) for side in (11, 13)]
            x, state, j = cat(x, np.where(left, x[part], later), np.where(left, later, x[part])), cat(state, *halves), cat(j, j[part], j[part])
            lo, hi, doc, w = cat(lo, lo[part], mid), cat(hi, mid, hi[part]), cat(doc, doc[part], doc[part]), cat(w, w[part], w[part])
        full = hi - lo == 1
        if full.any():
            # with few processes left, each draws several points at once: later ones change nothing that is set
            many = 1 if full.sum() > 4096 else 32
            f = np.flatnonzero(full)
            draw = j[f, None] + np.arange(many, dtype=np.uint64)
            wait = _wait(state[f, None], draw + np.uint64(1), (hi[f] - lo[f])[:, None])
            t = np.concatenate((x[f, None], x[f, None] + np.cumsum(wait, 1)), 1)
            point = C.pair(np.broadcast_to(state[f, None], draw.shape), draw).ravel()
            slot = np.repeat(doc[f], many) * registers + (point >> np.uint64(32)).astype(np.int64) % registers
            when = t[:, :-1].ravel()
            np.minimum.at(time, slot, when)
            first = np.flatnonzero(when == time[slot])  # the earliest points of registers
            name[slot[first]] = point[first]
            x[f], j[f] = t[:, -1], j[f] + np.uint64(many)
            latest = time.reshape(docs, registers).max(1)
        live = x < latest[doc]
        x, state, j, lo, hi, doc, w = x[live], state[live], j[live], lo[live], hi[live], doc[live], w[live]
    return name.reshape(docs, registers)


def _wait(state: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Time to the j-th point of a process of the given rate."""
    h = C.mix(state + j * np.uint64(0x9E3779B97F4A7C15))
    return -np.log(((h >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / length


def _bands(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = C.mix(np.full(len(sig), b + 1, np.uint64))
        for r in range(rows):
            h = C.pair(h, sig[:, b * rows + r])
        out[:, b] = h
    return out


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(id, k, n, bands, sketch) of rows (id, text, k): n shingles, the band hashes (none for a text without words),
    and the lowest four bits of each register, sixteen to a number."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "text", 1 << 20):
                data, off = C.text_bytes(part.column("text"))
                sh, doc, w = weighted(*shingles_of(data, off, size))
                many = part.num_rows
                sig = bag_min_hash(sh, doc, w, many, bands * rows)
                own = _bands(sig, bands, rows).view(np.int64)
                n = np.bincount(doc, w, many).astype(np.int64)
                some = np.concatenate(([0], np.cumsum((n > 0) * bands)))
                lists = pa.ListArray.from_arrays(pa.array(some, pa.int32()), pa.array(own[n > 0].ravel()))
                words = -(-bands * rows // 16)
                low = np.zeros((many, words * 16), np.uint64)
                low[:, : bands * rows] = sig & np.uint64(15)
                packed = (low.reshape(many, words, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(2, dtype=np.uint64)
                sketch = pa.ListArray.from_arrays(pa.array(np.arange(many + 1) * words, pa.int32()), pa.array(packed.view(np.int64).ravel()))
                yield pa.record_batch([part.column("id"), part.column("k"), pa.array(n), lists, sketch], ["id", "k", "n", "bands", "sketch"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"id {kind}, k string, n bigint, bands array<bigint>, sketch array<bigint>")


def _likely(a: str, b: str, registers: int, threshold: float) -> Column:
    """Whether two sketches agree as those of a pair at the threshold do, or up to MARGIN standard deviations less
    often. Registers of different texts agree in four bits by chance once in sixteen times."""
    p = threshold + (1 - threshold) / 16
    most = registers * (1 - p + MARGIN * np.sqrt(p * (1 - p) / registers))
    differ: Column = F.lit(0)
    for i in range(-(-registers // 16)):
        x = F.get(F.col(a), i).bitwiseXOR(F.get(F.col(b), i))
        any_ = x
        for shift in (1, 2, 3):
            any_ = any_.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(any_.bitwiseAND(F.lit(_NIBBLES).cast("bigint")))
    return differ <= F.lit(float(most))


def shingle_counts(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(nid, g, n): how often each text of (nid, text) has each shingle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "text"):
                sh, doc, w = weighted(*shingles_of(*C.text_bytes(part.column("text")), size))
                yield pa.record_batch([part.column("nid").take(pa.array(doc)), pa.array(sh.view(np.int64)), pa.array(w)], ["nid", "g", "n"])

    return texts.mapInArrow(scan, "nid bigint, g bigint, n bigint")


def verify(pairs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Exact similarity of rows (a, b, ta, tb): (a, b, sim)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "tb", 1 << 20):
                sides = []
                for c in ("ta", "tb"):
                    sh, doc = shingles_of(*C.text_bytes(part.column(c)), size)
                    sides.append((sh, doc))
                sh, doc = np.concatenate([x for x, _ in sides]), np.concatenate([x for _, x in sides])
                side = np.repeat([0, 1], [len(x) for x, _ in sides])
                o = np.lexsort((sh, doc))
                sh, doc, side = sh[o], doc[o], side[o]
                first = np.flatnonzero(np.concatenate(([True], (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])))) if len(sh) else np.zeros(0, np.int64)
                b = np.add.reduceat(side, first) if len(first) else first
                a = np.diff(np.append(first, len(sh))) - b
                low = np.bincount(doc[first], np.minimum(a, b), part.num_rows)
                high = np.bincount(doc[first], np.maximum(a, b), part.num_rows)
                yield pa.record_batch([part.column("a"), part.column("b"), pa.array(low / np.maximum(high, 1))], ["a", "b", "sim"])

    return pairs.mapInArrow(scan, "a bigint, b bigint, sim double")


def components(links: DataFrame, scratch: C.Scratch, tag: str) -> DataFrame:
    """(k, c): for every end of a link the smallest end of its component (large-star, small-star)."""
    edges = scratch.table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{tag}-0")
    step = 0
    while True:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        # large star: larger neighbours of u go to the least of u and its neighbours
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        step += 1
        edges = scratch.table(small, f"{tag}-{step}")
        scratch.drop(f"{tag}-{step - 1}")
        # done when no smaller end is a larger end of another edge: all edges lead to the least node of a component
        if edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty():
            return edges.select(F.col("u").alias("k"), F.col("v").alias("c"))


def _relabel(label: DataFrame, comp: DataFrame) -> DataFrame:
    """Component of each node after the components of the last round were joined."""
    return label.join(comp.select(F.col("k").alias("c"), F.col("c").alias("d")), "c", "left").select("nid", F.coalesce("d", "c").alias("c"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, text_key (digest of the text), class_key, class_id (the smallest id of
    the class), class_size (rows).

    Equal texts are in one class; so are texts that a chain of links joins. A null text counts as an empty one. Texts
    without words have no shingles and are in a class with equal texts only. A class whose ids are all null has a null
    class_id. Repeated rows each count. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    C.ship(spark)
    scratch = C.Scratch(spark, "neardup")
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("k", F.md5("text"))
    rows_of = scratch.table(signatures(base, bands, rows), "signatures")
    # equal texts are added up in each task before they are shuffled; the written node numbers are fixed
    merged = rows_of.groupBy("k").agg(F.min("id").alias("id"), F.first(F.struct("n", "bands", "sketch")).alias("x"))
    nodes = scratch.table(merged.select(F.monotonically_increasing_id().alias("nid"), "k", "id", "x.*"), "nodes")
    rows_nid = scratch.table(rows_of.select("id", "k").join(nodes.select("k", "nid"), "k"), "rows")
    scratch.drop("signatures")
    member = nodes.select("nid", F.explode("bands").alias("bk"))
    shared = member.groupBy("bk").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = scratch.table(member.join(shared, "bk").select("bk", "nid", "size"), "buckets-1")
    popular = scratch.table(buckets.groupBy("nid").agg(F.sum("size").alias("pop")), "popular")
    wanted = popular.join(nodes.select("nid", "k", "id"), "nid").select("nid", F.col("k").alias("wk"), F.col("id").alias("wid"))
    found = base.join(wanted, F.expr("id <=> wid and k = wk")).select("nid", "text")
    texts = scratch.table(found.groupBy("nid").agg(F.first("text").alias("text")), "texts")  # repeated rows meet
    label = popular.select("nid", F.col("nid").alias("c"))

    registers = bands * rows

    def join_links(pairs: DataFrame, step: int) -> DataFrame:
        """The verified pairs as links, and the components that they join."""
        near = scratch.table(pairs, f"pairs-{step}")
        text = lambda side: texts.select(F.col("nid").alias(side), F.col("text").alias(f"t{side}"))
        both = near.join(text("a"), "a").join(text("b"), "b").select("a", "b", "ta", "tb")
        links = scratch.table(verify(both).where(F.col("sim") >= threshold).select("a", "b"), f"links-{step}")
        if links.isEmpty():
            return label
        of = lambda side: label.select(F.col("nid").alias(side), F.col("c").alias(f"c{side}"))
        between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a <> b")
        return scratch.table(_relabel(label, components(between, scratch, f"comp-{step}")), f"label-{step}")

    # first: every node with the most popular node that it shares a bucket with
    ranked = F.max(F.struct("pop", "nid"))
    hub = buckets.join(popular, "nid").groupBy("bk").agg(ranked["nid"].alias("hub"), ranked["pop"].alias("pop"))
    best = buckets.join(hub, "bk").groupBy("nid").agg(F.max(F.struct("pop", "hub"))["hub"].alias("a")).where("a <> nid")
    sketch = lambda side: nodes.select(F.col("nid").alias(side), F.col("sketch").alias(f"s{side}"))
    pairs = best.withColumnRenamed("nid", "b").join(sketch("a"), "a").join(sketch("b"), "b")
    label = join_links(pairs.where(_likely("sa", "sb", registers, threshold)).select("a", "b"), 1)
    # then: what is outside the largest component of a bucket with its other components
    own = buckets.select("bk", "nid").join(label, "nid")
    sizes = scratch.table(_bounds(_open(own), nodes, texts), "bounds")
    open_ = scratch.table(_open(_feasible(own.join(sizes, "nid"), threshold)), "open")
    if not open_.isEmpty():
        facts = scratch.table(sizes.join(nodes.select("nid", "bands", "sketch"), "nid"), "facts")
        members = open_.select("bk", "nid", "c", "main").join(facts, "nid")
        hubs = open_.where("c <> main").select("bk", "nid", "c").join(facts, "nid").select(*(F.col(x).alias(f"h_{x}") for x in ("bk", "nid", "c", "n", "v", "bands", "sketch")))
        shared_most = F.least("v", "h_v")
        can = (
            (F.col("bk") == F.col("h_bk"))
            & (F.col("c") != F.col("h_c"))
            & ((F.col("c") == F.col("main")) | (F.col("nid") > F.col("h_nid")))
            & (shared_most >= threshold * (F.col("n") + F.col("h_n") - shared_most))
            & _likely("sketch", "h_sketch", registers, threshold)
            & (F.col("bk") == F.get(F.array_intersect("bands", "h_bands"), 0))
        )
        label = join_links(members.join(hubs, can).select(F.col("h_nid").alias("a"), F.col("nid").alias("b")), 2)
    scratch.drop("nodes", "texts", "bounds", "buckets-1", "open", "facts", *(f"{x}-{i}" for x in ("pairs", "links") for i in (1, 2)))
    keyed = rows_nid.join(label, "nid", "left").select("id", "k", F.coalesce("c", "nid").alias("c"))
    sums = keyed.groupBy("c").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return keyed.join(sums, "c").select(F.col("id").alias(id_col), F.col("k").alias("text_key"), F.col("c").alias("class_key"), "class_id", "class_size")


def _open(own: DataFrame) -> DataFrame:
    """Rows (bk, nid, c, ...) of the buckets with several components, with the largest one as ``main``."""
    size = own.groupBy("bk", "c").agg(F.count(F.lit(1)).alias("n_c"))
    main = size.groupBy("bk").agg(F.max(F.struct("n_c", "c"))["c"].alias("main"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    return own.join(main.drop("kinds"), "bk")


def _bounds(open_: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(nid, n, v) of the nodes in open buckets: all shingles, and those that another such node has too."""
    some = open_.select("nid").distinct()
    counts = shingle_counts(texts.join(some, "nid"))
    alone = counts.groupBy("g").agg(F.count(F.lit(1)).alias("df"), F.min("nid").alias("nid"), F.min("n").alias("n")).where("df = 1")
    lost = alone.groupBy("nid").agg(F.sum("n").alias("lost"))
    return some.join(nodes.select("nid", "n"), "nid").join(lost, "nid", "left").select("nid", "n", (F.col("n") - F.coalesce("lost", F.lit(0))).alias("v"))


def _feasible(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows whose node may reach the threshold with a member of its bucket.

    A node shares at most v of its n shingles, so a partner of size m gives v / (n + m - v) at most, and m must be at
    least the threshold's share of n: the smallest member must not be larger than that allows.
    """
    least = rows.groupBy("bk").agg(F.min("n").alias("least"))
    cap = F.col("v") / threshold + F.col("v") - F.col("n") + 1e-6
    return rows.join(least, "bk").where(F.greatest(F.col("least"), threshold * F.col("n") - 1e-6) <= cap).drop("least")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row with the smallest id (nulls last; of
    equal ids the one whose text has the smallest digest; of repeated rows one). A null text counts as empty, an empty
    table gives none, and a column that clashes with a helper column is set aside meanwhile."""
    docs, back = C.set_aside(docs, {f"__nd_{x}" for x in "dijkln"})
    found = classes(docs, id_col, text_col, **options).select(F.col(id_col).alias("__nd_i"), F.col("text_key").alias("__nd_k"), "class_key")
    first = F.min(F.struct(F.col("__nd_i").isNull().alias("null"), "__nd_i", "__nd_k")).alias("x")
    keep = found.groupBy("class_key").agg(first).select(F.col("x.__nd_i").alias("__nd_i"), F.col("x.__nd_k").alias("__nd_k"))
    n = found.groupBy("__nd_i", "__nd_k").agg(F.count(F.lit(1)).alias("__nd_n")).select(F.col("__nd_i").alias("__nd_j"), F.col("__nd_k").alias("__nd_l"), "__nd_n")
    once = keep.join(n, F.expr("__nd_i <=> __nd_j and __nd_k = __nd_l")).select("__nd_i", "__nd_k", "__nd_n")
    rows = docs.withColumn("__nd_d", F.md5(F.coalesce(text_col, F.lit(""))))
    rows = rows.join(once, (F.col("__nd_d") == F.col("__nd_k")) & F.col(id_col).eqNullSafe(F.col("__nd_i")))
    names = [f"`{c}`" for c in docs.columns]
    one = rows.where("__nd_n = 1").select(*names)
    many = rows.where("__nd_n > 1").groupBy("__nd_i", "__nd_k").agg(F.first(F.struct(*names)).alias("r")).select("r.*")
    return one.unionByName(many).select(*back)
