"""Vector code compression: product quantisation whose nearest entries are found by Orchard's search.

A vector of whole numbers is cut into equal consecutive parts; each part position has a codebook, learned by a few
rounds of assignment and averaging over all vectors. A part's nearest entry is searched from entry to entry: every
entry keeps a list of all entries of its codebook, sorted by their distance to it. The search walks the list of the
best entry so far and jumps to the list of any entry that is nearer. It ends where the list passes twice the current
distance: by the triangle inequality no entry further along can be nearer, nor as near. Distances are squared and
whole, so results are exact, ties included.

Spark reads the vectors once a round. A task sends one sum per entry and component that it met (bounded by the
codebooks, not by its rows), Spark adds these up, and the driver holds the codebooks only.

Defined results:

* rows whose vector is null or holds a null, NaN or infinite component are left out;
* vectors of unequal lengths, or of a length that ``parts`` doesn't divide, count as padded with zeros to the smallest
  multiple of ``parts`` that holds the longest; an empty vector is all zeros;
* the first entries are the parts of the first ``entries`` rows by id, then by vector (nulls last): rows that repeat an
  id are rows of their own, equal entries stay, and the lower index wins their ties; fewer rows give fewer entries;
* no usable row gives empty codebooks and no rows;
* components beyond 2**26 after scaling end the job with a message, as their squares would not fit a long;
* a null label is a label like any other; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C

LARGEST = 1 << 26
_ROWS = 4096  # vectors that are searched at once: with 16 parts of 64 entries, 4 MB of visit marks
_SALTS = 16


def usable(vector: Column) -> Column:
    """True for vectors that aren't null and hold finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole_parts(col: pa.Array, parts: int, width: int, scale: int) -> np.ndarray:
    """(rows, parts, width) whole numbers: floor(scale * x), missing components 0."""
    lists = col.cast(pa.large_list(pa.float64()))
    sizes = np.diff(lists.offsets.to_numpy())
    x = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST} after scaling by {scale}: its distances would not fit a long")
    out = np.zeros((len(col), parts * width), np.int64)
    out[np.arange(parts * width) < sizes[:, None]] = x.astype(np.int64)
    return out.reshape(len(col), parts, width)


@dataclass
class Search:
    """Codebooks (parts, entries, width) with each entry's list of all entries by distance."""

    books: np.ndarray

    def __post_init__(self) -> None:
        gap = np.stack([((b[:, None] - b[None]) ** 2).sum(2) for b in self.books])
        self.order = np.argsort(gap, axis=2, kind="stable")
        self.gap = np.take_along_axis(gap, self.order, 2)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each part; the lower index wins ties."""
        rows, parts, width = points.shape
        k = self.books.shape[1]
        x, part = points.reshape(-1, width), np.tile(np.arange(parts), rows)
        at, place = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        best = ((x - self.books[part, 0]) ** 2).sum(1)
        seen = np.zeros((len(x), k), bool)
        seen[:, 0] = True
        live = np.arange(len(x) if k > 1 else 0)
        while len(live):
            p, a, s = part[live], at[live], place[live]
            go = self.gap[p, a, s] <= 4 * best[live]  # beyond twice the distance (squared: four times) nothing is as near
            live, p, a, s = live[go], p[go], a[go], s[go]
            entry = self.order[p, a, s]
            place[live] = s + 1
            new = ~seen[live, entry]
            i, entry = live[new], entry[new]
            seen[i, entry] = True
            d = ((x[i] - self.books[part[i], entry]) ** 2).sum(1)
            better = (d < best[i]) | ((d == best[i]) & (entry < at[i]))
            i = i[better]
            at[i], best[i], place[i] = entry[better], d[better], 0
            live = live[place[live] < k]
        return at.reshape(rows, parts), best.reshape(rows, parts)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, _ROWS):
            yield b.slice(i, _ROWS)


def _sums(search: Search, scale: int):
    """Task: number and component sums of the parts that each entry is nearest to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = search.books.shape
        n, total = np.zeros(parts * k, np.int64), np.zeros((parts * k, width), np.int64)
        for b in _cut(batches):
            x = whole_parts(b.column("vec"), parts, width, scale)
            slot = (np.arange(parts) * k + search.nearest(x)[0]).ravel()
            n += np.bincount(slot, minlength=parts * k)
            np.add.at(total, slot, x.reshape(-1, width))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {
                "slot": np.repeat(used, width),
                "pos": np.tile(np.arange(width), len(used)),
                "n": np.repeat(n[used], width),
                "total": total[used].ravel(),
            }
        )

    return run


def _codes(search: Search, scale: int):
    """Task: the code and error of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, width = search.books.shape
        for b in _cut(batches):
            at, best = search.nearest(whole_parts(b.column("vec"), parts, width, scale))
            code = [row.tobytes().hex() for row in at.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(code, pa.string()), pa.array(best.sum(1))],
                ["vec_id", "label", "code", "error"],
            )

    return run


@dataclass
class Codebooks:
    """``books``: (parts, entries, width) whole numbers; a vector's components are floor(scale * x)."""

    books: np.ndarray
    scale: int

    def sha256(self) -> str:
        """Of all components by part, entry and place, decimal and comma-joined."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def learn(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks:
    """Codebooks of ``entries`` entries for each of ``parts`` part positions, learned from all usable vectors.

    They start as the parts of the first ``entries`` vectors by id. A round assigns every part to its nearest entry
    and makes each entry the mean of its parts, rounded down by component; entries without parts stay.
    """
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("entries must be 1 to 256, so that an index is two hex digits, and parts at least 1")
    C.ship(vectors.sparkSession)
    kept = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec")).where(usable(F.col("vec")))
    longest = kept.agg(F.max(F.size("vec"))).first()[0]
    width = -(-max(longest or 0, 1) // parts)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").toArrow()
    start = whole_parts(first.column("vec").combine_chunks(), parts, width, scale)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds if len(start) else 0):
        met = kept.select("vec").mapInArrow(_sums(Search(books), scale), "slot bigint, pos bigint, n bigint, total bigint")
        added = met.groupBy("slot", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        books = books.copy()
        for slot, pos, n, total in added.collect():  # one row per component of the codebooks at most
            books[slot // books.shape[1], slot % books.shape[1], pos] = int(total) // n
    return Codebooks(books, scale)


def encode(vectors: DataFrame, codebooks: Codebooks, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, code, error`` of every usable vector: two hex digits per part, and the sum of squared distances."""
    C.ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")).where(usable(F.col("vec")))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    if not codebooks.books.shape[1]:
        rows = rows.where(F.lit(False))
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
    return rows.mapInArrow(_codes(Search(codebooks.books), codebooks.scale), f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error bigint")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the error summed over equal labels (nulls together).

    A label may hold a third of the rows, so each label's sum is ``_SALTS`` join keys, of which a row takes one.
    """
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    copies = totals.select(F.col("label").alias("_l"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_s"))
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(_SALTS)).cast("int"))
    joined = salted.join(copies, F.col("label").eqNullSafe(F.col("_l")) & (F.col("_salt") == F.col("_s")))
    return joined.select(*coded.columns, "label_error")
