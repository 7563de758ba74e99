"""Helpers shared by the training-data operators: scratch tables in the shared
folder, and vectorised word hashing over Arrow string columns."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.session import ensure_checkpoint_dir


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application: they may start elsewhere than the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_wordloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    zipped = Path(tempfile.mkdtemp(prefix="wordloom-")) / "wordloom.zip"
    with zipfile.ZipFile(zipped, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(zipped))
    sc._wordloom_shipped = True  # type: ignore[attr-defined]


class Scratch:
    """Tables and files of one job in the shared folder named by ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: a short lineage that outlives lost executors."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)


def set_aside(df: DataFrame, taken: set[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns that have a name of ``taken`` (in any case) renamed, and the columns that give all of its
    old names back. A table without such a column is returned as it is."""
    names, own = [], {c.lower() for c in df.columns} | taken
    for c in df.columns:
        name = c
        while name.lower() in taken or (name != c and name.lower() in own):
            name += "_"
        own.add(name.lower())
        names.append(name)
    back = [F.col(f"`{n}`").alias(c) for n, c in zip(names, df.columns)]
    return (df if names == df.columns else df.toDF(*names)), back


def mounted(uri: str) -> str:
    """The file-system path of a shared folder that every executor mounts."""
    u = urlparse(uri)
    if u.scheme not in ("", "file"):
        raise ValueError(f"{uri}: this operator's files need a shared folder that is mounted as a file system")
    return u.path


def write_file(path: str, write) -> None:
    """Write through a temporary name, so that a repeated or speculative task replaces whole files only."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(tmp, "wb") as f:
        write(f)
    os.replace(tmp, path)


def fold(key: Column, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod`` (a null key counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod


# --- word hashing -----------------------------------------------------------------

_SEG = 1 << 20  # bytes hashed at once: eight-byte temporaries of one segment stay near 8 MB each
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POW: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers (at least a segment's) of the base and of its inverse, modulo 2**64."""
    if not _POW or len(_POW[0]) < n:
        _POW.clear()
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, _SEG), b, np.uint64)
            p[0] = 1
            _POW.append(np.cumprod(p))
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + mix(b))


def byte_class(word: bytes | np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, value to hash) for every byte; ``lower`` folds A-Z."""
    is_word = np.zeros(256, bool)
    is_word[np.frombuffer(word, np.uint8) if isinstance(word, bytes) else word] = True
    to = np.arange(256)
    if lower:
        to[65:91] += 32
        is_word[65:91] |= is_word[97:123]
    return is_word, _BYTE[to]


#: The words of the contracts, as classes of UTF-8 bytes: a byte of 0x80 or more is always inside a character.
ALNUM_LOWER = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]), lower=True)
NONSPACE = byte_class(bytes(x for x in range(256) if x != 0x20 and not 0x09 <= x <= 0x0D))
NONSPACE_LOWER = byte_class(bytes(x for x in range(256) if x != 0x20 and not 0x09 <= x <= 0x0D), lower=True)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets; null counts as empty."""
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if off else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def words(data: np.ndarray, off: np.ndarray, classes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of many texts at once: (hash, first byte, byte after the last, n+1 offsets into these).

    A hash is a polynomial over random byte values, modulo 2**64, finalised.
    """
    is_word, value = classes
    w = is_word[data]
    s, e = w.copy(), w.copy()
    s[1:] &= ~w[:-1]
    e[:-1] &= ~w[1:]
    edge = np.unique(off[(off > 0) & (off < len(data))])
    s[edge] = w[edge]
    e[edge - 1] = w[edge - 1]
    start, end = np.flatnonzero(s), np.flatnonzero(e) + 1
    return span_hashes(data, start, end, value), start, end, np.searchsorted(start, off)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray = _BYTE, final: bool = True) -> np.ndarray:
    """Hash of each span of bytes (without the finaliser if not ``final``); spans are in order and do not overlap."""
    h = np.empty(len(start), np.uint64)
    power, inverse = powers(_SEG)
    i = 0
    while i < len(start):
        a = start[i]
        j = int(np.searchsorted(end, a + _SEG - 1, "right"))
        if j <= i:  # one span longer than a segment
            h[i] = int.from_bytes(hashlib.blake2b(value[data[a : end[i]]].tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        span = end[j - 1] - a
        p = np.zeros(span + 1, np.uint64)
        np.cumsum(value[data[a : end[j - 1]]] * power[:span], out=p[1:])
        h[i:j] = (p[end[i:j] - a] - p[start[i:j] - a]) * inverse[start[i:j] - a]
        i = j
    return mix(h) if final else h


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have about ``limit`` bytes together (a longer text stands alone)."""
    size = np.diff(text_bytes(batch.column(column))[1])
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(size[at:]), limit, "right")))
        yield batch.slice(at, n)
        at += n
    pa.default_memory_pool().release_unused()  # workers live on between stages


def sorted_unique(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and their counts."""
    a = np.sort(a)
    at = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, np.int64)
    return a[at], np.diff(np.append(at, len(a)))


def runs(a: np.ndarray) -> np.ndarray:
    """First position of each run of equal values."""
    return np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, np.int64)


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted value in sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class HashIndex:
    """Sorted 64-bit keys with a table of where each leading bit pattern begins."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.searchsorted((keys >> self.shift).astype(np.int64), np.arange((1 << bits) + 1)).astype(np.int32)
        self.longest = int(np.diff(self.table).max()) if len(keys) else 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Position of each hash, or len(keys) where it is absent."""
        n = len(self.keys)
        out = np.full(len(h), n)
        if not n:
            return out
        top = (h >> self.shift).astype(np.int64)
        at, end = self.table[top].astype(np.int64), self.table[top + 1]
        live = np.flatnonzero(at < end)
        for _ in range(self.longest):
            hit = self.keys[at[live]] == h[live]
            out[live[hit]] = at[live[hit]]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < end[live]]
        return out
