"""Vector codes against a search of every entry, and on odd inputs."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from wordloom.llm import codes
from wordloom.llm import queries as Q

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, error string"


def plain(rows, parts, entries, rounds, scale=256):
    """(vec_id, label, code, error) by comparing every part with every entry, and the digest of the codebooks."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(scale * x) for x in r[1]] for r in good]
    width = -(-max([1, *map(len, whole)]) // parts)
    whole = [v + [0] * (parts * width - len(v)) for v in whole]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            met = defaultdict(list)
            for v in cut:
                met[near(p, v[p])[1]].append(v[p])
            new.append([tuple(sum(c) // len(met[k]) for c in zip(*met[k])) if k in met else e for k, e in enumerate(books[p])])
        books = new
    out = []
    for r, v in zip(good, cut):
        found = [near(p, v[p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{k:02x}" for _, k in found), sum(e for e, _ in found)))
    return out, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_query_equals_plain(spark):
    got = Q.QUERIES["op11_vector_codes"](spark, SF).collect()
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, sha = plain(table, 16, 64, 2)
    by = defaultdict(int)
    for _, label, _, error in want:
        by[label] += error
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == sorted((i, c, e, by[label]) for i, label, c, e in want)
    assert {r["codebooks_sha256"] for r in got} == {sha}


@pytest.mark.parametrize("entries,parts,rounds", [(4, 3, 2), (256, 2, 1), (1, 1, 3)])
def test_odd_vectors(spark, entries, parts, rounds):
    rng = np.random.default_rng(3)
    vecs = [[float(np.float32(x)) for x in rng.normal(size=6)] for _ in range(30)]
    nan, inf = float("nan"), float("inf")
    rows = [(i % 20, v, i % 3 or None, "x") for i, v in enumerate(vecs)]  # repeated ids
    rows += [(40, vecs[0], 1, None)] * 5 + [(None, vecs[1], None, "y"), (50, [], 1, ""), (51, [0.5], None, ""), (52, [-0.001] * 6, 2, "")]
    bad = [(60, None, 1, ""), (61, [1.0, None], 1, ""), (62, [nan, 1.0], 1, ""), (63, [inf], 1, ""), (64, [-inf, 0.0], None, "")]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(5)
    books = codes.learn(df, parts=parts, entries=entries, rounds=rounds)
    want, sha = plain(rows + bad, parts, entries, rounds)
    assert books.sha256() == sha
    got = codes.encode(df, books)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    total = defaultdict(int)
    for _, label, _, error in want:
        total[label] += error
    summed = codes.with_label_error(got).collect()
    assert len(summed) == len(want) and all(r["label_error"] == total[r["label"]] for r in summed)


def test_no_vectors_and_too_large_ones(spark):
    none = spark.createDataFrame([(1, None, 1, "")], SCHEMA)
    books = codes.learn(none)
    assert books.sha256() == hashlib.sha256(b"").hexdigest() and codes.encode(none, books).count() == 0
    assert codes.with_label_error(codes.encode(none, books)).columns == ["vec_id", "label", "code", "error", "label_error"]
    with pytest.raises(Exception, match="would not fit"):
        codes.learn(spark.createDataFrame([(1, [1e30], 1, "")], SCHEMA))
    with pytest.raises(ValueError):
        codes.learn(none, entries=257)


def test_search_visits_few_entries_and_finds_ties():
    rng = np.random.default_rng(5)
    books = rng.integers(-40, 40, (3, 50, 2))
    books[:, 7] = books[:, 3]  # equal entries: the lower index wins
    points = rng.integers(-60, 60, (400, 3, 2))
    at, best = codes.Search(books).nearest(points)
    d = ((points[:, :, None] - books[None]) ** 2).sum(3)
    assert (at == d.argmin(2)).all() and (best == d.min(2)).all()
