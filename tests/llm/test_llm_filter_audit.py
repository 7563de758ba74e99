"""The filter audit against a plain loop over documents and orders, and on odd inputs."""

from __future__ import annotations

import re
from itertools import permutations

import pytest

from wordloom.llm import filter_audit
from wordloom.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, hash string, n bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def plain(docs, labels):
    """{(part, order, step): counts} by applying every order to every document."""
    mark = {}
    for i, q, t in labels:
        if i is not None:
            a, b = mark.get(i, (0, 0))
            mark[i] = (a or int(q == 1), b or int(t == 1))
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    failed = []
    for i, t, lang, *_ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        f = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
        f += "D" * bool(re.search("[#$%&*|]", t)) + "E" * (i is not None and least[t] < i)
        failed.append((lang or "", f, *mark.get(i, (0, 0))))
    out = {}
    for part in {x[0] for x in failed}:
        own = [x for x in failed if x[0] == part]
        all_removed = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for k, c in enumerate(order):
                gone = [any(b in f for b in order[:k]) for _, f, _, _ in own]
                now = [x for x, g in zip(own, gone) if c in x[1] and not g]
                all_removed[c] += len(now)
                kept = sum(not g and c not in x[1] for x, g in zip(own, gone))
                redundant = sum(g and c in x[1] for x, g in zip(own, gone))
                out[part, order, k + 1] = [kept, len(now), redundant, sum(x[1] == c for x in own), sum(x[2] for x in now), sum(x[3] for x in now)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(all_removed[order[k - 1]])
    return out


def found(df):
    cols = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in cols] for r in df.collect()}


def test_query_equals_plain(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = found(Q.QUERIES["op12_filter_audit"](spark, SF))
    assert got == plain(docs, labels) and len(got) % 600 == 0


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_odd_documents(spark, monkeypatch, broadcast):
    monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", broadcast)  # both ways of finding repeated hashes
    long = " ".join(f"w{i}" for i in range(150_000))
    odd = [(1, None, None), (2, "", "en"), (None, "", "en"), (3, long, "en"), (4, long, "de"), (4, long, "de"), (5, "AB cd " * 60, ""), (6, "a | b", "en"),
           (None, "a | b", "en"), (7, "a | b", "fr"), (0, "AÉ\U0001f600 x", "en"), (8, "same", "en"), (8, "same", "en"), (8, "other", "en")]
    odd += [(100 + i, "hot text " * 70, "en") for i in range(300)]  # one text holds most rows
    labels = [(1, 1, 1), (1, 0, 0), (2, 0, 1), (2, 1, None), (4, 1, 0), (8, None, 1), (None, 1, 1), (999, 1, 1), (150, 1, 1), (100, 1, 1)]
    docs = spark.createDataFrame([(*r, "clash", 7) for r in odd], DOCS).repartition(4)
    got = found(filter_audit.audit(docs, spark.createDataFrame(labels, LABELS)))
    assert got == plain(odd, labels)


def test_no_documents_or_labels(spark):
    none, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(none, labels).count() == 0
    one = spark.createDataFrame([(1, "x", "en", "", 1)], DOCS)
    assert found(filter_audit.audit(one, labels)) == plain([(1, "x", "en")], [])
