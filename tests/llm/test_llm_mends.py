"""Sharding of shuffled inputs; pages with short leads, rival containers and deep nesting."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from wordloom.llm import common as C
from wordloom.llm import html_extract, sharding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("advisory,parts", [("64m", 8), ("4k", 64)])
def test_shards_of_a_shuffled_input(spark, advisory, parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    try:
        for k, v in zip(old, (advisory, str(parts), "false")):
            spark.conf.set(k, v)
        shuffled = docs.unionByName(docs).repartition("doc_id")
        got = sharding.shuffle_to_shards(shuffled, C.Scratch(spark, "t").path("out"), shards=8, bucket_bytes=40_000).select("_shard", "_slot", "doc_id").collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 2 * docs.count()
    by = {}
    for r in got:
        by.setdefault(r["_shard"], []).append(r["_slot"])
    assert sorted(by) == list(range(8)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


STORY = "<p>" + "A long sentence of the story that goes on for a while. " * 6 + "</p>"


def texts(spark, pages):
    df = spark.createDataFrame([(i, f"http://h{h}.example/{i}", p) for i, (h, p) in enumerate(pages)], "page_id int, url string, html string")
    return {r["page_id"]: r["text"].split("\n") for r in html_extract.extract(df).collect()}


def test_short_leads_stay_and_menus_go(spark):
    lead = "<body><div class=top><p>By Ann Lee</p></div><div class=story>" + STORY * 3 + "</div></body>"
    inner = "<body><article><div><div class=meta><p>5 May</p></div></div><div class=text>" + STORY * 3 + "</div></article></body>"
    menu = "<body><div class=x><a href=a>Home</a> <a href=b>News</a></div><div class=story>" + STORY * 3 + "</div></body>"
    got = texts(spark, [(1, lead), (2, inner), (3, menu)])
    assert got[0][0] == "By Ann Lee" and len(got[0]) == 4
    assert got[1][0] == "5 May" and len(got[1]) == 4
    assert len(got[2]) == 3


def test_host_path_must_hold_the_page(spark):
    usual = "<body><div class=content>" + STORY * 3 + "</div></body>"
    odd = "<body><div class=content><p>Read also the other story of today.</p></div><div class=main-text>" + STORY * 4 + "</div></body>"
    got = texts(spark, [(1, usual)] * 5 + [(1, odd)])
    assert len(got[5]) >= 4 and got[5][-1].startswith("A long sentence")
    assert all(len(got[i]) == 3 for i in range(5))


def test_deep_nesting_is_linear():
    n = 50_000
    t = time.process_time()
    page = html_extract.Page("<body>" + "<div class=a1>x" * n + STORY + "</div>" * n)
    at = page.best()
    assert page.text({at}) and page.on(page.path(at)) == {at}
    assert time.process_time() - t < 20


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id=page class=no-sidebar><section>{}</section></div>", "<form><div class=body>{}</div></form>"])
def test_templates(spark, wrap):
    page = "<html><body><nav><ul><li><a href=x>Menu</a></ul></nav>" + wrap.format("<h1>Title here</h1>" + STORY * 2) + "<footer>Imprint</footer></body></html>"
    (got,) = texts(spark, [(1, page)]).values()
    assert got[0] == "Title here" and len(got) == 3


def test_clashing_columns_are_set_aside(spark):
    from wordloom.llm import decontamination, neardup

    words = " ".join(f"word{i}" for i in range(40))
    rows = [(1, words, 5, "x", None, 1), (2, words, 6, "y", "z", 2), (3, "clean text of another kind " * 5, 7, None, "k", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __dc_words int, __DC_hits string, __nd_d string, __nd_n int")
    bench = spark.createDataFrame([(9, words)], "item_id bigint, text string")
    clean = decontamination.clean_rows(docs, bench)
    assert clean.columns == docs.columns and [tuple(r) for r in clean.collect()] == [rows[2]]
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


def test_windows_that_many_items_share_are_one_entry(spark, monkeypatch):
    from wordloom.llm import decontamination

    def one(k):
        return " ".join(f"w{k}x{i}" for i in range(13))

    shared = " ".join(f"common{i}" for i in range(13))
    items = [(i, f"{shared} {one(i)}" if i % 3 == 0 else one(i)) for i in range(90)] + [(None, shared), (5, "short"), (7, None)]
    bench = spark.createDataFrame(items, "item_id bigint, text string").repartition(7)
    texts = [f"lead {shared} tail", f"{one(4)} and {one(5)}", "short", f"lead {shared} tail", "nothing here", None, one(60)[4:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    windows = decontamination._Windows(C.Scratch(spark, "t"), bench, "item_id", 13)
    assert windows.distinct.count() == 1 + 30 * 13 + 60 + 1 and windows.per_item.count() > windows.distinct.count() + 29
    monkeypatch.setattr(decontamination, "LIVE", 3)
    for block in (50, 1000):  # ten blocks in four passes; one block
        got = {r["doc_id"]: r for r in decontamination.decontaminate(docs, bench, block=block).collect()}
        thirds = sorted(str(i) for i in range(0, 90, 3))
        assert [got[d]["items"] for d in range(7)] == [thirds, ["4", "5"], ["5"], thirds, [], [], []]
        assert [got[d]["n_hit"] for d in range(7)] == [13, 26, 1, 13, 0, 0, 0]
        assert [r["doc_id"] for r in decontamination.clean_rows(docs, bench, block=block).orderBy("doc_id").collect()] == [4, 5, 6]
