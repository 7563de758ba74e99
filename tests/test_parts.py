import pytest
from pyspark.sql import functions as F

from wordloom.operators import ngram as ng
from wordloom.sources.parts import Keyed, PartStore
from wordloom.streaming import ngram_stream as stream


def flat(df):
    return sorted((r["context"], r["word"], r["cnt"], int(r["first"])) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_equals_update(spark, tmp_path, docs):
    a, b, c = docs("a b a c a b d", "é 7"), docs("b d a b", start=5), docs("z a b", "", start=9)
    store = ng.NgramStore(spark, str(tmp_path / "m"), 1, buckets=4)
    assert store.model().counts.count() == 0
    want = ng.train_ngram(a, 1)
    for batch, more in ((0, None), (1, b), (2, c)):
        want = want.update(more, batch) if more else want
        store.train(more or a, batch)
        assert flat(store.model().counts) == flat(want.counts)
        assert sorted(r[0] for r in store.model().vocab.collect()) == sorted(r[0] for r in want.vocab.collect())
    # batches that are there already
    assert store.train(b, 1).version == 3 and flat(store.model().counts) == flat(want.counts)
    # earlier versions stay, until the old parts are deleted
    assert flat(store.model(1).counts) == flat(ng.train_ngram(a, 1).counts)
    assert "Exchange" not in plan(store.model().counts)
    assert len(store.parts.compact().parts) == 1 and store.parts.vacuum() == 6
    assert flat(store.model().counts) == flat(want.counts) and store.parts.compact().version == 4
    # another opening of the same folder, whose tables this session does not know
    for name in store.parts.names.values():
        spark.sql(f"DROP TABLE {name}")
    assert flat(ng.NgramStore(spark, str(tmp_path / "m"), 1, buckets=4).model().counts) == flat(want.counts)


def test_dead_writer_leaves_the_version(spark, tmp_path):
    spec = {"t": Keyed("k string, v bigint", ("k",), (("v", "sum"),)), "u": Keyed("k string", ("k",))}
    store = PartStore(spark, str(tmp_path / "s"), spec, 3)
    rows = spark.createDataFrame([("x", 1), (None, 2)], "k string, v bigint")
    store.append({"t": rows, "u": rows.select("k")})
    with pytest.raises(Exception, match="boom"):  # the second table fails after the first was written
        store.append({"t": rows, "u": rows.select(F.raise_error(F.lit("boom")).alias("k"))})
    assert store.version().version == 1 and sorted(store.read("t").collect(), key=str) == sorted(rows.collect(), key=str)
    assert store.vacuum() >= 1
    store.append({"t": rows, "u": rows.select("k")}, tag=7)
    assert {r["k"]: r["v"] for r in store.read("t").collect()} == {"x": 2, None: 4}
    assert store.read("u").count() == 2
    with pytest.raises(ValueError, match="no version 9"):
        store.read("t", 9)
    store._commit(store.version())
    with pytest.raises(ValueError, match="two writers"):
        store.read("t")


def test_stream_into_a_store(spark, tmp_path, docs):
    src = tmp_path / "incoming"
    texts = ["a b a c", "b d a b", "a b", "c a b d", "q"]
    for i, t in enumerate(texts):
        docs(t, start=10 * i).coalesce(1).write.parquet(str(src / f"part{i}"))
    store = stream.counts_store(spark, str(tmp_path / "store"), 3)
    arriving = lambda: stream.stream_documents(spark, str(src) + "/*", max_files=1, base_path=str(src))
    stream.start_ngram_parts(arriving(), 1, store, str(tmp_path / "ckpt"), compact_every=2).awaitTermination()
    whole = spark.createDataFrame([(10 * i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    want = flat(ng.train_ngram(whole, 1).counts)
    assert flat(store.read("counts")) == want
    assert len(list((tmp_path / "store" / "counts").glob("part=*"))) <= 2
    # a replay from the first batch on, as after a lost checkpoint
    v = store.version()
    stream.start_ngram_parts(arriving(), 1, store, str(tmp_path / "ckpt2"), compact_every=2).awaitTermination()
    assert flat(store.read("counts")) == want and store.version().parts == v.parts
