"""What the findings on growth asked for: work that is done once, files and tasks that grow with the input."""

from pyspark.sql import functions as F

from wordloom.operators import ngram as ng
from wordloom.operators import qa
from wordloom.plans import inputs
from wordloom.sources import files as fs
from wordloom.session import cut_lineage
from wordloom.streaming import ngram_stream as stream


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_result_line_is_parsed_once(spark):
    lines = spark.createDataFrame([
        ('{"custom_id": "7. q?", "response": {"body": {"choices": [{"message": {"content": "yes"}}]}}}',),
        ('{"custom_id": "8. q?", "response": {"body": {"choices": [{"message": {"content": 5}}]}}}',),
        ('{"custom_id": "9. q?"} trailing',),
        ('{"custom_id": "10. INF", "response": {"body": {"choices": [{"message": {"content": "+I"}}]}}}',),
        ('{"custom_id": "11. q?", "response": {"body": {"choices": [{"message": {"content": "x"}}]}}, "n": INF}',),
        (None,),
    ], "line string")
    res = qa.batch_responses(lines)
    gold = spark.createDataFrame([(7, "yes"), (10, "no")], "idx bigint, gold string")
    joined = qa.align_by_id(gold, res.select("idx", F.col("custom_id").alias("question"), "response"))
    assert _plan(joined).count("from_json(") == 1
    assert sorted((r["idx"], r["response"]) for r in res.collect()) == [(7, "yes"), (10, "+I")]
    assert {r["idx"] for r in joined.collect()} == {7, 10}


def test_counting_tasks_grow_with_the_table(spark, tmp_path, monkeypatch):
    rows = [(1, "a b a\nc a b"), (2, "b"), (3, None), (4, ""), (None, "a b"), (-5, "a b a"), (1, "a b a")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(inputs, "COUNT_BYTES", 50)
    docs = inputs.counted_documents(spark, str(tmp_path))
    assert docs.rdd.getNumPartitions() > 3 * spark.sparkContext.defaultParallelism
    counts = ng.train_ngram(docs, 1, batch=3).counts
    got = {(r["context"], r["word"]): (r["cnt"], r["b"], r["d"], r["p"]) for r in counts.select(
        "context", "word", "cnt", ng.key_batch(F.col("first")).alias("b"), ng.key_doc(F.col("first")).alias("d"), ng.key_pos(F.col("first")).alias("p")).collect()}
    assert got == {("a", "b"): (5, 3, -5, 1), ("b", "a"): (3, 3, -5, 2), ("a", "c"): (1, 3, 1, 3), ("c", "a"): (1, 3, 1, 4)}


def test_many_files_are_few_tasks(spark, tmp_path):
    rows = [(i, f"w{i} a b\nc") for i in range(150)] + [(7, "again"), (None, "n"), (200, None)]
    path = str(tmp_path / "corpus")
    fs.write_files(spark.createDataFrame(rows, "k bigint, text string"), "k", "text", path)
    corpus = fs.read_corpus(spark, path)
    texts = {r["text"] for r in corpus.collect()}
    assert corpus.count() == 152 and len(texts) == 152  # 7 and its second row are one file
    assert {"w7 a b\nc\nagain\n", "again\nw7 a b\nc\n"} & texts and {"w8 a b\nc\n", "n\n", "\n"} <= texts
    folders = {p.parent for p in (tmp_path / "corpus").rglob("*.txt")}
    assert 1 < len(folders) <= fs.SHELVES
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    with fs.small_files(spark):
        assert spark.read.text(path, wholetext=True).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.files.openCostInBytes") == old


def test_request_lines_can_be_compressed(spark, tmp_path):
    reqs = spark.createDataFrame([(1, "x"), (2, "y")], "idx long, q string").select(F.struct("idx", "q").alias("req"))
    fs.write_jsonl(reqs, "req", str(tmp_path / "r"), compression="gzip")
    assert list((tmp_path / "r").glob("*.txt.gz"))
    assert sorted(r["line"] for r in fs.read_lines(spark, str(tmp_path / "r")).collect()) == ['{"idx":1,"q":"x"}', '{"idx":2,"q":"y"}']


def test_cut_lineage_computes_once_and_caches_nothing(spark):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(run, "id bigint")
    out = cut_lineage(df)
    assert out.count() == 1000 and seen.value == 1000
    assert not df.is_cached


def test_chunks_of_one_file_are_counted_in_many_tasks(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("a b c\n" * 500, encoding="utf-8")
    monkeypatch.setattr(ng, "_COUNTED", 10)
    events = ng.chunk_events(fs.read_corpus_chunks(spark, str(tmp_path), 30), 2)
    assert events.rdd.getNumPartitions() == 150
    assert events.count() == 1498


def _by_rows(spark, docs, n, batch):
    """Counts by one row per n-gram, as they were made before."""
    return {(r["context"], r["word"], r["cnt"], r["first"]) for r in ng.count_events(ng._events(docs, n), batch).collect()}


def test_blocks_of_ngrams_equal_rows(spark, monkeypatch):
    """Small blocks that cut texts, null and repeated ids, negative ids, slots that are more than the partitions."""
    import random

    from wordloom.functions import grams

    rng = random.Random(3)
    words = ["a", "b", "é", "x" * 300, "日本", "7_"]
    rows = [(rng.choice([None, 3, 3, -8, 2**62, *range(20)]), rng.choice([None, "", "a b a b a", *(" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 40]))) for _ in range(6))])) for _ in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for n, batch, most in ((1, 0, 7), (2, 5, 30), (4, 1, 10_000)):
        want = _by_rows(spark, docs, n, batch)
        held = ng.Training(ng._tokens(docs, "doc_id", "text").select("doc_id", F.lit(0).alias("shift"), "t"), n, batch, 16)
        for keys in (["context"], ["context", "word"]):
            got = held.counts(5, keys)
            spots = {r[0]: r[1] for r in got.select(F.spark_partition_id(), F.pmod(F.hash(*keys), F.lit(5))).collect()}
            assert all(a == b for a, b in spots.items())
            assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
        # the tasks themselves with blocks of a few words, merged a few at a time
        monkeypatch.setattr(grams, "HELD", most)
        toks = held.toks.select("doc_id", "t").collect()
        rows = [(r["doc_id"], i, w, (hash(tuple(r["t"][i : i + n])) % 3 if i + n < len(r["t"]) else None)) for r in toks for i, w in enumerate(r["t"] or [])]
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("pos", pa.int64()), ("word", pa.string()), ("slot", pa.int32())])
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        blocks = sorted((b.to_pylist()[0] for b in grams.count_grams(n)(iter(table.to_batches(max_chunksize=4)))), key=lambda b: b["slot"])
        block = pa.RecordBatch.from_pylist(blocks, schema=pa.schema([("slot", pa.int32()), ("block", pa.binary())]))
        out = [tuple(r.values()) for b in grams.merge_grams(n)(iter([block])) for r in b.to_pylist()]
        key = lambda d, i: None if d is None else ((batch * 10**20 + d + 2**63) * 10**12 + i)
        assert sorted((c, w, k, str(key(d, i))) for c, w, k, d, i in out) == sorted((c, w, k, str(f)) for c, w, k, f in want)
        monkeypatch.setattr(grams, "HELD", 2_500_000)
        best = {}
        for c, _, k, f in want:
            best[c] = min(best.get(c, (0, 0)), (-k, -1 if f is None else int(f)))
        top = held.top1(4).collect()
        assert {r["context"] for r in top} == set(best) and len(top) == len(best)
        assert all(any((c, w, k) == (r["context"], r["word"], r["cnt"]) and (-1 if f is None else int(f)) == best[c][1] for c, w, k, f in want) for r in top)
        assert {r["context"]: (-r["cnt"], r["total"]) for r in top} == {c: (k, sum(x[2] for x in want if x[0] == c)) for c, (k, _) in best.items()}


def test_ngrams_are_not_shuffled_by_row(spark, docs):
    model = ng.train_ngram(docs(*(f"w{i} the w{i + 1} end" for i in range(300))), 2)
    assert "HashAggregate" not in _plan(model.counts) and _plan(model.counts).count("regexp_extract_all") == 1
    assert model.counts.count() == 302 + 298


def test_lookups_are_written_as_they_come(spark, docs):
    """No shuffle by context after that of the counts; intervals are those of the counts."""
    model = ng.train_ngram(docs(*(f"the w{i % 3} end{i}" for i in range(30))), 1)
    for mode, name in (("top1", "top1"), ("sample", "buckets")):
        lookups = ng.Lookups(model, mode)
        table = lookups.table(name)
        assert table.select(F.input_file_name()).distinct().count() <= lookups.parts
        assert table.select("context").distinct().count() == 4
        if mode == "sample":
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            with ng._as_it_lies(spark):
                keys = table.select("context", "bucket").where("context = 'the'").distinct()
                shown = keys.selectExpr("*", "1 AS x").join(table, ["context", "bucket"])._jdf.queryExecution().executedPlan().toString()
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            last = shown[: shown.rindex("FileScan")].splitlines()[-4:]
            assert "Bucketed: true" in shown and not any("Exchange" in x for x in last)
        lookups.drop()
    trained, plain = (sorted(map(tuple, m.intervals().collect())) for m in (model, ng.NgramModel(1, model.counts, model.vocab)))
    assert trained == plain
    prompts = spark.createDataFrame([(i, "the") for i in range(40)] + [(99, "end1")], "prompt_id bigint, text string")
    got = {r["prompt_id"]: (r["status"], r["next_word"]) for r in ng.predict(model, prompts, mode="sample", seed=1).collect()}
    assert got.pop(99) == ("unseen_context", None) and {w for _, w in got.values()} == {"w0", "w1", "w2"}


def test_a_stream_keeps_one_copy_of_its_counts(spark, tmp_path, docs):
    """No streaming state beside the table or store; a batch that is run again adds nothing."""
    src = tmp_path / "in"
    for i, t in enumerate(["a b a", "a b", "b a b"]):
        docs(t, start=i).coalesce(1).write.parquet(str(src / f"p{i}"))
    arriving = lambda: stream.stream_documents(spark, str(src) + "/*", max_files=1, base_path=str(src))
    want = {("a", "b"): 3, ("b", "a"): 2}
    for again in ("ck1", "ck2"):
        stream.start_ngram_counts(arriving(), 1, str(tmp_path / "table"), str(tmp_path / again)).awaitTermination()
        got = stream.current_counts(spark, str(tmp_path / "table"))
        assert {(r["context"], r["word"]): r["cnt"] for r in got.collect()} == want
    store = stream.counts_store(spark, str(tmp_path / "store"), 3)
    stream.start_ngram_parts(arriving(), 1, store, str(tmp_path / "ck3"), compact_every=2).awaitTermination()
    assert {(r["context"], r["word"]): r["cnt"] for r in store.read("counts").collect()} == want
    assert not list(tmp_path.glob("ck*/state/*"))
    # a bucket of a part is one file
    one = stream.counts_store(spark, str(tmp_path / "one"), 2)
    stream.start_ngram_parts(stream.stream_documents(spark, str(src) + "/*", base_path=str(src)), 1, one, str(tmp_path / "ck4")).awaitTermination()
    assert 1 <= len(list((tmp_path / "one" / "counts").glob("part=*/*.parquet"))) <= 2
    assert {(r["context"], r["word"]): r["cnt"] for r in one.read("counts").collect()} == want


def test_slots_follow_what_a_join_reads(spark, tmp_path, docs):
    """Spark's own figure for a join is the product of its sides."""
    docs(*(f"a b c{i} a b" for i in range(2000))).write.parquet(str(tmp_path / "d"))
    d = spark.read.parquet(str(tmp_path / "d"))
    assert ng._slots(d.join(d.select("doc_id").hint("merge"), "doc_id")) == 1
