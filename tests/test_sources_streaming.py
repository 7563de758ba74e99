from pyspark.sql import functions as F

from wordloom.operators import ngram as ng
from wordloom.sources import files as fs
from wordloom.streaming import ngram_stream as stream


def test_whole_file_corpus(spark, tmp_path):
    d = tmp_path / "corpus"
    d.mkdir()
    (d / "a.txt").write_text("a b a\nc a b d", encoding="utf-8")
    (d / "b.txt").write_text("b d", encoding="utf-8")
    corpus = fs.read_corpus(spark, str(d))
    rows = {r["file"].rsplit("/", 1)[-1]: (r["doc_id"], r["text"]) for r in corpus.collect()}
    assert rows == {"a.txt": (0, "a b a\nc a b d"), "b.txt": (1, "b d")}
    # one file = one sequence: the line break does not split the sequence, files are not bridged
    counts = {(r["context"], r["word"]): r["cnt"] for r in ng.train_ngram(corpus, 1).counts.collect()}
    assert counts[("a", "c")] == 1 and counts[("b", "d")] == 2 and ("d", "b") not in counts


def test_one_file_in_many_ranges(spark, tmp_path):
    """Cuts of any place and size give the counts, first places and vocabulary of the whole file."""
    import random

    rng = random.Random(6)
    d = tmp_path / "large"
    d.mkdir()
    for name in "ab":
        lines = [" ".join(rng.choice(["é", "b", "c.", "d", ""]) for _ in range(rng.choice([0, 1, 1, 2, 9]))) for _ in range(700)]
        (d / f"{name}.txt").write_text("\n".join(lines) + ("\n" if name == "a" else ""), encoding="utf-8")
    (d / "c.txt").write_text("", encoding="utf-8")
    (d / "d.txt").write_text("\n\nz", encoding="utf-8")
    whole = fs.read_corpus(spark, str(d))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for n, chars in ((1, 1), (3, 40), (4, 1 << 20)):
            chunks = fs.read_corpus_chunks(spark, str(d), chars)
            assert chunks.select("file", "block").distinct().count() > 10
            got, want = ng.train_ngram_chunks(chunks, n), ng.train_ngram(whole, n)
            flat = lambda m: sorted((r["context"], r["word"], r["cnt"], int(r["first"])) for r in m.counts.collect())
            assert flat(got) == flat(want)
            assert {r[0] for r in got.vocab.collect()} == {r[0] for r in want.vocab.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_request_lines_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "idx long, q string").select(
        F.struct("idx", "q").alias("req")
    )
    path = str(tmp_path / "req")
    fs.write_jsonl(df, "req", path)
    back = fs.read_lines(spark, path)
    assert sorted(r["line"] for r in back.collect()) == ['{"idx":1,"q":"x"}', '{"idx":2,"q":"y"}']


def test_streaming_counts_equal_batch(spark, tmp_path, docs):
    src = tmp_path / "incoming"
    d1 = docs("a b a c a b d")
    d2 = docs("b d", start=100)
    d1.write.parquet(str(src / "part1"))
    d2.write.parquet(str(src / "part2"))
    q = stream.start_ngram_counts(
        stream.stream_documents(spark, str(src) + "/*", max_files=1, base_path=str(src)),
        1, str(tmp_path / "table"), str(tmp_path / "ckpt"),
    )
    q.awaitTermination()
    got = {(r["context"], r["word"]): r["cnt"] for r in stream.current_counts(spark, str(tmp_path / "table")).collect()}
    want = {(r["context"], r["word"]): r["cnt"] for r in ng.train_ngram(d1.unionByName(d2), 1).counts.collect()}
    assert got == want
