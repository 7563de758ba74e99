"""Decoding, word counts, training rounds and tokenisation that grow no faster than the documents."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wordloom.operators import bpe as bp


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [200_000, 1])
def test_decode_moves_no_ids_for_a_small_vocabulary(spark, monkeypatch, most):
    monkeypatch.setattr(bp, "_DICTIONARY", most)
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, id bigint")
    ids = spark.createDataFrame([(7, 0), (7, 0), (8, 1), (9, -1), (None, 0), (9, None)], "doc_id bigint, id bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables whose size Spark can't tell
    try:
        out = bp.decode(ids, vocab)
        assert ("hashpartitioning(" in _plan(out)) == (most == 1)
        assert sorted(out.collect(), key=str) == sorted([(0, 7, "a"), (0, 7, "a"), (1, 8, "b"), (0, None, "a")], key=str)
        assert out.columns == ["id", "doc_id", "token"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_words_are_encoded_as_one():
    from wordloom.functions.merging import WordCoder, encode_word

    rand = random.Random(5)
    for _ in range(150):
        letters = rand.choice(["ab", "abc", "aé\U0001f600", "</w>a"])
        some = lambda n: "".join(rand.choice(letters) for _ in range(n))
        ids = {t: i for i, t in enumerate(sorted({some(rand.randint(1, 9)) + rand.choice(["", "</w>"]) for _ in range(rand.randint(0, 12))}))}
        words = [some(rand.choice([0, 1, 2, 5, 30, 63, 64, 90])) + rand.choice(["", "z"]) for _ in range(rand.randint(0, 20))]
        ends, tokens, numbers = WordCoder(ids).encode(pa.array(words, pa.string()))
        tokens = tokens.to_pylist()
        assert [(tokens[a:b], numbers[a:b].tolist()) for a, b in zip(ends, ends[1:])] == [encode_word(w, ids) for w in words]


def test_tasks_count_words_before_spark_does(spark):
    rows = [(5, "b a"), (5, "a b a"), (None, "n a n"), (3, "b! b"), (-4, "z a"), (9, None), (None, "n x"), (1, "  ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    types = bp.word_types(docs)
    assert "MapInArrow" in _plan(types)
    plain = bp.pretokens(docs).groupBy("word").agg(
        F.count(F.lit(1)).alias("freq"), F.min(bp.first_key(F.lit(0), F.col("doc_id"), F.col("pos"))).alias("first"))
    assert sorted(types.collect(), key=str) == sorted(plain.collect(), key=str)
    seen = {r["word"]: (r["freq"], r["first"]) for r in types.collect()}
    assert seen["n"] == (3, None) and seen["b"][0] == 4 and seen["a"][0] == 5


def test_rounds_take_blocks_of_types(spark):
    """A round's rows are blocks, however many types there are, and ties go to the pair met first."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("zq aaaa w"), F.col("id")).alias("text"))
    blocks, _, merges, cached = bp._merge_loop(bp.word_types(docs), 4)
    assert blocks.count() <= 100
    for df in cached:
        df.unpersist()
    # a a is counted three times in "aaaa"; then z q, q </w> and others are tied, and z q was met first.
    assert merges[0] == (1, "a", "a", 12_000)
    assert merges[1][1:] == ("z", "q", 4000)
    seg = {r["word"]: (r["freq"], r["symbols"]) for r in bp.segment_types(docs, 1).collect()}
    assert seg["aaaa"] == (4000, ["aa", "aa", "</w>"]) and seg["w17"] == (1, ["w", "1", "7", "</w>"])


def test_types_without_a_known_place_are_met_first(spark):
    docs = spark.createDataFrame([(1, "ab"), (None, "cd")], "doc_id bigint, text string")
    assert [r["l"] + r["r"] for r in bp.train_bpe(docs, 1).merges.collect()] == ["cd"]
