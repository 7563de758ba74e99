from pyspark.sql import functions as F

from wordloom.functions.text import bpe_pretokens, split_whitespace, ustrip, word_symbols, word_tokens

# FIXTURES §2
CASES = [
    ('Hello!! "quoted" a -b c.d e_f $5 don\'t',
     "hello quoted a b c d e_f 5 don t",
     "hello ! quoted \" a b c . d e_f 5 don ' t"),
    ("... ok?!", "ok", "ok ?"),
    ("", "", ""),
    ("été, x", "été x", "été , x"),
]


def test_tokenizers(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in CASES], "t string")
    got = df.select(
        "t", F.array_join(word_tokens("t"), " ").alias("w"), F.array_join(bpe_pretokens("t"), " ").alias("p")
    ).collect()
    res = {r["t"]: (r["w"], r["p"]) for r in got}
    for text, words, pre in CASES:
        assert res[text] == (words, pre)


def test_unicode_strip_and_split(spark):
    df = spark.createDataFrame([("  a\tb  c\n",), ("   ",)], "t string")
    rows = df.select(ustrip("t").alias("s"), split_whitespace("t").alias("w")).collect()
    assert rows[0]["s"] == "a\tb  c"
    assert rows[0]["w"] == ["a", "b", "c"]
    assert rows[1]["s"] == "" and rows[1]["w"] == []


def test_word_symbols(spark):
    row = spark.createDataFrame([("été",)], "w string").select(word_symbols("w").alias("s")).first()
    assert row["s"] == ["é", "t", "é", "</w>"]
