from pyspark.sql import functions as F

from wordloom.operators import bpe as bp


def _vocab(model):
    return {r["token"]: r["id"] for r in model.vocab.collect()}


def _merges(model):
    return [(r["l"], r["r"], r["cnt"]) for r in model.merges.orderBy("rank").collect()]


# FIXTURES §4: corpus "low low lower"
def test_merges_and_ties(spark, docs):
    m = bp.train_bpe(docs("low low lower"), 3)
    assert _merges(m) == [("l", "o", 3), ("lo", "w", 3), ("low", "</w>", 2)]


def test_vocab_k2_loses_intermediate_symbols(spark, docs):
    m = bp.train_bpe(docs("low low lower"), 2)
    assert _vocab(m) == {"</w>": 0, "e": 1, "low": 2, "r": 3}
    enc = bp.encode_words(spark.createDataFrame([("low",)], "word string"), m.vocab).first()
    assert enc["tokens"] == ["l", "o", "w"]
    ids = bp.token_ids(spark.createDataFrame([(t,) for t in enc["tokens"]], "token string"), m.vocab)
    assert [r["id"] for r in ids.collect()] == [-1, -1, -1]


def test_vocab_k3(spark, docs):
    m = bp.train_bpe(docs("low low lower"), 3)
    assert _vocab(m) == {"</w>": 0, "e": 1, "low": 2, "low</w>": 3, "r": 4}


def test_large_k_stops(spark, docs):
    m = bp.train_bpe(docs("low low lower"), 50)
    assert set(_vocab(m)) == {"low</w>", "lower</w>"}


def test_k_zero_is_characters(spark, docs):
    m = bp.train_bpe(docs("low low lower"), 0)
    assert set(_vocab(m)) == {"l", "o", "w", "e", "r", "</w>"}
    assert _merges(m) == []


def test_empty_corpus(spark, docs):
    m = bp.train_bpe(docs(""), 5)
    assert _vocab(m) == {}


def _merge(spark, symbols, left, right):
    from wordloom.functions.text import unwrap_symbols, wrap_symbols

    df = spark.createDataFrame([(symbols.split(" "),)], "s array<string>")
    out = df.select(unwrap_symbols(bp.merge_column(wrap_symbols(F.col("s")), left, right)).alias("o")).first()["o"]
    return " ".join(out)


def test_merge_whole_symbols_left_to_right(spark):
    assert _merge(spark, "a a a", "a", "a") == "aa a"
    assert _merge(spark, "a a a b a a", "a", "a") == "aa a b aa"
    assert _merge(spark, "xa b", "a", "b") == "xa b"
    assert _merge(spark, "a $ </w>", "$", "</w>") == "a $</w>"


def test_dollar_is_a_token(spark, docs):
    # pre-tokens a, $, a, $: types "a" (met first) and "$", tied at 2
    m = bp.train_bpe(docs("a$ a$"), 2)
    assert _merges(m) == [("a", "</w>", 2), ("$", "</w>", 2)]
    assert _vocab(m) == {"$</w>": 0, "a</w>": 1}


def test_encoder_leftmost(spark):
    vocab = spark.createDataFrame(
        [(t, i) for i, t in enumerate(["th", "the", "the</w>", "e</w>", "er", "t", "h", "e", "x"])], "token string, id bigint"
    )
    words = spark.createDataFrame([("the",), ("thth",), ("xer",), ("zz",)], "word string")
    got = {r["word"]: r["tokens"] for r in bp.encode_words(words, vocab).collect()}
    assert got == {"the": ["the</w>"], "thth": ["th", "th"], "xer": ["x", "er"], "zz": ["z", "z"]}


def _plain_encode(word, vocab):
    s = [*word, "</w>"]
    while True:
        at = next((i for i in range(len(s) - 1) if s[i] + s[i + 1] in vocab), None)
        if at is None:
            return s[:-1] if s[-1] == "</w>" else s
        left, right = s[at], s[at + 1]
        out, i = [], 0
        while i < len(s):
            if i + 1 < len(s) and (s[i], s[i + 1]) == (left, right):
                out.append(left + right)
                i += 2
            else:
                out.append(s[i])
                i += 1
        s = out


def test_encoder_equals_plain_rule(spark):
    long = "ab" * 600
    tokens = ["th", "the", "the</w>", "e</w>", "er", "t", "h", "e", "x", "ab", "aba", "abab", "abababab", long]
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, id bigint")
    words = ["the", "thth", "xer", "zz", "theretherthe", "hehehethe", "a", long, "x" + long]
    got = {r["word"]: r for r in bp.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), vocab).collect()}
    for w in words:
        want = _plain_encode(w, set(tokens))
        assert got[w]["tokens"] == want
        assert got[w]["ids"] == [tokens.index(t) if t in tokens else -1 for t in want]


def test_tokenize_roundtrip_property(spark, docs):
    corpus = docs("the cat sat on the mat, the dog sat on the log.", "cats and dogs!")
    m = bp.train_bpe(corpus, 12)
    toks = bp.tokenize(corpus, m)
    words = bp.pretokens(corpus)
    joined = toks.groupBy("doc_id", "pos").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tpos", "token"))), lambda s: s["token"]), "").alias("w")
    )
    rows = joined.join(words, ["doc_id", "pos"]).collect()
    assert rows and all(r["w"].replace("</w>", "") == r["word"] for r in rows)
    # every known token has a non-negative id
    assert toks.where((F.col("id") < 0) & F.col("token").isin(list(_vocab(m)))).count() == 0


def test_merge_symbols_equals_plain_rule():
    import random

    from wordloom.functions.merging import encode_word

    rng = random.Random(8)
    for _ in range(400):
        word = "".join(rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randint(0, 30)))
        known = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 6))) + ("</w>" if rng.random() < 0.2 else "") for _ in range(rng.randint(0, 25))}
        assert encode_word(word, dict.fromkeys(known, 1))[0] == _plain_encode(word, known), (word, known)


def test_long_word_is_near_linear():
    import time

    from wordloom.functions.merging import encode_word

    known = dict.fromkeys(["ab", "abc", "abcabc", "ca", "bc", "cabc"], 1)

    def took(n):
        t = time.process_time()
        encode_word("abc" * n, known)
        return time.process_time() - t

    took(100)
    short, long = min(took(4_000) for _ in range(3)), min(took(40_000) for _ in range(3))
    assert long < 40 * short and long < 5  # ten times the length; quadratic work would take a hundred times as long


def test_large_vocabulary_is_joined(spark, docs, monkeypatch):
    """Both ways of meeting the vocabulary give equal rows, with one word at a third of the occurrences."""
    corpus = docs(*(f"the the theory of {chr(97 + i % 26)}x{i} the, other thing" for i in range(60)), "", "ab" * 700, "éa naïve the")
    m = bp.train_bpe(corpus, 15)
    want = sorted(map(tuple, bp.tokenize(corpus, m).collect()))
    words = bp.pretokens(corpus).select("word")
    enc = sorted(map(tuple, bp.encode_words(words, m.vocab).collect()))
    monkeypatch.setattr(bp, "_DICTIONARY", 3)
    assert sorted(map(tuple, bp.tokenize(corpus, m).collect())) == want
    assert sorted(map(tuple, bp.encode_words(words, m.vocab).collect())) == enc


def test_bloom_lets_few_others_pass(spark, docs):
    vocab = spark.range(3000).select(F.concat(F.lit("t"), F.col("id")).alias("token"), "id")
    test = bp._bloom(vocab, 3000)
    assert vocab.where(test(F.col("token"))).count() == 3000
    others = spark.range(20000).select(F.concat(F.lit("u"), F.col("id")).alias("token"))
    assert others.where(test(F.col("token"))).count() < 400


def test_frequent_word_is_spread(spark):
    """No key of the occurrence join holds over twice its share though one word is a third of the occurrences."""
    word = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id")))
    occ = spark.range(90_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("pos"), word.alias("word"))
    counted = occ.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    keys = counted.withColumn("pieces", F.ceil(F.col("freq") * bp._PIECES / F.lit(90_000)).cast("int"))
    most = bp._deal(occ, keys).groupBy("word", "_piece").count().agg(F.max("count")).first()[0]
    assert most <= 2 * 90_000 / bp._PIECES
    encoded = counted.select("word", F.array("word").alias("tokens"), F.array(F.lit(7).cast("bigint")).alias("ids"), "freq")
    assert bp._meet(occ, encoded).where("tpos = 0 and token = if(doc_id % 3 = 0, 'hot', concat('w', doc_id))").count() == 90_000
