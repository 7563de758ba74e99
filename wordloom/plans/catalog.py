"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every computed column is aliased to the name used by the matching SQL in
:mod:`wordloom.plans.oracle`. Struct and array results are flattened to
scalars/strings so the two engines' outputs compare value for value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import word_symbols, word_tokens
from ..operators import bpe as bp
from ..operators import ngram as ng
from ..operators import qa
from ..operators import scoring as sc
from ..session import ensure_checkpoint_dir
from ..sources import files as fs
from ..streaming import ngram_stream as stream
from . import inputs

# Fixed parameters of the registered queries (also baked into the oracle SQL).
N_COUNTS = 2  # context length for the count / totals queries
VOLUME = 5000  # documents in a file of the large-file query
BUCKETS = 16  # of the stored models
N_PREDICT = 1  # context length for prediction / generation
SAMPLE_SEED = 7
GENERATE_WORDS = 5

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def _flat_first(df: DataFrame) -> DataFrame:
    return df.withColumn("first_doc", ng.key_doc(F.col("first"))).withColumn("first_pos", ng.key_pos(F.col("first"))).drop("first")


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{what}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------
# A. n-gram model
# ---------------------------------------------------------------------------

@register("word_tokens")
def q_word_tokens(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(word_tokens("text")).alias("pos", "token"))


@register("ngram_pairs")
def q_ngram_pairs(spark, sf_dir):
    return ng.ngram_events(inputs.documents(spark, sf_dir), N_COUNTS)


@register("ngram_counts")
def q_ngram_counts(spark, sf_dir):
    return ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_COUNTS).located()


@register("ngram_vocab")
def q_ngram_vocab(spark, sf_dir):
    return ng.vocabulary(inputs.documents(spark, sf_dir))


@register("ngram_context_totals")
def q_ngram_context_totals(spark, sf_dir):
    return ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_COUNTS).totals()


@register("ngram_probs")
def q_ngram_probs(spark, sf_dir):
    model = ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_PREDICT)
    return model.probabilities().select("context", "word", "cnt", "total", "prob")


@register("ngram_top1")
def q_ngram_top1(spark, sf_dir):
    model = ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_PREDICT)
    return model.top1()


@register("ngram_prompts")
def q_ngram_prompts(spark, sf_dir):
    model = ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_PREDICT)
    checked = ng._check_prompts(model, ng.normalize_prompts(inputs.prompts(spark, sf_dir, N_PREDICT)))
    return checked.select(
        "prompt_id", F.array_join("words", " ").alias("words"), F.size("words").alias("n_words"), "status", "oov_word"
    )


@register("ngram_oov")
def q_ngram_oov(spark, sf_dir):
    model = ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_PREDICT)
    checked = ng._check_prompts(model, ng.normalize_prompts(inputs.prompts(spark, sf_dir, N_PREDICT)))
    return checked.where(F.col("oov_word").isNotNull()).select("prompt_id", "oov_word")


def _predict(spark, sf_dir, mode):
    model = ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_PREDICT)
    res = ng.predict(model, inputs.prompts(spark, sf_dir, N_PREDICT), mode=mode, seed=SAMPLE_SEED)
    return res.select("prompt_id", "status", "oov_word", "next_word")


@register("ngram_predict")
def q_ngram_predict(spark, sf_dir):
    return _predict(spark, sf_dir, "top1")


@register("ngram_sample")
def q_ngram_sample(spark, sf_dir):
    return _predict(spark, sf_dir, "sample")


def _generate(spark, sf_dir, mode, n=N_PREDICT):
    model = ng.train_ngram(inputs.counted_documents(spark, sf_dir), n)
    res = ng.generate(model, inputs.prompts(spark, sf_dir, n), GENERATE_WORDS, mode=mode, seed=SAMPLE_SEED)
    return res.select("prompt_id", "status", "n_generated", "output")


@register("ngram_generate")
def q_ngram_generate(spark, sf_dir):
    return _generate(spark, sf_dir, "top1")


@register("ngram_generate_sample")
def q_ngram_generate_sample(spark, sf_dir):
    return _generate(spark, sf_dir, "sample")


@register("ngram_generate_n2")
def q_ngram_generate_n2(spark, sf_dir):
    """Two-word contexts: the context slides as (second word, generated word)."""
    return _generate(spark, sf_dir, "top1", n=2)


@register("ngram_incremental")
def q_ngram_incremental(spark, sf_dir):
    model = ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_PREDICT)
    bench = inputs.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    model = model.update(bench, batch=1)
    return _flat_batch_first(model.counts)


def _flat_batch_first(counts):
    return counts.select(
        "context", "word", "cnt",
        ng.key_batch(F.col("first")).alias("first_batch"), ng.key_doc(F.col("first")).alias("first_doc"),
        ng.key_pos(F.col("first")).alias("first_pos"),
    )


@register("ngram_store")
def q_ngram_store(spark, sf_dir):
    """Two training batches added to a stored model, read as one."""
    store = ng.NgramStore(spark, scratch_path(spark, "ngram-store"), N_PREDICT, buckets=BUCKETS)
    store.train(inputs.counted_documents(spark, sf_dir), batch=0)
    bench = inputs.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    store.train(bench, batch=1)
    return _flat_batch_first(store.model().counts)


@register("ngram_roundtrip")
def q_ngram_roundtrip(spark, sf_dir):
    model = ng.train_ngram(inputs.counted_documents(spark, sf_dir), N_PREDICT)
    path = scratch_path(spark, "ngram-model")
    model.save(path)
    return ng.NgramModel.load(spark, path).top1()


# ---------------------------------------------------------------------------
# C. scoring
# ---------------------------------------------------------------------------

def _scored(spark, sf_dir):
    return sc.score_lines(inputs.grading_lines(spark, sf_dir))


@register("response_content")
def q_response_content(spark, sf_dir):
    return _scored(spark, sf_dir).where(F.col("content").isNotNull()).select("model", "line_no", "content")


@register("verdict_clean")
def q_verdict_clean(spark, sf_dir):
    return _scored(spark, sf_dir).where(F.col("cleaned").isNotNull()).select("model", "line_no", "cleaned")


@register("verdict_score")
def q_verdict_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("model", "line_no", "outcome")


@register("score_outcomes")
def q_score_outcomes(spark, sf_dir):
    return sc.outcome_counts(_scored(spark, sf_dir), ["model"])


@register("qa_accuracy")
def q_qa_accuracy(spark, sf_dir):
    return sc.accuracy(_scored(spark, sf_dir))


@register("qa_accuracy_by_model")
def q_qa_accuracy_by_model(spark, sf_dir):
    return sc.accuracy(_scored(spark, sf_dir), ["model"])


# ---------------------------------------------------------------------------
# C. questions, requests, alignment, grading requests
# ---------------------------------------------------------------------------

def _questions(spark, sf_dir):
    return qa.flatten_qa(inputs.qa_files(spark, sf_dir))


def _numbered(spark, sf_dir):
    return qa.flatten_numbered(inputs.qa_files(spark, sf_dir))


def _numbered_table(spark, sf_dir):
    """Numbered questions as a written table, for queries that read them twice."""
    path = scratch_path(spark, "numbered")
    _numbered(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _flat_request(df):
    req = F.col("request")
    return df.select(
        "idx", "custom_id",
        req["body"]["model"].alias("model"),
        req["body"]["temperature"].alias("temperature"),
        F.get(req["body"]["messages"], 0)["content"].alias("system"),
        F.get(req["body"]["messages"], 1)["content"].alias("user"),
        "line",
    )


@register("qa_flatten")
def q_qa_flatten(spark, sf_dir):
    return _questions(spark, sf_dir).select("file_id", "a", "p", "q", "question", F.size("answers").alias("n_answers"))


@register("qa_gold")
def q_qa_gold(spark, sf_dir):
    return qa.gold_of(_numbered(spark, sf_dir))


@register("qa_answerable")
def q_qa_answerable(spark, sf_dir):
    return qa.answerable(qa.gold_of(_numbered(spark, sf_dir))).select("idx", "gold")


@register("qa_limit")
def q_qa_limit(spark, sf_dir):
    numbered = _numbered(spark, sf_dir).where(F.col("idx") <= qa.QUESTION_CAP)
    return numbered.select("idx", "file_id", "a", "p", "q", "question")


@register("qa_requests")
def q_qa_requests(spark, sf_dir):
    numbered = _numbered(spark, sf_dir)
    return _flat_request(qa.answer_requests(numbered))


@register("qa_requests_raw")
def q_qa_requests_raw(spark, sf_dir):
    numbered = _numbered(spark, sf_dir)
    return _flat_request(qa.raw_answer_requests(numbered))


def _model1_responses(numbered):
    res = qa.batch_responses(inputs.answer_batch_lines(numbered))
    return res.select("idx", F.col("custom_id").alias("question"), "response")


def _model2_rows(pairs):
    return pairs.select(
        "*",
        F.size(word_tokens("question")).cast("bigint").alias("input_tokens"),
        F.size(word_tokens("response")).cast("bigint").alias("output_tokens"),
    )


@register("response_usage")
def q_response_usage(spark, sf_dir):
    rows = _model2_rows(inputs.conversation_pairs(spark, sf_dir))
    return rows.select("conv_id", "turn", *qa.response_rows(rows).columns)


@register("qa_align_id")
def q_qa_align_id(spark, sf_dir):
    numbered = _numbered_table(spark, sf_dir)
    return qa.align_by_id(qa.gold_of(numbered), _model1_responses(numbered))


@register("qa_align_pos")
def q_qa_align_pos(spark, sf_dir):
    numbered = _numbered_table(spark, sf_dir)
    rows = inputs.responses(numbered).withColumnRenamed("idx", "place")
    return qa.align_by_position(qa.gold_of(numbered), rows, ["place"])


@register("grade_requests")
def q_grade_requests(spark, sf_dir):
    numbered = _numbered_table(spark, sf_dir)
    aligned = qa.align_by_id(qa.gold_of(numbered), _model1_responses(numbered))
    return _flat_request(qa.grade_requests(aligned, strict=True))


@register("grade_requests_lenient")
def q_grade_requests_lenient(spark, sf_dir):
    numbered = _numbered_table(spark, sf_dir)
    rows = inputs.responses(numbered).withColumnRenamed("idx", "place")
    aligned = qa.align_by_position(qa.gold_of(numbered), rows, ["place"])
    return _flat_request(qa.grade_requests(aligned, strict=False))


def echo_model(questions):
    """A deterministic local stand-in for a chat model (U1 test function)."""
    import pandas as pd

    responses = "echo: " + questions.astype(str)
    return pd.DataFrame({
        "response": responses,
        "input_tokens": questions.astype(str).str.split().str.len(),
        "output_tokens": responses.str.split().str.len(),
    })


@register("qa_answer_fn")
def q_qa_answer_fn(spark, sf_dir):
    numbered = _numbered(spark, sf_dir).select("idx", "question")
    return qa.answer_with(numbered, echo_model)


# ---------------------------------------------------------------------------
# B. byte-pair encoding
# ---------------------------------------------------------------------------

K_MERGES = 50  # merges learned by the registered BPE queries


def _bpe_docs(spark, sf_dir):
    return inputs.documents(spark, sf_dir)


def _types(spark, sf_dir):
    return bp.with_symbols(bp.word_types(_bpe_docs(spark, sf_dir)))


@register("bpe_pretokens")
def q_bpe_pretokens(spark, sf_dir):
    return bp.pretokens(_bpe_docs(spark, sf_dir)).withColumnRenamed("word", "token")


@register("bpe_word_freqs")
def q_bpe_word_freqs(spark, sf_dir):
    return _flat_first(bp.word_types(_bpe_docs(spark, sf_dir)))


@register("bpe_symbols")
def q_bpe_symbols(spark, sf_dir):
    types = bp.word_types(_bpe_docs(spark, sf_dir))
    return types.select("word", F.array_join(word_symbols(F.col("word")), " ").alias("symbols"))


@register("bpe_pair_stats")
def q_bpe_pair_stats(spark, sf_dir):
    stats = bp.pair_stats(_types(spark, sf_dir))
    return stats.select(
        "l", "r", "cnt",
        ng.key_doc(F.col("first.t")).alias("first_doc"), ng.key_pos(F.col("first.t")).alias("first_pos"),
        F.col("first.i").alias("first_i"),
    )


@register("bpe_best_pair")
def q_bpe_best_pair(spark, sf_dir):
    stats = bp.pair_stats(_types(spark, sf_dir))
    return stats.orderBy(F.desc("cnt"), F.asc("first")).limit(1).select("l", "r", "cnt")


@register("bpe_merge_once")
def q_bpe_merge_once(spark, sf_dir):
    seg = bp.segment_types(_bpe_docs(spark, sf_dir), 1)
    return seg.select("word", F.array_join("symbols", " ").alias("symbols"))


def _model(spark, sf_dir):
    return bp.train_bpe(_bpe_docs(spark, sf_dir), K_MERGES)


@register("bpe_train")
def q_bpe_train(spark, sf_dir):
    return _model(spark, sf_dir).merges


@register("bpe_vocab")
def q_bpe_vocab(spark, sf_dir):
    return _model(spark, sf_dir).vocab


@register("bpe_encode")
def q_bpe_encode(spark, sf_dir):
    model = _model(spark, sf_dir)
    words = bp.pretokens(_bpe_docs(spark, sf_dir)).select("word")
    enc = bp.encode_words(words, model.vocab)
    return enc.select("word", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n_tokens"))


@register("bpe_ids")
def q_bpe_ids(spark, sf_dir):
    model = _model(spark, sf_dir)
    words = bp.pretokens(_bpe_docs(spark, sf_dir)).select("word")
    encoded = bp.encode_words(words, model.vocab)
    return encoded.select(F.inline(F.arrays_zip(F.col("tokens").alias("token"), F.col("ids").alias("id")))).distinct()


@register("bpe_tokenize")
def q_bpe_tokenize(spark, sf_dir):
    return bp.tokenize(_bpe_docs(spark, sf_dir), _model(spark, sf_dir))


@register("bpe_decode")
def q_bpe_decode(spark, sf_dir):
    model = _model(spark, sf_dir)
    ids = bp.tokenize(_bpe_docs(spark, sf_dir), model).select("doc_id", "pos", "tpos", "id")
    return bp.decode(ids, model.vocab).select("doc_id", "pos", "tpos", "id", "token")


@register("bpe_roundtrip")
def q_bpe_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bpe-model")
    _model(spark, sf_dir).save(path)
    return bp.BpeModel.load(spark, path).vocab


# ---------------------------------------------------------------------------
# Sources / sinks and streaming, each through files under the shared folder
# ---------------------------------------------------------------------------

@register("qa_file_roundtrip")
def q_qa_file_roundtrip(spark, sf_dir):
    """QA documents written as JSON Lines, read back with the QA schema, flattened."""
    path = scratch_path(spark, "qa-files")
    files = inputs.qa_files(spark, sf_dir)
    files.select(F.to_json(F.struct("data")).alias("value")).write.text(path)
    back = fs.read_qa(spark, path, multiline=False)
    qs = qa.flatten_qa(back)
    return qs.select("question", F.size("answers").alias("n_answers"))


@register("score_from_files")
def q_score_from_files(spark, sf_dir):
    """S9 + S3: result lines written unchanged, read back as lines and scored."""
    path = scratch_path(spark, "grading-results")
    fs.write_lines(inputs.grading_lines(spark, sf_dir), "line", path)
    scored = sc.score_lines(fs.read_lines(spark, path))
    return sc.outcome_counts(scored)


@register("requests_sink")
def q_requests_sink(spark, sf_dir):
    """Requests written as JSON Lines (gzip: every line repeats the prompts) and read back."""
    path = scratch_path(spark, "requests")
    numbered = _numbered(spark, sf_dir)
    fs.write_jsonl(qa.answer_requests(numbered), "request", path, compression="gzip")
    back = spark.read.schema("custom_id string, method string, url string, body struct<model: string, temperature: double>").json(path)
    return back.select("custom_id", "method", "url", F.col("body.model").alias("model"), F.col("body.temperature").alias("temperature"))


APPENDS = 3


@register("response_rows_roundtrip")
def q_response_rows_roundtrip(spark, sf_dir):
    """S6 + S4: response rows of all questions appended in three batches as JSON Lines, read back, aligned by position."""
    path = scratch_path(spark, "responses")
    numbered = _numbered_table(spark, sf_dir)
    rows = _model2_rows(inputs.responses(numbered))
    share = -(-numbered.count() // APPENDS)
    for batch in range(APPENDS):
        part = rows.where((F.col("idx") > batch * share) & (F.col("idx") <= (batch + 1) * share))
        fs.append_response_rows(part, path, ["idx"], batch, compression="gzip")
    back = fs.read_response_rows(spark, path)
    return qa.align_by_position(qa.gold_of(numbered), back, fs.RESPONSE_ORDER)


@register("response_array_rows")
def q_response_array_rows(spark, sf_dir):
    """S4, array branch: the conversation pairs of each conversation as one JSON array file, read back."""
    path = scratch_path(spark, "response-arrays")
    rows = _model2_rows(inputs.conversation_pairs(spark, sf_dir))
    fields = F.struct("turn", "question", "response", "input_tokens", "output_tokens")
    lists = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(fields)).alias("r"))  # one conversation's turns
    files = lists.select("conv_id", F.to_json(F.transform("r", lambda x: x.dropFields("turn"))).alias("value"))
    files.write.partitionBy("conv_id").text(path)
    back = fs.read_response_rows(spark, path, json_array=True)
    return back.select("question", "response", "input_tokens", "output_tokens")


@register("qa_multiline_files")
def q_qa_multiline_files(spark, sf_dir):
    """S2, one multi-line JSON document per file: each source's documents as one file, read back, flattened."""
    path = scratch_path(spark, "qa-multiline")
    files = inputs.qa_files(spark, sf_dir)
    fs.write_files(files.select("file_id", F.to_json(F.struct("data"), {"pretty": "true"}).alias("value")), "file_id", "value", path)
    back = qa.flatten_numbered(fs.read_qa(spark, path, multiline=True))
    return back.select("a", "p", "q", "question", F.size("answers").alias("n_answers"))


@register("corpus_files")
def q_corpus_files(spark, sf_dir):
    """Every document written as a text file of its own, read back whole, n-grams counted."""
    path = scratch_path(spark, "corpus")
    fs.write_files(inputs.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", path)
    corpus = fs.read_corpus(spark, path)
    return ng.train_ngram(corpus, N_COUNTS).counts.select("context", "word", "cnt")


@register("corpus_large_files")
def q_corpus_large_files(spark, sf_dir):
    """Documents in id order as files of many documents each, read in chunks; contexts cross documents and chunks."""
    path = scratch_path(spark, "volumes")
    docs = inputs.documents(spark, sf_dir).select(F.expr(f"doc_id div {VOLUME}").alias("volume"), "doc_id", F.coalesce("text", F.lit("")).alias("value"))
    dealt = docs.repartition("volume").sortWithinPartitions("volume", "doc_id").drop("doc_id")
    dealt.write.partitionBy("volume").text(path)
    chunks = fs.read_corpus_chunks(spark, path, chunk_chars=1 << 16)
    return ng.train_ngram_chunks(chunks, N_COUNTS).counts.select("context", "word", "cnt")


@register("ngram_stream_counts")
def q_ngram_stream_counts(spark, sf_dir):
    """Streaming counterpart of ``ngram_counts``: documents read as a stream, counts kept as state."""
    base = scratch_path(spark, "ngram-stream")
    # A glob (one-letter class) so the file source keeps ``basePath`` = the table folder.
    docs = stream.stream_documents(spark, f"{sf_dir}/document[s].parquet", base_path=sf_dir).repartition(inputs.count_tasks(spark, sf_dir), "doc_id")
    q = stream.start_ngram_counts(docs, N_COUNTS, f"{base}/table", f"{base}/checkpoint")
    q.awaitTermination()
    return _flat_first(stream.current_counts(spark, f"{base}/table"))


@register("ngram_stream_store")
def q_ngram_stream_store(spark, sf_dir):
    """The same stream with a store of committed parts as its sink."""
    base = scratch_path(spark, "ngram-stream")
    docs = stream.stream_documents(spark, f"{sf_dir}/document[s].parquet", base_path=sf_dir).repartition(inputs.count_tasks(spark, sf_dir), "doc_id")
    store = stream.counts_store(spark, f"{base}/store", BUCKETS)
    stream.start_ngram_parts(docs, N_COUNTS, store, f"{base}/checkpoint").awaitTermination()
    return _flat_first(store.read("counts"))
