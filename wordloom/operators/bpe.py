"""Byte-pair encoding (B) as DataFrame jobs.

Representation: a word's segmentation as a column is one string in which
every symbol is wrapped as ``TAB symbol SPACE`` (:func:`wrap_symbols`). Symbols
never contain whitespace, so merging the pair (l, r) is the literal
``replace('\\tl \\tr ', '\\tlr ')``: whole symbols only, left to right,
non-overlapping -- the reference's merge rule -- and it stays inside codegen.

Training keeps the word *types* as blocks, a row each, in which symbols are
numbers (:mod:`..functions.segments`), and the pair counts as a table. A round
merges the leading pairs that cannot influence each other (see
:func:`_leading_pairs`) by the same rule; it reads the blocks once and touches
only the types that contain one of the pairs: their old pairs are subtracted
and their new pairs added (counts are additive). The earliest occurrence of a
pair, which breaks ties between equally frequent pairs ("met first"), is not
subtractable, so it is computed for the pairs tied at the maximum, when they
are tied. At most ``_ROUND`` rows reach the driver per round.

A trained vocabulary has k tokens and the alphabet, so tasks hold it and
encode and decode documents where they are. A vocabulary beyond a stated size is met by
joins instead: on substrings of distinct words that pass a Bloom filter, and
on words cut into pieces by their frequency. Merging inside a word takes
O(n log n) steps either way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.merging import encode_batches, merge_batches, tokenize_batches
from ..functions.segments import BLOCK, FIRST_NAME, block_tokens, block_types, count_words, first_places, form_blocks, merge_blocks, symbol_text
from ..functions.text import END_OF_WORD, bpe_pretokens, unwrap_symbols, word_symbols, wrap_symbols
from ..session import cut_lineage, ship_package
from .ordering import dense_index, first_key, key_doc, key_pos

# Leading counts fetched per round; more merges than this are never made in one round.
_ROUND = 16
# Rounds between reliable checkpoints of the loop state.
_CHECKPOINT_EVERY = 8
# Copies of the vocabulary that a per-occurrence decode joins, so that one id is many keys.
_SALTS = 16
# Tokens of a vocabulary that every task holds; a larger vocabulary is joined.
_DICTIONARY = 200_000
# Most bits of the filter that substrings pass before they are joined with a larger vocabulary (16 MB).
_BLOOM_BITS = 1 << 27
# A word with more than one part in so many of all occurrences is several join keys.
_PIECES = 1000


# ---------------------------------------------------------------------------
# Word types and pair statistics
# ---------------------------------------------------------------------------

def pretokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """F2 occurrences: ``doc_id, pos, word``."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.posexplode(bpe_pretokens(text_col)).alias("pos", "word"))


def _joined_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, words``: a document's pre-tokens with spaces between them (they have none), which tasks take over at
    less cost than an array."""
    words = F.coalesce(F.array_join(bpe_pretokens(text_col), " "), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), words.alias("words"))


def word_types(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, freq, first`` with ``first`` the earliest ``(doc_id, pos)``
    packed by :func:`first_key` (hash-aggregatable). Tasks count a batch's words before Spark adds the counts up."""
    ship_package(docs.sparkSession)
    counted = _joined_words(docs, id_col, text_col).mapInArrow(count_words, "word string, freq bigint, doc_id bigint, pos int")
    return counted.groupBy("word").agg(
        F.sum("freq").alias("freq"), F.min(first_key(F.lit(0), F.col("doc_id"), F.col("pos"))).alias("first")
    )


def with_symbols(types: DataFrame) -> DataFrame:
    """initial segmentation (characters then ``</w>``), wrapped."""
    return types.withColumn("sym", wrap_symbols(word_symbols(F.col("word"))))


def _pair_array(symbols: Column, weight: Column) -> Column:
    """Adjacent pairs of a symbol array as structs ``i, l, r, w``."""
    none = F.array().cast("array<struct<i:int,l:string,r:string,w:bigint>>")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(symbols) - 2),
        lambda i: F.struct(i.alias("i"), F.get(symbols, i).alias("l"), F.get(symbols, i + 1).alias("r"), weight.cast("bigint").alias("w")),
    )
    return F.when(F.size(symbols) >= 2, pairs).otherwise(none)


def type_pairs(types: DataFrame) -> DataFrame:
    """Adjacent symbol pairs of every type: ``first, i, l, r, w`` (``i`` = symbol index)."""
    return types.select("first", "freq", unwrap_symbols(F.col("sym")).alias("_s")).select(
        "first", F.inline(_pair_array(F.col("_s"), F.col("freq")))
    )


def pair_stats(types: DataFrame) -> DataFrame:
    """``l, r, cnt, first`` where ``first = (type first, symbol index)`` of the earliest occurrence."""
    return type_pairs(types).groupBy("l", "r").agg(
        F.sum("w").alias("cnt"), F.min(F.struct(F.col("first").alias("t"), F.col("i"))).alias("first")
    )


def merge_column(sym: Column, left: str, right: str) -> Column:
    """F4 on the wrapped string."""
    return F.replace(sym, F.lit(f"\t{left} \t{right} "), F.lit(f"\t{left}{right} "))


# ---------------------------------------------------------------------------
# Training (B7)
# ---------------------------------------------------------------------------

@dataclass
class BpeModel:
    """``vocab(token, id)`` and, for inspection, ``merges(rank, l, r, cnt)``."""

    vocab: DataFrame
    merges: DataFrame

    def save(self, path: str) -> None:
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        self.merges.write.mode("overwrite").parquet(f"{path}/merges")

    @staticmethod
    def load(spark, path: str) -> "BpeModel":
        return BpeModel(spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges"))


def _leading_pairs(pairs: DataFrame, blocks: DataFrame, most: int) -> list[tuple[int, int, int]]:
    """The next merges in order, as many as one round can make (none when no pair is left).

    Pairs are taken by falling count while each has a count of its own and
    shares no symbol with those before it. A merge changes only counts of pairs
    that contain one of its symbols, and a new pair occurs at most as often as
    a pair it replaces, which is not among those taken and so has a smaller
    count: merging them one after another would choose the same pairs. If the
    highest count is tied, the pair met first is the round's only merge.
    """
    want = min(most, _ROUND)
    top = pairs.orderBy(F.desc("cnt")).limit(want + 1).collect()
    out: list[tuple[int, int, int]] = []
    used: set[int] = set()
    for row, after in zip(top[:want], [*top[1:], None]):
        if (after is not None and after["cnt"] == row["cnt"]) or not used.isdisjoint((row["l"], row["r"])):
            break
        used.update((row["l"], row["r"]))
        out.append((row["l"], row["r"], row["cnt"]))
    if top and not out:
        tied = pairs.where(F.col("cnt") == top[0]["cnt"]).select("l", "r")
        first = blocks.mapInArrow(first_places, "l int, r int, doc_id bigint, pos int, i int").join(tied, ["l", "r"], "left_semi")
        win = first.orderBy("doc_id", "pos", "i").limit(1).collect()[0]
        out.append((win["l"], win["r"], top[0]["cnt"]))
    return out


def _merge_loop(types: DataFrame, k: int):
    """Run up to ``k`` merges over ``types``; return the final blocks, the names of their symbols, merges and the cached state.

    The blocks and pair tables are checkpointed every few rounds (reliable,
    bounded lineage) and kept in memory in between.
    """
    ship_package(types.sparkSession)
    met = types.select("word", "freq", key_doc(F.col("first")).alias("doc_id"), key_pos(F.col("first")).alias("pos"))
    blocks = cut_lineage(met.mapInArrow(form_blocks, BLOCK)).persist()
    pairs = cut_lineage(blocks.select(F.inline("change")).groupBy("l", "r").agg(F.sum("w").alias("cnt"))).persist()
    names = [END_OF_WORD]
    numbers = {END_OF_WORD: FIRST_NAME}
    merges: list[tuple[int, str, str, int]] = []
    unread: list[DataFrame] = []  # states that the one being computed does not read
    last: list[DataFrame] = []  # the state before the current one
    rounds = 0
    while len(merges) < k:
        best = _leading_pairs(pairs, blocks, k - len(merges))
        for df in unread:
            df.unpersist()
        if not best:
            break
        step = []
        for left, right, cnt in best:
            l, r = symbol_text(left, names), symbol_text(right, names)
            if l + r not in numbers:
                numbers[l + r] = FIRST_NAME + len(names)
                names.append(l + r)
            step.append((left, right, numbers[l + r]))
            merges.append((len(merges) + 1, l, r, cnt))
        new_blocks = blocks.select(*blocks.columns[:-1]).mapInArrow(merge_blocks(step), BLOCK)
        rounds += 1
        if rounds % _CHECKPOINT_EVERY == 0:
            new_blocks = cut_lineage(new_blocks)
        new_blocks = new_blocks.persist()
        change = new_blocks.select(F.inline("change")).groupBy("l", "r").agg(F.sum("w").alias("cnt"))
        new_pairs = pairs.unionByName(change).groupBy("l", "r").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") != 0)
        if rounds % _CHECKPOINT_EVERY == 0:
            new_pairs = cut_lineage(new_pairs)
        # The new blocks are computed from the last ones when the next round reads the pairs; those go after that.
        unread, last = last, [blocks, pairs]
        blocks, pairs = new_blocks, new_pairs.persist()
    # Cached state still held: the caller releases it once its result is materialised.
    return blocks, names, merges, [*unread, *last, blocks, pairs]


def train_bpe(docs: DataFrame, k: int = 500, id_col: str = "doc_id", text_col: str = "text") -> BpeModel:
    """Learn up to ``k`` merges (fewer when no pair is left); k <= 0 means none.

    The vocabulary is the set of symbols in the *final* segmentation of the
    corpus' word types, numbered from 0 in code-point order (W5, G7).
    """
    spark = docs.sparkSession
    blocks, names, merges, cached = _merge_loop(word_types(docs, id_col, text_col), k)
    vocab = blocks.mapInArrow(block_tokens(names), "token string").distinct()
    vocab = dense_index(vocab, ["token"], "id", start=0).select("token", "id")  # checkpointed
    for df in cached:
        df.unpersist()
    merges_df = spark.createDataFrame(merges, "rank int, l string, r string, cnt bigint")
    return BpeModel(vocab, merges_df)


def segment_types(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The training types after ``k`` merges: ``word, freq, first, symbols``."""
    blocks, names, _, cached = _merge_loop(word_types(docs, id_col, text_col), k)
    types = blocks.mapInArrow(block_types(names), "word string, freq bigint, doc_id bigint, pos int, symbols array<string>")
    out = cut_lineage(types.select("word", "freq", first_key(F.lit(0), F.col("doc_id"), F.col("pos")).alias("first"), "symbols"))
    for df in cached:
        df.unpersist()
    return out


# ---------------------------------------------------------------------------
# Encoding (B9) and tokenization
# ---------------------------------------------------------------------------

def _dictionary(vocab: DataFrame) -> dict[str, int] | None:
    """The vocabulary as token -> id if it has at most ``_DICTIONARY`` tokens, else None."""
    rows = vocab.select("token", "id").limit(_DICTIONARY + 1).collect()
    return {r["token"]: r["id"] for r in rows} if len(rows) <= _DICTIONARY else None


def _bloom(vocab: DataFrame, tokens: int):
    """A test ``Column -> Column`` that every token of the vocabulary passes, and few other strings.

    Two bits of a table of 32 bits a token (up to ``_BLOOM_BITS``), added up in Spark.
    """
    bits = min(max(1 << (32 * tokens - 1).bit_length(), 64), _BLOOM_BITS)

    def places(token: Column) -> list[Column]:
        h = F.xxhash64(token)
        return [F.pmod(h, F.lit(bits)), F.pmod(F.xxhash64(h), F.lit(bits))]

    one = lambda p: F.struct(F.floor(p / 64).cast("int").alias("at"), (p % 64).cast("int").alias("bit"))
    set_bits = vocab.select(F.inline(F.array(*(one(p) for p in places(F.col("token")))))).distinct()
    words = set_bits.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("w"))
    table = [0] * (bits // 64)
    for r in words.collect():  # bits / 64 rows at most
        table[r["at"]] = r["w"]
    lit = F.lit(table) if bits <= 1 << 16 else F.expr(f"from_json('{table}', 'array<bigint>')")

    def test(token: Column) -> Column:
        hit = F.lit(True)
        for p in places(token):
            word = F.get(lit, F.floor(p / 64).cast("int"))
            hit = hit & (F.call_function("shiftrightunsigned", word, (p % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return hit

    return test


def _word_hits(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """The vocabulary tokens that are substrings of each word (with its end mark): ``word, hits array<token, id>``.

    Every symbol that the encoder can form is such a substring. Substrings are
    no longer than the longest token and pass a Bloom filter of the vocabulary
    inside the row, so that hardly more than the true hits are exploded and
    shuffled.
    """
    longest, tokens = vocab.agg(F.max(F.char_length("token")), F.count(F.lit(1))).first()
    spans = F.expr(
        f"flatten(transform(sequence(0, size(s) - 1), i -> transform(sequence(1, least({max(longest or 0, 1)}, size(s) - i)), "
        "n -> array_join(slice(s, i + 1, n), ''))))"
    )
    passed = F.filter(F.array_distinct(spans), _bloom(vocab, tokens))
    each = words.select("word", word_symbols(F.col("word")).alias("s")).select("word", F.explode(passed).alias("token"))
    return each.join(vocab.select("token", "id"), "token").groupBy("word").agg(F.collect_list(F.struct("token", "id")).alias("hits"))


def encode_words(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """Encode distinct ``word``s: ``word, tokens, ids`` (arrays), trailing ``</w>`` dropped, -1 for unknown tokens.

    While an adjacent pair's concatenation is in the vocabulary, the leftmost
    such pair is merged wherever it occurs (:func:`merge_symbols`). Tasks hold
    the vocabulary if it has at most ``_DICTIONARY`` tokens (a trained one has
    k plus the alphabet); a larger one is met by a join on the words'
    substrings (:func:`_word_hits`).
    """
    distinct = words.select("word").where(F.col("word").isNotNull()).distinct()
    out = "word string, tokens array<string>, ids array<bigint>"
    ids = _dictionary(vocab)
    ship_package(words.sparkSession)
    if ids is not None:
        return distinct.mapInArrow(encode_batches(ids), out)
    hits = _word_hits(distinct, vocab).withColumnRenamed("word", "_hw")
    known = F.coalesce("hits", F.array().cast("array<struct<token:string,id:bigint>>"))
    return distinct.join(hits, F.col("word") == F.col("_hw"), "left").select("word", known.alias("hits")).mapInArrow(merge_batches, out)


def tokenize(docs: DataFrame, model: BpeModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """B10 + J2: ``doc_id, pos, tpos, token, id``: every pre-token of every document, in order.

    With a vocabulary that tasks can hold, documents are encoded where they
    are: nothing is shuffled, and a word that a third of all occurrences are is
    looked up in a table. With a larger one, distinct words are encoded first
    and met by their occurrences (:func:`_meet`).
    """
    ids = _dictionary(model.vocab)
    if ids is not None:
        ship_package(docs.sparkSession)
        return _joined_words(docs, id_col, text_col).mapInArrow(tokenize_batches(ids), "doc_id bigint, pos int, tpos int, token string, id bigint")
    occ = pretokens(docs, id_col, text_col)
    counted = occ.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    encoded = encode_words(counted.select("word"), model.vocab)
    return _meet(occ, cut_lineage(encoded.join(counted, "word")))


def _meet(occ: DataFrame, encoded: DataFrame) -> DataFrame:
    """Occurrences (``doc_id, pos, word``) with the tokens of their word (``word, tokens, ids, freq``).

    A word is as many join keys as it has ``_PIECES``-ths of all occurrences,
    and an occurrence takes one of them by a hash of its place: no key holds
    more than that share. The words that have several keys are fewer than
    ``_PIECES``, so that their number of keys is a table that tasks hold.
    """
    total = encoded.agg(F.sum("freq")).first()[0] or 1
    keys = encoded.withColumn("pieces", F.ceil(F.col("freq") * _PIECES / F.lit(total)).cast("int"))
    dealt = _deal(occ, keys)
    copies = keys.select("word", "tokens", "ids", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("_piece"))
    pairs = F.posexplode(F.arrays_zip(F.col("tokens").alias("token"), F.col("ids").alias("id")))
    flat = dealt.join(copies, ["word", "_piece"]).select("doc_id", "pos", pairs.alias("tpos", "x"))
    return flat.select("doc_id", "pos", "tpos", F.col("x.token").alias("token"), F.col("x.id").alias("id"))


def _deal(occ: DataFrame, keys: DataFrame) -> DataFrame:
    """Add ``_piece``, the key of a word (0 to ``pieces`` - 1) that an occurrence takes."""
    several = F.broadcast(keys.where("pieces > 1").select("word", "pieces"))
    piece = F.coalesce(F.pmod(F.xxhash64("doc_id", "pos"), "pieces"), F.lit(0)).cast("int")
    return occ.join(several, "word", "left").withColumn("_piece", piece).drop("pieces")


def token_ids(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """J2 for a table of distinct tokens: ``id`` of each ``token`` (-1 when unknown)."""
    v = vocab.select("token", "id")
    return tokens.join(v, "token", "left").withColumn("id", F.coalesce(F.col("id"), F.lit(-1).cast("bigint")))


def decode(ids: DataFrame, vocab: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Id -> token (inner join; unknown ids have no token).

    A vocabulary of at most ``_DICTIONARY`` tokens is a table that tasks hold:
    nothing is shuffled. With a larger one, a few ids carry most occurrences,
    so each id is ``_SALTS`` join keys: an occurrence takes one by a hash of its
    ``key`` columns (all by default), and the vocabulary is copied that many times.
    """
    tokens = vocab.select("token", "id")
    if tokens.limit(_DICTIONARY + 1).count() <= _DICTIONARY:
        return ids.join(F.broadcast(tokens), "id")
    salted = ids.withColumn("_salt", F.pmod(F.xxhash64(*(key or ids.columns)), F.lit(_SALTS)).cast("int"))
    copies = tokens.select("token", "id", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"))
    return salted.join(copies, ["id", "_salt"]).drop("_salt")
