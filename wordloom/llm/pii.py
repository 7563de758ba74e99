"""Personal data by weak supervision, in DataFrame functions only.

Four base kinds (email, ip, card, phone) are patterns with a check each; their valid matches are personal data by
definition. The method adds spans that the base misses: one broad pattern finds candidates of six kinds, and labelers
vote on each (1 for, -1 against, 0 silent): patterns of the form, gazetteers, and words of the context. How far a
labeler can be trusted is estimated by expectation-maximisation from the votes alone, the valid base matches being
known answers. The resulting probabilities train the final span classifier, a logistic regression per kind over votes
and shape, which decides on the candidates.

A text is read once, inside its row; only numbers leave that step. Whatever is learned depends on how often each
combination of features occurs: Spark counts those over all documents, and their number is bounded by the product of
the features' values, not by the corpus, so the driver fits both models on the counts. No row is shuffled.

Patterns use possessive repetition and start only where a run of their characters starts, so that a text of one
unbroken run takes linear time; neither changes what matches.

Defined results:

* a null or empty text has no spans, zero counts and the digest of the empty string;
* rows that repeat an id, and rows with a null id, are rows of their own, each returned once with its own spans;
* no documents give no rows; a kind without candidates gets a classifier that adds nothing;
* other columns of the input are not read; places are code points, the end exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C

KINDS = ("email", "ip", "card", "phone", "secret", "name")
EMAIL, IP, CARD, PHONE, SECRET, NAME = range(len(KINDS))

# --- patterns --------------------------------------------------------------------

_LOCAL = "A-Za-z0-9._%+-"
_EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"  # shorter runs of digits fail the check of 13 digits anyway
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_AT, _DOT = r"(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)", r"(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
_NATIONAL = r"(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9])"
_TOKEN = "A-Za-z0-9+/_-"
_SECRET = rf"(?=[{_TOKEN}]{{16}})(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[{_TOKEN}]++={{0,2}}"
_NAME = r"\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++){1,2}"
_MAIL = rf"[{_LOCAL}]++(?:@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++|{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++)"
#: Candidates start after a character that can't belong to them. The first form that matches at a place wins, so they
#: do not overlap.
_CANDIDATE = (
    rf"(?<![{_LOCAL}/\p{{L}}(])(?:(?=[+(0-9])(?:{_PHONE}|{_IP}|{_CARD}|{_NATIONAL})|{_MAIL}|{_SECRET}|{_NAME})"
)

_BASE = ((_EMAIL, "contains(_t, '@')"), (_IP, "_t rlike '[0-9][.][0-9]'"), (_CARD, "true"), (_PHONE, "contains(_t, '+')"))
_BEFORE, _AFTER = 40, 24  # characters of context, up to the next match

# --- fixed values: gazetteers and context words --------------------------------------

TOP_DOMAINS = "com org net edu gov mil int info biz io dev app ai me tv eu uk us ca au nz ie de at ch li fr be lu nl es pt it mx ar cl co br".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 354 358 420 421".split()
GIVEN_NAMES = (
    "anna ann alice andrew anthony barbara brian carol charles christopher daniel david donald dorothy edward elizabeth emily emma george helen "
    "james jane jennifer jessica john joseph karen kevin laura linda lisa margaret mark mary matthew michael nancy olivia patricia paul peter "
    "richard robert ronald ruth sarah sharon steven susan thomas william hans klaus jürgen wolfgang dieter stefan andreas matthias karl heinz "
    "ursula monika petra sabine renate claudia katrin anja heike jean pierre michel philippe alain nicolas claire marie sophie camille juliette "
    "françois louis henri antoine isabelle nathalie sylvie jose josé juan carlos luis miguel manuel francisco antonio pedro pablo jorge maría "
    "maria carmen ana isabel dolores pilar teresa rosa lucía elena sofía"
).split()
NOT_NAMES = (
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november "
    "december london paris berlin madrid lyon hamburg munich münchen barcelona new york san los united states kingdom north south east west "
    "university street avenue road the this that und der die das les des una los las"
).split()
SECRET_STARTS = r"^(?:sk[_-]|pk[_-]|AKIA|ASIA|gh[pousr]_|eyJ|xox[abp]-|AIza)"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|65|62)"
RESERVED_IP = r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|192\.0\.2|198\.51\.100|203\.0\.113|22[4-9]|23[0-9])\."
#: By kind: words before a span that speak for it.
CUES = (
    "mail|contact|write|schreib|courriel|correo|reply|address",
    r"\bip\b|server|host|login|logged|client|addr|from",
    "card|visa|master|amex|credit|debit|karte|carte|tarjeta|payment",
    r"tel\b|tel\.|phone|call|fax|mobil|móvil|ruf|appel|llam|contact|whatsapp",
    "token|key|secret|passw|pwd|auth|bearer|credential|api",
    r"\b(?:mr|mrs|ms|dr|prof|herr|frau|mme|señor|señora|sr|sra)\.?\s*$|dear|signed|sincerely|name|contact|liebe|cher|estimad",
)
#: Words before a span that speak for a number or word of another sort.
OTHER = r"version|isbn|issn|order|invoice|section|chapter|page|figure|serial|build|model|release|article|hash|commit|checksum|sha|md5|digest|uuid"


# --- places of matches ----------------------------------------------------------------

def _spans(df: DataFrame, name: str, pattern: str, where: str = "true") -> DataFrame:
    """Add column ``name``: ``text, start, end, before, after`` of every match in ``_t``, in order.

    Matches and the text between them come from one search each; places are running sums of their lengths. The sums
    are taken in blocks of about the root of their number, so that the work stays far from quadratic.
    """
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(F.expr(where), F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split("_t", pattern, -1)).otherwise(none))
    df = df.withColumn("_u", F.expr("zip_with(_m, slice(_g, 1, size(_m)), (m, g) -> char_length(m) + char_length(g))"))
    df = df.withColumn("_b", F.expr("greatest(int(ceil(sqrt(size(_u)))), 1)"))
    # ``transform(array(x), v -> ..)[0]`` names a value: what a lambda takes from another column may be written into the
    # lambda by the optimizer, and would be computed for every element
    add = "0, (a, z) -> a + z"
    blocks = "transform(array(_u), u -> transform(sequence(0, _b - 1), b -> slice(u, b * _b + 1, _b)))[0]"
    df = df.withColumn("_s", F.expr(blocks))
    block = f"transform(array(aggregate(slice(o, 1, b), {add})), before -> transform(x, (y, i) -> before + aggregate(slice(x, 1, i), {add})))[0]"
    starts = f"transform(array(transform(_s, x -> aggregate(x, {add}))), o -> flatten(transform(_s, (x, b) -> {block})))[0]"
    df = df.withColumn("_f", F.expr(starts))
    place = "_f[i] + char_length(_g[i])"
    each = f"named_struct('text', m, 'start', {place}, 'end', {place} + char_length(m), 'before', right(_g[i], {_BEFORE}), 'after', left(_g[i + 1], {_AFTER}))"
    return df.withColumn(name, F.expr(f"transform(_m, (m, i) -> {each})")).drop("_m", "_g", "_u", "_b", "_s", "_f")


# --- checks ------------------------------------------------------------------------

def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled and cast out by nines, is a multiple of ten."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d >= "5", 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: int, text: Column) -> Column:
    """Whether a match of a base pattern is personal data of that kind."""
    if kind == IP:
        return text.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})(?:\.|$)){4}$")
    if kind == CARD:
        short = F.when(F.length(_digits(text)).between(13, 19), _digits(text))
        return F.coalesce(_luhn(short), F.lit(False))
    if kind == PHONE:
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


# --- candidates, votes and features ---------------------------------------------------

def _kind(text: Column) -> Column:
    """The kind of candidate, from its own form."""
    return (
        F.when(text.contains("@") | text.rlike(rf"^\S+?{_AT}"), EMAIL)
        .when(text.startswith("+"), PHONE)
        .when(text.rlike(r"^[0-9]++(?:\.[0-9]++){3}$"), IP)
        .when(text.rlike(rf"^{_CARD}$"), CARD)
        .when(text.rlike(r"^[0-9() ./-]++$"), PHONE)
        .when(text.contains(" "), NAME)
        .otherwise(SECRET)
    )


def _by_kind(kind: Column, **of: Column) -> Column:
    out = F.lit(0)
    for name, value in of.items():
        out = F.when(kind == KINDS.index(name), value).otherwise(out)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0)


def _votes(x: Column) -> dict[str, Column]:
    """Labelers over a candidate (``kind, text, before, after``): 1 for, -1 against, 0 silent."""
    kind, text, before, after = x["kind"], x["text"], F.lower(x["before"]), x["after"]
    digits, words = _digits(text), F.split(F.lower(text), " ")
    cue = F.lit(False)
    for k, pattern in enumerate(CUES):
        cue = F.when(kind == k, before.rlike(pattern)).otherwise(cue)
    filler = text.rlike(r"([0-9A-Za-z])\1{6}") | digits.startswith("123456789")
    return {
        # patterns
        "form": _by_kind(
            kind,
            email=_vote(text.rlike(r"^[A-Za-z0-9][^@]*@[^@]*\.[A-Za-z]{2,}$") | text.rlike(_AT), text.rlike(r"@[^@]*\.[0-9-]+$")),
            ip=F.when(_valid(IP, text), 1).otherwise(-1),
            card=F.when(_valid(CARD, text), 1).otherwise(-1),
            phone=F.when(F.length(digits).between(9, 15), 1).otherwise(-1),
            # digits and a-f alone may as well be a checksum: the context has to tell
            secret=_vote(~text.rlike("^[0-9a-f]+$") & text.rlike("[0-9].*[0-9].*[0-9]") & text.rlike("[A-Za-z].*[A-Za-z]") & (F.length(text) >= 20), text.rlike(r"[/_-].*[/_-]")),
            name=_vote(F.lit(False), text.rlike(r"\p{Ll}{14}")),
        ),
        "filler": F.when(filler, -1).otherwise(0),
        # gazetteers
        "listed": _by_kind(
            kind,
            email=_vote(F.lower(F.regexp_extract(text, "([A-Za-z]+)$", 1)).isin(TOP_DOMAINS)),
            card=_vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS)),
            phone=F.when(text.startswith("+"), _vote(digits.rlike(f"^(?:{'|'.join(CALLING_CODES)})"))).otherwise(_vote(digits.startswith("0"))),
            secret=_vote(text.rlike(SECRET_STARTS)),
            name=_vote(F.get(words, F.lit(0)).isin(GIVEN_NAMES)),
        ),
        "reserved": _by_kind(
            kind,
            ip=_vote(F.lit(False), text.rlike(RESERVED_IP)),
            phone=_vote(F.lit(False), digits.rlike("^(?:000|999)")),
            name=_vote(F.lit(False), F.exists(words, lambda w: w.isin(NOT_NAMES))),
        ),
        # context
        "cue": _vote(cue),
        "other": _vote(F.lit(False), before.rlike(OTHER)),
        "assigned": _vote((kind != NAME) & before.rlike(r"[:=]\s*[\"']?$")),
        "glued": _vote(F.lit(False), before.rlike(r"[\p{L}0-9_/]$") | after.rlike(r"^[\p{L}0-9_/]")),
    }


def _shape(x: Column) -> dict[str, Column]:
    """Features of the classifier beside the votes, 0 to 3."""
    text = x["text"]
    long = F.char_length(text)
    share = F.length(_digits(text)) / long
    return {
        "length": F.when(long < 12, 0).when(long < 17, 1).when(long < 33, 2).otherwise(3),
        "digits": F.when(share == 0, 0).when(share < 0.4, 1).when(share < 0.9, 2).otherwise(3),
    }


LABELERS = ("form", "filler", "listed", "reserved", "cue", "other", "assigned", "glued")
SHAPE = ("length", "digits")
FEATURES = (*LABELERS, *SHAPE)
_VALUES = 4  # codes of a feature: a vote is coded -1, 0, 1 as 0, 1, 2


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` (kind, start, end of the valid base spans, by kind and start) and ``candidates``
    (kind, start, end, valid, features) of every row; no text is kept."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    for k, (pattern, where) in enumerate(_BASE):
        df = _spans(df, f"_{k}", pattern, where)
    df = _spans(df, "_c", _CANDIDATE).drop("_t")

    def place(kind: Column, x: Column) -> list[Column]:
        return [kind.cast("int").alias("kind"), x["start"].alias("start"), x["end"].alias("end")]

    def checked(k: int) -> Column:
        return F.transform(F.filter(f"_{k}", lambda x: _valid(k, x["text"])), lambda x: F.struct(*place(F.lit(k), x)))

    base = [checked(k) for k in range(len(_BASE))]
    df = df.withColumn("_k", F.transform("_c", lambda x: F.struct(*place(_kind(x["text"]), x), *(x[c].alias(c) for c in ("text", "before", "after")))))

    def features(x: Column) -> Column:
        codes = {k: v + 1 for k, v in _votes(x).items()} | _shape(x)
        ok = F.lit(False)
        for k, (pattern, _) in enumerate(_BASE):
            ok = F.when((x["kind"] == k) & x["text"].rlike(f"^(?:{pattern})$"), _valid(k, x["text"])).otherwise(ok)
        return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), ok.alias("valid"), F.array(*(codes[f].cast("int") for f in FEATURES)).alias("features"))

    return df.select("doc_id", F.concat(*base).alias("base"), F.transform("_k", features).alias("candidates"))


# --- the models -----------------------------------------------------------------------

#: A combination of features: (kind, feature codes, is a valid base span) and how often it occurs.
Cell = tuple[int, tuple[int, ...], bool, int]


@dataclass
class Reliability:
    """Share of right votes by labeler, and share of personal data by kind."""

    right: list[float]
    share: list[float]


def estimate(cells: list[Cell], share: float = 0.3, rounds: int = 40) -> tuple[list[float], Reliability]:
    """Expectation-maximisation over the votes: probability of each cell, and the labelers' reliabilities.

    A labeler that votes is right with one probability, whatever the answer and the kind: many labelers vote one way
    only, and what valid base spans tell of one serves the kinds that have none. A silent labeler says nothing.
    Reliabilities start at, and are smoothed towards, 8 right votes in 10, and a kind's share of personal data towards
    ``share`` (as if of 10 candidates), which also is the answer where all are silent.
    """
    votes = [[(j, code == 2) for j, code in enumerate(f[: len(LABELERS)]) if code != 1] for _, f, _, _ in cells]
    out = Reliability([0.8] * len(LABELERS), [share] * len(KINDS))
    prob: list[float] = []
    for _ in range(rounds):
        prob = []
        for (kind, _, valid, _), cast in zip(cells, votes):
            odds = math.log(out.share[kind] / (1 - out.share[kind]))
            odds += sum((1 if yes else -1) * math.log(out.right[j] / (1 - out.right[j])) for j, yes in cast)
            prob.append(1.0 if valid else 1 / (1 + math.exp(-max(min(odds, 30), -30))) if cast else share)
        right, of_kind = [[8.0, 10.0] for _ in LABELERS], [[10 * share, 10.0] for _ in KINDS]
        for (kind, _, _, n), cast, p in zip(cells, votes, prob):
            for j, yes in cast:
                right[j][0] += n * (p if yes else 1 - p)
                right[j][1] += n
            if cast:
                of_kind[kind][0] += n * p
                of_kind[kind][1] += n
        out = Reliability([a / b for a, b in right], [a / b for a, b in of_kind])
    return prob, out


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """Gaussian elimination with pivots; ``a`` is positive definite."""
    n = len(b)
    m = [[*row, y] for row, y in zip(a, b)]
    for i in range(n):
        top = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[top] = m[top], m[i]
        for r in range(i + 1, n):
            if q := m[r][i] / m[i][i]:
                m[r] = [x - q * y for x, y in zip(m[r], m[i])]
    x = [0.0] * n
    for i in reversed(range(n)):
        x[i] = (m[i][n] - sum(m[i][j] * x[j] for j in range(i + 1, n))) / m[i][i]
    return x


def fit(cells: list[Cell], prob: list[float], ridge: float = 0.05, rounds: int = 15) -> list[list[float]]:
    """Logistic regression per kind on probable answers: a constant, then one weight per feature and code.

    Newton steps on the counts; each count enters with its probability as answer. A kind without candidates gets a
    constant that says no.
    """
    size = 1 + len(FEATURES) * _VALUES
    out = []
    for kind in range(len(KINDS)):
        rows = [([0, *(1 + j * _VALUES + c for j, c in enumerate(f))], p, n) for (k, f, _, n), p in zip(cells, prob) if k == kind]
        w = [0.0] * size
        for _ in range(rounds if rows else 0):
            grad = [-ridge * x for x in w]
            curve = [[ridge * (i == j) for j in range(size)] for i in range(size)]
            for at, p, n in rows:
                q = 1 / (1 + math.exp(-max(min(sum(w[i] for i in at), 30), -30)))
                for i in at:
                    grad[i] += n * (p - q)
                    for j in at:
                        curve[i][j] += n * q * (1 - q)
            w = [x + d for x, d in zip(w, _solve(curve, grad))]
        out.append(w if rows else [-1.0, *[0.0] * (size - 1)])
    return out


def cells_of(found: DataFrame) -> list[Cell]:
    """Counts of the combinations of features over all candidates: as many as the features allow at most."""
    each = found.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.features", "c.valid").agg(F.count(F.lit(1)).alias("n"))
    return sorted((r["kind"], tuple(r["features"]), r["valid"], r["n"]) for r in each.collect())


def _accepted(weights: list[list[float]]) -> Column:
    """Candidates that the classifier takes for personal data: the sum of their weights is positive."""
    size = len(weights[0])
    flat = F.array(*(F.lit(float(x)) for w in weights for x in w))

    def score(x: Column) -> Column:
        at = x["kind"] * size
        parts = F.transform(x["features"], lambda c, j: F.get(flat, at + 1 + j * _VALUES + c))
        return F.aggregate(parts, F.get(flat, at), lambda a, y: a + y)

    return F.filter("candidates", lambda x: ~x["valid"] & (score(x) > 0))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: the valid base spans, and these with those that the classifier adds (kind, start, end;
    by kind and start)."""
    scratch = C.Scratch(docs.sparkSession, "pii")
    found = scratch.table(find(docs, id_col, text_col), "found")  # numbers only: texts are searched once
    cells = cells_of(found)
    prob, _ = estimate(cells)
    added = F.transform(_accepted(fit(cells, prob)), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))
