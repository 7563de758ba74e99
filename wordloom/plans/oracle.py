"""DuckDB SQL for every registered query that SQL can express.

The views ``documents``, ``benchmark``, ``labels``, ``conversations`` ... are
registered by the caller. Shared CTE fragments are composed in Python; the
iterative BPE queries unroll their rounds into chained CTEs.
DuckDB's RE2 has no look-around, so those regexes are restated without it.
"""

from __future__ import annotations

import string

from ..functions.text import SPACE_CLASS, WORD_CLASS, WORD_PATTERN
from . import catalog as C
from ..operators import qa as QA
from .inputs import ANSWER_TEXT, GAP, GRADE_MODELS, GRADE_SHAPES, PROMPT_STRIDE, RESPONSES, SENTENCE_PATTERN

WS = "[" + SPACE_CLASS + "]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def split_ws_sql(x: str) -> str:
    s = strip_sql(x)
    return f"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE string_split_regex({s}, '{WS}+') END)"


def tokens_sql(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD_PATTERN}')"


def cte_tokens(src: str = "documents", id_col: str = "doc_id", name: str = "tok") -> str:
    return f"{name} AS (SELECT {id_col} AS doc_id, {tokens_sql('text')} AS t FROM {src})"


def cte_events(n: int, tok: str = "tok", name: str = "ev") -> str:
    return f"""{name} AS (
  SELECT doc_id, i, array_to_string(t[i - {n} + 1 : i], ' ') AS context, t[i + 1] AS word
  FROM (SELECT doc_id, t, unnest(range({n}, len(t))) AS i FROM {tok} WHERE len(t) > {n}))"""


def cte_counts(ev: str = "ev", name: str = "cnts", batch: int = 0) -> str:
    return f"""{name} AS (
  SELECT context, word, count(*) AS cnt, {batch} AS first_batch,
         arg_min(doc_id, (doc_id, i)) AS first_doc, arg_min(i, (doc_id, i)) AS first_pos
  FROM {ev} GROUP BY context, word)"""


def cte_vocab(tok: str = "tok", name: str = "vocab") -> str:
    return f"{name} AS (SELECT DISTINCT unnest(t) AS word FROM {tok})"


def cte_top1(cnts: str = "cnts", name: str = "top1") -> str:
    return f"""{name} AS (
  SELECT context, arg_min(word, (-cnt, first_batch, first_doc, first_pos)) AS word,
         max(cnt) AS cnt, CAST(sum(cnt) AS BIGINT) AS total
  FROM {cnts} GROUP BY context)"""


def model_ctes(n: int) -> str:
    return ",\n".join([cte_tokens(), cte_events(n), cte_counts(), cte_vocab()])


def cte_prompts(n: int, name: str = "prompts") -> str:
    return f"""bw AS (SELECT item_id, text, {split_ws_sql('text')} AS ws FROM benchmark),
{name}_raw AS (
  SELECT item_id * {PROMPT_STRIDE} AS prompt_id, text FROM benchmark
  UNION ALL
  SELECT item_id * {PROMPT_STRIDE} + p + 1 AS prompt_id, array_to_string(ws[p + 1 : p + {n}], ' ') AS text
  FROM (SELECT item_id, ws, unnest(range(0, len(ws) - {n} + 1)) AS p FROM bw WHERE len(ws) >= {n})),
{name} AS (SELECT prompt_id, {split_ws_sql('lower(text)')} AS words FROM {name}_raw)"""


def cte_checked(n: int, prompts: str = "prompts", vocab: str = "vocab", name: str = "checked") -> str:
    return f"""pw AS (SELECT prompt_id, generate_subscripts(words, 1) AS pos, unnest(words) AS word FROM {prompts}),
oovs AS (SELECT prompt_id, arg_min(word, pos) AS oov_word FROM pw
         WHERE word NOT IN (SELECT word FROM {vocab}) GROUP BY prompt_id),
{name} AS (
  SELECT p.prompt_id, p.words,
         CASE WHEN len(p.words) <> {n} THEN 'bad_arity' WHEN o.oov_word IS NOT NULL THEN 'oov' END AS status,
         CASE WHEN len(p.words) = {n} THEN o.oov_word END AS oov_word
  FROM {prompts} p LEFT JOIN oovs o USING (prompt_id))"""


def draw_sql(seed: int, prompt_id: str, step: str, total: str) -> str:
    key = f"concat_ws(':', '{seed}', CAST({prompt_id} AS VARCHAR), CAST({step} AS VARCHAR))"
    u32 = f"CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT)"
    return f"CAST((CAST({u32} AS HUGEINT) * {total}) // 4294967296 AS BIGINT)"


def cte_intervals(cnts: str = "cnts", name: str = "iv") -> str:
    return f"""{name} AS (
  SELECT context, word, cnt,
         sum(cnt) OVER (PARTITION BY context ORDER BY first_batch, first_doc, first_pos
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cnt AS lo,
         CAST(sum(cnt) OVER (PARTITION BY context) AS BIGINT) AS total
  FROM {cnts})"""


SQL: dict[str, str] = {}

SQL["word_tokens"] = f"""
SELECT doc_id, CAST(p - 1 AS INTEGER) AS pos, token FROM (
  SELECT doc_id, generate_subscripts({tokens_sql('text')}, 1) AS p, unnest({tokens_sql('text')}) AS token
  FROM documents)"""

SQL["ngram_pairs"] = f"""WITH {cte_tokens()}, {cte_events(C.N_COUNTS)}
SELECT doc_id, CAST(i AS INTEGER) AS i, context, word FROM ev"""

SQL["ngram_counts"] = f"""WITH {model_ctes(C.N_COUNTS)}
SELECT context, word, cnt, first_doc, CAST(first_pos AS INTEGER) AS first_pos FROM cnts"""

SQL["ngram_vocab"] = f"""WITH {cte_tokens()}, {cte_vocab()} SELECT word FROM vocab"""

SQL["ngram_context_totals"] = f"""WITH {model_ctes(C.N_COUNTS)}
SELECT context, CAST(sum(cnt) AS BIGINT) AS total FROM cnts GROUP BY context"""

SQL["ngram_probs"] = f"""WITH {model_ctes(C.N_PREDICT)}
SELECT context, word, cnt, total, cnt / total AS prob
FROM (SELECT *, CAST(sum(cnt) OVER (PARTITION BY context) AS BIGINT) AS total FROM cnts)"""

SQL["ngram_top1"] = f"""WITH {model_ctes(C.N_PREDICT)}, {cte_top1()}
SELECT context, word, cnt, total FROM top1"""

SQL["ngram_roundtrip"] = SQL["ngram_top1"]

_CHECKED = f"""WITH {model_ctes(C.N_PREDICT)}, {cte_prompts(C.N_PREDICT)}, {cte_checked(C.N_PREDICT)}"""

SQL["ngram_prompts"] = f"""{_CHECKED}
SELECT prompt_id, array_to_string(words, ' ') AS words, len(words) AS n_words, status, oov_word FROM checked"""

SQL["ngram_oov"] = f"""{_CHECKED}
SELECT prompt_id, oov_word FROM checked WHERE oov_word IS NOT NULL"""

SQL["ngram_predict"] = f"""{_CHECKED}, {cte_top1()}
SELECT c.prompt_id, COALESCE(c.status, CASE WHEN t.word IS NULL THEN 'unseen_context' ELSE 'ok' END) AS status,
       c.oov_word, t.word AS next_word
FROM checked c LEFT JOIN top1 t ON c.status IS NULL AND t.context = array_to_string(c.words, ' ')"""

SQL["ngram_sample"] = f"""{_CHECKED}, {cte_intervals()},
q AS (SELECT c.prompt_id, array_to_string(c.words, ' ') AS context FROM checked c WHERE c.status IS NULL),
drawn AS (
  SELECT q.prompt_id, iv.word FROM q
  JOIN (SELECT DISTINCT context, total FROM iv) tt ON tt.context = q.context
  JOIN iv ON iv.context = q.context
   AND iv.lo <= {draw_sql(C.SAMPLE_SEED, 'q.prompt_id', '0', 'tt.total')}
   AND {draw_sql(C.SAMPLE_SEED, 'q.prompt_id', '0', 'tt.total')} < iv.lo + iv.cnt)
SELECT c.prompt_id, COALESCE(c.status, CASE WHEN d.word IS NULL THEN 'unseen_context' ELSE 'ok' END) AS status,
       c.oov_word, d.word AS next_word
FROM checked c LEFT JOIN drawn d USING (prompt_id)"""


def _generate_sql(mode: str, n: int = C.N_PREDICT) -> str:
    if mode == "top1":
        pick = f"""{cte_top1()},
step_fn AS (SELECT context, word AS next_word FROM top1)"""
        nxt = """LEFT JOIN step_fn s ON s.context = g.ctx"""
        nxt_word = "s.next_word"
    else:
        pick = f"""{cte_intervals()},
tt AS (SELECT DISTINCT context, total FROM iv)"""
        r = draw_sql(C.SAMPLE_SEED, "g.prompt_id", "g.step", "tt.total")
        nxt = f"""LEFT JOIN tt ON tt.context = g.ctx
  LEFT JOIN iv s ON s.context = g.ctx AND s.lo <= {r} AND {r} < s.lo + s.cnt"""
        nxt_word = "s.word"
    checked = f"""WITH {model_ctes(n)}, {cte_prompts(n)}, {cte_checked(n)}"""
    return f"""{checked}, {pick},
gen AS (
  WITH RECURSIVE g(prompt_id, step, ctx, words, done) AS (
    SELECT prompt_id, 0, array_to_string(words, ' '), words, false FROM checked WHERE status IS NULL
    UNION ALL
    SELECT g.prompt_id, g.step + 1,
           CASE WHEN {nxt_word} IS NULL THEN g.ctx ELSE array_to_string(list_append(g.words, {nxt_word})[-{n}:], ' ') END,
           CASE WHEN {nxt_word} IS NULL THEN g.words ELSE list_append(g.words, {nxt_word}) END,
           {nxt_word} IS NULL
    FROM g {nxt}
    WHERE NOT g.done AND g.step < {C.GENERATE_WORDS})
  SELECT prompt_id, arg_max(words, step) AS words, bool_or(done) AS halted FROM g GROUP BY prompt_id)
SELECT c.prompt_id,
       COALESCE(c.status, CASE WHEN g.halted THEN 'unseen_context' ELSE 'ok' END) AS status,
       CAST(COALESCE(len(g.words) - len(c.words), 0) AS INTEGER) AS n_generated,
       CASE WHEN len(g.words) > len(c.words) THEN array_to_string(g.words, ' ') END AS output
FROM checked c LEFT JOIN gen g USING (prompt_id)"""


SQL["ngram_generate"] = _generate_sql("top1")
SQL["ngram_generate_sample"] = _generate_sql("sample")
SQL["ngram_generate_n2"] = _generate_sql("top1", 2)

SQL["ngram_incremental"] = f"""WITH {cte_tokens()}, {cte_events(C.N_PREDICT)}, {cte_counts()},
{cte_tokens('benchmark', 'item_id', 'tok2')}, {cte_events(C.N_PREDICT, 'tok2', 'ev2')}, {cte_counts('ev2', 'cnts2', 1)},
allc AS (SELECT * FROM cnts UNION ALL SELECT * FROM cnts2)
SELECT context, word, CAST(sum(cnt) AS BIGINT) AS cnt,
       arg_min(first_batch, (first_batch, first_doc, first_pos)) AS first_batch,
       arg_min(first_doc, (first_batch, first_doc, first_pos)) AS first_doc,
       CAST(arg_min(first_pos, (first_batch, first_doc, first_pos)) AS INTEGER) AS first_pos
FROM allc GROUP BY context, word"""


# ---------------------------------------------------------------------------
# C. scoring
# ---------------------------------------------------------------------------

def _models_sql() -> str:
    parts = []
    for k, (model, label) in enumerate(GRADE_MODELS):
        parts.append(
            f"""SELECT '{model}' AS model, l.doc_id * {len(GRADE_MODELS)} + {k} AS line_no, l.doc_id,
         CASE WHEN l.{label} = 1 THEN 'true' ELSE 'false' END AS b,
         'doc ' || CAST(l.doc_id AS VARCHAR) || ' (' || d.lang || ')' AS e
  FROM labels l JOIN documents d USING (doc_id)"""
        )
    return "\n  UNION ALL\n  ".join(parts)


def cte_grading_lines(name: str = "glines") -> str:
    plain = """'{"explanation": "' || e || '", "score": ' || b || '}'"""
    s = f"(doc_id % {GRADE_SHAPES})"
    content = f"""CASE
    WHEN {s} = 0 THEN {plain}
    WHEN {s} = 1 THEN '```json' || chr(10) || {plain} || chr(10) || '```'
    WHEN {s} = 2 THEN '```' || chr(10) || {plain} || chr(10) || '```'
    WHEN {s} = 3 THEN '{{"explanation": "see \\q in ' || e || '", "score": ' || b || '}}'
    WHEN {s} = 4 THEN '{{"explanation": "' || e || '", "score": "' || b || '"}}'
    WHEN {s} = 5 THEN ' ' || chr(9) || ' '
    WHEN {s} = 9 THEN '{{"score": ' || b || '}} trailing'
    WHEN {s} = 10 THEN '{{''score'': ' || b || '}}'
    WHEN {s} = 11 THEN '{{"explanation": "' || e || '"}}'
    WHEN {s} = 12 THEN '```json' || chr(10) || '{{"score": ' || b || '}}' || chr(10) || '```' || chr(10)
    WHEN {s} = 13 THEN '{{"score": ' || b || '}}]'
    WHEN {s} = 14 THEN '{{"score": ' || b || '}}] junk'
    ELSE {plain} END"""
    cid = """'{"custom_id": "doc-' || CAST(doc_id AS VARCHAR) || '"'"""
    return f"""graw AS ({_models_sql()}),
gcontent AS (SELECT *, {content} AS content0 FROM graw),
{name} AS (
  SELECT model, line_no, CASE
    WHEN {s} = 6 THEN 'not json ' || CAST(doc_id AS VARCHAR)
    WHEN {s} = 7 THEN {cid} || ', "error": {{"message": "failed"}}}}'
    WHEN {s} = 8 THEN {cid} || ', "response": {{"status_code": 200, "body": {{"choices": []}}}}}}'
    ELSE {cid} || ', "response": {{"status_code": 200, "body": {{"choices": [{{"message": {{"role": "assistant", "content": '
         || CASE WHEN {s} = 16 THEN '{{"score": ' || b || '}}' ELSE to_json(content0) END || '}}}}]}}}}}}'
         || CASE WHEN {s} = 15 THEN ']' ELSE '' END END AS line
  FROM gcontent)"""


def cte_scored(lines: str = "glines", name: str = "scored") -> str:
    ln = strip_sql("line")
    c0 = "content"
    c1 = f"(CASE WHEN starts_with({c0}, '```json') THEN {strip_sql(f"replace({c0}, '```json', '')")} ELSE {c0} END)"
    c2 = f"(CASE WHEN suffix(c1, '```') THEN {strip_sql("replace(c1, '```', '')")} ELSE c1 END)"
    c3 = r"""regexp_replace(c2, '\\([^"\\/bfnrt]|$)', '\\\\\1', 'g')"""
    return f"""sl AS (
  SELECT model, line_no, {ln} AS l FROM {lines}),
sp AS (
  SELECT model, line_no,
         CASE WHEN json_valid(l) THEN json_type(l) = 'OBJECT' ELSE false END AS ok,
         CASE WHEN (CASE WHEN json_valid(l) THEN json_type(l) = 'OBJECT' ELSE false END)
               AND json_type(l, '$.response.body.choices[0].message.content') = 'VARCHAR'
              THEN json_extract_string(l, '$.response.body.choices[0].message.content') END AS content
  FROM sl),
s1 AS (SELECT *, {c1} AS c1 FROM sp),
s2 AS (SELECT *, CASE WHEN content IS NOT NULL AND {strip_sql('content')} <> '' THEN {c2} END AS c2 FROM s1),
s3 AS (SELECT *, {c3} AS cleaned FROM s2),
{name} AS (
  SELECT model, line_no, content, cleaned, CASE
    WHEN NOT ok THEN 'bad_line'
    WHEN content IS NULL THEN 'no_content'
    WHEN {strip_sql('content')} = '' THEN 'empty'
    WHEN NOT obj THEN 'bad_json'
    WHEN score_type = 'BOOLEAN' AND CAST(json_extract(cleaned, '$.score') AS VARCHAR) = 'true' THEN 'correct'
    ELSE 'incorrect' END AS outcome
  FROM (SELECT *, CASE WHEN obj THEN json_type(cleaned, '$.score') END AS score_type
        FROM (SELECT *, CASE WHEN json_valid(cleaned) THEN json_type(cleaned) = 'OBJECT' ELSE false END AS obj FROM s3)))"""


_SCORED = f"WITH {cte_grading_lines()}, {cte_scored()}"

SQL["response_content"] = f"""{_SCORED}
SELECT model, line_no, content FROM scored WHERE content IS NOT NULL"""

SQL["verdict_clean"] = f"""{_SCORED}
SELECT model, line_no, cleaned FROM scored WHERE cleaned IS NOT NULL"""

SQL["verdict_score"] = f"""{_SCORED}
SELECT model, line_no, outcome FROM scored"""

SQL["score_outcomes"] = f"""{_SCORED}
SELECT model, outcome, count(*) AS n FROM scored GROUP BY model, outcome"""


def _accuracy_sql(by: str) -> str:
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""{_SCORED},
acc AS (
  SELECT {sel}count(*) FILTER (WHERE outcome = 'correct') AS correct,
         count(*) FILTER (WHERE outcome IN ('correct', 'incorrect')) AS answered
  FROM scored {grp})
SELECT {sel}correct, answered,
       CASE WHEN answered > 0 THEN CAST(correct AS DOUBLE) / CAST(answered AS DOUBLE) END AS accuracy,
       CASE WHEN answered > 0 THEN printf('%.2f%%', CAST(correct AS DOUBLE) / CAST(answered AS DOUBLE) * 100.0) END AS percent
FROM acc"""


SQL["qa_accuracy"] = _accuracy_sql("")
SQL["qa_accuracy_by_model"] = _accuracy_sql("model")


# ---------------------------------------------------------------------------
# C. questions, requests, alignment
# ---------------------------------------------------------------------------

def sql_literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_template(template: str, **exprs: str) -> str:
    """``str.format`` rendered as a SQL concatenation."""
    parts = []
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(sql_literal(literal))
        if field is not None:
            parts.append(f"CAST({exprs[field]} AS VARCHAR)")
    return "(" + " || ".join(parts) + ")"


def cte_questions(name: str = "questions") -> str:
    (q_lab, q_yes, q_no) = ANSWER_TEXT[0]
    return f"""qdocs AS (SELECT d.doc_id AS file_id, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
qpar AS (SELECT file_id, quality, toxic, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS p,
                unnest(string_split(text, chr(10))) AS par FROM qdocs),
qsent AS (SELECT file_id, quality, toxic, p,
                 list_filter(list_transform(regexp_extract_all(par, '{SENTENCE_PATTERN}'), lambda s: {strip_sql('s')}),
                             lambda s: s <> '') AS sents FROM qpar),
{name} AS (
  SELECT file_id, CAST(0 AS INTEGER) AS a, p, CAST(generate_subscripts(sents, 1) - 1 AS INTEGER) AS q,
         unnest(sents) AS question,
         CASE WHEN quality IS NOT NULL THEN 2 ELSE 0 END AS n_answers,
         CASE WHEN quality IS NOT NULL THEN lower(CASE WHEN {q_lab} = 1 THEN '{q_yes}' ELSE '{q_no}' END) END AS gold
  FROM qsent),
numbered AS (SELECT row_number() OVER (ORDER BY file_id, a, p, q) AS idx, * FROM {name})"""


def cte_pairs(name: str = "pairs") -> str:
    return f"""{name} AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS response,
         row_number() OVER (ORDER BY u.conv_id, u.turn) AS idx
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""


def request_select(cid: str, model: str, system: str, user: str, temperature: float | None) -> str:
    temp = f"CAST({temperature} AS DOUBLE)" if temperature is not None else "CAST(NULL AS DOUBLE)"
    body_temp = f"'temperature': {temp}, " if temperature is not None else ""
    return f"""{cid} AS custom_id, '{model}' AS model, {temp} AS temperature,
       {sql_literal(system)} AS system, {user} AS "user",
       to_json({{'custom_id': {cid}, 'method': '{QA.REQUEST_METHOD}', 'url': '{QA.REQUEST_URL}',
                'body': {{'model': '{model}', {body_temp}'messages': [
                   {{'role': 'system', 'content': {sql_literal(system)}}},
                   {{'role': 'user', 'content': {user}}}]}}}})::VARCHAR AS line"""


_Q = f"WITH {cte_questions()}"

SQL["qa_flatten"] = f"""{_Q}
SELECT file_id, a, p, q, question, n_answers FROM questions"""

SQL["qa_gold"] = f"""{_Q}
SELECT idx, question, gold FROM numbered"""

SQL["qa_answerable"] = f"""{_Q}
SELECT idx, gold FROM numbered WHERE gold IS NOT NULL"""

SQL["qa_limit"] = f"""{_Q}
SELECT idx, file_id, a, p, q, question FROM numbered WHERE idx <= {QA.QUESTION_CAP}"""

_CID = "(CAST(idx AS VARCHAR) || '. ' || question)"

SQL["qa_requests"] = f"""{_Q}
SELECT idx, {request_select(_CID, QA.ANSWER_MODEL, QA.ANSWER_SYSTEM, sql_template(QA.ANSWER_USER, question='question'), QA.TEMPERATURE)}
FROM numbered"""

SQL["qa_requests_raw"] = f"""{_Q}
SELECT idx, {request_select(_CID, QA.ANSWER_MODEL, QA.ANSWER_SYSTEM, sql_template(QA.RAW_USER, question='question'), None)}
FROM numbered"""

SQL["response_usage"] = f"""WITH {cte_pairs()}
SELECT conv_id, turn, question, response,
       CAST(len({tokens_sql('question')}) AS BIGINT) AS input_tokens,
       CAST(len({tokens_sql('response')}) AS BIGINT) AS output_tokens
FROM pairs"""

# First model: responses carry the numbered custom id as their question.
_ANSWER = f"[{', '.join(sql_literal(r) for r in RESPONSES)}][idx % {len(RESPONSES)} + 1]"
_M1 = f"""m1 AS (SELECT idx, CAST(idx AS VARCHAR) || '. ' || question AS question, {_ANSWER} AS response
       FROM numbered WHERE idx % {GAP} <> 0)"""
_M2 = f"""m2 AS (SELECT idx, question, {_ANSWER} AS response FROM numbered)"""

SQL["qa_align_id"] = f"""{_Q}, {_M1}
SELECT n.idx, n.gold, m.question, m.response FROM numbered n JOIN m1 m USING (idx)"""

SQL["qa_align_pos"] = f"""{_Q}, {_M2}
SELECT n.idx, n.gold, m.question, m.response FROM numbered n JOIN m2 m USING (idx)"""


def _grade_sql(models_cte: str, m: str, strict: bool) -> str:
    system = QA.GRADE_SYSTEM_STRICT if strict else QA.GRADE_SYSTEM_LENIENT
    user = sql_template(QA.GRADE_USER, question="m.question", student_response="m.response", correct_answers="n.gold")
    cid = "(CAST(n.idx AS VARCHAR) || '. ' || m.question)"
    return f"""{_Q}, {models_cte}
SELECT n.idx, {request_select(cid, QA.GRADER_MODEL, system, user, QA.TEMPERATURE)}
FROM numbered n JOIN {m} m USING (idx) WHERE n.gold IS NOT NULL"""


SQL["grade_requests"] = _grade_sql(_M1, "m1", True)
SQL["grade_requests_lenient"] = _grade_sql(_M2, "m2", False)

SQL["qa_answer_fn"] = f"""{_Q}
SELECT idx, question, 'echo: ' || question AS response,
       CAST(len({split_ws_sql('question')}) AS BIGINT) AS input_tokens,
       CAST(len({split_ws_sql("'echo: ' || question")}) AS BIGINT) AS output_tokens
FROM numbered"""


# ---------------------------------------------------------------------------
# B. byte-pair encoding (merges unrolled into chained CTEs)
# ---------------------------------------------------------------------------

_W = "[" + WORD_CLASS + "]"
_NW = "[^" + WORD_CLASS + "]"
_PRE_MATCH = _W + "+" + "[^" + WORD_CLASS + SPACE_CLASS + "]?"


def cte_pretokens(src: str = "documents", id_col: str = "doc_id", name: str = "pt") -> str:
    """F2 without look-behind: match word + optional attached punctuation, then split it off."""
    return f"""{name}_m AS (SELECT {id_col} AS doc_id, regexp_extract_all(lower(text), '{_PRE_MATCH}') AS ms FROM {src}),
{name}_0 AS (SELECT doc_id, generate_subscripts(ms, 1) AS mi, unnest(ms) AS m FROM {name}_m),
{name}_1 AS (SELECT doc_id, mi, regexp_extract(m, '^{_W}+') AS w, regexp_extract(m, '{_NW}$') AS pch FROM {name}_0),
{name} AS MATERIALIZED (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY mi, part) - 1 AS INTEGER) AS pos, word
  FROM (SELECT doc_id, mi, 0 AS part, w AS word FROM {name}_1
        UNION ALL SELECT doc_id, mi, 1 AS part, pch AS word FROM {name}_1 WHERE pch <> ''))"""


def wrap_sql(word: str) -> str:
    return f"(chr(9) || array_to_string(list_append(string_split({word}, ''), '</w>'), ' ' || chr(9)) || ' ')"


def unwrap_sql(sym: str) -> str:
    return f"string_split(substr({sym}, 2, length({sym}) - 2), ' ' || chr(9))"


def cte_bpe_types(pt: str = "pt", name: str = "bt0") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT word, count(*) AS freq, arg_min(doc_id, (doc_id, pos)) AS first_doc, arg_min(pos, (doc_id, pos)) AS first_pos,
         {wrap_sql('word')} AS sym
  FROM {pt} GROUP BY word)"""


def cte_pair_stats(types: str, name: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT l, r, CAST(sum(freq) AS BIGINT) AS cnt,
         arg_min(first_doc, (first_doc, first_pos, i)) AS fd,
         arg_min(first_pos, (first_doc, first_pos, i)) AS fp,
         arg_min(i, (first_doc, first_pos, i)) AS fi
  FROM (SELECT freq, first_doc, first_pos, i, s[i] AS l, s[i + 1] AS r
        FROM (SELECT *, unnest(range(1, len(s))) AS i FROM (SELECT *, {unwrap_sql('sym')} AS s FROM {types})))
  GROUP BY l, r)"""


def bpe_merge_ctes(k: int, types0: str = "bt0") -> str:
    """``k`` rounds: pair stats -> best (count desc, first met) -> rewrite the types."""
    out = []
    prev = types0
    for j in range(1, k + 1):
        out.append(cte_pair_stats(prev, f"bp{j}"))
        out.append(f"bb{j} AS MATERIALIZED (SELECT {j} AS rank, l, r, cnt FROM bp{j} ORDER BY cnt DESC, fd, fp, fi LIMIT 1)")
        out.append(
            f"""bt{j} AS MATERIALIZED (
  SELECT word, freq, first_doc, first_pos,
         CASE WHEN b.l IS NULL THEN sym
              ELSE replace(sym, chr(9) || b.l || ' ' || chr(9) || b.r || ' ', chr(9) || b.l || b.r || ' ') END AS sym
  FROM {prev} LEFT JOIN bb{j} b ON true)"""
        )
        prev = f"bt{j}"
    return ",\n".join(out)


def cte_bpe_model(k: int) -> str:
    merges = " UNION ALL ".join(f"SELECT * FROM bb{j}" for j in range(1, k + 1)) or "SELECT 0 AS rank, '' AS l, '' AS r, 0 AS cnt WHERE false"
    return f"""{cte_pretokens()},
{cte_bpe_types()},
{bpe_merge_ctes(k)},
bmerges AS ({merges}),
bvocab AS MATERIALIZED (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id
           FROM (SELECT DISTINCT unnest({unwrap_sql('sym')}) AS token FROM bt{k}))"""


def cte_encode(words: str, name: str = "enc") -> str:
    """B9 as a recursive CTE: leftmost in-vocabulary pair, merged everywhere, until none."""
    return f"""vl AS (SELECT list(token) AS v FROM bvocab),
{name}_r AS (
  WITH RECURSIVE e(word, sym, done) AS (
    SELECT word, {wrap_sql('word')}, false FROM {words}
    UNION ALL
    SELECT word,
           CASE WHEN ci IS NULL THEN sym
                ELSE replace(sym, chr(9) || s[ci] || ' ' || chr(9) || s[ci + 1] || ' ', chr(9) || s[ci] || s[ci + 1] || ' ') END,
           ci IS NULL
    FROM (SELECT word, sym, s, list_filter(range(1, len(s)), lambda i: list_contains(v, s[i] || s[i + 1]))[1] AS ci
          FROM (SELECT e.word, e.sym, {unwrap_sql('e.sym')} AS s, vl.v FROM e, vl WHERE NOT e.done)))
  SELECT word, sym FROM e WHERE done),
{name} AS (
  SELECT word, CASE WHEN len(s) > 0 AND s[len(s)] = '</w>' THEN s[1 : len(s) - 1] ELSE s END AS tokens
  FROM (SELECT word, {unwrap_sql('sym')} AS s FROM {name}_r))"""


K = C.K_MERGES
_BPE = f"WITH {cte_bpe_model(K)}"

SQL["bpe_pretokens"] = f"""WITH {cte_pretokens()}
SELECT doc_id, pos, word AS token FROM pt"""

SQL["bpe_word_freqs"] = f"""WITH {cte_pretokens()}, {cte_bpe_types()}
SELECT word, freq, first_doc, first_pos FROM bt0"""

SQL["bpe_symbols"] = f"""WITH {cte_pretokens()}, {cte_bpe_types()}
SELECT word, array_to_string(list_append(string_split(word, ''), '</w>'), ' ') AS symbols FROM bt0"""

SQL["bpe_pair_stats"] = f"""WITH {cte_pretokens()}, {cte_bpe_types()}, {cte_pair_stats('bt0', 'bp1')}
SELECT l, r, cnt, fd AS first_doc, fp AS first_pos, CAST(fi - 1 AS INTEGER) AS first_i FROM bp1"""

SQL["bpe_best_pair"] = f"""WITH {cte_pretokens()}, {cte_bpe_types()}, {cte_pair_stats('bt0', 'bp1')}
SELECT l, r, cnt FROM bp1 ORDER BY cnt DESC, fd, fp, fi LIMIT 1"""

SQL["bpe_merge_once"] = f"""WITH {cte_pretokens()}, {cte_bpe_types()}, {bpe_merge_ctes(1)}
SELECT word, array_to_string({unwrap_sql('sym')}, ' ') AS symbols FROM bt1"""

SQL["bpe_train"] = f"""{_BPE}
SELECT CAST(rank AS INTEGER) AS rank, l, r, cnt FROM bmerges"""

SQL["bpe_vocab"] = f"""{_BPE}
SELECT token, id FROM bvocab"""

SQL["bpe_roundtrip"] = SQL["bpe_vocab"]

_ENC_DOCS = f"""{_BPE}, ew AS (SELECT DISTINCT word FROM pt), {cte_encode('ew')}"""

SQL["bpe_encode"] = f"""{_ENC_DOCS}
SELECT word, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS INTEGER) AS n_tokens FROM enc"""

SQL["bpe_ids"] = f"""{_ENC_DOCS}
SELECT t.token, COALESCE(v.id, -1) AS id
FROM (SELECT DISTINCT unnest(tokens) AS token FROM enc) t LEFT JOIN bvocab v USING (token)"""

_TOK = f"""{_ENC_DOCS},
toks AS (
  SELECT q.doc_id, q.pos, CAST(generate_subscripts(e.tokens, 1) - 1 AS INTEGER) AS tpos, unnest(e.tokens) AS token
  FROM pt q JOIN enc e USING (word)),
tid AS (SELECT t.*, COALESCE(v.id, -1) AS id FROM toks t LEFT JOIN bvocab v USING (token))"""

SQL["bpe_tokenize"] = f"""{_TOK}
SELECT doc_id, pos, tpos, token, id FROM tid"""

SQL["bpe_decode"] = f"""{_TOK}
SELECT t.doc_id, t.pos, t.tpos, t.id, v.token FROM tid t JOIN bvocab v ON v.id = t.id"""


# ---------------------------------------------------------------------------
# Sources / sinks and streaming
# ---------------------------------------------------------------------------

SQL["qa_file_roundtrip"] = f"""{_Q}
SELECT question, n_answers FROM questions"""

SQL["score_from_files"] = f"""{_SCORED}
SELECT outcome, count(*) AS n FROM scored GROUP BY outcome"""

SQL["requests_sink"] = f"""{_Q}
SELECT {_CID} AS custom_id, '{QA.REQUEST_METHOD}' AS method, '{QA.REQUEST_URL}' AS url,
       '{QA.ANSWER_MODEL}' AS model, CAST({QA.TEMPERATURE} AS DOUBLE) AS temperature
FROM numbered"""

SQL["response_rows_roundtrip"] = SQL["qa_align_pos"]

SQL["ngram_stream_counts"] = SQL["ngram_counts"]

SQL["ngram_stream_store"] = SQL["ngram_counts"]

SQL["ngram_store"] = SQL["ngram_incremental"]

SQL["response_array_rows"] = f"""SELECT question, response, input_tokens, output_tokens FROM ({SQL['response_usage']})"""

SQL["qa_multiline_files"] = f"""{_Q}
SELECT a, p, q, question, n_answers FROM questions"""

SQL["corpus_files"] = f"""WITH {model_ctes(C.N_COUNTS)}
SELECT context, word, cnt FROM cnts"""

_LAGS = " || ' ' || ".join(f"lag(word, {k}) OVER o" for k in range(C.N_COUNTS, 0, -1))
SQL["corpus_large_files"] = f"""WITH {cte_tokens()},
w AS (SELECT doc_id // {C.VOLUME} AS volume, doc_id, unnest(t) AS word, unnest(range(len(t))) AS p FROM tok),
ev AS (SELECT {_LAGS} AS context, word FROM w WINDOW o AS (PARTITION BY volume ORDER BY doc_id, p))
SELECT context, word, count(*) AS cnt FROM ev WHERE context IS NOT NULL GROUP BY context, word"""
