import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wordloom.operators import qa
from wordloom.sources import files as fs

# FIXTURES §5
QA_DOC = {
    "data": [
        {"paragraphs": [
            {"qas": [
                {"question": "Q1?", "answers": [{"text": "X"}, {"text": "Y"}]},
                {"question": "Q2?", "answers": []},
            ]},
            {"qas": []},
        ]},
        {"paragraphs": [{"qas": [{"question": "Qé3?", "answers": [{"text": "Zé"}]}]}]},
    ]
}


def _files(spark, tmp_path):
    p = tmp_path / "qa"
    p.mkdir()
    (p / "dev.json").write_text(json.dumps(QA_DOC, indent=2, ensure_ascii=False), encoding="utf-8")
    return fs.read_qa(spark, str(p))


def test_flatten_gold_and_gaps(spark, tmp_path):
    qs = qa.flatten_qa(_files(spark, tmp_path))
    gold = {r["idx"]: (r["question"], r["gold"]) for r in qa.gold_table(qs).collect()}
    assert gold == {1: ("Q1?", "x"), 2: ("Q2?", None), 3: ("Qé3?", "zé")}
    assert [r["idx"] for r in qa.answerable(qa.gold_table(qs)).orderBy("idx").collect()] == [1, 3]
    assert [r["idx"] for r in qa.number_questions(qs, 2).orderBy("idx").collect()] == [1, 2]


def test_request_ids_and_double_numbering(spark, tmp_path):
    qs = qa.flatten_qa(_files(spark, tmp_path))
    numbered = qa.number_questions(qs)
    reqs = {r["idx"]: r for r in qa.answer_requests(numbered).collect()}
    assert reqs[1]["custom_id"] == "1. Q1?"
    body = json.loads(reqs[1]["line"])
    assert body["body"]["temperature"] == 0.2 and body["body"]["messages"][1]["content"].endswith(": Q1?")
    raw = json.loads(qa.raw_answer_requests(numbered).where("idx = 1").first()["line"])
    assert "temperature" not in raw["body"] and raw["body"]["messages"][1]["content"] == "Q1?"
    # first model: batch results carry the numbered id as question
    lines = spark.createDataFrame(
        [(json.dumps({"custom_id": f"{i}. {q}", "response": {"body": {"choices": [{"message": {"content": f"A{i}"}}]}}}),)
         for i, q in [(3, "Qé3?"), (1, "Q1?"), (2, "Q2?")]], "line string")
    res = qa.batch_responses(lines).select("idx", F.col("custom_id").alias("question"), "response")
    grade = {r["idx"]: r["custom_id"] for r in qa.grade_requests(qa.align_by_id(qa.gold_table(qs), res)).collect()}
    assert grade == {1: "1. 1. Q1?", 3: "3. 3. Qé3?"}


def test_positional_alignment_truncates(spark, tmp_path):
    qs = qa.flatten_qa(_files(spark, tmp_path))
    rows = spark.createDataFrame([(0, "Q1?", "r1"), (1, "Q2?", "r2")], "pos long, question string, response string")
    out = qa.align_by_position(qa.gold_table(qs), rows, ["pos"])
    assert sorted(r["idx"] for r in out.collect()) == [1, 2]
    graded = {r["idx"]: r["custom_id"] for r in qa.grade_requests(out, strict=False).collect()}
    assert graded == {1: "1. Q1?"}


def test_template_is_single_pass(spark):
    df = spark.createDataFrame([("what is {question} or {correct_answers}?",)], "q string")
    out = df.select(qa.fill_template(qa.GRADE_USER, question=F.col("q"), student_response=F.lit("s"),
                                     correct_answers=F.lit("c")).alias("u")).first()["u"]
    expected = qa.GRADE_USER.format(question="what is {question} or {correct_answers}?", student_response="s",
                                    correct_answers="c")
    assert out == expected


def test_answer_function_and_response_files(spark, tmp_path):
    qs = spark.createDataFrame([(1, "a b c"), (2, "d")], "idx long, question string")

    def fn(questions):
        return pd.DataFrame({"response": questions.str.upper(), "input_tokens": questions.str.len(),
                             "output_tokens": 1})

    out = {r["idx"]: (r["response"], r["input_tokens"]) for r in qa.answer_with(qs, fn).collect()}
    assert out == {1: ("A B C", 5), 2: ("D", 1)}
    path = str(tmp_path / "resp")
    many = spark.range(12).selectExpr("id as idx", "concat('q', id) as question").repartition(3)
    fs.append_response_rows(qa.answer_with(qs, fn), path, ["idx"], 0)
    fs.append_response_rows(qa.answer_with(many, fn), path, ["idx"], 1)
    back = fs.read_response_rows(spark, path).orderBy(*fs.RESPONSE_ORDER).collect()
    assert [r["question"] for r in back] == ["a b c", "d", *(f"q{i}" for i in range(12))]
    with pytest.raises(Exception, match="1 rows for"):
        qa.answer_with(qs.coalesce(1), lambda q: fn(q).head(1)).collect()


def test_json_array_response_file(spark, tmp_path):
    p = tmp_path / "arr.json"
    rows = [{"question": f"q{i}", "response": f"r{i}", "input_tokens": i, "output_tokens": 1} for i in range(5)]
    p.write_text(json.dumps(rows), encoding="utf-8")
    got = fs.read_response_rows(spark, str(p), json_array=True).orderBy("file", "block", "row").collect()
    assert [r["question"] for r in got] == [f"q{i}" for i in range(5)]
