import json

from pyspark.sql import functions as F

from wordloom.functions.jsonx import repair_escapes, strip_fences
from wordloom.operators import scoring as sc

FENCE = "```"


def _line(content):
    return json.dumps({"custom_id": "x", "response": {"body": {"choices": [{"message": {"content": content}}]}}})


def _outcomes(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, line string")
    return [r["outcome"] for r in sc.score_lines(df).orderBy("i").collect()]


# FIXTURES §6: fences
def test_fences(spark):
    cases = [
        (FENCE + 'json\n{"score": true}\n' + FENCE, "correct"),
        (FENCE + '\n{"score": true}\n' + FENCE, "correct"),
        (FENCE + '\n{"score": true}\n' + FENCE + "\n", "bad_json"),
        (FENCE + 'json\n{"score": true}\n' + FENCE + "\n", "correct"),
        (" " + FENCE + 'json\n{"score": true}\n' + FENCE, "bad_json"),
        ("   \n\t", "empty"),
    ]
    assert _outcomes(spark, [_line(c) for c, _ in cases]) == [o for _, o in cases]


def test_escape_repair(spark):
    cases = [
        ("a \\x b", "a \\\\x b"),
        ("a \\\\x b", "a \\\\\\x b"),
        ("\\u00e9", "\\\\u00e9"),
        ('ok \\n \\"', 'ok \\n \\"'),
        ("end\\", "end\\\\"),
    ]
    df = spark.createDataFrame([(a,) for a, _ in cases], "s string")
    got = [r["o"] for r in df.select(repair_escapes(F.col("s")).alias("o")).collect()]
    assert got == [b for _, b in cases]


def test_verdicts(spark):
    correct = ['{"score": true}', '{"score": false, "score": true}', '{"x":NaN,"score":true}', '  {"score": true}  ']
    counted = ['{"score": false}', '{"score": "true"}', '{"score": 1}', '{"score": null}', "{}", '{"Score": true}',
               '{"a":{"score":true}}', '{"score":[true]}', '{"score": true, "score": false}']
    bad = ['{"score": true', '{"score": true} xx', "{'score': true}", '{"score": True}', "{score:true}",
           '{"score":true,}', '{"x":[1,],"score":true}', '{"x":01,"score":true}', '{"a": "x\ny", "score": true}',
           '﻿{"score": true}', '{"score": true}, {"score": true}', '[{"score":true}]', "true", "3", '"s"', "null"]
    out = _outcomes(spark, [_line(c) for c in correct + counted + bad])
    assert out == ["correct"] * len(correct) + ["incorrect"] * len(counted) + ["bad_json"] * len(bad)


def test_lines(spark):
    lines = ["not json", "", json.dumps({"x": 1}), json.dumps({"response": {"body": {"choices": []}}}),
             json.dumps({"response": None}), _line(None), "[1]"]
    assert _outcomes(spark, lines) == ["bad_line", "bad_line", "no_content", "no_content", "no_content", "no_content", "bad_line"]


def test_accuracy(spark):
    lines = [_line('{"score": true}'), _line('{"score": true}'), _line('{"score": false}'), "junk"]
    df = spark.createDataFrame([(l,) for l in lines], "line string")
    row = sc.accuracy(sc.score_lines(df)).first()
    assert (row["correct"], row["answered"], row["percent"]) == (2, 3, "66.67%")
    none = spark.createDataFrame([("junk",)], "line string")
    row = sc.accuracy(sc.score_lines(none)).first()
    assert row["accuracy"] is None and row["percent"] is None


def test_strip_fences_order(spark):
    df = spark.createDataFrame([(FENCE + "json\n{}\n" + FENCE + "\n",)], "s string")
    assert df.select(strip_fences(F.col("s")).alias("o")).first()["o"] == "{}"


def test_strict_value_and_string_content(spark):
    """Trailing junk after a closing bracket, non-Python numbers and content that is no string are not scored."""
    from wordloom.operators import scoring as sc

    def line(content):
        return '{"response": {"body": {"choices": [{"message": {"content": ' + content + "}}]}}}"

    cases = {
        line('"{\\"score\\": true}"'): "correct",
        line('"{\\"score\\": true}]"'): "bad_json",
        line('"{\\"score\\": true}] junk"'): "bad_json",
        line('"{\\"score\\": true}][1]"'): "bad_json",
        line('"{\\"score\\": true, \\"x\\": +INF}"'): "bad_json",
        line('"{\\"score\\": true, \\"x\\": NaN}"'): "correct",
        line('"{\\"score\\": true, \\"x\\": \\"+INF\\"}"'): "correct",
        line('{"score": true}'): "no_content",
        line('"{\\"score\\": true}"') + "]": "bad_line",
        line('"{\\"score\\": true}"') + "] junk": "bad_line",
    }
    rows = spark.createDataFrame([(x,) for x in cases], "line string")
    assert {r["line"]: r["outcome"] for r in sc.score_lines(rows).collect()} == cases


def test_percent_text_rounds_the_binary_value(spark):
    from wordloom.operators import scoring as sc

    for right, n in ((1, 4000), (3, 4000), (1, 8), (2, 3)):
        rows = spark.range(n).selectExpr(f"if(id < {right}, 'correct', 'incorrect') as outcome")
        assert sc.accuracy(rows).first()["percent"] == f"{right / n * 100:.2f}%"
