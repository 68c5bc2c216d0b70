import random

import pytest
from pyspark.sql import functions as F

from toolgauge.functions import json_text as J
from toolgauge.functions.text import WHITESPACE, strip, unfence_anchored, unfence_anywhere
from toolgauge.operators import scoring

ONE = '{"name": "reserve", "arguments": {"venue": "Luna"}}'
TWO = '{"name": "reserve", "arguments": {"venue": "Luna", "seats": "7"}}'
BARE = '{"name": "reserve"}'

# (expected call, prediction, error type; '' is correct)
CASES = [
    (TWO, TWO, ""),
    (TWO, ONE, "missing_param"),
    (BARE, '{"name": "reserve", "arg', "malformed_json"),
    (TWO, TWO.replace("reserve", "cancel"), "wrong_tool"),
    # fences
    (ONE, f"Sure!\n```json\n{ONE}\n```\nDone.", ""),
    (ONE, f"```\n{ONE}\n```", ""),
    (ONE, f"```json\n{ONE}", ""),
    (ONE, f"``` nothing ```\n```json\n{ONE}\n```", ""),
    (ONE, f"```python\n{ONE}\n```", "malformed_json"),
    (ONE, '{"name": "reserve", "arguments": {"venue": "```x```"}}', "malformed_json"),
    # strictness
    (ONE, "", "malformed_json"),
    (ONE, None, "malformed_json"),
    (ONE, ONE + " as asked", "malformed_json"),
    (ONE, ONE + ONE, "malformed_json"),
    (ONE, ONE + "," + ONE, "malformed_json"),
    (ONE, ONE + "]", "malformed_json"),
    (ONE, ONE + "}", "malformed_json"),
    (ONE, ONE.replace('"', "'"), "malformed_json"),
    (ONE, ONE.replace("Luna", "Lu\nna"), "malformed_json"),
    (ONE, "﻿" + ONE, "malformed_json"),
    (ONE, "\xa0" + ONE, "malformed_json"),
    (ONE, " \n" + ONE + "\t", ""),
    # names
    (ONE, '{"arguments": {"venue": "Luna"}}', "wrong_tool"),
    (ONE, ONE.replace("reserve", "Reserve"), "wrong_tool"),
    (ONE, '{"name": null, "arguments": {"venue": "Luna"}}', "wrong_tool"),
    ('{"name": "5"}', '{"name": 5}', "wrong_tool"),
    ('{"name": "5"}', '{"name": "5"}', ""),
    (ONE, '{"name": "x", ' + ONE[1:], ""),  # the last of two equal keys counts
    # roots that are no object
    (ONE, "[]", "wrong_tool"),
    (ONE, f"[{ONE}]", "wrong_tool"),
    (ONE, '"name"', "wrong_tool"),
    (ONE, "7", "wrong_tool"),
    (ONE, "null", "wrong_tool"),
    # values
    (ONE, ONE.replace("Luna", "LUNA"), ""),
    (ONE, ONE.replace("Luna", " Luna"), "wrong_param_value"),
    (TWO, TWO.replace('"7"', "7"), ""),
    (TWO, TWO.replace('"7"', "7.0"), "wrong_param_value"),
    ('{"name": "a", "arguments": {"x": true}}', '{"name": "a", "arguments": {"x": "True"}}', ""),
    ('{"name": "a", "arguments": {"x": null}}', '{"name": "a", "arguments": {"x": "None"}}', ""),
    ('{"name": "a", "arguments": {"x": null}}', '{"name": "a", "arguments": {}}', "missing_param"),
    ('{"name": "a", "arguments": {"x": 1.50}}', '{"name": "a", "arguments": {"x": "1.5"}}', ""),
    ('{"name": "a", "arguments": {"x": 1e3}}', '{"name": "a", "arguments": {"x": "1000.0"}}', ""),
    ('{"name": "a", "arguments": {"x": 12345678.5}}', '{"name": "a", "arguments": {"x": "12345678.5"}}', ""),
    ('{"name": "a", "arguments": {"x": [1, {"b": 2}]}}', '{"name": "a", "arguments": {"x": [1,{"b":2}]}}', ""),
    ('{"name": "a", "arguments": {"x": [1, 2]}}', '{"name": "a", "arguments": {"x": "[1,2]"}}', ""),
    ('{"name": "a", "arguments": {"x": [1, 2]}}', '{"name": "a", "arguments": {"x": "[1, 2]"}}', "wrong_param_value"),
    # words that only the reader takes for numbers
    *[('{"name": "a", "arguments": {"x": 1}}', '{"name": "a", "arguments": {"x": %s}}' % w, "malformed_json") for w in ("+Infinity", "-INF", "INF", "+INF")],
    *[('{"name": "a", "arguments": {"x": %s}}' % w, '{"name": "a", "arguments": {"x": %s}}' % w, "") for w in ("-Infinity", "NaN", '"INF \\" +Infinity"')],
    # the earliest expected argument decides
    (TWO, '{"name": "reserve", "arguments": {"venue": "Vega"}}', "wrong_param_value"),
    (TWO, '{"name": "reserve", "arguments": {"seats": "4"}}', "missing_param"),
    # more than expected
    (ONE, '{"name": "reserve", "arguments": {"venue": "Luna", "unit": "C"}}', "hallucinated_param"),
    (BARE, ONE, "hallucinated_param"),
    # equal keys: first position, last value
    (ONE, '{"name": "reserve", "arguments": {"venue": "Vega", "venue": "Luna"}}', ""),
    ('{"name": "a", "arguments": {"x": 1, "y": 2, "x": 3}}', '{"name": "a", "arguments": {"y": 2, "x": 3}}', ""),
    ('{"name": "a", "arguments": {"x": 1, "y": 2, "x": 3}}', '{"name": "a", "arguments": {"y": 9, "x": 1}}', "wrong_param_value"),
    # arguments that are absent, null or no object
    (BARE, BARE, ""),
    (BARE, '{"name": "reserve", "arguments": null}', ""),
    ('{"name": "reserve", "arguments": null}', BARE, ""),
    (ONE, BARE, "missing_param"),
    (ONE, '{"name": "reserve", "arguments": [1]}', "missing_param"),
    (ONE, '{"name": "reserve", "arguments": "{\\"venue\\": \\"Luna\\"}"}', "missing_param"),
    (BARE, '{"name": "reserve", "arguments": [1]}', "hallucinated_param"),
]


def test_every_rule(spark):
    rows = [(i, e, p) for i, (e, p, _) in enumerate(CASES)]
    pairs = spark.createDataFrame(rows, "ord int, expected_tool_call string, predicted string")
    got = {r.ord: (r.is_correct, r.error_type) for r in scoring.score_calls(pairs).collect()}
    for i, (expected, predicted, error) in enumerate(CASES):
        assert got[i] == (error == "", error), (expected, predicted)


def test_no_limit_but_memory(spark):
    values = ["1" * 1500, f'"{"s" * 21_000_000}"', "[" * 1200 + "]" * 1200]
    rows = [(i, '{"name": "a", "arguments": {"x": %s}}' % v) for i, v in enumerate(values)]
    pairs = spark.createDataFrame(rows, "ord int, expected_tool_call string").withColumn("predicted", F.col("expected_tool_call"))
    assert sorted((r.ord, r.error_type) for r in scoring.score_calls(pairs).select("ord", "error_type").collect()) == [(0, ""), (1, ""), (2, "")]


def test_evaluations_do_not_share_predictions(spark):
    examples = spark.createDataFrame([(it, 0, BARE) for it in (1, 2)], "iteration int, ord long, expected_tool_call string")
    predictions = spark.createDataFrame([(1, 0, BARE)], "iteration int, ord long, predicted string")
    scored = scoring.score_calls(scoring.with_predictions(examples, predictions, ["iteration"])).collect()
    assert {r.iteration: r.error_type for r in scored} == {1: "", 2: "malformed_json"}


def test_expectations_with_foreign_numbers_are_rejects(spark):
    """+Infinity and INF are numbers to the reader, but no JSON."""
    calls = [TWO.replace('"7"', number) for number in ("+Infinity", "-INF", "NaN", "7")]
    rows = [(i, str(i), call, call) for i, call in enumerate(calls)]
    frame = spark.createDataFrame(rows, "ord int, id string, expected_tool_call string, predicted string")
    assert sorted(r["ord"] for r in scoring.score_calls(frame).collect()) == [2, 3]
    assert sorted(r["ord"] for r in scoring.example_rejects(frame).collect()) == [0, 1]


def test_grid_of_evaluations(spark):
    """Each example once per evaluation of its run; what is absent there counts as malformed there."""
    examples = spark.createDataFrame([(i, i % 2, 9, ONE) for i in range(4)], "ord int, run_id int, iteration int, expected_tool_call string")
    evaluations = spark.createDataFrame([(0, 1), (0, 2), (1, 1)], "run_id int, iteration int")
    predictions = spark.createDataFrame([(0, 0, 1, ONE), (2, 0, 2, ONE), (1, 1, 1, ONE)], "ord int, run_id int, iteration int, predicted string")
    grid = scoring.evaluation_grid(examples, evaluations, ["run_id"], "iteration")
    scored = scoring.score_calls(scoring.with_predictions(grid, predictions, ["run_id", "iteration"]))
    assert sorted((r["run_id"], r["iteration"], r["ord"], r["error_type"]) for r in scored.collect()) == [
        (0, 1, 0, ""), (0, 1, 2, "malformed_json"), (0, 2, 0, "malformed_json"), (0, 2, 2, ""),
        (1, 1, 1, ""), (1, 1, 3, "malformed_json"),
    ]


def test_negatives_and_rejects_are_not_scored(spark):
    rows = [(0, None), (1, "null"), (2, '{"arguments": {}}'), (3, "[1]"), (4, "{broken"), (5, BARE)]
    examples = spark.createDataFrame(rows, "ord long, expected_tool_call string")
    lanes = {r.ord: r.lane for r in scoring.expected_lanes(examples).collect()}
    assert lanes == {0: "negative", 1: "negative", 2: "reject", 3: "reject", 4: "reject", 5: "scored"}
    assert sorted(r.ord for r in scoring.negatives(examples).collect()) == [0, 1]
    pairs = examples.withColumn("predicted", F.lit(BARE))
    assert [r.ord for r in scoring.score_calls(pairs).collect()] == [5]


def test_missing_prediction_counts_as_malformed(spark):
    examples = spark.createDataFrame(
        [(0, "unknown", "q", BARE), (1, "unknown", "q", BARE)],
        "ord long, id string, user_query string, expected_tool_call string",
    )
    predictions = spark.createDataFrame([(1, BARE)], "ord long, predicted string")
    scored = scoring.score_calls(scoring.with_predictions(examples, predictions))
    assert {r.ord: r.error_type for r in scored.collect()} == {0: "malformed_json", 1: ""}
    failed = scoring.failures(scored).collect()
    assert [(r.ord, r.id, r.predicted) for r in failed] == [(0, "unknown", None)]


def test_numbers_print_like_python(spark):
    rng = random.Random(3)
    values = [rng.choice([1, -1]) * rng.random() * 10.0**p for p in range(-12, 25) for _ in range(4)]
    values += [9.45883729103682e16, 2.0e-3, 1.1e23, 2.2250738585072014e-308, 1.7976931348623157e308, 0.0, 1e16, 1e15, 0.0001, 0.00001, 123456789.0, 5e-324]
    rows = [(i, '{"name": "a", "arguments": {"x": %r}}' % v, '{"name": "a", "arguments": {"x": "%r"}}' % v) for i, v in enumerate(values)]
    pairs = spark.createDataFrame(rows, "ord int, expected_tool_call string, predicted string")
    wrong = [values[r.ord] for r in scoring.score_calls(pairs).collect() if not r.is_correct]
    assert not wrong


@pytest.mark.parametrize(
    "text, anchored, anywhere",
    [
        ("```json\n[1]\n```", "\n[1]\n", "[1]"),
        (" ```json[1]```", " ```json[1]", "[1]"),
        ("```json[1]```\n", "[1]```\n", "[1]"),
        ("[1]", "[1]", "[1]"),
        (" [1] ", " [1] ", " [1] "),
        ("a```b```c", "a```b```c", "b"),
        ("```", "", ""),
    ],
)
def test_fences(spark, text, anchored, anywhere):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(unfence_anchored(F.col("t")).alias("a"), unfence_anywhere(F.col("t")).alias("b")).first()
    assert (row.a, row.b) == (anchored, anywhere)


def test_strip_and_spacing(spark):
    texts = [WHITESPACE + "a b" + WHITESPACE, "x", WHITESPACE]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.s for r in df.select(strip(F.col("t")).alias("s")).collect()] == [t.strip() for t in texts]
    import json

    values = [{"a": 1, "b": [1, 2, {"c": 'q"x, y: z\\'}]}, {}, [], {"t": "a\nb\\\"c"}, "a,b:c"]
    for seps in [(",", ":"), (" , ", " : ")]:
        df = spark.createDataFrame([(json.dumps(v, separators=seps),) for v in values], "t string")
        got = [r.s for r in df.select(J.python_spacing(F.col("t")).alias("s")).collect()]
        assert got == [json.dumps(v) for v in values]


def test_parses_run_once_per_row(spark):
    examples = spark.createDataFrame([(0, "i", "q", BARE, BARE)], "ord long, id string, user_query string, expected_tool_call string, predicted string")
    plan = scoring.failures(scoring.score_calls(examples))._jdf.queryExecution().optimizedPlan().toString()
    # One strict parse of each side; the rare branches add the three others.
    assert plan.count("from_json") <= 8, plan
