import json

import pytest
from pyspark.sql import functions as F

from toolgauge.operators import catalog, metrics, prompts, responses, split
from toolgauge.operators.ranking import dense_positions
from toolgauge.sources import jsonl


def specs(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "tool_ord int, spec string")


TOOL = json.dumps(
    {
        "name": "reserve",
        "description": "Hold seats at a venue",
        "parameters": {
            "venue": {"type": "string", "description": "Where to go", "required": True},
            "seats": {"type": "integer", "description": "Party size", "required": False},
        },
    }
)


def test_catalog_normalises(spark):
    rows = catalog.tool_catalog(
        specs(spark, TOOL, '{"name": "b", "parameters": {"z": "string", "a": {"type": "t", "description": "d"}}}', '{"name": "c", "parameters": {}}')
    ).orderBy("tool_ord").collect()
    assert [(r.name, r.description) for r in rows] == [("reserve", "Hold seats at a venue"), ("b", ""), ("c", "")]
    assert [tuple(p) for p in rows[0].parameters] == [("venue", "string", "Where to go", True), ("seats", "integer", "Party size", False)]
    assert [tuple(p) for p in rows[1].parameters] == [("z", "string", "", True), ("a", "t", "d", True)]
    assert rows[2].parameters == []


@pytest.mark.parametrize(
    "spec",
    [
        '{"description": "no name"}',
        '{"name": "a", "parameters": {"x": {"type": "t"}}}',
        '{"name": "a", "parameters": {"x": {"description": "t"}}}',
        '{"name": "a", "parameters": {"x": null}}',
        '{"name": "a", "parameters": null}',
        '{"name": "a", "description": null}',
        '{"name": "a"} and more',
        '{"name": "a", "parameters": {"x": ["string"]}}',
    ],
)
def test_catalog_refuses(spark, spec):
    with pytest.raises(Exception, match="name|lacks|null|no object|list"):
        catalog.tool_catalog(specs(spark, spec)).collect()


def test_required_as_text(spark):
    """Truth values in words count; numbers and truth values are no types."""
    given = {w: {"type": "t", "description": "d", "required": w} for w in ("false", "No", "off", "0", "true", "YES", "1")}
    spec = json.dumps({"name": "a", "parameters": given})
    (row,) = catalog.tool_catalog(specs(spark, spec)).collect()
    assert [p["required"] for p in row.parameters] == [False] * 4 + [True] * 3
    for value in (5, True, 1.5):
        with pytest.raises(Exception, match="number or truth value"):
            catalog.tool_catalog(specs(spark, json.dumps({"name": "a", "parameters": {"x": value}}))).collect()
    with pytest.raises(Exception, match="unclear `required`"):
        catalog.tool_catalog(specs(spark, spec.replace('"YES"', '"perhaps"'))).collect()


def test_calls_held_in_strings(spark):
    """A call given as a string stays a string, the text null included."""
    answers = [
        '[{"user_query": "q", "expected_tool_call": "{\\"name\\": \\"a\\"}"}, {"user_query": "q", "expected_tool_call": {"name": "a"}}]',
        '[{"user_query": "q", "expected_tool_call": "null"}, {"user_query": "q", "expected_tool_call": null}]',
    ]
    frame = spark.createDataFrame([(str(i), a) for i, a in enumerate(answers)], "prompt_id string, raw string")
    rows = sorted(responses.ingest_responses(frame).collect(), key=lambda r: (r.prompt_id, r.pos))
    assert [r.expected_tool_call for r in rows] == ['"{\\"name\\": \\"a\\"}"', '{"name":"a"}', '"null"', None]


def test_schema(spark):
    tools = catalog.tool_catalog(specs(spark, TOOL, '{"name": "b"}'))
    listed = lambda t: spark.range(1).select(catalog.schema_list(t).alias("s")).first().s
    schemas = json.loads(listed(tools))
    assert schemas[0] == {
        "type": "function",
        "function": {
            "name": "reserve",
            "description": "Hold seats at a venue",
            "parameters": {
                "type": "object",
                "properties": {
                    "venue": {"type": "string", "description": "Where to go"},
                    "seats": {"type": "integer", "description": "Party size"},
                },
                "required": ["venue"],
            },
        },
    }
    assert list(schemas[0]["function"]["parameters"]["properties"]) == ["venue", "seats"]
    assert schemas[1]["function"]["parameters"] == {"type": "object", "properties": {}, "required": []}
    assert listed(tools.limit(0)) == "[]"


def test_datagen_prompt(spark):
    prompt = prompts.datagen_prompts(catalog.tool_catalog(specs(spark, TOOL)), 40).first().prompt
    for part in ("reserve", "Hold seats at a venue", "  venue (string, required) Where to go\n", "  seats (integer, optional) Party size\n", "40"):
        assert part in prompt


CALL = {"name": "t", "arguments": {"b": 1, "a": "x"}}
GOOD = json.dumps([{"user_query": "q0", "expected_tool_call": CALL}, {"user_query": "q1", "expected_tool_call": None}])
THIRD_BAD = json.dumps([{"user_query": "q0", "expected_tool_call": CALL}, {"user_query": "q1", "expected_tool_call": None}, {"user_query": "q2"}, {"user_query": "q3", "expected_tool_call": CALL}])

# raw answer, base outcome (count or reason), number of patch rows
ANSWERS = [
    (GOOD, 2, 2),
    ("```json\n" + GOOD + "\n```", 2, 2),
    ("```json\n" + GOOD + "\n```\n", "invalid_json", 2),
    ("  " + GOOD + "  ", 2, 2),
    ("Here: ```json " + GOOD + "``` bye", "invalid_json", 2),
    (GOOD[:-2], "invalid_json", 0),
    (THIRD_BAD, "bad_item", 2),
    (GOOD[:-1] + ', "text"]', "bad_item", 2),
    ('["text", ' + GOOD[1:], "bad_item", 0),
    (GOOD[:-1] + ', "{\\"user_query\\": 1, \\"expected_tool_call\\": 2}"]', "bad_item", 2),
    (GOOD + GOOD, "invalid_json", 0),
    ('{"user_query": "q", "expected_tool_call": null}', "bad_item", 0),
    ("3", "bad_item", 0),
    ("[]", 0, 0),
    ("", "invalid_json", 0),
]


def test_last_of_repeated_keys_and_runs(spark):
    raw = '[{"user_query": "old", "expected_tool_call": null, "user_query": "new"}]'
    df = spark.createDataFrame([(r, "p", 1, 0, raw) for r in (4, 5)], "run_id int, prompt_id string, iteration int, cluster_id int, raw string")
    rows = responses.patch_rows(df).collect()
    assert {r.user_query for r in rows} == {"new"} and sorted(r.id for r in rows) == [f"run{r}_train_iter1_0_0" for r in (4, 5)]


def test_responses(spark):
    rows = [(str(i), i, 1, -1, raw) for i, (raw, _, _) in enumerate(ANSWERS)]
    df = spark.createDataFrame(rows, "prompt_id string, n int, iteration int, cluster_id int, raw string")
    good = responses.ingest_responses(df).collect()
    bad = {r.n: r for r in responses.response_rejects(df).collect()}
    patched = responses.patch_rows(df).collect()
    for i, (raw, base, patch) in enumerate(ANSWERS):
        mine = sorted((r for r in good if r.n == i), key=lambda r: r.pos)
        if isinstance(base, str):
            assert not mine and bad[i].reason == base, raw
        else:
            assert len(mine) == base and i not in bad, raw
        mine = sorted((r for r in patched if r.n == i), key=lambda r: r.pos)
        assert [r.id for r in mine] == [f"train_iter1_-1_{k}" for k in range(patch)], raw
        for r in mine[:1]:
            assert r.user_query == "q0" and [tuple(m) for m in r.messages] == [("user", "q0")]
            assert r.expected_tool_call == json.dumps(CALL, separators=(",", ":"))
        for r in mine[1:2]:
            assert r.expected_tool_call is None
    assert bad[5].head == GOOD[:-2][:200]


@pytest.mark.parametrize("n, cut", [(10, 8), (1, 0), (0, 0), (7, 5), (101, 80)])
def test_split_is_exact(spark, n, cut):
    df = spark.range(n).withColumnRenamed("id", "ord").repartition(3)
    first = {r.ord: (r.split, r.id) for r in split.split_examples(df, "ord", seed=1).collect()}
    assert sorted(i for s, i in first.values() if s == "train") == sorted(f"train_{k}" for k in range(cut))
    assert sorted(i for s, i in first.values() if s == "eval") == sorted(f"eval_{k}" for k in range(n - cut))
    again = {r.ord: (r.split, r.id) for r in split.split_examples(df.repartition(7), "ord", seed=1).collect()}
    assert first == again
    if n > 50:
        other = {r.ord: (r.split, r.id) for r in split.split_examples(df, "ord", seed=2).collect()}
        assert first != other


def test_dense_positions(spark):
    df = spark.range(1000).selectExpr("id", "id div 300 as bucket").repartition(5)
    got = dense_positions(df, ["bucket"], [F.desc("id")], "place").collect()
    order = [r.id for r in sorted(got, key=lambda r: r.place)]
    assert sorted(r.place for r in got) == list(range(1000))
    assert order == [i for b in range(4) for i in range(min(999, b * 300 + 299), b * 300 - 1, -1)]


def test_files_round_trip(spark, tmp_path):
    path = str(tmp_path / "data")
    assert not jsonl.train_exists(spark, path)
    tools = catalog.tool_catalog(specs(spark, TOOL))
    schemas = catalog.schema_list(tools)
    shown = json.loads(spark.range(1).select(schemas.alias("s")).first().s)
    call = '{"name": "reserve", "arguments": {"z": 1, "a": "é \\"x\\""}}'
    df = spark.range(10).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") != 3, call).alias("expected_tool_call"),
        F.array(F.struct(F.lit("user").alias("role"), F.concat(F.lit('say "'), "id", F.lit('"')).alias("content"))).alias("messages"),
    )
    parts = split.split_examples(df, "ord")
    jsonl.write_split(parts, schemas, path)
    assert jsonl.train_exists(spark, path + "/split=train")
    assert spark.read.text(path + "/split=train").count() == 8
    lines = [json.loads(r.value) for r in spark.read.text(path).select("value").collect()]
    assert len(lines) == 10 and all(line["tools"] == shown for line in lines)
    assert all(list(line["expected_tool_call"]["arguments"]) == ["z", "a"] for line in lines if line["expected_tool_call"])
    back = jsonl.read_examples(spark, path + "/split=train")
    rows = back.collect()
    assert sorted(r.ord for r in rows) == list(range(8)) and {r.id for r in rows} == {f"train_{i}" for i in range(8)}
    assert all(r.user_query.startswith('say "') for r in rows)

    patches = spark.createDataFrame([("train_iter1_0_0", call)], "id string, expected_tool_call string").withColumn(
        "messages", F.array(F.struct(F.lit("user").alias("role"), F.lit("new").alias("content")))
    )
    for _ in range(2):  # an iteration that runs twice is there once
        jsonl.append_patches(patches, schemas, path, 1)
    assert spark.read.text(path + "/split=train").count() == 9
    assert spark.read.text(path + "/split=eval").count() == 2


def test_lines_keep_order_and_defaults(spark, tmp_path):
    file = tmp_path / "eval.jsonl"
    rows = [{"messages": [{"role": "system", "content": f"m{i}"}, {"role": "user", "content": "x"}], "expected_tool_call": None, "tools": []} for i in range(200)]
    rows[5]["id"] = "five"
    file.write_text("".join(json.dumps(r) + "\n" for r in rows))
    got = sorted(jsonl.read_examples(spark, str(file)).collect(), key=lambda r: r.ord)
    assert [r.user_query for r in got] == [f"m{i}" for i in range(200)]
    assert [r.ord for r in got] == list(range(200))
    assert got[5].id == "five" and got[6].id == "unknown" and got[6].expected_tool_call is None
    file.write_text('{"a": 1} x\n')
    with pytest.raises(Exception, match="not a JSON line"):
        jsonl.read_examples(spark, str(file)).collect()


def history(spark, *rows):
    return spark.createDataFrame(list(rows), "run_id long, iteration long, overall_accuracy double, failure_count long")


def test_progress_and_stop(spark):
    h = history(spark, (1, 1, 0.5, 5), (1, 2, 0.4, 6), (1, 3, 0.9, 1), (1, 4, 0.95, 1), (2, 1, 0.0, 9), (2, 2, 0.0, 9), (2, 3, 0.1, 9), (2, 4, 0.2, 8), (3, 1, 0.0, 0), (3, 2, 0.1, 1))
    best = {(r.run_id, r.iteration): (r.best_accuracy, r.improved) for r in metrics.run_progress(h).collect()}
    assert best[1, 2] == (0.5, False) and best[1, 3] == (0.9, True) and best[2, 1] == (0.0, False)
    stops = {(r.run_id, r.iteration): r.stop_reason for r in metrics.stop_decision(h, 0.9, 3).collect()}
    assert stops == {
        (1, 1): "continue", (1, 2): "continue", (1, 3): "target_reached",
        (2, 1): "continue", (2, 2): "continue", (2, 3): "max_iterations",
        (3, 1): "no_failures",
    }
    for target, limit in ((1.1, 3), (-0.1, 3), (0.5, 0)):
        with pytest.raises(ValueError):
            metrics.stop_decision(h, target, limit)


def test_accuracy_of_nothing(spark):
    scored = spark.createDataFrame([], "run_id long, iteration long, tool string, is_correct boolean")
    assert metrics.overall_accuracy(scored).first().overall_accuracy == 0.0
    tools = catalog.tool_catalog(specs(spark, TOOL))
    assert [tuple(r) for r in metrics.per_tool_accuracy(scored, tools).collect()] == [("reserve", 0, 0, 0.0)]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    h = history(spark, (1, 1, 0.5, 5), (1, 2, 0.75, 2)).drop("run_id")
    tools = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.0), (2, "a", 0.75)], "iteration long, tool string, accuracy double")
    assert [jsonl.append_run_log(spark, h, tools, path, token) for token in ("first", "second")] == [1, 2]
    assert jsonl.append_run_log(spark, h, tools, path, "second") == 2  # a repeated write
    rows = jsonl.read_run_log(spark, path).orderBy("run_id", "iteration").collect()
    assert [(r.run_id, r.iteration, r.best_accuracy) for r in rows] == [(1, 1, 0.75), (1, 2, 0.75), (2, 1, 0.75), (2, 2, 0.75)]
    logged = jsonl.read_tool_log(spark, path).filter("run_id = 2").collect()
    assert sorted((r.iteration, r.tool, r.accuracy) for r in logged) == [(1, "a", 0.5), (1, "b", 0.0), (2, "a", 0.75)]
    failed = spark.createDataFrame([("1", "wrong_tool")], "id string, error_type string")
    for _ in range(2):
        jsonl.write_failures(failed, str(tmp_path / "f"), 3)
    assert spark.read.json(str(tmp_path / "f" / "iter=3")).count() == 1


def test_texts(spark):
    failed = spark.createDataFrame(
        [("q", '{"name":"t","arguments":{"a":[1,2]}}', "p", "wrong_tool"), ("q", "{}", None, "malformed_json"), ("q", '{"name":"t","arguments":null}', "p", "x")],
        "user_query string, expected string, predicted string, error_type string",
    )
    assert [r.failure_text for r in prompts.failure_text(failed).collect()] == [
        'mistake: wrong_tool\nasked: q\nwanted: t {"a": [1, 2]}\nanswered: p',
        "mistake: malformed_json\nasked: q\nwanted: ? {}\nanswered: ",
        "mistake: x\nasked: q\nwanted: t null\nanswered: p",
    ]
    broken = failed.select(F.concat("expected", F.lit(" junk")).alias("expected_tool_call"), F.array(F.struct(F.lit("u").alias("role"), F.lit("c").alias("content"))).alias("messages"))
    assert prompts.sft_text(broken).count() == 0
    examples = failed.select(F.col("expected").alias("expected_tool_call"), F.array(F.struct(F.lit("system").alias("role"), F.lit("hi").alias("content")), F.struct(F.lit("user").alias("role"), F.lit("no").alias("content"))).alias("messages"))
    assert prompts.sft_text(examples).first().text == (
        '<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n{"name": "t", "arguments": {"a":[1,2]}}<|im_end|>\n'
    )
    assert prompts.eval_prompts(examples).first().prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
