"""Inputs of the registered queries, derived by Spark from the given tables.

Every view covers its whole table. Groups are bounded by the key ranges they are
cut from: an answer or evaluation never spans more than EVENTS_PER_RUN events.
Numbers inside JSON are integers, since engines print doubles differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from toolgauge.functions.stage import computed

EVENTS_PER_RUN = 1000
ITERATIONS = 10
# A run's set is evaluated in so many iterations at most.
EVALUATIONS = 3

_MESSAGES = "array(named_struct('role', 'user', 'content', user_query)) AS messages"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _call(name: str, k: str | None, cents: str | None, extra: str = "channel") -> str:
    """SQL for the JSON text of a call; the arguments are SQL, None leaves one out."""
    args = [f"""'"{key}": ', {value}""" for key, value in (("k", k), ("cents", cents)) if value]
    return (
        f"""concat('{{"name": "', {name}, '", "arguments": {{', """
        + ", ', ', ".join(args)
        + f", {extra}, '}}}}')"
    )


def _event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
        "CAST(round(value * 100) AS BIGINT) AS cents",
        f"event_id DIV {EVENTS_PER_RUN} AS run_id",
        f"user_id % {ITERATIONS} + 1 AS iteration",
        """if(event_id % 5 = 0, ', "channel": "Web"', '') AS channel""",
    )


def eval_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One example per event; a few expect no call."""
    exact = _call("event_type", "k", "cents")
    return (
        _event_fields(spark, sf_dir)
        .selectExpr(
            "event_id AS ord",
            "run_id",
            "iteration",
            "concat('eval_', event_id) AS id",
            "concat('user ', user_id, ' asks for ', event_type, ' number ', event_id) AS user_query",
            f"if(event_id % 97 <> 0, {exact}, NULL) AS expected_tool_call",
        )
        .selectExpr("*", _MESSAGES)
    )


def mixed_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The examples, with expectations that were damaged in three ways among them."""
    return eval_examples(spark, sf_dir).withColumn(
        "expected_tool_call",
        F.expr(
            """CASE ord % 13 WHEN 3 THEN concat(expected_tool_call, ' etc.')
               WHEN 7 THEN replace(expected_tool_call, '"name"', '"tool"')
               WHEN 11 THEN concat('[', expected_tool_call, ']') ELSE expected_tool_call END"""
        ),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model answered to every example: sixteen kinds of right and wrong text."""
    return _predicted(_event_fields(spark, sf_dir).withColumn("kind", F.expr("event_id % 16"))).select(
        "ord", "predicted"
    )


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which iterations each run had: one to EVALUATIONS of them."""
    runs = table(spark, sf_dir, "events").selectExpr(f"event_id DIV {EVENTS_PER_RUN} AS run_id").distinct()
    return runs.selectExpr("run_id", f"explode(sequence(1, CAST(run_id % {EVALUATIONS} + 1 AS INT))) AS iteration")


def iteration_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of each iteration to the set of its run: other kinds each time, some absent."""
    asked = _event_fields(spark, sf_dir).drop("iteration").join(evaluations(spark, sf_dir), "run_id")
    answered = asked.filter("(event_id + iteration) % 11 <> 0").withColumn(
        "kind", F.expr("(event_id + 5 * iteration) % 16")
    )
    return _predicted(answered).select("run_id", "iteration", "ord", "predicted")


def _predicted(events: DataFrame) -> DataFrame:
    """Events with `ord` and the text `predicted` for their `kind`."""
    web = """if(channel = '', '', ', "channel": "WEB"')"""
    fence = "```"
    return (
        events
        .selectExpr("*", f"{_call('event_type', 'k', 'cents')} AS exact")
        .selectExpr(
            "*",
            "event_id AS ord",
            f"""CASE
            WHEN kind <= 5 THEN exact
            WHEN kind = 6 THEN concat('Sure, here is the call:\\n{fence}json\\n', exact, '\\n{fence}\\nAnything else?')
            WHEN kind = 7 THEN concat('{fence}\\n', exact, '\\n{fence}')
            WHEN kind = 8 THEN {_call("event_type", "concat('\"', k, '\"')", "concat('\"', cents, '\"')", web)}
            WHEN kind = 9 THEN left(exact, length(exact) - 3)
            WHEN kind = 10 THEN concat(exact, ' as you asked')
            WHEN kind = 11 THEN {_call("concat(event_type, '_all')", "k", "cents")}
            WHEN kind = 12 THEN {_call("event_type", "k", None)}
            WHEN kind = 13 THEN {_call("event_type", "k + 1", "cents")}
            WHEN kind = 14 THEN {_call("event_type", "k", "cents", "channel, ', \"currency\": \"EUR\"'")}
            ELSE {_call("event_type", "k + 1", None)} END AS predicted""",
        )
    )


def example_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The examples as JSON lines; every seventh lacks its id."""
    return eval_examples(spark, sf_dir).selectExpr(
        "ord",
        """concat('{"tools": [], "messages": [{"role": "user", "content": "', user_query,
           '"}], "expected_tool_call": ', coalesce(expected_tool_call, 'null'),
           if(ord % 7 = 0, '', concat(', "id": "', id, '"')), '}') AS line""",
    )


def event_tool_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tool per event type but 'error', plus 'refund', which no event has."""
    seen = (
        table(spark, sf_dir, "events")
        .filter("event_type <> 'error'")
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), F.min("event_id").alias("tool_ord"))
        .selectExpr(
            "tool_ord",
            """concat('{"name": "', event_type, '", "description": "seen ', n,
               ' times", "parameters": {"k": "integer", "cents": "integer"}}') AS spec""",
        )
    )
    refund = spark.range(1).selectExpr(
        "-1L AS tool_ord", """'{"name": "refund", "parameters": {"cents": "integer"}}' AS spec"""
    )
    return seen.unionByName(refund)


def part_tool_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tool per part: full, shorthand and missing pieces in turn."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS tool_ord",
        """concat('{"name": "order_', p_partkey, '"',
           if(p_partkey % 5 = 1, '', concat(', "description": "Order the ', p_name, '"')),
           CASE p_partkey % 5
             WHEN 2 THEN ', "parameters": {"quantity": "integer", "note": "string"}'
             WHEN 3 THEN ', "parameters": {}'
             WHEN 4 THEN ''
             ELSE concat(', "parameters": {"quantity": {"type": "integer", "description": "How many, packed by ',
                p_size, '", "required": true}, "brand": {"type": "string", "description": "', p_brand,
                ' or similar", "required": false}, "grade": {"type": "string", "description": "',
                lower(p_type), '"}}') END, '}') AS spec""",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model answer per run and user, over all events, wrapped in five ways."""
    items = (
        _event_fields(spark, sf_dir)
        .selectExpr(
            "run_id",
            "user_id",
            "event_id",
            """concat('"user_query": "do ', event_type, ' ', event_id, '", ') AS q""",
            f"""concat('"expected_tool_call": ',
                if(event_id % 8 = 0, 'null', {_call("event_type", "k", "cents")})) AS c""",
        )
        .groupBy("run_id", "user_id")
        # At most EVENTS_PER_RUN events share a run.
        .agg(F.expr("array_sort(collect_list(struct(event_id, q, c))) AS items"))
        .selectExpr(
            "user_id % 5 AS kind",
            "concat(run_id, '_', user_id) AS prompt_id",
            """concat('[', array_join(transform(items, (x, i) ->
               concat('{', if(user_id % 5 = 4 AND i = 2, '', x.q), x.c, '}')), ', '), ']') AS body""",
        )
    )
    wrapped = F.expr(
        """CASE kind WHEN 1 THEN concat('```json\\n', body, '\\n```')
                     WHEN 2 THEN concat('```json\\n', body, '\\n```\\n')
                     WHEN 3 THEN left(body, length(body) - 2)
                     ELSE body END"""
    )
    return computed(items, raw=wrapped).select("prompt_id", "raw")


def prompt_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each prompt was about: a tool, or a cluster of one iteration of one run."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr(f"event_id DIV {EVENTS_PER_RUN} AS run_id", "user_id")
        .distinct()
        .selectExpr(
            "concat(run_id, '_', user_id) AS prompt_id",
            "concat('tool_', user_id % 7) AS tool",
            "run_id",
            f"user_id % {ITERATIONS} + 1 AS iteration",
            f"user_id DIV {ITERATIONS} - 1 AS cluster_id",
        )
    )


def vector_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures that come with a vector and a fixed clustering, label 9 as noise."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS ord",
        "concat('eval_', vec_id) AS id",
        "concat('question ', vec_id) AS user_query",
        """concat('{"name": "t', label, '", "arguments": {"v": ', vec_id, '}}') AS expected""",
        """concat('{"name": "t', (label + 1) % 10, '"}') AS predicted""",
        """get(array('wrong_tool', 'missing_param', 'wrong_param_value', 'hallucinated_param'),
               CAST((label + vec_id % 3) % 4 AS INT)) AS error_type""",
        "if(label = 9, -1, label) AS cluster_id",
        "embedding",
    )


def first_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first message of every conversation; later turns are never gathered."""
    return (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id")
        .agg(F.expr("array(min_by(named_struct('role', role, 'content', text), turn)) AS messages"))
    )
