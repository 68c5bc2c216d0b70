"""DuckDB SQL that restates the registered queries on the same tables."""

from __future__ import annotations

from toolgauge.operators.prompts import PATCH_TASK, datagen_task


def _quoted(text: str) -> str:
    """Python text as a SQL literal."""
    return "'" + text.replace("'", "''") + "'"


EVENTS = """
e AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents,
         event_id // 1000 AS run_id,
         user_id % 10 + 1 AS iteration,
         CASE WHEN event_id % 5 = 0 THEN ', "channel": "Web"' ELSE '' END AS channel
  FROM events
)"""

EXAMPLES = (
    EVENTS
    + """,
x AS (
  SELECT *, event_id AS ord, 'eval_' || event_id AS id,
         'user ' || user_id || ' asks for ' || event_type || ' number ' || event_id AS user_query,
         '{"name": "' || event_type || '", "arguments": {"k": ' || k || ', "cents": ' || cents || channel || '}}' AS exact
  FROM e
),
ex AS (
  SELECT *, CASE WHEN event_id % 97 <> 0 THEN exact END AS expected_tool_call FROM x
)"""
)

# Prediction texts, then scoring from the texts alone, with DuckDB's own JSON functions.
SCORED = (
    EXAMPLES
    + """,
pr AS (
  SELECT ord, run_id, iteration, id, user_query, expected_tool_call,
    CASE WHEN event_id % 16 <= 5 THEN exact
         WHEN event_id % 16 = 6 THEN 'Sure, here is the call:' || chr(10) || '```json' || chr(10) || exact || chr(10) || '```' || chr(10) || 'Anything else?'
         WHEN event_id % 16 = 7 THEN '```' || chr(10) || exact || chr(10) || '```'
         WHEN event_id % 16 = 8 THEN '{"name": "' || event_type || '", "arguments": {"k": "' || k || '", "cents": "' || cents || '"' || CASE WHEN channel <> '' THEN ', "channel": "WEB"' ELSE '' END || '}}'
         WHEN event_id % 16 = 9 THEN substr(exact, 1, length(exact) - 3)
         WHEN event_id % 16 = 10 THEN exact || ' as you asked'
         WHEN event_id % 16 = 11 THEN '{"name": "' || event_type || '_all", "arguments": {"k": ' || k || ', "cents": ' || cents || channel || '}}'
         WHEN event_id % 16 = 12 THEN '{"name": "' || event_type || '", "arguments": {"k": ' || k || channel || '}}'
         WHEN event_id % 16 = 13 THEN '{"name": "' || event_type || '", "arguments": {"k": ' || (k + 1) || ', "cents": ' || cents || channel || '}}'
         WHEN event_id % 16 = 14 THEN '{"name": "' || event_type || '", "arguments": {"k": ' || k || ', "cents": ' || cents || channel || ', "currency": "EUR"}}'
         ELSE '{"name": "' || event_type || '", "arguments": {"k": ' || (k + 1) || channel || '}}' END AS predicted
  FROM ex WHERE expected_tool_call IS NOT NULL
),
cut AS (
  SELECT *, CASE
      WHEN contains(predicted, '```json') THEN trim(split_part(split_part(predicted, '```json', 2), '```', 1), chr(10) || ' ')
      WHEN contains(predicted, '```') THEN trim(split_part(predicted, '```', 2), chr(10) || ' ')
      ELSE predicted END AS body
  FROM pr
),
args AS (
  SELECT *, json_extract_string(expected_tool_call, '$.name') AS tool,
         CASE WHEN json_valid(body) THEN json_extract_string(body, '$.name') END AS p_name,
         json_keys(expected_tool_call, '$.arguments') AS e_keys,
         CASE WHEN json_valid(body) THEN json_keys(body, '$.arguments') END AS p_keys
  FROM cut
),
faults AS (
  SELECT *, list_filter(list_transform(e_keys, lambda key:
      CASE WHEN NOT list_contains(p_keys, key) THEN 'missing_param'
           WHEN lower(json_extract_string(CASE WHEN json_valid(body) THEN body END, '$.arguments.' || key))
             <> lower(json_extract_string(expected_tool_call, '$.arguments.' || key)) THEN 'wrong_param_value' END),
      lambda fault: fault IS NOT NULL) AS found
  FROM args
),
scored AS (
  SELECT *, error_type = '' AS is_correct FROM (
    SELECT *, CASE WHEN NOT json_valid(body) THEN 'malformed_json'
                   WHEN p_name IS DISTINCT FROM tool THEN 'wrong_tool'
                   WHEN len(found) > 0 THEN found[1]
                   WHEN len(list_filter(p_keys, lambda key: NOT list_contains(e_keys, key))) > 0 THEN 'hallucinated_param'
                   ELSE '' END AS error_type
    FROM faults)
)"""
)

# The whole set of a run in each of its iterations; what was not answered is empty text.
_ANSWERED = "(event_id + it) % 11 <> 0"
EVALUATED = (
    SCORED.replace("event_id % 16", "(event_id + 5 * it) % 16")
    .replace("SELECT ord, run_id, iteration, id, user_query", "SELECT ord, run_id, it AS iteration, id, user_query")
    .replace("CASE WHEN (event_id + 5 * it) % 16 <= 5", f"CASE WHEN NOT ({_ANSWERED}) THEN '' WHEN (event_id + 5 * it) % 16 <= 5")
    .replace(
        "FROM ex WHERE expected_tool_call IS NOT NULL",
        "FROM (SELECT *, unnest(generate_series(1, run_id % 3 + 1)) AS it FROM ex) WHERE expected_tool_call IS NOT NULL",
    )
)
EVALUATED_HISTORY = (
    EVALUATED
    + """,
history AS (
  SELECT run_id, iteration, count(*) AS total, count(*) FILTER (is_correct) AS correct,
         count(*) FILTER (NOT is_correct) AS failure_count,
         CAST(count(*) FILTER (is_correct) AS DOUBLE) / count(*) AS overall_accuracy,
         count(*) FILTER (predicted = '') AS absent
  FROM scored GROUP BY ALL
)"""
)

HISTORY = (
    SCORED
    + """,
history AS (
  SELECT run_id, iteration, count(*) AS total, count(*) FILTER (is_correct) AS correct,
         count(*) FILTER (NOT is_correct) AS failure_count,
         CAST(count(*) FILTER (is_correct) AS DOUBLE) / count(*) AS overall_accuracy
  FROM scored GROUP BY ALL
)"""
)

EVENT_CATALOG = """
tools AS (
  SELECT min(event_id) AS tool_ord, event_type AS name, 'seen ' || count(*) || ' times' AS description, false AS single
  FROM events WHERE event_type <> 'error' GROUP BY event_type
  UNION ALL SELECT -1, 'refund', '', true
)"""

PART_CATALOG = """
specs AS (
  SELECT p_partkey AS tool_ord, 'order_' || p_partkey AS name,
         CASE WHEN p_partkey % 5 = 1 THEN '' ELSE 'Order the ' || p_name END AS description,
         CASE WHEN p_partkey % 5 = 2 THEN
                [{'name': 'quantity', 'type': 'integer', 'description': '', 'required': true},
                 {'name': 'note', 'type': 'string', 'description': '', 'required': true}]
              WHEN p_partkey % 5 IN (3, 4) THEN []
              ELSE [{'name': 'quantity', 'type': 'integer', 'description': 'How many, packed by ' || p_size, 'required': true},
                    {'name': 'brand', 'type': 'string', 'description': p_brand || ' or similar', 'required': false},
                    {'name': 'grade', 'type': 'string', 'description': lower(p_type), 'required': true}]
         END AS parameters
  FROM part
)"""

RESPONSES = (
    EVENTS
    + """,
items AS (
  SELECT run_id, user_id, event_id,
         '"user_query": "do ' || event_type || ' ' || event_id || '", ' AS q,
         CASE WHEN event_id % 8 <> 0 THEN '{"name": "' || event_type || '", "arguments": {"k": ' || k || ', "cents": ' || cents || channel || '}}' END AS call,
         row_number() OVER (PARTITION BY run_id, user_id ORDER BY event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY run_id, user_id) AS n
  FROM e
),
origin AS (
  SELECT run_id, user_id, run_id || '_' || user_id AS prompt_id, 'tool_' || user_id % 7 AS tool,
         user_id % 10 + 1 AS iteration, user_id // 10 - 1 AS cluster_id
  FROM (SELECT DISTINCT run_id, user_id FROM e)
),
answers AS (
  SELECT prompt_id, tool, user_id,
         CASE user_id % 5
           WHEN 1 THEN '```json' || chr(10) || body || chr(10) || '```'
           WHEN 2 THEN '```json' || chr(10) || body || chr(10) || '```' || chr(10)
           WHEN 3 THEN substr(body, 1, length(body) - 2)
           ELSE body END AS raw,
         n
  FROM (
    SELECT run_id, user_id, count(*) AS n,
           '[' || string_agg('{' || CASE WHEN user_id % 5 = 4 AND pos = 2 THEN '' ELSE q END
               || '"expected_tool_call": ' || coalesce(call, 'null') || '}', ', ' ORDER BY event_id) || ']' AS body
    FROM items GROUP BY run_id, user_id) JOIN origin USING (run_id, user_id)
),
patches AS (
  SELECT prompt_id, run_id, iteration, cluster_id, CAST(pos AS INTEGER) AS pos,
         json_extract_string('{' || q || '"z": 1}', '$.user_query') AS user_query,
         replace(replace(call, ': ', ':'), ', ', ',') AS expected_tool_call,
         'run' || run_id || '_train_iter' || iteration || '_' || cluster_id || '_' || pos AS id
  FROM items JOIN origin USING (run_id, user_id)
  WHERE user_id % 5 IN (0, 1, 2) OR (user_id % 5 = 4 AND pos < 2)
)"""
)

SPLIT = (
    EXAMPLES
    + """,
placed AS (
  SELECT *, row_number() OVER (ORDER BY md5('7|' || ord), ord) - 1 AS place,
         CAST(floor(CAST(count(*) OVER () AS DOUBLE) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS cut
  FROM ex
),
halves AS (
  SELECT ord, user_query, expected_tool_call,
         CASE WHEN place < cut THEN 'train' ELSE 'eval' END AS split,
         CASE WHEN place < cut THEN 'train_' || place ELSE 'eval_' || (place - cut) END AS id
  FROM placed
)"""
)

VECTOR_FAILURES = """
vf AS (
  SELECT vec_id AS ord, 'question ' || vec_id AS user_query,
         '{"name": "t' || label || '", "arguments": {"v": ' || vec_id || '}}' AS expected,
         '{"name": "t' || (label + 1) % 10 || '"}' AS predicted,
         ['wrong_tool', 'missing_param', 'wrong_param_value', 'hallucinated_param'][(label + vec_id % 3) % 4 + 1] AS error_type,
         CASE WHEN label = 9 THEN -1 ELSE label END AS cluster_id
  FROM embeddings
),
errors AS (
  SELECT cluster_id, error_type,
         row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, error_type) AS place
  FROM vf GROUP BY cluster_id, error_type
),
summary AS (
  SELECT cluster_id, CASE WHEN cluster_id = -1 THEN 'noise_outliers' ELSE 'Cluster_' || cluster_id || '_' || error_type END AS label,
         size, cluster_ord
  FROM (SELECT cluster_id, count(*) AS size, min(ord) AS cluster_ord FROM vf GROUP BY cluster_id)
  JOIN errors USING (cluster_id) WHERE place = 1
)"""

# Every pair of vectors, which is affordable at the size this is checked at.
NEIGHBORS = """
vec AS MATERIALIZED (SELECT vec_id AS ord, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ranked AS MATERIALIZED (
  SELECT a.ord, b.ord AS neighbor, list_distance(a.x, b.x) AS dist,
         row_number() OVER (PARTITION BY a.ord ORDER BY list_distance(a.x, b.x), b.ord) AS place
  FROM vec a JOIN vec b ON a.ord <> b.ord
),
core AS MATERIALIZED (SELECT ord, dist AS core FROM ranked WHERE place = 5)"""

# The same with no more rows than the neighbours that are asked for.
NEAREST = NEIGHBORS.replace(
    "FROM vec a JOIN vec b ON a.ord <> b.ord", "FROM vec a JOIN vec b ON a.ord <> b.ord QUALIFY place <= 5"
)

_TOOL_HISTORY = """
runs AS (SELECT DISTINCT run_id, iteration FROM scored),
wanted AS (
  SELECT run_id, iteration, name AS tool FROM runs, tools
  UNION SELECT run_id, iteration, tool FROM scored
)
SELECT run_id, iteration, tool, count(s.ord) AS total, count(*) FILTER (s.is_correct) AS correct,
       coalesce(CAST(count(*) FILTER (s.is_correct) AS DOUBLE) / nullif(count(s.ord), 0), 0.0) AS accuracy
FROM wanted LEFT JOIN scored s USING (run_id, iteration, tool) GROUP BY ALL"""

_PROGRESS = """,
p AS (
  SELECT run_id, iteration, overall_accuracy,
         greatest(max(overall_accuracy) OVER (PARTITION BY run_id ORDER BY iteration), 0.0) AS best_accuracy,
         max(overall_accuracy) OVER (PARTITION BY run_id ORDER BY iteration
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
  FROM history
)
SELECT run_id, iteration, overall_accuracy, best_accuracy,
       overall_accuracy > coalesce(earlier, 0.0) AS improved FROM p"""

_SCHEMA_HEAD = """'{"type":"function","function":{"name":"' || name || '","description":"' || description || '","parameters":{"type":"object","properties":{'"""

SQL: dict[str, str] = {
    "scan_examples": f"""WITH {EXAMPLES}
SELECT ord, CASE WHEN ord % 7 = 0 THEN 'unknown' ELSE id END AS id, user_query,
       replace(replace(expected_tool_call, ': ', ':'), ', ', ',') AS expected_tool_call FROM ex""",
    "tool_catalog": f"""WITH {PART_CATALOG}
SELECT tool_ord, name, description, CAST(i - 1 AS INTEGER) AS pos, parameters[i].name AS param,
       parameters[i].type AS type, parameters[i].description AS param_description,
       parameters[i].required AS required
FROM (SELECT *, unnest(CASE WHEN len(parameters) = 0 THEN [NULL] ELSE range(1, len(parameters) + 1) END) AS i FROM specs)""",
    "tool_schema": f"""WITH {PART_CATALOG}
SELECT tool_ord, name, {_SCHEMA_HEAD}
       || array_to_string(list_transform(parameters, lambda p: '"' || p.name || '":{{"type":"' || p.type || '","description":"' || p.description || '"}}'), ',')
       || '}},"required":['
       || array_to_string(list_transform(list_filter(parameters, lambda p: p.required), lambda p: '"' || p.name || '"'), ',')
       || ']}}}}}}' AS schema
FROM specs""",
    "datagen_prompts": f"""WITH {PART_CATALOG}
SELECT tool_ord, name AS tool,
       'TOOL ' || name || chr(10) || description || chr(10) || 'It takes:' || chr(10)
       || array_to_string(list_transform(parameters, lambda p: '  ' || p.name || ' (' || p.type
            || CASE WHEN p.required THEN ', required) ' ELSE ', optional) ' END || p.description || chr(10)), '')
       || {_quoted(datagen_task(30))} AS prompt
FROM specs""",
    "patch_prompts": f"""WITH {VECTOR_FAILURES},
shown AS (
  SELECT cluster_id, string_agg('* ' || user_query || chr(10) || '  should give ' || expected || chr(10) || '  but gave ' || predicted,
         chr(10) ORDER BY ord) AS lines
  FROM (SELECT * FROM vf QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY ord) <= 3)
  GROUP BY cluster_id
)
SELECT cluster_id, label, CAST(least(20, size * 3) AS INTEGER) AS requested,
       'WEAKNESS ' || label || chr(10) || 'Seen in evaluation:' || chr(10) || lines || chr(10)
       || 'TASK' || chr(10) || 'Teach the model otherwise with ' || least(20, size * 3)
       || {_quoted(PATCH_TASK)} AS prompt
FROM summary JOIN shown USING (cluster_id)""",
    "ingest_responses": f"""WITH {RESPONSES}
SELECT prompt_id, tool, CAST(pos AS INTEGER) AS pos,
       json_extract_string('{{' || q || '"z": 1}}', '$.user_query') AS user_query,
       replace(replace(call, ': ', ':'), ', ', ',') AS expected_tool_call
FROM items JOIN origin USING (run_id, user_id)
WHERE user_id % 5 IN (0, 1) OR (user_id % 5 = 4 AND n < 3)""",
    "response_rejects": f"""WITH {RESPONSES}
SELECT prompt_id, tool, CASE WHEN user_id % 5 = 4 THEN 'bad_item' ELSE 'invalid_json' END AS reason,
       substr(CASE WHEN starts_with(raw, '```json') THEN substr(raw, 8) ELSE raw END, 1, 200) AS head
FROM answers WHERE user_id % 5 IN (2, 3) OR (user_id % 5 = 4 AND n >= 3)""",
    "patch_rows": f"WITH {RESPONSES} SELECT * FROM patches",
    "split_examples": f"WITH {SPLIT} SELECT ord, split, id, user_query, expected_tool_call FROM halves",
    "training_lines": f"""WITH {SPLIT}, {EVENT_CATALOG},
one AS (
  SELECT '[' || string_agg({_SCHEMA_HEAD}
       || CASE WHEN single THEN '' ELSE '"k":{{"type":"integer","description":""}},' END
       || '"cents":{{"type":"integer","description":""}}}},"required":['
       || CASE WHEN single THEN '' ELSE '"k",' END || '"cents"]}}}}}}', ',' ORDER BY tool_ord) || ']' AS schemas
  FROM tools
)
SELECT split, id, '{{"tools": ' || schemas || ', "messages": [{{"role":"user","content":"' || user_query
       || '"}}], "expected_tool_call": ' || coalesce(expected_tool_call, 'null') || ', "id": "' || id || '"}}' AS line
FROM halves, one""",
    "train_after_patch": f"""WITH {SPLIT}, {RESPONSES.split(EVENTS + ',', 1)[1]}
SELECT id, user_query, expected_tool_call FROM halves WHERE split = 'train'
UNION ALL SELECT id, user_query, expected_tool_call FROM patches""",
    "score_calls": f"WITH {SCORED} SELECT ord, id, tool, is_correct, error_type FROM scored",
    "overall_accuracy": f"""WITH {SCORED}
SELECT count(*) AS total, count(*) FILTER (is_correct) AS correct,
       count(*) FILTER (NOT is_correct) AS failure_count,
       coalesce(CAST(count(*) FILTER (is_correct) AS DOUBLE) / nullif(count(*), 0), 0.0) AS overall_accuracy
FROM scored""",
    "per_tool_accuracy": f"""WITH {SCORED}, {EVENT_CATALOG},
c AS (SELECT tool, count(*) AS total, count(*) FILTER (is_correct) AS correct FROM scored GROUP BY tool)
SELECT coalesce(tool, name) AS tool, coalesce(total, 0) AS total, coalesce(correct, 0) AS correct,
       coalesce(CAST(correct AS DOUBLE) / total, 0.0) AS accuracy
FROM tools FULL JOIN c ON tool = name""",
    "failures": f"""WITH {SCORED}
SELECT ord, id, user_query, expected_tool_call AS expected, predicted, error_type
FROM scored WHERE NOT is_correct""",
    "negatives": f"WITH {EXAMPLES} SELECT ord, id, user_query FROM ex WHERE expected_tool_call IS NULL",
    "example_rejects": f"""WITH {EXAMPLES}
SELECT ord, id, CASE ord % 13 WHEN 3 THEN expected_tool_call || ' etc.' WHEN 7 THEN replace(expected_tool_call, '"name"', '"tool"')
         ELSE '[' || expected_tool_call || ']' END AS expected_tool_call
FROM ex WHERE expected_tool_call IS NOT NULL AND ord % 13 IN (3, 7, 11)""",
    "patch_rejects": f"""WITH {RESPONSES}
SELECT prompt_id, run_id, iteration, cluster_id,
       CASE WHEN answers.user_id % 5 = 3 THEN 'invalid_json' ELSE 'bad_item' END AS reason,
       CAST(CASE WHEN answers.user_id % 5 = 3 THEN 0 ELSE 2 END AS INTEGER) AS used
FROM answers JOIN origin USING (prompt_id)
WHERE answers.user_id % 5 = 3 OR (answers.user_id % 5 = 4 AND n >= 3)""",
    "run_log": f"""WITH {HISTORY}, {EVENT_CATALOG},
wanted AS (
  SELECT run_id, iteration, name AS tool FROM history, tools
  UNION SELECT run_id, iteration, tool FROM scored
),
long AS (
  SELECT run_id, iteration, tool,
         coalesce(CAST(count(*) FILTER (s.is_correct) AS DOUBLE) / nullif(count(s.ord), 0), 0.0) AS accuracy
  FROM wanted LEFT JOIN scored s USING (run_id, iteration, tool) GROUP BY ALL
)
SELECT run_id, iteration, overall_accuracy,
       greatest(max(overall_accuracy) OVER (PARTITION BY run_id), 0.0) AS best_accuracy, tool, accuracy
FROM history JOIN long USING (run_id, iteration)""",
    "failure_text": f"""WITH {SCORED}
SELECT ord, 'mistake: ' || error_type || chr(10) || 'asked: ' || user_query || chr(10) || 'wanted: ' || tool || ' '
       || substr(expected_tool_call, position('"arguments": ' IN expected_tool_call) + 13,
                 length(expected_tool_call) - position('"arguments": ' IN expected_tool_call) - 13)
       || chr(10) || 'answered: ' || predicted AS failure_text
FROM scored WHERE NOT is_correct""",
    "sft_text": f"""WITH {EXAMPLES}
SELECT ord, '<|im_start|>user' || chr(10) || user_query || '<|im_end|>' || chr(10)
       || '<|im_start|>assistant' || chr(10) || '{{"name": "' || event_type || '", "arguments": {{"k":' || k || ',"cents":' || cents
       || replace(replace(channel, ', ', ','), ': ', ':') || '}}}}<|im_end|>' || chr(10) AS text
FROM ex WHERE expected_tool_call IS NOT NULL""",
    "eval_prompts": """
SELECT conv_id, '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt
FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""",
    "tool_history": f"WITH {SCORED}, {EVENT_CATALOG}, {_TOOL_HISTORY}",
    "evaluation_history": f"WITH {EVALUATED}, {EVENT_CATALOG}, {_TOOL_HISTORY}",
    "evaluation_summary": f"WITH {EVALUATED_HISTORY} SELECT * FROM history",
    "evaluation_progress": f"WITH {EVALUATED_HISTORY}{_PROGRESS}",
    "clusters_over_iterations": """
WITH vf AS (
  SELECT vec_id AS ord, vec_id % 3 + 1 AS iteration,
         ['wrong_tool', 'missing_param', 'wrong_param_value', 'hallucinated_param'][(label + vec_id % 3) % 4 + 1] AS error_type,
         CASE WHEN label = 9 THEN -1 ELSE label END AS cluster_id
  FROM embeddings),
errors AS (
  SELECT iteration, cluster_id, error_type,
         row_number() OVER (PARTITION BY iteration, cluster_id ORDER BY count(*) DESC, error_type) AS place
  FROM vf GROUP BY iteration, cluster_id, error_type)
SELECT iteration, cluster_ord, cluster_id,
       CASE WHEN cluster_id = -1 THEN 'noise_outliers' ELSE 'Cluster_' || cluster_id || '_' || error_type END AS label
FROM (SELECT iteration, cluster_id, min(ord) AS cluster_ord FROM vf GROUP BY ALL) JOIN errors USING (iteration, cluster_id)
WHERE place = 1""",
    "iteration_summary": f"""WITH {HISTORY}, {RESPONSES.split(EVENTS + ',', 1)[1]},
added AS (SELECT run_id, iteration, count(*) AS n FROM patches GROUP BY ALL)
SELECT run_id, iteration, total, correct, failure_count, overall_accuracy,
       coalesce(n, 0) AS appended_rows, 'maker-model-3b-v' || iteration AS checkpoint
FROM history LEFT JOIN added USING (run_id, iteration)""",
    "run_progress": f"WITH {HISTORY}{_PROGRESS}",
    "stop_decision": f"""WITH {HISTORY},
s AS (
  SELECT *, CASE WHEN overall_accuracy >= CAST(0.6 AS DOUBLE) THEN 'target_reached'
                 WHEN iteration >= 8 THEN 'max_iterations'
                 WHEN failure_count = 0 THEN 'no_failures' ELSE 'continue' END AS stop_reason
  FROM history
)
SELECT run_id, iteration, overall_accuracy, failure_count, stop_reason FROM s
WHERE iteration <= coalesce((SELECT min(iteration) FROM s t WHERE t.run_id = s.run_id AND t.stop_reason <> 'continue'), 8)""",
    "cluster_summary": f"WITH {VECTOR_FAILURES} SELECT cluster_id, label, size, cluster_ord FROM summary",
    "clusters_handled": f"WITH {VECTOR_FAILURES} SELECT cluster_ord, cluster_id, label FROM summary",
    "core_distances": f"WITH {NEAREST} SELECT ord, round(core, 6) AS core_distance FROM core",
    "mutual_reachability": f"""WITH {NEAREST}
SELECT r.ord, r.neighbor, round(r.dist, 6) AS distance,
       round(greatest(r.dist, a.core, b.core), 6) AS reachability
FROM ranked r JOIN core a ON a.ord = r.ord JOIN core b ON b.ord = r.neighbor""",
    "mst_weights": f"""WITH RECURSIVE {NEIGHBORS},
reach AS MATERIALIZED (
  SELECT r.ord AS a, r.neighbor AS b, greatest(r.dist, x.core, y.core) AS w
  FROM ranked r JOIN core x ON x.ord = r.ord JOIN core y ON y.ord = r.neighbor
),
grown(ord, dist, inside) USING KEY (ord) AS (
  SELECT ord, CASE WHEN ord = (SELECT min(ord) FROM vec) THEN CAST(-1 AS DOUBLE) ELSE CAST('infinity' AS DOUBLE) END, false
  FROM vec
  UNION
  SELECT s.ord, CASE WHEN s.ord = p.ord OR e.w IS NULL THEN s.dist ELSE least(s.dist, e.w) END, s.ord = p.ord
  FROM (SELECT ord FROM recurring.grown WHERE NOT inside ORDER BY dist, ord LIMIT 1) p
  JOIN recurring.grown s ON NOT s.inside
  LEFT JOIN reach e ON e.a = p.ord AND e.b = s.ord
)
SELECT round(dist, 6) AS reachability, count(*) AS edges FROM grown WHERE dist >= 0 GROUP BY 1""",
}

# What is read back is what was written.
SQL["logged_runs"] = SQL["run_log"]
