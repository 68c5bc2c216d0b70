"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from toolgauge.llm import resampling, weak_rules as rules


def _op10() -> str:
    k = len(rules.RULES)
    vote = "\n + ".join(
        f"(CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END * {3**i})"
        for i, (_, bad, good) in enumerate(rules.RULES)
    )
    smooth, rounds = rules.SMOOTHING, []
    believed = f"{rules.BELIEF_SHARE} * (any_value(g) + any_value(b))"
    alarm, rest = rules.BELIEVED_ALARM, (1 - rules.BELIEVED_ALARM) / 2
    for r in range(1, rules.ROUNDS + 1):
        rounds.append(f"""
t{r} AS MATERIALIZED (SELECT sum(n * q) + 0.0 AS g, sum(n * (1 - q)) + 0.0 AS b FROM q{r - 1}),
m{r} AS MATERIALIZED (
  SELECT slots.slot,
    (coalesce(sum(n * q), 0) + {smooth} + {believed} * CASE WHEN slots.slot % 3 = 0 THEN {alarm} ELSE {rest} END)
      / (any_value(g) + {3 * smooth} + {believed}) AS good,
    (coalesce(sum(n * (1 - q)), 0) + {smooth}) / (any_value(b) + {3 * smooth}) AS bad
  FROM slots CROSS JOIN t{r} LEFT JOIN filled ON filled.slot = slots.slot
  LEFT JOIN q{r - 1} ON q{r - 1}.pattern = filled.pattern GROUP BY slots.slot),
q{r} AS MATERIALIZED (
  SELECT p.pattern, p.n,
    1 / (1 + exp(-ln((any_value(g) + {smooth}) / (any_value(b) + {smooth})) - sum(ln(good / bad)))) AS q
  FROM q{r - 1} AS p JOIN filled USING (pattern) JOIN m{r} USING (slot) CROSS JOIN t{r}
  GROUP BY p.pattern, p.n)""")
    return f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS i, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (
  SELECT doc_id, i, text,
    list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)),
      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
e AS (
  SELECT i, unnest(generate_series(1, len(words) - 2)) AS pos, words FROM w WHERE len(words) >= 3),
g AS (SELECT i, pos, words[pos] AS a, words[pos + 1] AS b, words[pos + 2] AS c FROM e),
h AS (SELECT i, pos, count(*) OVER (PARTITION BY i, a, b, c) AS n FROM g),
repeated AS (
  SELECT i, count(DISTINCT pos + k) AS n_repeat_words
  FROM h CROSS JOIN (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY i),
f AS MATERIALIZED (
  SELECT doc_id, i, len(words) AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(text) - length(translate(text, '{rules.CAPITALS}', '')) AS n_capitals,
    len(list_distinct(words)) AS n_distinct,
    length(text) - length(regexp_replace(text, '[^\\p{{L}}\\p{{M}}\\p{{N}}\\x20\\x09-\\x0D]+', '', 'g')) AS n_marks
  FROM w LEFT JOIN repeated USING (i)),
v AS MATERIALIZED (SELECT *, {vote} AS pattern FROM f),
slots AS MATERIALIZED (SELECT range AS slot FROM range({3 * k})),
patterns AS MATERIALIZED (SELECT pattern, count(*) AS n FROM v GROUP BY pattern),
filled AS MATERIALIZED (
  SELECT pattern, 3 * k.range + (pattern // pow(3, k.range)::BIGINT) % 3 AS slot
  FROM patterns CROSS JOIN range({k}) AS k),
q0 AS MATERIALIZED (
  SELECT pattern, any_value(n) AS n, CASE WHEN bool_or(slot % 3 = 0) THEN 0.1 ELSE 0.9 END::DOUBLE AS q
  FROM patterns JOIN filled USING (pattern) GROUP BY pattern),
{",".join(rounds)}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words)
    AND q >= {rules.THRESHOLD} AS kept
FROM v JOIN q{rules.ROUNDS} USING (pattern)"""


OP1 = """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS squeezed
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(squeezed) AS text_sha256
FROM t WINDOW same AS (PARTITION BY squeezed)"""

OP4 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (
  SELECT *, octet_length(payload) AS n, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q"""



def _op12() -> str:
    """CRC-32 from its polynomial, byte by byte, once for each different word."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    n, z = resampling.BUCKETS, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH t AS MATERIALIZED (
  SELECT 0 AS kind, row_number() OVER () AS i, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), item_id, coalesce(text, '') FROM benchmark),
w AS MATERIALIZED (
  SELECT kind, i, unnest(list_filter(
    regexp_split_to_array(translate(text, '{upper}', '{lower}'), '{z}'), lambda x: x <> '')) AS word FROM t),
x AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM w)),
crc AS MATERIALIZED (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(generate_series(1, length(h) // 2),
      lambda k: (16 * (strpos('0123456789ABCDEF', substr(h, 2 * k - 1, 1)) - 1)
        + strpos('0123456789ABCDEF', substr(h, 2 * k, 1)) - 1)::BIGINT)),
    lambda state, byte: xor(state >> 8, ({table}::BIGINT[])[(xor(state, byte) & 255) + 1])),
    4294967295::BIGINT) % {n} AS bucket FROM x),
f AS MATERIALIZED (SELECT kind, i, bucket FROM w JOIN crc USING (word)),
b AS (
  SELECT buckets.range AS bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t
  FROM range({n}) AS buckets LEFT JOIN f ON f.bucket = buckets.range GROUP BY buckets.range),
a AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM b),
g AS (
  SELECT bucket, floor(1000 * ln((t::DOUBLE + 1) * (all_s + {n}) / ((s::DOUBLE + 1) * (all_t + {n}))))::BIGINT AS gain
  FROM b CROSS JOIN a),
d AS (
  SELECT f.i, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM f JOIN g USING (bucket) WHERE kind = 0 GROUP BY f.i),
h AS (
  SELECT i, doc_id, list_reduce(list_transform(generate_series(1, 8),
      lambda k: (strpos('0123456789abcdef', substr(sha256('{resampling.SEED}:' || doc_id), k, 1)) - 1)::BIGINT),
    lambda x, y: 16 * x + y) AS h FROM t WHERE kind = 0),
s AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM h LEFT JOIN d USING (i)),
r AS (
  SELECT *, n_features >= {resampling.LEAST_WORDS} AS eligible,
    row_number() OVER (PARTITION BY n_features >= {resampling.LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= {resampling.LEAST_WORDS}) OVER () AS n FROM s)
SELECT doc_id, n_features, weight, score,
  CASE WHEN eligible AND place <= {resampling.PERCENT} * n // 100 THEN place END AS rank FROM r"""


SQL = {"op12_resampling": _op12(), "op4_warc": OP4, "op1_exact_dedup": OP1, "op10_quality_rules": _op10()}
