"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at one property of a text and votes good, bad or not at all. A latent
class model (one probability per rule, vote and class) is fitted by expectation
maximisation over the counts of vote patterns; the posterior probability of the good
class decides. There are at most 3 ** len(RULES) patterns however many documents there
are, so the fit sees all documents through one small aggregate.

Everything is built from Spark SQL functions. Windows of words are compared by 64-bit
hashes: two different ones of a text agree with odds of n * n / 2^65 for n windows, 3e-8
for a million words. Texts of any length are taken whole; one row holds its words.

Defined results: a null or empty text has no words, counts of 0 and fails the base rule.
A null doc_id stays null. Rows that repeat are judged alike, one result each. An empty
table gives an empty result. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from toolgauge.functions.stage import computed
from toolgauge.llm import rows
from toolgauge.session import settle

SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "[^\\p{L}\\p{M}\\p{N}\\x20\\x09-\\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ROUNDS = 20
# A verdict needs this posterior probability of the good class.
THRESHOLD = 0.5
# Votes added to each (rule, class): keeps every probability above 0.
SMOOTHING = 1.0
# What is believed before any document is seen, so that the two classes do not change
# places: a rule calls so many good documents bad. The belief counts like this share of
# all documents, little enough for a rule that is wrong more often to be found out.
BELIEVED_ALARM = 0.05
BELIEF_SHARE = 0.01

# name, SQL condition of a bad vote, SQL condition of a good vote; else the rule abstains.
# The SQL runs on Spark and on DuckDB; multiplications avoid a division by 0 words.
RULES = (
    ("symbols", "5 * n_symbols > n_words", "50 * n_symbols < n_words"),
    ("repeats", "10 * n_repeat_words > 3 * n_words", "10 * n_repeat_words < n_words"),
    ("lines", "10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines >= 3"),
    ("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words",
     "word_chars >= 4 * n_words AND 2 * word_chars <= 13 * n_words"),
    ("capitals", "10 * n_capitals > 3 * word_chars", "10 * n_capitals < word_chars"),
    ("variety", "5 * n_distinct < n_words", "5 * n_distinct > 2 * n_words"),
    ("length", "n_words < 50", "n_words >= 100"),
    ("marks", "10 * n_marks > word_chars", "20 * n_marks < word_chars"),
)
FEATURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_capitals n_distinct n_marks"
).split()


def features(docs: DataFrame) -> DataFrame:
    """Counts of each text: doc_id (and all columns but text), then FEATURES as long."""
    text = F.col("text")
    without = lambda chars: F.length(F.translate(text, chars, ""))
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE)
    )
    lines = F.filter(
        F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != ""
    )
    split = computed(
        docs,
        _words=words,
        _lines=lines,
        word_chars=without(SPACE_CHARS),
        n_symbols=F.length(text) - without(SYMBOLS),
        n_marks=F.length(text) - F.length(F.regexp_replace(text, MARKS, "")),
        n_capitals=F.length(text) - without(CAPITALS),
    ).drop("text")
    # Windows as (64-bit hash of the words, place), sorted: equal ones stand together.
    windows = F.when(
        F.size("_words") >= WINDOW,
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - WINDOW),
                lambda i: F.struct(
                    F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]).alias("h"),
                    i.alias("at"),
                ),
            )
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,at:int>>"))
    sorted_windows = computed(
        split,
        _windows=windows,
        n_words=F.size("_words"),
        n_distinct=F.size(F.array_distinct("_words")),
        n_lines=F.size("_lines"),
        n_dup_lines=F.size("_lines") - F.size(F.array_distinct("_lines")),
    ).drop("_words", "_lines")
    near = lambda i: F.get("_windows", i)["h"]
    places = F.sort_array(
        F.transform(
            F.filter(
                F.col("_windows"),
                lambda w, i: _same(w["h"], near(i - 1), near(i + 1)),
            ),
            lambda w: w["at"],
        )
    )
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, at: F.struct(
            (acc["n"] + at + WINDOW - F.greatest(at, acc["end"])).alias("n"),
            (at + WINDOW).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    counted = computed(sorted_windows, n_repeat_words=covered).drop("_windows")
    kept = [c for c in counted.columns if c not in FEATURES]
    return counted.select(*kept, *[F.col(c).cast("long").alias(c) for c in FEATURES])


def _same(own: Column, before: Column, after: Column) -> Column:
    return F.coalesce(before == own, F.lit(False)) | F.coalesce(after == own, F.lit(False))


def base_failed() -> Column:
    return F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    )


def pattern() -> Column:
    """All votes as one number: digit k to base 3 is rule k's vote (0 bad, 1 none, 2 good)."""
    votes = [
        f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END * {3**k}"
        for k, (_, bad, good) in enumerate(RULES)
    ]
    return F.expr(" + ".join(f"({vote})" for vote in votes)).cast("int")


def posteriors(patterns: DataFrame) -> DataFrame:
    """(pattern, n) -> (pattern, posterior): EM over the pattern counts.

    Starts from all-must-pass: patterns without a bad vote are good with 0.9, others
    with 0.1. One row holds all patterns; it is bounded by the number of rules.
    """
    slots = 3 * len(RULES)
    table = F.array_sort(F.collect_list(F.struct("pattern", "n")))
    vote = lambda p, k: F.floor(p / F.pow(F.lit(3), k)).cast("int") % 3
    each_rule = F.sequence(F.lit(0), F.lit(len(RULES) - 1))
    one = patterns.groupBy().agg(table.alias("t"))
    one = computed(
        one,
        p=F.transform(
            "t",
            lambda r: F.struct(
                r["pattern"].alias("pattern"),
                r["n"].cast("double").alias("n"),
                # Slots (rule, vote) that this pattern fills.
                F.transform(each_rule, lambda k: k * 3 + vote(r["pattern"], k)).alias("slots"),
            ),
        ),
    )

    def total(weights: Column) -> Column:
        return F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)

    believed = BELIEF_SHARE * total(F.transform("p", lambda r: r["n"]))

    def alarm(s: Column) -> Column:
        """Votes that the belief adds to a slot of the good class."""
        return believed * F.when(s % 3 == 0, BELIEVED_ALARM).otherwise((1 - BELIEVED_ALARM) / 2)

    def shares(mass: Column, added=lambda s: F.lit(0.0), added_total: Column | float = 0.0) -> Column:
        """log P(vote | class) per slot, with the class's mass per pattern."""
        return F.transform(
            F.sequence(F.lit(0), F.lit(slots - 1)),
            lambda s: F.log(
                (
                    total(
                        F.zip_with(
                            F.col("p"),
                            mass,
                            lambda r, m: F.when(
                                F.get(r["slots"], F.floor(s / 3).cast("int")) == s, m
                            ).otherwise(0.0),
                        )
                    )
                    + SMOOTHING
                    + added(s)
                )
                / (total(mass) + 3 * SMOOTHING + added_total)
            ),
        )

    def step(q: Column) -> Column:
        good = F.zip_with("p", q, lambda r, x: r["n"] * x)
        bad = F.zip_with("p", q, lambda r, x: r["n"] * (1 - x))
        # The odds per slot and the prior, bound once for all patterns of this round.
        odds = F.zip_with(shares(good, alarm, believed), shares(bad), lambda a, b: a - b)
        prior = F.log((total(good) + SMOOTHING) / (total(bad) + SMOOTHING))
        bound = F.array(F.struct(odds.alias("odds"), prior.alias("prior")))
        return F.flatten(
            F.transform(
                bound,
                lambda m: F.transform(
                    F.col("p"),
                    lambda r: 1
                    / (
                        1
                        + F.exp(
                            -m["prior"]
                            - F.aggregate(
                                r["slots"], F.lit(0.0), lambda a, s: a + F.get(m["odds"], s)
                            )
                        )
                    ),
                ),
            )
        )

    start = F.transform(
        "p",
        lambda r: F.when(F.exists(r["slots"], lambda s: s % 3 == 0), 0.1).otherwise(0.9),
    )
    fitted = computed(
        one, q=F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda q, _: step(q))
    )
    pairs = F.zip_with("p", "q", lambda r, x: F.struct(r["pattern"].alias("pattern"), x.alias("posterior")))
    return fitted.select(F.inline(pairs))


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) -> the same without text, FEATURES, base_failed, posterior, kept."""
    counts = settle(features(docs).withColumn("pattern", pattern()))
    # At most 3 ** len(RULES) rows, whatever the size of the input.
    verdicts = F.broadcast(settle(posteriors(counts.groupBy("pattern").agg(F.count("*").alias("n")))))
    return (
        counts.join(verdicts, "pattern")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= THRESHOLD))
        .drop("pattern")
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that the rules accept."""
    placed, place = rows.numbered(docs)
    seen = placed.select(place, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.only(placed, place, judge(seen).filter("kept"))
