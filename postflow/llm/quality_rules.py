"""Quality rules: a table of thresholds compiled into one Spark projection, without functions of
the user."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import WHITE, filled, whole_row

# Frequent words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it on with as was be by this are at from or "
    "de la le les et des en un une du est que qui dans pour pas sur avec au "
    "der die und das den von zu mit sich ist im auf für als dem nicht ein eine "
    "el los las del por con una su para es no se lo al y").split()
SYMBOLS = "#*$%&|<>"

# A document is rejected if one of its figures lies outside (least, most). The bounds hold for
# every text of at least 50 words; shorter ones fail the base rule anyway.
THRESHOLDS: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("mean_word_chars", "word_chars / n_words", 1.5, 20.0),
    ("symbols_per_word", "n_symbols / n_words", None, 0.25),
    ("stop_word_share", "n_stop_words / n_words", 0.02, None),
    ("repeated_line_share", "n_dup_lines / n_lines", None, 0.5),
    ("upper_case_share", "n_upper_words / n_words", None, 0.5),
)
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50


def repeated_words(words: str) -> tuple[Column, Column]:
    """Two steps: the hashed 3-word windows of an array column in order of hash, and from them
    (as column ``windows``) the number of words that lie in a window found twice or more."""
    at = F.col(words)
    windows = F.when(F.size(at) >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(at) - 3, F.lit(0))),
        lambda i: F.struct(F.xxhash64(F.get(at, i), F.get(at, i + 1), F.get(at, i + 2)).alias("h"),
                           i.alias("p")))))
    sorted_ = F.col("windows")
    twice = F.filter(sorted_, lambda x, i: (
        (F.get(sorted_, i - 1)["h"] == x["h"]) | (F.get(sorted_, i + 1)["h"] == x["h"])))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))
    return windows, F.coalesce(covered, F.lit(0)).cast("long")


def measured(docs: DataFrame, text: str, carried: list[Column]) -> DataFrame:
    """The carried columns and every figure that the rules read."""
    body = filled(text)
    letters = F.translate(F.col("body"), SYMBOLS, "")
    split = docs.select(*carried, body.alias("body"))
    split = split.select(
        "*",
        F.filter(F.split("body", WHITE), lambda w: w != "").alias("words"),
        F.filter(F.split("body", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.char_length(F.regexp_replace("body", WHITE, "")).cast("long").alias("word_chars"),
        (F.char_length("body") - F.char_length(letters)).cast("long").alias("n_symbols"))
    windows, repeated = repeated_words("words")
    names = [x for x in split.columns if x not in ("body", "words", "lines")]
    counted = split.select(
        *names,
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: (w == F.upper(w)) & (w != F.lower(w))))
        .cast("long").alias("n_upper_words"),
        windows.alias("windows"))
    return counted.withColumn("n_repeat_words", repeated).drop("windows")


def base_failed() -> Column:
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))


def within(thresholds=THRESHOLDS) -> Column:
    """The threshold table as one condition; an undefined ratio (nothing to divide by) passes."""
    bounds = []
    for _, ratio, least, most in thresholds:
        over, under = (F.col(x) for x in ratio.split(" / "))
        value = F.when(under > 0, over / under)
        if least is not None:
            bounds.append(F.coalesce(value >= least, F.lit(True)))
        if most is not None:
            bounds.append(F.coalesce(value <= most, F.lit(True)))
    return reduce(Column.__and__, bounds)


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the figures, base_failed and kept.

    A null or empty text has no words and fails the base rule; repeated rows are judged alike; an
    empty table gives an empty result; other columns of ``docs`` are not read. Texts of any length
    are read whole: the repeated windows are found by sorting, in n log n steps.
    """
    rows = measured(docs, text, [F.col(key).alias("doc_id")])
    return rows.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & within())


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    # A filter on a column that isn't deterministic stays above the figures; else the optimizer
    # would put their expressions into the filter, once for each place that reads them.
    rows = measured(docs, text, [whole_row(docs)]).withColumn("task", F.spark_partition_id())
    kept = ~base_failed() & within() & (F.col("task") >= 0)
    return rows.filter(kept).select("whole_row.*")


def query_sql() -> str:
    """The same for DuckDB, from the same table of thresholds."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    bounds = []
    for _, ratio, least, most in THRESHOLDS:
        under = ratio.split(" / ")[1]
        value = f"CASE WHEN {under} > 0 THEN {ratio} END"
        bounds += [f"coalesce({value} >= {least}, true)"] if least is not None else []
        bounds += [f"coalesce({value} <= {most}, true)"] if most is not None else []
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body FROM documents),
split AS (
  SELECT doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM split WHERE len(words) >= 3),
windows AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, words[p], words[p + 1], words[p + 2]) AS n
  FROM places),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM windows WHERE n >= 2) GROUP BY doc_id),
figures AS (
  SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_filter(words, lambda w: w IN ({stop}))) AS BIGINT) AS n_stop_words,
         CAST(len(list_filter(words, lambda w: w = upper(w) AND w <> lower(w))) AS BIGINT) AS n_upper_words,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed
  FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(bounds)} AS kept
FROM judged
"""
