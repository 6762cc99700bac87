"""Rule-based quality filter: a table of thresholds compiled into one projection.

A rule bounds a ratio of two counts of the text. Bounds are in thousandths and compared as
integers, so no rounding decides a verdict.

Null and blank texts have zero of everything and fail the word minimum. Ties at a bound pass.
Repeated rows are judged one by one, and an empty table gives an empty one. The counts of the text
replace columns of the same names; all other columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import SPACE, need, words_of

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the and of to in is that for was with on as by at be this it are from or an a "
    "der die das und ist zu mit von für den ein eine nicht auf im sich des dem "
    "le la les et de des un une en que dans du pour qui est sur par pas avec au "
    "el los las y se del por con para no su es lo una como al"
).split()


@dataclass(frozen=True)
class Rule:
    """1000 * numerator must lie between low and high times the denominator."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", 2500, 12000),
    Rule("symbols", "n_symbols", "n_words", None, 100),
    Rule("stop_words", "n_stop_words", "n_words", 20, None),
    Rule("letters", "n_letter_words", "n_words", 700, None),
    Rule("shouting", "n_shout_words", "n_words", None, 200),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 900),
    Rule("cut_lines", "n_cut_lines", "n_lines", None, 300),
)
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_stop_words", "n_letter_words", "n_shout_words",
    "n_lines", "n_dup_lines", "n_bullet_lines", "n_cut_lines", "n_repeat_words",
)


def verdict(rules: Sequence[Rule]) -> Column:
    """The whole table as one condition."""
    kept = F.lit(True)
    for r in rules:
        value, unit = F.col(r.numerator) * 1000, F.col(r.denominator)
        if r.low is not None:
            kept = kept & (value >= unit * r.low)
        if r.high is not None:
            kept = kept & (value <= unit * r.high)
    return kept


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)


def text_counts(docs: DataFrame, text: str = "text", window: int = 3) -> DataFrame:
    """Add the counts the rules use.

    A word repeats if a window of ``window`` words over it occurs twice or more in the text. Windows
    are ordered by a 64-bit hash next to their place, so equal ones are neighbours and the cost
    is n log n for any length; a false match within one text of a million words has odds of 1 in 10^7.
    """
    need(docs, text)
    t = F.coalesce(F.col("_t"), F.lit(""))
    base = docs.drop(*(c for c in docs.columns if c in COUNTS)).withColumn("_t", F.col(text).cast("string"))
    base = base.withColumn("_w", words_of(F.col("_t"))).withColumn(
        "_l", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    w, lines = F.col("_w"), F.col("_l")
    base = base.withColumn("_g", F.when(F.size(w) >= window, F.sort_array(F.transform(
        F.slice(w, F.lit(1), F.size(w) - (window - 1)),
        lambda x, i: F.struct(F.xxhash64(x, *(F.get(w, i + k) for k in range(1, window))).alias("h"), i.alias("i")),
    ))))
    g = F.col("_g")
    # Neighbours in hash order that are equal are windows that occur again.
    base = base.withColumn("_p", F.sort_array(F.transform(F.filter(
        g, lambda x, i: F.coalesce(x["h"] == F.get(g, i + 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(g, i - 1)["h"], F.lit(False))), lambda x: x["i"])))
    p = F.col("_p")
    steps = F.zip_with(p, F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(1))), lambda a, b: F.least(b - a, F.lit(window)))
    covered = F.when(F.size(p) > 0, F.aggregate(steps, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(window))))

    def count(array: Column) -> Column:
        return F.size(array).cast("long")

    def chars(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, "")).cast("long")

    return base.withColumns({
        "n_words": count(w),
        "word_chars": chars(SPACE + "+"),
        "n_symbols": chars(r"[^#*$%&|<>]+"),
        "n_stop_words": count(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))),
        "n_letter_words": count(F.filter(w, lambda x: x.rlike(r"\p{L}"))),
        "n_shout_words": count(F.filter(w, lambda x: x.endswith("!!"))),
        "n_lines": count(lines),
        "n_dup_lines": count(lines) - count(F.array_distinct(lines)),
        "n_bullet_lines": count(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))),
        "n_cut_lines": count(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }).drop("_t", "_w", "_l", "_g", "_p")


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every document."""
    return text_counts(docs.drop("base_failed", "kept"), text).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules))


def kept_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns only.

    The judged rows are counted on their way (``quality_rules`` among the query's observed metrics). That also keeps the
    optimizer from moving the filter below the counts, where it would repeat every count in each place it is used.
    """
    judged = judge(docs.withColumns({f"_own_{c}": F.col(c) for c in docs.columns}), rules, text)
    seen = judged.observe("quality_rules", F.count(F.lit(1)).alias("judged"), F.count_if("kept").alias("kept"))
    return seen.filter("kept").select(*(F.col(f"_own_{c}").alias(c) for c in docs.columns))


def rules_sql(rules: Sequence[Rule] = RULES) -> str:
    parts = []
    for r in rules:
        if r.low is not None:
            parts.append(f"1000 * {r.numerator} >= {r.low} * {r.denominator}")
        if r.high is not None:
            parts.append(f"1000 * {r.numerator} <= {r.high} * {r.denominator}")
    return " AND ".join(parts)


def judged_sql(source: str = "documents") -> str:
    """The verdict in SQL: one row per document of ``source`` with all counts."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, * FROM {source}),
w AS (SELECT rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
p AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM g) WHERE c > 1),
r AS (SELECT rid, sum(least(3, coalesce(nxt - i, 3))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM p) GROUP BY rid),
c AS (SELECT w.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words,
  CAST(len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS BIGINT) AS n_letter_words,
  CAST(len(list_filter(w, lambda x: x LIKE '%!!')) AS BIGINT) AS n_shout_words,
  CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  CAST(len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
  CAST(len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS BIGINT) AS n_cut_lines,
  CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN r ON w.rid = r.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND {rules_sql()} AS kept FROM b"""
