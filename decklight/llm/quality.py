"""Quality rules (operator 2), as one projection of built-in functions.

``RULES`` is the threshold table: each row bounds one measure of a text.
``rule_columns`` compiles it into Column expressions; no user function runs.

Defined results: a null or empty text has no words and fails; equal texts get
equal results; very long texts are read whole; an empty table gives an empty table.
``quality_measures`` returns doc_id and measures only, so other columns cannot clash;
``quality_filter`` adds no columns.

Windows of three words are compared by a 64-bit hash of the words.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .shared import WORD_GAP, text_or_empty

SYMBOLS = "#*$%&|<>"

#: Frequent short words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from have in is it of on that the this to was with "
    "au avec dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "das dem den der die ein eine für ich ist mit nicht sie und von zu "
    "con como del el es los las más no para por se su una y"
).split()


class Rule(NamedTuple):
    measure: str
    least: float | None
    most: float | None


#: A text is kept if it passes the base check and every one of these.
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.3),
    Rule("stop_word_ratio", 0.01, None),
    Rule("dup_line_ratio", None, 0.5),
)


def quality_measures(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """(doc_id, counts) of each row; with ``whole_rows`` also the row itself, as the struct ``row``."""
    row = [F.struct(*docs.columns).alias("row")] if whole_rows else []
    base = docs.select("doc_id", text_or_empty().alias("text"), *row)
    split = base.select(
        "doc_id",
        *(["row"] if row else []),
        F.filter(F.split("text", WORD_GAP), lambda w: w != "").alias("words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]")).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        *(["row"] if row else []),
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.when(F.size("words") >= 3, _window_hashes(F.col("words"))).alias("windows"),
    )
    placed = counted.select(
        *[c for c in counted.columns if c != "windows"],
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("placed"),
    )
    at = placed.select(*[c for c in placed.columns if c != "placed"], _repeated_starts(F.col("placed")).alias("at"))
    return at.select(
        *[c for c in at.columns if c != "at"],
        F.coalesce(_covered(F.col("at")), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _window_hashes(words: Column) -> Column:
    at = F.sequence(F.lit(0), F.size(words) - 3)
    return F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))


def _repeated_starts(placed: Column) -> Column:
    """Starts, ascending, of the windows that are found twice or more."""
    same = lambda s, k: F.coalesce(F.get(placed, k)["h"] == s["h"], F.lit(False))
    found = F.filter(placed, lambda s, k: same(s, k - 1) | same(s, k + 1))
    return F.sort_array(F.transform(found, lambda s: s["i"]))


def _covered(at: Column) -> Column:
    """Words in the union of the three-word windows that start at ``at``."""
    new = F.transform(at, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(at, k - 1))))
    return F.aggregate(new, F.lit(0), lambda total, n: total + n)


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "mean_word_chars": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "stop_word_ratio": F.col("n_stop_words") / words,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


def rule_columns(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """One boolean Column per bound in the table."""
    measure = ratios()
    out = []
    for rule in rules:
        if rule.least is not None:
            out.append(measure[rule.measure] >= F.lit(rule.least))
        if rule.most is not None:
            out.append(measure[rule.measure] <= F.lit(rule.most))
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def kept(rules: tuple[Rule, ...] = RULES) -> Column:
    passed = ~base_failed()
    for column in rule_columns(rules):
        passed = passed & column
    return passed


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    return quality_measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), kept(rules).alias("kept"),
    )


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The kept rows of ``docs``, with their own columns.

    The verdict passes through a generator, for a filter is not pushed below one:
    pushed down it would repeat the array expressions within each other.
    """
    judged = quality_measures(docs, whole_rows=True).select("row", F.explode(F.array(kept(rules))).alias("kept"))
    return judged.where("kept").select("row.*")


def op2_quality_rules(docs: DataFrame) -> DataFrame:
    return quality_verdicts(docs)


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
_DELIMITERS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: The same counts and verdict for DuckDB.
OP2_SQL = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ \x09-\x0D]')) AS lines
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER () AS rid FROM split
), windows AS (
  SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM numbered WHERE len(words) >= 3
), counted AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n FROM windows
), covered AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE n >= 2) GROUP BY rid
), measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(translate(text, {_DELIMITERS}, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_filter(words, lambda w: lower(w) IN ({_STOP_SQL}))) AS BIGINT) AS n_stop_words,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM numbered LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, greatest(n_words, 1) AS w FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / w >= 2.0 AND word_chars / w <= 15.0 AND n_symbols / w <= 0.3
       AND n_stop_words / w >= 0.01 AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AS kept
FROM judged
"""
