"""Quality rules: a threshold table compiled into one projection.

DataFrame functions only, no shuffle: every measure of a document is an
expression over its own text, so the job is a map over the scan.

Defined cases
-------------
* Null or empty text: no words, all counts 0, ``base_failed`` true.
* A line is one of the parts between line feeds; lines without a word are
  never duplicates.
* Ratios of a document without words or lines are 0.
* Repeated rows are judged one by one; other columns are carried in ``row``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import let, name

#: Frequent words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to a in is that it for was on are as with be by this have not he she at from or an they which you "
    "de la que el en y los se del las un por con no una su para es al lo como más pero sus le ya "
    "et les des est dans qui une du pas pour sur au plus par avec ce il elle ne sont son "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es").split()

#: (name, measure, least, most); None: no limit on that side.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("word_length", "mean_word_chars", 2.0, 14.0),
    ("symbols", "symbols_per_word", None, 0.3),
    ("stop_words", "stop_word_share", 0.02, None),
    ("no_letters", "letterless_share", None, 0.4),
    ("exclamations", "exclamations_per_word", None, 0.3),
    ("bullets", "bullet_line_share", None, 0.9),
    ("ellipses", "ellipsis_line_share", None, 0.3),
    ("duplicate_lines", "duplicate_line_share", None, 0.5),
)


def repeated_words(words: Column) -> Column:
    """Words inside a 3-word window that the text holds twice or more.

    The windows' hashes are compared as a set first; only a text with a
    repeat sorts them with their places, where equal ones are neighbours.
    """
    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(placed, lambda s: F.filter(
            s, lambda x, j: x["h"].eqNullSafe(F.get(s, j - 1)["h"]) | x["h"].eqNullSafe(F.get(s, j + 1)["h"])))
        at = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(at))

    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - 3),
                         lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 4, F.lit(0)).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def measured(text: Column) -> Column:
    """Struct of all counts of a text."""
    word = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    line = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(w: Column, ln: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
            F.size(ln).alias("n_word_lines"),
            (F.size(ln) - F.size(F.array_distinct(ln))).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop_words"),
            F.size(F.filter(w, lambda x: ~x.rlike(r"\p{L}"))).alias("n_letterless"),
            F.regexp_count(text, F.lit("!")).alias("n_exclamations"),
            F.size(F.filter(ln, lambda x: x.rlike(r"^[\x20\t]*[-*•]\x20"))).alias("n_bullets"),
            F.size(F.filter(ln, lambda x: x.rlike(r"(\.\.\.|…)[\x20\t\r]*$"))).alias("n_ellipses"))

    return let(word, lambda w: let(line, lambda ln: counts(w, ln)))


def verdict(m: Column, rules=RULES) -> Column:
    """True if every rule of the table holds."""
    measures = {
        "mean_word_chars": share(m["word_chars"], m["n_words"]),
        "symbols_per_word": share(m["n_symbols"], m["n_words"]),
        "stop_word_share": share(m["n_stop_words"], m["n_words"]),
        "letterless_share": share(m["n_letterless"], m["n_words"]),
        "exclamations_per_word": share(m["n_exclamations"], m["n_words"]),
        "bullet_line_share": share(m["n_bullets"], m["n_word_lines"]),
        "ellipsis_line_share": share(m["n_ellipses"], m["n_word_lines"]),
        "duplicate_line_share": share(m["n_dup_lines"], m["n_word_lines"]),
    }
    tests = [t for _, measure, least, most in rules for t in (
        [measures[measure] >= least] if least is not None else []) + (
        [measures[measure] <= most] if most is not None else [])]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def apply_rules(docs: DataFrame, text_col: str = "text", rules=RULES, min_words: int = 50,
                max_repeat_percent: int = 50) -> DataFrame:
    """``row`` and, per row, the counts, ``base_failed`` and ``kept``."""
    text = F.coalesce(docs[name(text_col)], F.lit(""))
    out = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"), measured(text).alias("m"))
    m = F.col("m")
    failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"])
    return out.select("row", "m", failed.alias("base_failed"), (~failed & verdict(m, rules)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    out = apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [F.col(f"m.{c}").cast("long").alias(c)
              for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select("row.doc_id", *counts, "base_failed", "kept")


ORACLE = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ln
  FROM documents
), win AS (
  SELECT doc_id, i, row(w[i], w[i + 1], w[i + 2]) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) v(o) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ln) AS n_lines, len(ln) - len(list_distinct(ln)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(list_filter(w, lambda v: list_contains([{', '.join(repr(s) for s in STOP_WORDS)}], lower(v)))) AS n_stop,
         len(list_filter(w, lambda v: NOT regexp_matches(v, '\pL'))) AS n_letterless,
         length(regexp_replace(x, '[^!]', '', 'g')) AS n_excl,
         len(list_filter(ln, lambda l: regexp_matches(l, '^[\x20\t]*[-*•]\x20'))) AS n_bullets,
         len(list_filter(ln, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\t\r]*$'))) AS n_ellipses
  FROM t LEFT JOIN covered USING (doc_id)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words
       AND n_symbols / n_words <= 0.3 AND n_stop / n_words >= 0.02 AND n_letterless / n_words <= 0.4
       AND n_excl / n_words <= 0.3 AND n_bullets / n_lines <= 0.9 AND n_ellipses / n_lines <= 0.3
       AND n_dup_lines / n_lines <= 0.5 AS kept
FROM f
"""
