"""Quality rules: a table of thresholds compiled into one projection of native expressions."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.operators.lateral import computed_once

WHITE = " \t\n\u000b\f\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"

# The most frequent function words of the languages scored.
STOP_WORDS = {
    "en": "the of and to a in is that it was for on with as be by this are at from or an not have he she they which",
    "fr": "de la le et les des en du un une que pour est qui dans par sur pas avec au ne se ce il plus",
    "de": "der die und in den von das zu mit sich für des nicht auf ist im dem ein eine als auch es an",
    "es": "de la que el en y las los del se no con por para un una su es al lo como más",
    "it": "di e il la che in un a per è una sono mi ho lo ha le si ti con non",
    "pt": "de a o que e do da em um para com não uma os no se na por mais as dos",
    "nl": "de van een het en in is dat op te zijn met voor niet aan er om ook als",
}


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts of ``MEASURES`` that must lie between two bounds, both allowed."""

    name: str
    count: str
    of: str
    least: float | None = None
    most: float | None = None


# Clean prose of the four languages lies well inside these bounds; the bounds are not fitted closely to any table.
RULES = (
    Rule("word_length", "word_chars", "n_words", 3, 10),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("shouting", "n_bangs", "n_words", most=0.3),
    Rule("stop_words", "n_stop_words", "n_words", least=0.06),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
)

MIN_WORDS = 50
MAX_REPEATED = 0.5  # share of words in windows that occur again
WINDOW = 3


def _length_of(text: Column, dropped: str) -> Column:
    return F.char_length(F.regexp_replace(text, dropped, ""))


def _repeated_words(words: Column) -> Column:
    """Words covered by windows of three that occur twice or more in the text.

    Windows are compared by 64-bit hash: sorted with their positions, equal ones are neighbours. The
    positions found, in order, each add the words that the one before did not cover.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")),
    )

    def found(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, i: x["h"].eqNullSafe(F.get(ordered, i - 1)["h"]) | x["h"].eqNullSafe(F.get(ordered, i + 1)["h"]),
        )
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    covered = F.aggregate(
        F.transform(F.array(F.array_sort(windows)), found)[0],  # a lambda's argument is computed once
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("words")),
        lambda a, i: F.struct(i.alias("last"), (a["words"] + F.least(F.lit(WINDOW), i - a["last"])).alias("words")),
        lambda a: a["words"].cast("long"),
    )
    return F.when(F.size(words) >= WINDOW, covered).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The frame with one struct column ``measures`` of counts (all long) for each whole text.

    A null text counts as an empty one. Words are runs of anything but ASCII white space. A line is a
    duplicate if it holds a word and equals an earlier line of the same text. The counts are fixed once for each row: a
    filter on them would otherwise move below and take copies of all these expressions along.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    stops = sorted({word for words in STOP_WORDS.values() for word in words.split()})
    trimmed = F.btrim(body, F.lit(WHITE))

    def counted(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            _length_of(body, WHITE_RUN).cast("long").alias("word_chars"),
            _length_of(body, "[^#*$%&|<>]+").cast("long").alias("n_symbols"),
            _length_of(body, "[^!]+").cast("long").alias("n_bangs"),
            F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(",.;:!?"))).isin(stops))).cast("long").alias("n_stop_words"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated_words(words).alias("n_repeat_words"),
        )

    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    bound = F.transform(
        F.array(F.struct(words.alias("words"), lines.alias("lines"))), lambda x: counted(x["words"], x["lines"])
    )
    return computed_once(docs.drop("measures"), measures=bound[0])


def failed_rules(measured: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a struct of measures breaks, in the order of the table.

    Counts are compared with bounds times the other count, so that nothing is divided by zero.
    """

    def broken(rule: Rule) -> Column:
        count, of = measured[rule.count].cast("double"), measured[rule.of].cast("double")
        tests = [count < of * rule.least] if rule.least is not None else []
        tests += [count > of * rule.most] if rule.most is not None else []
        either = tests[0]
        for test in tests[1:]:
            either = either | test
        return F.when(either, F.lit(rule.name))

    return F.array_compact(F.array(*[broken(rule) for rule in rules]))


def base_failed(measured: Column) -> Column:
    return (measured["n_words"] < MIN_WORDS) | (
        measured["n_repeat_words"].cast("double") > MAX_REPEATED * measured["n_words"].cast("double")
    )


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows with ``measures``, ``base_failed``, ``failed`` (names of broken rules) and ``kept``.

    A row is kept if it passes the base test and breaks no rule. Null and empty texts have no words
    and fail the base test. Rows are judged one by one, so ties, repeats and empty tables need no
    care. Columns of these four names in the input are replaced, others pass through.
    """
    m = F.col("measures")
    judged = measures(docs, text).withColumns({"base_failed": base_failed(m), "failed": failed_rules(m, rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base test and verdict for each document."""
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[F.col("measures")[n].alias(n) for n in names], "base_failed", "kept")


def _oracle() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))
    counts = {"n_bangs": "n_bangs", "n_stop_words": "n_stop_words"}
    tests = []
    for rule in RULES:
        count = counts.get(rule.count, rule.count)
        if rule.least is not None:
            tests.append(f"{count} >= {rule.of} * {float(rule.least)}::double")
        if rule.most is not None:
            tests.append(f"{count} <= {rule.of} * {float(rule.most)}::double")
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT row_id, i, words[i : i + {WINDOW - 1}] AS w
  FROM (SELECT row_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM texts WHERE len(words) >= {WINDOW})
),
again AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows) WHERE n > 1
),
repeated AS (
  SELECT row_id, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (VALUES {", ".join(f"({k})" for k in range(WINDOW))}) AS offsets(k) GROUP BY row_id
),
counted AS (
  SELECT doc_id, len(words)::bigint AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint AS n_symbols,
         length(regexp_replace(text, '[^!]+', '', 'g'))::bigint AS n_bangs,
         len(list_filter(words, lambda w: lower(rtrim(w, ',.;:!?')) IN ({stops})))::bigint AS n_stop_words,
         len(lines)::bigint AS n_lines,
         (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint AS n_repeat_words
  FROM texts LEFT JOIN repeated USING (row_id)
),
based AS (
  SELECT *, n_words < {MIN_WORDS} OR n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(tests)} AS kept
FROM based
"""


ORACLE = _oracle()
