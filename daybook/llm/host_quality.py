"""Quality rules by host: rule failures aggregated by domain, shrunk, joined back.

Every document is measured by base rules over its whole text. The failure
rate of each host is shrunk towards the rate of all hosts by a beta prior
whose strength is fitted to the spread of the hosts' rates (method of
moments), less the spread that chance alone gives rates of so few documents: a host of
few documents stays near the mean, a large one keeps its own rate. A document is kept if it passes the base rules and the shrunk rate
of its host is not above the limit.

Cases: a null or empty text has no words and fails; a null host is a host of
its own; rows that share an id are separate rows, counted and returned each;
an empty table gives no rows; only the id, text and host columns are read. A
text of any length is measured whole, in time n log n of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import BLANKS, let, stored, table

#: Symbols counted by the base rules.
SYMBOLS = "#*$%&|<>"
A_WORD = "[^ \\t\\n\\x0B\\f\\r]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host is rejected above this shrunk failure rate: most of it fails.
MAX_HOST_RATE = 0.5


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more."""

    def covered(hashes: Column) -> Column:
        def of(s: Column) -> Column:
            again = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"]))
                             | (F.get(s, i + 1)["h"].eqNullSafe(x["h"])))
            at = F.sort_array(F.transform(again, lambda x: x["i"]))
            return let(at, lambda p: F.aggregate(
                F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                           lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
                F.lit(0), lambda total, x: total + x))
        return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of)

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - WINDOW + 1),
                           lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(let(hashes, windows), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Base measures and verdict of each document: one pass, no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(A_WORD)))
    counted = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                      F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                                      _repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return (counted.select("doc_id", "host", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")
            .withColumn("base_failed", failed))


def host_rates(measured: DataFrame) -> DataFrame:
    """(host, n, failures, shrunk_rate) with the empirical beta prior. The
    numbers of the prior are all that reaches the driver. A host's rate of n
    documents varies by mean * (1 - mean) / n about its true rate; what is left of the
    variance of the rates is that of the true ones."""
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.col("base_failed").cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("n")
    mean, var, inverse = hosts.agg(F.sum("failures") / F.sum("n"), F.var_pop(rate), F.avg(1 / F.col("n"))).first()
    mean = mean or 0.0
    var = (var or 0.0) - mean * (1 - mean) * (inverse or 0.0)
    strength = max(mean * (1 - mean) / var - 1, 0.0) if var > 0 else 1e6
    shrunk = (F.col("failures") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.withColumn("shrunk_rate", shrunk)


def judge_by_host(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, ``base_failed``, ``host_rate`` and ``kept`` of each document.

    The measures (numbers only) are stored in the shared folder, so texts are
    read and split once; the verdicts, one row per host, join back to them."""
    measured = stored(measure(docs, id_col, text_col, host_col), "host-quality")
    rates = host_rates(measured).select(F.col("host").alias("rated_host"), F.col("shrunk_rate").alias("host_rate"))
    return (measured.join(rates, F.col("host").eqNullSafe(F.col("rated_host")), "left").drop("rated_host")
            .withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)))


def op10_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (judge_by_host(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text,
        list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM d),
win AS (SELECT doc_id, unnest(range(1, len(words) - {WINDOW} + 2)) AS i,
          unnest([words[k:k+{WINDOW - 1}] for k in range(1, len(words) - {WINDOW} + 2)]) AS g FROM w),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n FROM
         (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
        length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
        (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b GROUP BY source),
q AS (SELECT sum(f) / sum(n) AS mean, var_pop(f / n) AS v, avg(1 / n) AS inverse FROM h),
p AS (SELECT mean, v - mean * (1 - mean) * inverse AS v FROM q),
s AS (SELECT mean, CASE WHEN v > 0 THEN greatest(mean * (1 - mean) / v - 1, 0) ELSE 1e6 END AS strength FROM p),
r AS (SELECT source, (f + mean * strength) / (n + strength) AS rate FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= {MAX_HOST_RATE} AS kept
FROM b JOIN r ON b.source IS NOT DISTINCT FROM r.source
"""
