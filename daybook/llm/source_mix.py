"""Mixing sources to target weights by Poisson replication.

Each source has a target repetition rate: its target share of the output over
its share of the input. A document's count is drawn by inverting the Poisson
distribution of that mean at a uniform number hashed from the seed and its id,
so it is the same in every run and on every retry. Documents are exploded by
their counts, then dealt out and sorted by a hash of id and copy, which is a
global shuffle in one exchange that no source or document can skew.

Rates above ``MAX_PART`` are drawn as sums of independent parts, which have
the same distribution and keep each inversion short.

Cases: a null source is a source of its own; a source without a weight gets
``default_weight``; weights of zero drop a source; rows that share an id get
the same count; a null id is hashed as the text "null"; texts of any kind
pass through, and so do other columns; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import fresh, table

MAX_PART = 16.0
#: Terms of the distribution of one part; beyond them less than 1e-15 is left.
TERMS = 64
#: So many sources at most are broadcast; more are joined by a shuffle.
MAX_BROADCAST_SOURCES = 5_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits hashed from the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def target_rates(docs: DataFrame, source_col: str = "source", weights: dict | None = None,
                 default_weight: float = 0.0, alpha: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, n, rate): rate = target share * epochs * all rows / rows of the
    source. Without ``weights`` the share goes with the row count to the power
    ``alpha``."""
    counts = docs.groupBy(F.col(source_col).alias("mix_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n"), F.lit(alpha)))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()],
                                                  "given_source string, given double")
        counts = (counts.join(given, F.col("mix_source").eqNullSafe(F.col("given_source")), "left")
                  .select("mix_source", "n", F.coalesce("given", F.lit(default_weight)).alias("weight")))
    total, weight = counts.agg(F.sum("n"), F.sum("weight")).first()
    if not total or not weight:
        return counts.select("mix_source", "n", F.lit(0.0).alias("rate"))
    return counts.select("mix_source", "n",
                         (F.col("weight") / F.lit(weight) * F.lit(epochs) * F.lit(float(total)) / F.col("n")).alias("rate"))


def _cdf(mean: Column) -> Column:
    """array<double>: P(count <= k) for k = 0, 1, ... of a Poisson distribution."""
    zero = F.exp(-mean)
    start = F.struct(zero.alias("p"), F.array(zero).alias("cdf"))

    def step(a: Column, k: Column) -> Column:
        p = a["p"] * mean / k
        return F.struct(p.alias("p"), F.array_append(a["cdf"], F.element_at(a["cdf"], -1) + p).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda a: a["cdf"])


def mix_sources(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
                copy_col: str | None = None, **targets) -> DataFrame:
    """Each document as often as its Poisson count says, in shuffled order, with
    the number of the copy as the last column, ``copy_col``, if that is given (see
    ``fresh`` for a name that ``docs`` has)."""
    rates = target_rates(docs, source_col, **targets)
    parts = F.greatest(F.ceil(F.col("rate") / MAX_PART), F.lit(1)).cast("int")
    rates = rates.withColumn("parts", parts).withColumn("cdf", _cdf(F.col("rate") / F.col("parts")))
    src, n_parts, cdf, times, copy, key = fresh(docs, "mix_source", "parts", "cdf", "poisson", "mix_copy", "mix_key")
    rates = rates.where("rate > 0").select(F.col("mix_source").alias(src), F.col("parts").alias(n_parts),
                                           F.col("cdf").alias(cdf))
    if rates.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    the_id = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    count = F.aggregate(F.sequence(F.lit(1), F.col(n_parts)), F.lit(0), lambda total, j: total + F.size(
        F.filter(F.col(cdf), lambda c: c <= uniform(F.lit(str(seed)), the_id, j.cast("string")))))
    copies = F.explode(F.when(F.col(times) > 0, F.sequence(F.lit(1), F.col(times))))
    dealt = (docs.join(rates, F.col(source_col).eqNullSafe(F.col(src)))
             .withColumn(times, count).withColumn(copy, copies)
             .withColumn(key, F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), the_id, F.col(copy).cast("string"))))
             .repartition(F.col(key)).sortWithinPartitions(key))
    extra = [F.col(copy).alias(*fresh(docs, copy_col))] if copy_col else []
    return dealt.select(*(F.col(f"`{c}`") for c in docs.columns), *extra)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs, copy_col="copy")


ORACLE = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, sqrt(n) / (SELECT sum(sqrt(n)) FROM n) * (SELECT count(*) FROM documents) / n AS rate FROM n),
p AS (SELECT source, rate, greatest(ceil(rate / {MAX_PART}), 1)::INT AS parts FROM r),
pmf AS (SELECT source, parts, k, exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)) AS p
        FROM p, range(0, {TERMS + 1}) t(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
u AS (SELECT doc_id, d.source, text, ('0x' || substr(md5('17:' || doc_id || ':' || j), 1, 13))::BIGINT
             / 4503599627370496.0::DOUBLE AS u
      FROM documents d JOIN p ON d.source IS NOT DISTINCT FROM p.source, range(1, 1000) t(j) WHERE j <= parts),
counts AS (SELECT doc_id, u.source, text, sum((SELECT count(*) FROM cdf WHERE cdf.source = u.source AND c <= u)) AS n
           FROM u GROUP BY ALL)
SELECT doc_id, source, text, copy::INT AS copy FROM counts, range(1, 10000) t(copy) WHERE copy <= n
"""
