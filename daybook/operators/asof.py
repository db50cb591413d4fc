"""As-of join by union and carry: each fact gets the version of its key that is in
force on its date, and no (fact, version) pairs are formed.

Versions and facts are cut into blocks of ``block_days`` days, the facts of a block into
``spread`` parts. A first, small pass gathers the versions of each (key, block) and the
parts that its facts lie in, and carries the last version into the next blocks of the key
that hold rows. Then versions, carried versions and facts are unioned, dealt by
(key, block, part) and sorted by date; the last version before a fact is the last value seen.
A hot key spreads over its blocks, and within a block over the parts; versions go to
those parts only that have facts. The dimension is read once. Work is linear in facts and
versions but for the sort.

The dimension has one version for each key and effective date (``strict`` mode): of several
the one that ends last counts. A version holds on [effective_date, end_date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DAYS = 64
SPREAD = 4


def _block(day: str, days: int) -> Column:
    return F.floor(F.unix_date(F.col(day)) / days)


def asof_carry(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_date: str, how: str = "inner",
               block_days: int = BLOCK_DAYS, spread: int = SPREAD) -> DataFrame:
    """``facts`` and a last column ``version``: a struct of the columns of ``dim``. With
    ``how`` = "left" facts without a version stay, theirs is NULL; facts of a null
    key or date have none."""
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    key_type = facts.schema[fact_key].dataType
    versions = dim.where(F.col(dim_key).isNotNull() & F.col("effective_date").isNotNull()).select(
        F.col(dim_key).cast(key_type).alias("_key"), F.col("effective_date").alias("_date"),
        F.coalesce("end_date", F.lit("9999-12-31").cast("date")).alias("_end"), F.struct(*dim.columns).alias("_version"))
    given = facts.select(F.struct(*(F.col(f"`{c}`") for c in facts.columns)).alias("_fact"),
                         F.col(fact_key).alias("_key"), F.col(fact_date).cast("date").alias("_date"))
    whole = given.where(F.col("_key").isNotNull() & F.col("_date").isNotNull())
    block = _block("_date", block_days).alias("_block")

    part = F.pmod(F.xxhash64("_fact"), F.lit(spread)).cast("int").alias("_part")
    asked = whole.select("_key", block, "_date", "_fact", part)

    # One row for each (key, block) that holds rows: its versions and the parts of its facts.
    own = versions.select("_key", block, F.struct("_date", "_end", "_version").alias("_known"), F.lit(None).cast("int").alias("_part"))
    touched = asked.select("_key", "_block", "_part").distinct()
    blocks = own.unionByName(touched, allowMissingColumns=True).groupBy("_key", "_block").agg(
        F.collect_list("_known").alias("_own"), F.collect_set("_part").alias("_parts"))
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("_own") > 0, F.array_max("_own"))
    carried = blocks.withColumn("_carried", F.last(last, ignorenulls=True).over(before))

    # Versions meet facts only in the parts that have some.
    every = F.concat("_own", F.when(F.col("_carried").isNotNull(), F.array("_carried")).otherwise(F.slice("_own", 1, 0)))
    known = (carried.where(F.size("_parts") > 0).select("_key", "_block", F.explode("_parts").alias("_part"), every.alias("_every"))
             .select("_key", "_block", "_part", F.explode("_every").alias("_known"))
             .select("_key", "_block", "_part", "_known._date", "_known._end", "_known._version"))
    order = (Window.partitionBy("_key", "_block", "_part").orderBy("_date", F.col("_fact").isNotNull(), "_end")
             .rowsBetween(Window.unboundedPreceding, 0))
    seen = F.last(F.when(F.col("_fact").isNull(), F.struct("_end", "_version")), ignorenulls=True).over(order)
    found = (known.unionByName(asked, allowMissingColumns=True).withColumn("_seen", seen).where(F.col("_fact").isNotNull())
             .select("_fact", F.when(F.col("_date") < F.col("_seen._end"), F.col("_seen._version")).alias("version")))
    if how == "inner":
        found = found.where(F.col("version").isNotNull())
    else:
        rest = given.where(F.col("_key").isNull() | F.col("_date").isNull())
        found = found.unionByName(rest.select("_fact", F.lit(None).cast(found.schema["version"].dataType).alias("version")))
    return found.select(*(F.col("_fact").getField(c).alias(c) for c in facts.columns), "version")
