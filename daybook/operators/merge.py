"""Merge of staged batches into a type-2 dimension, dealt once by key.

The dimension is read as its change log: a slim row for each version written
(key, effective date, one digest for each tracked column) and one for each version
ended since. The log and the batch are unioned with a tag and dealt by key; sorted by
(key, date, tag), one pass over each key

* drops versions that have ended and batch rows whose (key, date) is loaded,
* chooses the survivor among several rows of one (key, date),
* ends versions and inserts new ones, in ``as_written`` or ``strict`` mode.

There is no join: neither the texts of the dimension nor any of its columns beside the
key, the date and the digests are read. What is written are the inserted versions
in full and, for a version that ends, its key, date and end.

A digest is the MD5 of the column's text, NULL for NULL. Equal values have equal
digests, so a plain ``!=`` (NULL is never a difference) and a null-safe comparison both
work on them; two different values of one key that share 128 bits are not told apart.

A key's rows meet in one task: its open versions and its rows of the batch, sorted
outside memory if they are many. Copies are reduced before (staging is DISTINCT).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.expressions import DIM_FLOOR_DATE
from daybook.operators.scd2 import AS_WRITTEN, STRICT, Scd2Spec

#: Kinds of rows of the change log.
OPEN, ENDED, CLOSING = "open", "ended", "closing"
DIGESTS = "digests"
DIGESTS_TYPE = T.ArrayType(T.BinaryType())

# Order of the rows of one (key, date): a version that has ended, an open one, the batch.
_ENDED, _VERSION, _BATCH = 0, 1, 2


def digests(columns: list[str]) -> Column:
    """array<binary>: a digest for each column, NULL for NULL."""
    return F.array(*(F.unhex(F.md5(F.col(c).cast("string"))) for c in columns))


def _runs(rows: DataFrame, spec: Scd2Spec) -> Column:
    """The first later date at which a tracked column differs under plain ``!=``: per
    column the next start of a run among its non-NULL digests, see ``scd2``."""
    before = Window.partitionBy(spec.key).orderBy("effective_date").rowsBetween(Window.unboundedPreceding, -1)
    return F.array(*(
        (d := F.get(DIGESTS, F.lit(i))).isNotNull()
        & F.coalesce(F.last(d, ignorenulls=True).over(before) != d, F.lit(True))
        for i in range(len(spec.tracked))))


def _as_written(rows: DataFrame, spec: Scd2Spec) -> DataFrame:
    after = (Window.partitionBy(spec.key).orderBy(F.desc("effective_date"))
             .rowsBetween(Window.unboundedPreceding, -1))
    ends = [F.when(F.get(DIGESTS, F.lit(i)).isNotNull(),
                   F.min(F.when(F.get("_starts", F.lit(i)), F.col("effective_date"))).over(after))
            for i in range(len(spec.tracked))]
    return (rows.withColumn("_starts", _runs(rows, spec))
            .withColumn("end_date", ends[0] if len(ends) == 1 else F.least(*ends)))


def _strict(rows: DataFrame, spec: Scd2Spec) -> DataFrame:
    order = Window.partitionBy(spec.key).orderBy("effective_date")
    same = F.lag(DIGESTS).over(order).eqNullSafe(F.col(DIGESTS)) & F.lag(F.lit(1)).over(order).isNotNull()
    kept = rows.withColumn("_same", same).where(~F.col("_same"))
    return kept.withColumn("end_date", F.lead("effective_date").over(order))


def merge_changes(log: DataFrame, batch: DataFrame, spec: Scd2Spec, mode: str = AS_WRITTEN,
                  load_col: str = "load_date", high_water: Column | None = None) -> DataFrame:
    """The changes that ``batch`` makes: the value columns, effective_date, end_date,
    digests and ``kind`` (open, ended: an inserted version; closing: a version of the
    log that ends, its value columns NULL).

    ``log``: key, effective_date, digests, kind (open or closing). ``high_water``: the
    dimension's greatest effective date; rows loaded before it are ignored. The batch
    may span several load dates: the result is that of its dates one by one."""
    if mode not in (AS_WRITTEN, STRICT):
        raise ValueError(f"unknown SCD2 mode {mode!r}")
    values = [c for c in spec.value_columns if c != spec.key]
    given = batch.where(F.col(load_col) >= F.coalesce(high_water, F.lit(DIM_FLOOR_DATE).cast("date"))
                        if high_water is not None else F.lit(True))
    new = given.select(spec.key, F.col(load_col).alias("effective_date"), digests(spec.tracked).alias(DIGESTS),
                       F.lit(_BATCH).alias("_tag"), *values)
    old = log.select(spec.key, "effective_date", DIGESTS,
                     F.when(F.col("kind") == CLOSING, _ENDED).otherwise(_VERSION).alias("_tag"))
    every = new.unionByName(old, allowMissingColumns=True).repartition(spec.key)
    # A struct orders NULL first, so does the dedupe of a whole history.
    best = [*spec.prefer, *(c for c in values if c not in spec.prefer)]
    turn = F.row_number().over(Window.partitionBy(spec.key, "effective_date")
                               .orderBy("_tag", *(F.desc_nulls_last(c) for c in best)))
    # A null key or date is no version's; the first row of a (key, date) speaks for it.
    rows = every.withColumn("_turn", turn).where((F.col("_turn") == 1) & (F.col("_tag") != _ENDED))
    out = (_as_written if mode == AS_WRITTEN else _strict)(rows, spec)
    seed, ends = F.col("_tag") == _VERSION, F.col("end_date").isNotNull()
    kind = F.when(seed, CLOSING).when(ends, ENDED).otherwise(OPEN)
    return out.where(~seed | ends).select(*spec.value_columns, "effective_date", "end_date", DIGESTS, kind.alias("kind"))
