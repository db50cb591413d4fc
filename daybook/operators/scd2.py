"""Slowly changing dimensions, type 2.

Two modes:

``as_written`` — the warehouse models' behaviour: every incoming row becomes
a new version whether or not it changed; an active version is closed by the
first later load whose tracked values differ under plain ``!=`` (NULL on
either side never counts as a difference). A key can have several active
versions.

``strict`` — insert only on change (NULL-safe comparison); one active
version per key; half-open validity ``[effective_date, end_date)``.

Two ways to build, with identical results:

``scd2_history`` — all load batches in one job, no loop. One shuffle on the
entity key, then window passes inside each key. The rows per key are one
per load date after the (key, date) dedupe, so even the hottest key holds at
most as many rows as there are load days.

``scd2_apply`` — one daily batch merged into an existing target (the
incremental model), via ``keyed_upsert``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.expressions import changed, null_date
from daybook.operators.clean import dedupe_by_key
from daybook.operators.upsert import gate, keyed_upsert, not_yet_loaded

AS_WRITTEN, STRICT = "as_written", "strict"


@dataclass(frozen=True)
class Scd2Spec:
    key: str
    tracked: list[str]
    # Carried along but never compared.
    carried: list[str] = field(default_factory=list)
    # Preferred survivor among several rows of one (key, load date), greatest
    # first; ties are broken by all remaining columns.
    prefer: list[str] = field(default_factory=list)
    # Column order of the dimension table (before the validity columns).
    columns: list[str] = field(default_factory=list)

    @property
    def value_columns(self) -> list[str]:
        return self.columns or [self.key] + self.tracked + self.carried


PRODUCTS = Scd2Spec(
    key="product_id",
    tracked=["product_name", "product_description", "product_inventory_status"],
)

COMMENTS = Scd2Spec(
    key="comment_id",
    tracked=["comment_content", "comment_rating", "days_to_review", "rating_valid"],
    carried=["product_id", "sentiment", "created_at", "purchased_at"],
    prefer=["created_at"],
    columns=["comment_id", "product_id", "sentiment", "comment_content", "comment_rating",
             "created_at", "purchased_at", "days_to_review", "rating_valid"],
)

VALIDITY = ["effective_date", "end_date", "is_active"]


def _versions(stg: DataFrame, spec: Scd2Spec, load_col: str = "load_date") -> DataFrame:
    """Incoming rows as candidate versions: one per (key, load date)."""
    df = stg.select(*spec.value_columns, F.col(load_col).alias("effective_date"))
    return dedupe_by_key(df, [spec.key, "effective_date"], spec.prefer)


def _as_written_end(df: DataFrame, spec: Scd2Spec, extra: tuple[str, ...] = ()) -> DataFrame:
    """End date of every version under the as-written rule, without pairing
    rows: per tracked column c, a version with non-NULL c is closed by the
    first later version whose c is non-NULL and different, and that is the
    next start of a run in the non-NULL subsequence of c. Two window passes
    over the same key partitioning (ascending, then descending), no extra
    shuffle, O(rows) per key."""
    key, eff = spec.key, F.col("effective_date")
    asc_prev = Window.partitionBy(key).orderBy("effective_date").rowsBetween(Window.unboundedPreceding, -1)
    desc_prev = (Window.partitionBy(key).orderBy(F.desc("effective_date"))
                 .rowsBetween(Window.unboundedPreceding, -1))
    starts = []
    for i, c in enumerate(spec.tracked):
        prev_nn = F.last(F.col(c), ignorenulls=True).over(asc_prev)
        starts.append(F.col(c).isNotNull() & (prev_nn.isNull() | (prev_nn != F.col(c))))
    df = df.select("*", *[s.alias(f"_start{i}") for i, s in enumerate(starts)])
    ends = [F.when(F.col(c).isNotNull(),
                   F.min(F.when(F.col(f"_start{i}"), eff)).over(desc_prev))
            for i, c in enumerate(spec.tracked)]
    end = ends[0] if len(ends) == 1 else F.least(*ends)
    return (df.select(*spec.value_columns, "effective_date", end.alias("end_date"), *extra)
              .withColumn("is_active", F.col("end_date").isNull()))


def _strict_runs(df: DataFrame, spec: Scd2Spec, extra: tuple[str, ...] = ()) -> DataFrame:
    """Keep the first version of each run of NULL-safe-equal tracked values;
    its end is the next kept version's start."""
    w = Window.partitionBy(spec.key).orderBy("effective_date")
    first = F.lag(F.lit(1)).over(w).isNull()
    same = reduce(and_, [F.lag(F.col(c)).over(w).eqNullSafe(F.col(c)) for c in spec.tracked])
    kept = df.withColumn("_start", first | ~same).where("_start")
    return (kept.withColumn("end_date", F.lead("effective_date").over(w))
                .withColumn("is_active", F.col("end_date").isNull())
                .select(*spec.value_columns, *VALIDITY, *extra))


def scd2_history(stg: DataFrame, spec: Scd2Spec, mode: str = AS_WRITTEN,
                 load_col: str = "load_date") -> DataFrame:
    """The dimension that loading every batch of ``stg`` in date order gives."""
    v = _versions(stg, spec, load_col)
    if mode == AS_WRITTEN:
        return _as_written_end(v, spec)
    if mode == STRICT:
        return _strict_runs(v, spec)
    raise ValueError(f"unknown SCD2 mode {mode!r}")


def incoming(target: DataFrame, batch: DataFrame, spec: Scd2Spec,
             load_col: str = "load_date") -> DataFrame:
    """Rows of one batch that the dimension takes in: at or after the
    target's newest effective date, (key, date) not already present, one per
    (key, date)."""
    b = gate(batch, target, load_col, "effective_date", inclusive=True)
    b = not_yet_loaded(b, target, spec.key, load_col, "effective_date")
    return _versions(b, spec, load_col)


def scd2_delta(target: DataFrame, batch: DataFrame, spec: Scd2Spec,
               mode: str = AS_WRITTEN, load_col: str = "load_date") -> DataFrame:
    """The rows one batch writes into the dimension: new versions plus the
    closed versions they end. A batch carries one load date (staging gives
    exactly that); for many dates at once use ``scd2_history``."""
    inc = incoming(target, batch, spec, load_col)
    active = target.where(F.col("is_active") & F.col("end_date").isNull())
    # Only active versions of keys present in the batch can close.
    e = active.join(inc.select(spec.key).distinct(), spec.key, "left_semi").alias("e")
    n = inc.alias("n")
    null_safe = mode == STRICT
    pairs = e.join(n, F.col(f"e.{spec.key}") == F.col(f"n.{spec.key}"))
    closed = (pairs.where(changed("e", "n", spec.tracked, null_safe))
                   .select(*[F.col(f"e.{c}").alias(c) for c in spec.value_columns],
                           F.col("e.effective_date"),
                           F.col("n.effective_date").alias("end_date"),
                           F.lit(False).alias("is_active")))
    new = inc
    if mode == STRICT:
        # Insert only keys that are new or whose active version changed.
        unchanged = pairs.where(~changed("e", "n", spec.tracked, True)).select(F.col(f"n.{spec.key}").alias(spec.key))
        new = inc.join(unchanged, spec.key, "left_anti")
    new = new.select(*spec.value_columns, "effective_date",
                     null_date().alias("end_date"), F.lit(True).alias("is_active"))
    # The delta is already one row per (key, effective_date), so the model's
    # final one-row-per-(key, date) guard has nothing to remove: new rows are
    # deduped and absent from the target (anti join), and a closed row keeps
    # its older target date, which no new row of the batch can carry.
    return new.unionByName(closed)


def scd2_apply(target: DataFrame, batch: DataFrame, spec: Scd2Spec,
               mode: str = AS_WRITTEN, load_col: str = "load_date") -> DataFrame:
    """Target after merging one batch on (key, effective_date)."""
    target = target.select(*spec.value_columns, *VALIDITY)
    delta = scd2_delta(target, batch, spec, mode, load_col)
    return keyed_upsert(target, delta, [spec.key, "effective_date"])


def scd2_merge_delta(target: DataFrame, batch: DataFrame, spec: Scd2Spec,
                     mode: str = AS_WRITTEN, load_col: str = "load_date") -> DataFrame:
    """The rows that a batch of several load dates writes into the dimension,
    in one job and with the same result as applying its dates one by one.

    The active versions of the batch's keys seed the same window pass that
    ``scd2_history`` runs: every seed is older than the batch rows of its
    key (the gate and the (key, date) anti join guarantee it), a seed can
    only be closed by a batch row, and under the as-written rule an active
    seed never differs from a later active seed (it would have been closed),
    so the window end dates are exactly the loop's. Seeds whose end did not
    change are not written."""
    target = target.select(*spec.value_columns, *VALIDITY)
    inc = incoming(target, batch, spec, load_col)
    keys = inc.select(spec.key).distinct()
    seeds = (target.where(F.col("is_active") & F.col("end_date").isNull())
                   .join(keys, spec.key, "left_semi")
                   .select(*spec.value_columns, "effective_date", F.lit(True).alias("_seed")))
    rows = seeds.unionByName(inc.withColumn("_seed", F.lit(False)))
    if mode == AS_WRITTEN:
        out = _as_written_end(rows, spec, ("_seed",))
    elif mode == STRICT:
        out = _strict_runs(rows, spec, ("_seed",))
    else:
        raise ValueError(f"unknown SCD2 mode {mode!r}")
    return out.where(~F.col("_seed") | F.col("end_date").isNotNull()).drop("_seed")


def scd2_merge(target: DataFrame, batch: DataFrame, spec: Scd2Spec,
               mode: str = AS_WRITTEN, load_col: str = "load_date") -> DataFrame:
    """Target after merging a batch that may span several load dates."""
    target = target.select(*spec.value_columns, *VALIDITY)
    delta = scd2_merge_delta(target, batch, spec, mode, load_col)
    return keyed_upsert(target, delta, [spec.key, "effective_date"])
