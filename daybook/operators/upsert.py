"""Keyed upsert and the incremental gates, for stores without MERGE.

``keyed_upsert``: matched key -> the delta row replaces the target row,
unmatched delta -> inserted, target rows the delta does not mention -> kept.
It is one anti join plus a union; the join is on the full composite key
(entity key + date), so a hot entity spreads over its dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.expressions import DIM_FLOOR_DATE, FACT_FLOOR_DATE


def keyed_upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    cols = target.columns
    delta = delta.select(*cols)
    # A join on a list of names moves the keys to the front; restore order.
    kept = target.join(delta.select(*keys), on=keys, how="left_anti").select(*cols)
    return kept.unionByName(delta)


def high_water_mark(target: DataFrame, date_col: str, floor: str):
    """The target's greatest date (or the floor when the target is empty) as
    a scalar subquery: Spark runs it once and folds the value into the
    filter of the batch scan; nothing is joined and nothing reaches the
    driver."""
    return target.agg(F.coalesce(F.max(date_col), F.lit(floor).cast("date"))).scalar()


def gate(batch: DataFrame, target: DataFrame, load_col: str, target_col: str,
         inclusive: bool) -> DataFrame:
    """Incremental predicate against the target's high-water mark.

    Dimensions use ``load_date >= max(effective_date)`` (floor 1900-01-01),
    facts ``load_date > max(snapshot_date)`` (floor 1900-12-31): a second
    batch on one day can still add new keys to a dimension but adds nothing
    to a fact."""
    hwm = high_water_mark(target, target_col, DIM_FLOOR_DATE if inclusive else FACT_FLOOR_DATE)
    return batch.where(F.col(load_col) >= hwm if inclusive else F.col(load_col) > hwm)


def not_yet_loaded(batch: DataFrame, target: DataFrame, key: str, load_col: str,
                   target_col: str) -> DataFrame:
    """Drop batch rows whose (key, date) the target already holds (re-runs)."""
    t = target.select(F.col(key), F.col(target_col).alias(load_col))
    return batch.join(t, on=[key, load_col], how="left_anti")
