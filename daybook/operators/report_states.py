"""Quality reports from mergeable states.

A run leaves, for each of its days, a handful of state rows of one shape - table, day,
metric, key, n, total, m2, least, most, sketch - whatever they count: a measure has
its number, sum, sum of squared deviations and extremes; a NULL count, a rule or a value of
a distribution has a number; the ids have a HyperLogLog sketch. ``merged`` adds rows up by
an associative aggregate, so states of days make states of months, and a report over
any span of days reads states only, never the rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.expressions import UNKNOWN

COLUMNS = ["table_name", "day", "metric", "key", "n", "total", "m2", "least", "most", "sketch"]
SCHEMA = ("table_name string, day date, metric string, key string, n bigint, total double, m2 double, least double, "
          "most double, sketch binary")
RECORDS, NULLS, IDS = "total_records", "null_count", "ids"


@dataclass(frozen=True)
class ReportSpec:
    table: str
    measures: list[str] = field(default_factory=list)
    rules: dict[str, Column] = field(default_factory=dict)
    distributions: list[str] = field(default_factory=list)
    nulls: bool = False
    id_col: str = "id"
    day_col: str = "date"


def products_spec() -> ReportSpec:
    return ReportSpec("products", ["price", "all_time_quantity_sold"],
                      {"negative_price": F.col("price") < 0, "negative_quantity": F.col("all_time_quantity_sold") < 0},
                      ["inventory_status"], nulls=True)


def comments_spec() -> ReportSpec:
    return ReportSpec("comments", [], {"valid_ratings": F.col("rating_valid"), "unknown_content": F.col("content") == UNKNOWN},
                      ["rating", "sentiment"])


def _row(metric: str | Column, key: str | Column | None, n: Column, total: Column | None = None, m2: Column | None = None,
         least: Column | None = None, most: Column | None = None, sketch: Column | None = None) -> Column:
    def typed(c, kind: str) -> Column:
        return (c if isinstance(c, Column) else F.lit(c)).cast(kind)

    return F.struct(typed(metric, "string").alias("metric"), typed(key, "string").alias("key"), typed(n, "bigint").alias("n"),
                    typed(total, "double").alias("total"), typed(m2, "double").alias("m2"), typed(least, "double").alias("least"),
                    typed(most, "double").alias("most"), typed(sketch, "binary").alias("sketch"))


def states(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """State rows of each day of ``df``: one aggregate for all numbers, one for each
    distribution, all combined before their shuffle."""
    day = F.col(spec.day_col).alias("day")
    count, measured = F.count(F.lit(1)), spec.measures
    numbers = [count.alias("records"), F.hll_sketch_agg(F.col(spec.id_col)).alias("ids")]
    for i, m in enumerate(measured):
        c = F.col(m).cast("double")
        numbers += [F.count(c).alias(f"n{i}"), F.sum(c).alias(f"total{i}"), F.coalesce(F.var_pop(c) * F.count(c), F.lit(0.0)).alias(f"m2{i}"),
                    F.min(c).alias(f"least{i}"), F.max(c).alias(f"most{i}")]
    numbers += [F.count_if(p).alias(f"rule{i}") for i, p in enumerate(spec.rules.values())]
    nulls = [c for c in df.columns if spec.nulls]
    numbers += [F.count_if(F.col(c).isNull()).alias(f"null{i}") for i, c in enumerate(nulls)]
    rows = [_row(RECORDS, None, F.col("records")), _row(IDS, None, F.col("records"), sketch=F.col("ids"))]
    rows += [_row(m, None, *(F.col(f"{x}{i}") for x in ("n", "total", "m2", "least", "most"))) for i, m in enumerate(measured)]
    rows += [_row(name, None, F.col(f"rule{i}")) for i, name in enumerate(spec.rules)]
    rows += [_row(NULLS, c, F.col(f"null{i}")) for i, c in enumerate(nulls)]
    parts = [df.groupBy(day).agg(*numbers).select("day", F.inline(F.array(*rows)))]
    for c in spec.distributions:
        parts.append(df.groupBy(day, F.col(c).cast("string").alias("value")).agg(count.alias("records"))
                     .select("day", F.inline(F.array(_row(c, F.col("value"), F.col("records"))))))
    return reduce(lambda a, b: a.unionByName(b), parts).select(F.lit(spec.table).alias("table_name"), "*").select(*COLUMNS)


def merged(rows: DataFrame, keep_day: bool = False) -> DataFrame:
    """States added up by table, metric and key (and day): rows of the same shape.
    Deviations are taken from the common mean: m2 = sum(m2) + sum(total^2 / n) - total^2 / n."""
    by = ["table_name", *(["day"] if keep_day else []), "metric", "key"]
    n, total = F.sum("n"), F.sum("total")
    between = F.sum(F.try_divide(F.col("total") * F.col("total"), F.col("n"))) - F.try_divide(total * total, n)
    out = rows.groupBy(*by).agg(
        n.alias("n"), total.alias("total"), (F.sum("m2") + F.greatest(between, F.lit(0.0))).alias("m2"), F.min("least").alias("least"),
        F.max("most").alias("most"), F.hll_union_agg("sketch").alias("sketch"))
    # An aggregate of no sketch is the empty one.
    sketch = F.when(F.col("metric") == IDS, F.col("sketch"))
    return out.select(*(c for c in [*by, "n", "total", "m2", "least", "most"]), sketch.alias("sketch"),
                      *([] if keep_day else [F.lit(None).cast("date").alias("day")])).select(*COLUMNS)


def report(rows: DataFrame) -> DataFrame:
    """(table_name, metric, key, value) of states: averages, extremes and the sample
    deviation of measures, counts, distributions, the estimated number of ids."""
    n, total = F.col("n"), F.col("total")

    def entry(metric: Column | str, value: Column) -> Column:
        return F.struct((metric if isinstance(metric, Column) else F.lit(metric)).alias("metric"), value.cast("double").alias("value"))

    def named(prefix: str) -> Column:
        return F.concat(F.lit(prefix), F.col("metric"))

    of_measure = F.array(entry(named("avg_"), F.round(F.try_divide(total, n), 4)), entry(named("min_"), F.col("least")),
                         entry(named("max_"), F.col("most")), entry(named("sum_"), total),
                         entry(named("stddev_"), F.when(n > 1, F.round(F.sqrt(F.col("m2") / (n - 1)), 4))))
    found = (F.when(F.col("metric") == IDS, F.array(entry("distinct_ids_estimate", F.hll_sketch_estimate("sketch"))))
             .when(F.col("m2").isNotNull(), of_measure)  # no count has one
             .otherwise(F.array(entry(F.col("metric"), n))))
    return (merged(rows).select("table_name", "key", F.explode(found).alias("e"))
            .select("table_name", "e.metric", "key", "e.value"))


def over(rows: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """States of the days from ``start`` to ``end``, both included; None: no bound (and
    then the rows without a day are in)."""
    if start is not None:
        rows = rows.where(F.col("day") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("day") <= F.lit(end).cast("date"))
    return rows
