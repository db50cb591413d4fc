"""The warehouse model over the fixture inputs, as lazy DataFrames.

``Warehouse`` wires sources -> clean -> stage -> dimensions -> facts for
every load batch at once (the result the daily runs produce one by one);
nothing here runs until a caller acts on a frame."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import clean as C
from daybook.operators import facts as FA
from daybook.operators import scd2 as S
from daybook.operators import staging as ST
from daybook.sources import contracts as K
from daybook.session import checkpoint_dir, scratch_path, small_tasks
from daybook.sources import fixtures as FX

# Processing date stamped by the review job in the catalog queries (the last
# fixture day); a daily run passes its own run date instead.
CATALOG_RUN_DATE = "2024-01-30"


class Warehouse:
    """``stored=True`` makes the staged tables behave like the stored tables
    they are in the daily runs: computed once and written as Parquet in the
    session's shared checkpoint folder, then read by every later step. Queries that read a staged table several times use it; the rest
    stay one lazy plan."""

    def __init__(self, spark: SparkSession, sf_dir: str, run_date: str = CATALOG_RUN_DATE,
                 stored: bool = False):
        self.spark, self.sf_dir, self.run_date, self.stored = spark, sf_dir, run_date, stored
        self._kept: dict[str, DataFrame] = {}
        if stored:
            checkpoint_dir(spark)

    def _store(self, df: DataFrame, always: bool = False) -> DataFrame:
        """Write ``df`` as a Parquet table in the shared checkpoint folder and
        read it back (lineage cut; later scans are columnar and pruned)."""
        if not (self.stored or always):
            return df
        path = scratch_path(self.spark, "stored")
        with small_tasks(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def staged(self, df: DataFrame, always: bool = False) -> DataFrame:
        """``df`` as a stored table, if this warehouse's are (or always)."""
        return self._store(df, always)

    # --- products ---
    @cached_property
    def raw_products(self) -> DataFrame:
        return FX.raw_products(self.spark, self.sf_dir)

    @cached_property
    def clean_products_by_day(self) -> DataFrame:
        """The product job run on each load day: one row per (id, day)."""
        return C.clean_products(self.raw_products, dedupe_keys=["id", "date"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return self._store(ST.stage_products(self.clean_products_by_day))

    def _once(self, name: str, make) -> DataFrame:
        """A dimension or fact of a stored warehouse is computed once, as its staged
        tables are."""
        if not self.stored:
            return make()
        if name not in self._kept:
            self._kept[name] = self._store(make())
        return self._kept[name]

    def dim_products(self, mode: str = S.AS_WRITTEN) -> DataFrame:
        return self._once(f"dim_products_{mode}", lambda: S.scd2_history(self.stg_products, S.PRODUCTS, mode))

    @cached_property
    def fact_products(self) -> DataFrame:
        return FA.fact_products(self.stg_products, K.empty(self.spark, K.FACT_PRODUCTS))

    # --- reviews ---
    @cached_property
    def raw_comments(self) -> DataFrame:
        return FX.raw_comments(self.spark, self.sf_dir)

    @cached_property
    def clean_comments(self) -> DataFrame:
        return C.clean_comments(self.raw_comments, self.run_date)

    @cached_property
    def stg_comments(self) -> DataFrame:
        return self._store(ST.stage_comments(self.clean_comments))

    @cached_property
    def comment_history(self) -> DataFrame:
        return self._store(FX.comment_history(self.spark, self.sf_dir))

    def dim_comments(self, mode: str = S.AS_WRITTEN, history: bool = True) -> DataFrame:
        src = self.comment_history if history else self.stg_comments
        return self._once(f"dim_comments_{mode}_{history}", lambda: S.scd2_history(src, S.COMMENTS, mode))

    @cached_property
    def fact_comments(self) -> DataFrame:
        return FA.fact_comments(self.stg_comments, self.dim_products(S.AS_WRITTEN),
                                K.empty(self.spark, K.FACT_COMMENTS))

    # --- helpers for split-batch queries ---
    def before_last_batch(self, df: DataFrame, col: str = "load_date") -> tuple[DataFrame, DataFrame]:
        """(rows before the newest load date, rows of the newest load date),
        the newest date found by a scalar subquery."""
        last = df.agg(F.max(col)).scalar()
        return df.where(F.col(col) < last), df.where(F.col(col) == last)
