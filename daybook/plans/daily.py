"""The daily batch: land -> clean -> append raw -> stage -> dimensions ->
facts -> data tests, for one run date.

Storage layout under ``root`` (a shared folder on a cluster):

* ``raw/products``, ``raw/comments`` — cleaned rows under
  ``run_ts=<run>/date=<day>``: each run appends a folder of its own, so a
  second batch of a day, a late document or one without a date removes
  nothing, and a re-run replaces only its own rows.
* ``staging/products``, ``staging/comments`` — the staged rows of each run under
  ``run_ts=<run>``, written once and read by every later step of it.
* ``dim_products``, ``dim_comments`` — ``Scd2Store``: each run writes the
  versions it inserts or ends, committed by a marker.
* ``fact_products``, ``fact_comments`` — partitioned by ``snapshot_date``; a
  run only ever adds its own snapshot partition (the gate admits nothing
  older than the newest snapshot), so writing that partition is the whole
  upsert and the fact history is never rewritten.
* ``reports/tests``, ``reports/quality``, ``reports/states`` — a folder
  ``run_ts=<run>`` for each run: the data tests, the quality report and its mergeable
  states by day, computed in the run.

Each written table cuts the lineage for the next step, so a run's plans
stay short however many runs came before.

Runs of many days (``run_batches``) write each table in the order of the runs, and a run
waits only for what it reads: its own rows, and the tables as the run before left them.
So the rows of the next runs are cleaned and staged while one loads, and its tests go on
beside the next loads, on the state that it left.
"""

from __future__ import annotations

import datetime as dt
from collections import deque
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.operators import checks as CH
from daybook.operators import clean as C
from daybook.operators import facts as FA
from daybook.operators import quality as Q
from daybook.operators import report_states as RS
from daybook.operators import scd2 as S
from daybook.operators import staging as ST
from daybook.sinks import tables as SK
from daybook.sources import contracts as K
from daybook.sources import days as DAYS
from daybook.sources import documents as DOC
from daybook.sources import readers as RD


#: Name of the run that holds the documents without a valid day.
UNDATED = "undated"

#: Runs of ``run_batches`` that are under way at once.
UNDER_WAY = 3


@dataclass
class Layout:
    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    @property
    def raw_products(self) -> str:
        return f"{self.root}/raw/products"

    @property
    def raw_comments(self) -> str:
        return f"{self.root}/raw/comments"

    @property
    def fact_products(self) -> str:
        return f"{self.root}/fact_products"

    @property
    def fact_comments(self) -> str:
        return f"{self.root}/fact_comments"


def _together(*steps: Callable):
    """Results of independent steps, whose Spark jobs run side by side."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


@dataclass
class Staged:
    """A run whose rows are in raw and staging."""

    run: str
    products: DataFrame
    comments: DataFrame
    with_products: bool
    with_comments: bool
    metrics: list[dict]


@dataclass
class State:
    """The tables as a run left them: later runs do not change what it reads."""

    dim_products: int
    dim_comments: int
    fact_comments: DataFrame


class DailyWarehouse:
    def __init__(self, spark: SparkSession, root: str, mode: str = S.AS_WRITTEN):
        self.spark, self.layout, self.mode = spark, Layout(root), mode
        self.dim_products = SK.Scd2Store(spark, f"{self.layout.root}/dim_products", K.DIM_PRODUCTS, S.PRODUCTS)
        self.dim_comments = SK.Scd2Store(spark, f"{self.layout.root}/dim_comments", K.DIM_COMMENTS, S.COMMENTS,
                                         cluster_col="product_id")
        self.metrics: list[dict] = []

    # -------------------------------------------------------------- readers
    def _read_or_empty(self, path: str, contract) -> DataFrame:
        fs, p = SK._fs(self.spark, path)
        if not fs.exists(p):
            return K.empty(self.spark, contract)
        return K.conform(self.spark.read.schema(contract).parquet(path), contract)

    def _raw_day(self, path: str, run_date: str | None, contract) -> DataFrame:
        """One day of a raw table: read that day's folder of each run only.
        Rows without a day are staged by no run."""
        if run_date is None:
            return K.empty(self.spark, contract)
        day = f"{path}/run_ts=*/date={run_date}"
        fs, p = SK._fs(self.spark, day)
        if not fs.globStatus(p):
            return K.empty(self.spark, contract)
        # The day comes from the folder: as a literal it would be in the generated code, anew each day.
        return K.conform(self.spark.read.option("basePath", path).schema(contract).parquet(day), contract)

    def _stored(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.layout.root}/{path}")
        return self.spark.read.schema(df.schema).parquet(f"{self.layout.root}/{path}")

    def reports(self, kind: str) -> DataFrame:
        """Every run's report rows: ``kind`` is ``tests`` or ``quality``."""
        return (self.spark.read.option("basePath", f"{self.layout.root}/reports/{kind}")
                .parquet(f"{self.layout.root}/reports/{kind}/run_ts=*")
                .withColumn("run_ts", F.col("run_ts").cast("string")))

    def history_report(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """The quality report of a span of days, from the states that runs have left."""
        at = f"{self.layout.root}/reports/states"
        rows = self.spark.read.option("basePath", at).schema(RS.SCHEMA).parquet(f"{at}/run_ts=*")
        return RS.report(RS.over(rows, start, end))

    def fact_products(self) -> DataFrame:
        return self._read_or_empty(self.layout.fact_products, K.FACT_PRODUCTS)

    def fact_comments(self) -> DataFrame:
        return self._read_or_empty(self.layout.fact_comments, K.FACT_COMMENTS)

    def raw_products(self) -> DataFrame:
        return self._read_or_empty(self.layout.raw_products, K.CLEAN_PRODUCTS)

    def raw_comments(self) -> DataFrame:
        return self._read_or_empty(self.layout.raw_comments, K.CLEAN_COMMENTS)

    # --------------------------------------------------------------- ingest
    def ingest(self, run: str, product_docs: DataFrame | None = None,
               review_pages: DataFrame | None = None) -> tuple[DataFrame | None, DataFrame | None]:
        """Land a run's JSON documents and give its raw rows for ``run_batch`` or
        ``run_range``. What cannot be read is kept beside them, under
        ``ingest/<table>/run_ts=<run>/is_rejected=true``, and the run's quality report
        counts it. Ingesting a run again replaces its documents."""
        landed = {}
        if product_docs is not None:
            landed["products"] = lambda: SK.land_ingested(DOC.ingest_products(product_docs), self._ingested("products", run))
        if review_pages is not None:
            landed["comments"] = lambda: SK.land_ingested(DOC.ingest_reviews(review_pages), self._ingested("comments", run))
        found = dict(zip(landed, _together(*landed.values())))
        return tuple(SK.rows(found[name]) if name in found else None for name in ("products", "comments"))

    def _ingested(self, name: str, run: str) -> str:
        return f"{self.layout.root}/ingest/{name}/run_ts={run}"

    def _reject_counts(self, name: str, run: str) -> list[DataFrame]:
        """The number of rejected documents of a run that was ingested here."""
        fs, p = SK._fs(self.spark, self._ingested(name, run))
        if not fs.exists(p):
            return []
        landed = self.spark.read.schema("rejected string, is_rejected boolean").parquet(self._ingested(name, run))
        return [landed.where(F.col("is_rejected")).agg(
            F.lit(name).alias("table_name"), F.lit("rejected_documents").alias("metric"),
            F.lit(None).cast("string").alias("key"), F.count(F.lit(1)).cast("double").alias("value"))]

    # ------------------------------------------------------------------ run
    def run_batch(self, run_date: str | None, products: DataFrame | None,
                  comments: DataFrame | None, run_ts: str | None = None) -> DataFrame:
        """Run one day. ``products`` / ``comments`` are landed raw documents
        (either may be None). ``run_ts`` names the run: a run of the same name
        replaces the raw rows of the one before, another name (a second batch
        of the day) adds to them; the run date if None. A ``run_date`` of None is
        for documents without a day: they reach raw and the quality report, and
        no dimension or fact. Returns the run's data-test report, which is stored."""
        staged = self._prepare(run_date, products, comments, run_ts)
        self.metrics += staged.metrics
        return self._load(staged.run, staged.products, staged.comments, staged.with_products, staged.with_comments,
                          lambda: self._comment_facts(staged.comments))

    def run_batches(self, batches: Iterable[Callable[[], tuple]]) -> None:
        """``run_batch`` for each run in order; a batch gives its arguments when called, and
        no two batches are of one day. ``UNDER_WAY`` runs overlap: each table is written in
        order, review facts and tests read the versions that their own run left, and the
        product dimension waits until the run before has its review facts, so that these can be made
        again. After a failed step no later run writes that table, nor one that reads it."""
        none = Future()
        none.set_result(0)
        dp = dc = fp = none
        fc, under_way = Future(), deque()
        fc.set_result(self.fact_comments())
        with ExitStack() as pools:
            # A thread for each table: a run's step begins when that of the run before has ended.
            rows, to_dp, to_dc, to_fp, to_fc, tests = (pools.enter_context(ThreadPoolExecutor(1)) for _ in range(6))
            try:
                for batch in batches:
                    if len(under_way) == UNDER_WAY:
                        self.metrics += under_way.popleft()[-1].result()
                    run = rows.submit(self._prepared, batch)
                    dp = to_dp.submit(self._dim_step, run, self.dim_products, "products", dp, fc)
                    dc = to_dc.submit(self._dim_step, run, self.dim_comments, "comments", dc)
                    fp = to_fp.submit(self._product_facts_step, run, fp)
                    fc = to_fc.submit(self._review_facts_step, run, dp, fc)
                    under_way.append((run, dp, dc, fp, fc, tests.submit(self._tests_step, run, dp, dc, fp, fc)))
                while under_way:
                    self.metrics += under_way.popleft()[-1].result()
            finally:
                for step in (x for steps in under_way for x in steps):
                    step.cancel()

    def _prepared(self, batch: Callable[[], tuple]) -> Staged:
        staged = self._prepare(*batch())
        self._report(staged.run, staged.with_products, staged.with_comments)
        return staged

    def _dim_step(self, run: Future, dim: SK.Scd2Store, name: str, *before: Future) -> int:
        """The dimension's version after a run."""
        for step in before:
            step.result()
        staged = run.result()
        rows, given = {"products": (staged.products, staged.with_products),
                       "comments": (staged.comments, staged.with_comments)}[name]
        return dim.merge(rows, self.mode) if given else dim.current_version() or 0

    def _product_facts_step(self, run: Future, before: Future) -> None:
        before.result()
        staged = run.result()
        if staged.with_products:
            self._write_product_facts(staged.products)

    def _review_facts_step(self, run: Future, dp: Future, before: Future) -> DataFrame:
        """The review fact as a run leaves it: a frame of the files that it has then."""
        kept, staged = before.result(), run.result()
        if not staged.with_comments:
            return kept
        self._write_review_facts(self._comment_facts(staged.comments, dp.result()))
        return self.fact_comments()

    def _tests_step(self, run: Future, dp: Future, dc: Future, fp: Future, fc: Future) -> list[dict]:
        staged = run.result()
        fp.result()
        self._tested(staged.run, staged.products, staged.comments, State(dp.result(), dc.result(), fc.result()))
        return staged.metrics

    def _prepare(self, run_date: str | None, products: DataFrame | None, comments: DataFrame | None,
                 run_ts: str | None = None) -> Staged:
        """Clean, append to raw and stage the documents of a run."""
        run, lay = run_ts or run_date or UNDATED, self.layout

        def raw(name: str, clean: DataFrame, path: str) -> Callable:
            def step() -> dict:
                obs = Observation(f"{name}_{run}")
                SK.append_run(Q.observed_metrics(clean, obs), path, run)
                return {"run_date": run_date, "table": name, **obs.get}
            return step

        steps = []
        if products is not None:
            steps.append(raw("products", C.clean_products(products), lay.raw_products))
        if comments is not None:
            steps.append(raw("comments", C.clean_comments(comments, run_date), lay.raw_comments))
        metrics = _together(*steps)
        stg_p, stg_c = self._stage(
            run, ST.stage_products(self._raw_day(lay.raw_products, run_date, K.CLEAN_PRODUCTS), run_date),
            ST.stage_comments(self._raw_day(lay.raw_comments, run_date, K.CLEAN_COMMENTS), run_date))
        return Staged(run, stg_p, stg_c, products is not None, comments is not None, metrics)

    def _comment_facts(self, stg_c: DataFrame, version: int | None = None) -> DataFrame:
        return FA.fact_comments_delta(stg_c, self.dim_products.active(stg_c, version), self.fact_comments())

    def _write_review_facts(self, rows: DataFrame) -> None:
        SK.write_clustered(rows, self.layout.fact_comments, "snapshot_date", "product_id", mode="overwrite",
                           tiebreak=("comment_id",))

    def _write_product_facts(self, stg_p: DataFrame) -> None:
        SK.write_clustered(FA.fact_products_delta(stg_p, self.fact_products()), self.layout.fact_products,
                           "snapshot_date", "product_id", mode="overwrite")

    def run_range(self, start: str | None, end: str | None, products: DataFrame | None,
                  comments: DataFrame | None, run_ts: str | None = None) -> DataFrame:
        """Catch up every day in [start, end] in one pass: the same tables as
        running ``run_batch`` for each day in order, with one job per step
        instead of one per day (a dimension takes all dates in one merge, the review
        fact via the as-of activity test). ``products`` / ``comments`` hold the
        landed documents of those days; those without a day are kept in raw.
        ``start`` and ``end`` are None if no document has a day."""
        run, lay = run_ts or (f"{start}_{end}" if start and end else UNDATED), self.layout
        steps = []
        if products is not None:
            clean_p = C.clean_products(products, dedupe_keys=["id", "date"])
            steps.append(lambda: SK.append_run(clean_p, lay.raw_products, run))
        if comments is not None:
            clean_c = C.clean_comments(comments, None)
            steps.append(lambda: SK.append_run(clean_c, lay.raw_comments, run))
        _together(*steps)
        lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
        stg_p, stg_c = self._stage(
            run, ST.stage_products(self.raw_products().where(F.col("date").between(lo, hi))),
            ST.stage_comments(self.raw_comments().where(F.col("date").between(lo, hi))))
        return self._load(run, stg_p, stg_c, products is not None, comments is not None,
                          lambda: FA.fact_comments_delta_asof(stg_c, self.dim_products.read(), self.fact_comments()))

    def run_days(self, days: list[str], products: DataFrame | None, comments: DataFrame | None, run_ts: str) -> DataFrame:
        """Catch up any set of days in one pass, however scattered: as ``run_range``, but
        only the folders of these days are read, of this run or of others. The day
        table stays beside the run's reports. A gate ignores days that a dimension or fact
        has passed already."""
        steps = []
        if products is not None:
            clean_p = C.clean_products(products, dedupe_keys=["id", "date"])
            steps.append(lambda: SK.append_run(clean_p, self.layout.raw_products, run_ts))
        if comments is not None:
            clean_c = C.clean_comments(comments, None)
            steps.append(lambda: SK.append_run(clean_c, self.layout.raw_comments, run_ts))
        _together(*steps)
        wanted = DAYS.write_days(self.spark, f"{self.layout.root}/reports/days/run_ts={run_ts}", days)
        stg_p, stg_c = self._stage(run_ts, ST.stage_products(DAYS.of_days(self.raw_products(), wanted)),
                                   ST.stage_comments(DAYS.of_days(self.raw_comments(), wanted)))
        return self._load(run_ts, stg_p, stg_c, products is not None, comments is not None,
                          lambda: FA.fact_comments_delta_asof(stg_c, self.dim_products.read(), self.fact_comments()))

    def _stage(self, run: str, stg_p: DataFrame, stg_c: DataFrame) -> list[DataFrame]:
        """Each run stages into folders of its own: a reader of an older run's rows, or a
        run at the same time, is not disturbed."""
        return _together(lambda: self._stored(stg_p, f"staging/products/run_ts={run}"),
                         lambda: self._stored(stg_c, f"staging/comments/run_ts={run}"))

    def _load(self, run: str, stg_p: DataFrame, stg_c: DataFrame, with_products: bool, with_comments: bool,
              comment_facts: Callable) -> DataFrame:
        """Dimensions, facts and reports from the staged rows of a run."""
        def review_facts() -> None:
            self._write_review_facts(comment_facts())

        def products() -> None:
            self.dim_products.merge(stg_p, self.mode)
            if with_comments:  # needs the products' new versions
                review_facts()

        steps = [lambda: self._report(run, with_products, with_comments)]
        if with_products:
            steps += [products, lambda: self._write_product_facts(stg_p)]
        if with_comments:
            steps.append(lambda: self.dim_comments.merge(stg_c, self.mode))
            if not with_products:
                steps.append(review_facts)
        _together(*steps)
        return self._tested(run, stg_p, stg_c)

    def _state(self) -> State:
        return State(self.dim_products.current_version() or 0, self.dim_comments.current_version() or 0, self.fact_comments())

    def _tested(self, run: str, stg_p: DataFrame, stg_c: DataFrame, state: State | None = None) -> DataFrame:
        return self._stored(self.tests(stg_p, stg_c, state).coalesce(1), f"reports/tests/run_ts={run}")

    def _report(self, run: str, with_products: bool, with_comments: bool) -> None:
        """The whole quality report on the raw rows that this run wrote."""
        def own(path: str, contract) -> DataFrame:
            return K.conform(self.spark.read.schema(contract).parquet(f"{path}/run_ts={run}"), contract)

        parts, states = [], []
        if with_products:
            states.append(RS.states(own(self.layout.raw_products, K.CLEAN_PRODUCTS), RS.products_spec()))
            parts.append(Q.product_report(own(self.layout.raw_products, K.CLEAN_PRODUCTS))
                         .select(F.lit("products").alias("table_name"), "*"))
            parts += self._reject_counts("products", run)
        if with_comments:
            states.append(RS.states(own(self.layout.raw_comments, K.CLEAN_COMMENTS), RS.comments_spec()))
            parts.append(Q.comments_report(own(self.layout.raw_comments, K.CLEAN_COMMENTS))
                         .select(F.lit("comments").alias("table_name"), "*"))
            parts += self._reject_counts("comments", run)
        if parts:
            self._stored(CH.union_all(parts).coalesce(1), f"reports/quality/run_ts={run}")
            self._stored(CH.union_all(states).coalesce(1), f"reports/states/run_ts={run}")

    def tests(self, stg_p: DataFrame, stg_c: DataFrame, state: State | None = None) -> DataFrame:
        """The warehouse's declared tests on the given state, or the current one."""
        state = state or self._state()
        # These tests ask for no end date, and a version is active or not but never NULL.
        dp, dc = self.dim_products.inserted(state.dim_products), self.dim_comments.inserted(state.dim_comments)
        fc = state.fact_comments
        return CH.union_all([
            # The product job's business rules are counted, never enforced.
            CH.check_tables([
                (stg_p, "stg_products", ["product_id", "product_name", "load_date"], {
                    "product_price": F.col("product_price") < 0,
                    "product_all_time_quantity_sold": F.col("product_all_time_quantity_sold") < 0,
                }),
                (stg_c, "stg_comments", ["comment_id", "product_id", "load_date"], {}),
                (dp, "dim_products", ["product_id", "effective_date", "is_active", "product_name"], {}),
                (dc, "dim_comments", ["comment_id", "product_id", "comment_content", "comment_rating"], {}),
                (fc, "fact_comments", ["comment_id"], {}),
            ]),
            CH.check_relationships([(stg_c, stg_p, "stg_comments", "product_id", "product_id"),
                                    (dc, dp, "dim_comments", "product_id", "product_id")]),
        ])

    def row_counts(self) -> DataFrame:
        """Rows per stored table, as one small frame."""
        frames = {
            "raw_products": self.raw_products(), "raw_comments": self.raw_comments(),
            "dim_products": self.dim_products.read(), "dim_comments": self.dim_comments.read(),
            "fact_products": self.fact_products(), "fact_comments": self.fact_comments(),
        }
        return CH.union_all([df.agg(F.lit(name).alias("table_name"),
                                    F.count(F.lit(1)).cast("bigint").alias("rows"))
                             for name, df in frames.items()])


def land_by_day(df: DataFrame, root: str, entity: str) -> str:
    """Land raw documents partitioned by their text ``date`` so each run
    reads only its own day."""
    path = f"{root.rstrip('/')}/landing/{entity}"
    df.write.mode("overwrite").partitionBy("date").parquet(path)
    return path


def landed_day(spark: SparkSession, path: str, day: str, contract) -> DataFrame:
    """One landed day, read with the schema its own files carry."""
    fs, p = SK._fs(spark, f"{path}/date={day}")
    return RD.read_landed_days(spark, path, [day], contract) if fs.exists(p) else K.empty(spark, contract)


def _is_day(text: str) -> bool:
    """Whether cleaning reads ``text`` as a day: yyyy-MM-dd, and in the calendar."""
    try:
        return dt.date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


def _landed(spark: SparkSession, path: str) -> list[str]:
    """The ``date`` of every landed folder, as its name spells it."""
    fs, p = SK._fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n.removeprefix("date=") for n in names if n.startswith("date="))


def landed_days(spark: SparkSession, path: str) -> list[str]:
    """The days that have a folder (one entry a day)."""
    return [d for d in _landed(spark, path) if _is_day(d)]


def landed_undated(spark: SparkSession, path: str) -> list[str]:
    """The folders that are no day's: of a null date, or of another spelling."""
    return [d for d in _landed(spark, path) if not _is_day(d)]


def run_days(spark: SparkSession, root: str, raw_products: DataFrame, raw_comments: DataFrame,
             mode: str = S.AS_WRITTEN) -> DailyWarehouse:
    """Land both raw inputs once, then run every load day in date order, as
    the daily schedule would. The list of days is tiny (one entry per day);
    all row work happens in Spark. Documents without a valid day follow in a
    run of their own."""
    pl = DailyWarehouse(spark, root, mode)
    lp, lc = _together(lambda: land_by_day(raw_products, root, "products"),
                       lambda: land_by_day(raw_comments, root, "comments"))
    p_days, c_days = (set(landed_days(spark, p)) for p in (lp, lc))
    p_rest, c_rest = (landed_undated(spark, p) for p in (lp, lc))

    def batch(day: str) -> Callable[[], tuple]:
        return lambda: (day, landed_day(spark, lp, day, K.RAW_PRODUCTS) if day in p_days else None,
                        landed_day(spark, lc, day, K.RAW_COMMENTS) if day in c_days else None)

    batches = [batch(day) for day in sorted(p_days | c_days)]
    if p_rest or c_rest:
        batches.append(lambda: (None, RD.read_landed_days(spark, lp, p_rest, K.RAW_PRODUCTS) if p_rest else None,
                                RD.read_landed_days(spark, lc, c_rest, K.RAW_COMMENTS) if c_rest else None))
    pl.run_batches(batches)
    return pl


def backfill(spark: SparkSession, root: str, raw_products: DataFrame, raw_comments: DataFrame,
             mode: str = S.AS_WRITTEN) -> DailyWarehouse:
    """Land both raw inputs, then catch up all their days in one run. Every
    landed folder is read: a date that is no day gives a NULL one in raw."""
    pl = DailyWarehouse(spark, root, mode)
    lp, lc = _together(lambda: land_by_day(raw_products, root, "products"),
                       lambda: land_by_day(raw_comments, root, "comments"))
    days = landed_days(spark, lp) + landed_days(spark, lc)
    p = RD.read_landed_days(spark, lp, _landed(spark, lp), K.RAW_PRODUCTS)
    c = RD.read_landed_days(spark, lc, _landed(spark, lc), K.RAW_COMMENTS)
    pl.run_range(min(days, default=None), max(days, default=None), p, c)
    return pl
