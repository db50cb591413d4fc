"""Hard negatives for anchors, with score bounds along a spanning tree of them.

1. Vectors become integers and are written once, spread over equal partitions.
2. Anchors are dealt into blocks of about ``BLOCK`` by a hash of their id; the
   stated set of queries is compared with all rows block by block. A block has a
   bounded size (see ``BLOCK``), whatever the table holds, and is all that the
   driver and a broadcast carry: its anchors, their minimum spanning tree, five
   positives of each.
3. A task scores its rows at the root of the tree. From an anchor to its child the
   score of a row changes by no more than the length of the edge times the norm of
   the row, so bounds at the parent give bounds at the child. Only rows whose
   bounds overlap a window that is still open are scored exactly, and these
   carry exact scores further down. Windows: at first the scores above the fifth
   positive found so far, then those between 30 and 90 % of a positive above
   the tenth negative found so far.
4. Each task hands on the rows that are among its own first five or ten, so what
   is shuffled does not grow with the number of rows of a label, and Spark
   ranks them.

Bounds leave out only rows that cannot be in the result, so it is exact. Scores are
computed as doubles where all products and sums are integers below 2^53, else as
64-bit integers.

Cases: rows with a null id or label, a null vector or a null or non-finite component
take no part; a vector that is shorter than another counts as ending in zeros; of
rows that share an id the one of smallest label, then smallest vector takes part;
components beyond 2^24 after scaling count as 2^24; equal scores rank by smaller id;
an anchor without another row of its label, or whose positives score below 0, has
no rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import partitions_for, stored, table
from daybook.session import scratch_path

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
LIMIT = 2 ** 24
#: Anchors of a block on average; a block of a hash has twice as many with a
#: probability below 1e-80.
BLOCK = 1000
#: Rows of a written partition, and rows that a task holds bounds for at a time.
PART_ROWS = 16384
STEP_ROWS = 2048
FOUND = "anchor_id long, vec_id long, score long"


def vectors(rows: DataFrame, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
            label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the rows that take part; v: scaled integers. ``label``
    may be an expression over the columns vec_id and label."""
    taken = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                        F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    fine = F.forall("x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    scaled = F.transform("x", lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x * scale))).cast("int"))
    taken = taken.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(fine)
    return (taken.select("vec_id", (F.col("label") if label is None else label).cast("long").alias("label"), scaled.alias("v"))
            .groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v"))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The lists as rows of ``width`` 64-bit integers, cut or filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.asarray(vectors.value_lengths())
    values = np.asarray(vectors.flatten(), np.int64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out, rows = np.zeros((len(sizes), width), np.int64), np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows[places < width], places[places < width]] = values[places < width]
    return out


class AnchorTree:
    """Anchors in an order in which each follows its parent, with the lengths of the
    edges of their minimum spanning tree."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray):
        order, parent, edge = [], np.full(len(ids), -1), np.zeros(len(ids))
        exact = points.astype(float)
        near = np.full(len(ids), np.inf)
        left = np.ones(len(ids), bool)
        at = int(np.argmin(((exact - exact.mean(0)) ** 2).sum(1)))
        for _ in range(len(ids)):
            order.append(at)
            left[at] = False
            far = np.sqrt(((exact - exact[at]) ** 2).sum(1))
            closer = left & (far < near)
            near[closer], parent[closer] = far[closer], at
            if left.any():
                at = int(np.argmin(np.where(left, near, np.inf)))
                edge[at] = near[at]
        place = np.empty(len(ids), int)
        place[order] = np.arange(len(ids))
        self.ids, self.labels, self.points = ids[order], labels[order], points[order]
        self.parent = np.where(parent[order] < 0, -1, place[parent[order]])
        self.edge = edge[order]
        self.norm = np.sqrt((exact[order] ** 2).sum(1))
        self.last_child = np.arange(len(ids))
        for k, p in enumerate(self.parent):
            if p >= 0:
                self.last_child[p] = k

    def scored(self, rows: np.ndarray, wanted: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, numbers of rows, their exact scores) for each anchor.
        ``wanted(anchor, low, high)`` tells by the bounds which rows to score."""
        most = max(np.abs(rows).max(initial=0) * np.abs(self.points).max(initial=0), 1)
        kind = float if most * max(1, rows.shape[1]) < 2 ** 53 else np.int64
        x, anchors = rows.astype(kind), self.points.astype(kind)
        norm = np.sqrt((rows.astype(float) ** 2).sum(1))
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in range(len(self.ids)):
            p = self.parent[k]
            if p < 0:
                low = high = None
                some = np.arange(len(rows))
            else:
                reach = self.edge[k] * norm * (1 + 1e-9) + 1 + 1e-9 * self.norm[k] * norm
                low, high = bounds[p][0] - reach, bounds[p][1] + reach
                some = np.flatnonzero(wanted(k, low, high))
            exact = x[some] @ anchors[k]
            if p < 0:
                low = high = exact.astype(float)
                keep = np.flatnonzero(wanted(k, low, high))
                yield k, some[keep], exact[keep].astype(np.int64)
            else:
                low[some] = high[some] = exact
                yield k, some, exact.astype(np.int64)
            if self.last_child[k] > k:
                bounds[k] = low, high
            if p >= 0 and self.last_child[p] == k:
                del bounds[p]


def _first(ids: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count``: higher scores, then smaller ids."""
    if len(ids) > 8 * count:
        some = np.flatnonzero(scores >= np.partition(scores, -count)[-count])
        return some[np.lexsort((ids[some], -scores[some]))[:count]]
    return np.lexsort((ids, -scores))[:count]


def _best(batches: Iterator[pa.RecordBatch], tree: AnchorTree, windows: list[list[tuple[float, float]]], same_label: bool,
          count: int) -> Iterator[pa.RecordBatch]:
    """(anchor_id, vec_id, score): the first ``count`` of these rows in each window
    (least and greatest score) of each anchor, among those of its label or of others."""
    least = [[low for low, _ in own] for own in windows]
    found = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in own] for own in windows]
    for whole in batches:
        for b in (whole.slice(k, STEP_ROWS) for k in range(0, whole.num_rows, STEP_ROWS)):
            ids, labels = (np.asarray(b.column(k)) for k in (0, 1))

            def wanted(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                overlap = np.zeros(len(ids), bool)
                for (_, top), bottom in zip(windows[k], least[k]):
                    overlap |= (high >= bottom) & (low <= top)
                return overlap & ((labels == tree.labels[k]) == same_label) & (ids != tree.ids[k])

            for k, some, scores in tree.scored(matrix(b.column(2), tree.points.shape[1]), wanted):
                for j, (low, high) in enumerate(windows[k]):
                    fits = (scores >= least[k][j]) & (scores <= high)
                    if fits.any():
                        one, two = (np.concatenate(x) for x in zip(found[k][j], (ids[some[fits]], scores[fits])))
                        first = _first(one, two, count)
                        found[k][j] = one[first], two[first]
                        if len(first) == count:
                            least[k][j] = max(low, two[first[-1]])
    for k, own in enumerate(found):
        one, two = (np.concatenate([x[i] for x in own] or [np.empty(0, np.int64)]) for i in (0, 1))
        one, places = np.unique(one, return_index=True)  # a row that several windows hold goes once
        if len(one):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(one), tree.ids[k])), pa.array(one), pa.array(two[places])],
                                             ["anchor_id", "vec_id", "score"])


def _ranked(rows: DataFrame, keys: list[str], count: int) -> DataFrame:
    order = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", order).where(f"rank <= {count}")


def _mined(rows: DataFrame, anchors: pa.Table) -> DataFrame:
    width = max([len(v) for v in anchors["v"].to_pylist()], default=0)
    tree = AnchorTree(np.asarray(anchors["vec_id"]), np.asarray(anchors["label"]), matrix(anchors["v"], width))
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(tree)
    every = [[(-np.inf, np.inf)]] * len(tree.ids)
    positives = stored(_ranked(rows.mapInArrow(lambda x: _best(x, shared.value, every, True, POSITIVES), FOUND),
                               ["anchor_id"], POSITIVES), "positives")
    # Five of each anchor of the block.
    scores: dict[int, list[int]] = {}
    for r in positives.select("anchor_id", "score").collect():
        scores.setdefault(r["anchor_id"], []).append(r["score"])
    windows = [[(-(-LOW_PERCENT * s // 100), HIGH_PERCENT * s // 100) for s in sorted(set(scores.get(a, []))) if s >= 0]
               for a in tree.ids.tolist()]
    near = spark.sparkContext.broadcast(windows)
    found = rows.mapInArrow(lambda x: _best(x, shared.value, near.value, False, NEGATIVES), FOUND).distinct()
    of = positives.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    inside = found.join(of, "anchor_id").where(
        f"{LOW_PERCENT} * positive_score <= 100 * score AND 100 * score <= {HIGH_PERCENT} * positive_score")
    return _ranked(inside, ["anchor_id", "positive_id"], NEGATIVES).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def hard_negatives(taken: DataFrame, every: int = EVERY, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    ``taken``: see ``vectors``; anchors are the ids divisible by ``every``."""
    spark = taken.sparkSession
    written = stored(taken, "vectors")
    rows = stored(written.repartition(partitions_for(written.count(), PART_ROWS, 1), "vec_id"), "vectors")
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = partitions_for(anchors.count(), block, 1)
    number = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    path = scratch_path(spark, "hard-negatives")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    spark.createDataFrame([], schema).write.parquet(f"{path}/block=none")
    for k in range(blocks):
        of_block = anchors.where(number == k).toArrow()
        if of_block.num_rows:
            _mined(rows, of_block).write.mode("overwrite").parquet(f"{path}/block={k}")
    return spark.read.schema(schema).parquet(path).select("anchor_id", "positive_id", "rank", "negative_id",
                                                          "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors(table(spark, sf_dir, "embeddings"), moved))


ORACLE = f"""
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM taken a JOIN taken r ON a.vec_id % {EVERY} = 0 AND a.vec_id != r.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW_PERCENT} * positive_score <= 100 * score AND 100 * score <= {HIGH_PERCENT} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
