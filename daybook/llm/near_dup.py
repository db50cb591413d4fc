"""MinHash near-dedup with sequential Bayesian verification.

1. One pass over whole texts gives each document the size of its shingle set,
   a MinHash signature and the SHA-256 of its lower-cased words. Documents of
   equal words are one class, a numbered node; its label is its smallest id.
2. Nodes that agree in a whole band of the signature are candidates.
   Not all pairs of a bucket are compared: its hubs (one in the first round,
   eight times as many in each further one) are compared with those members that
   are not yet in the same component. The members that share the most buckets
   with others, such as the text that all of a group were made from, are hubs
   first. From the second round on, the shingles that another of the documents
   left has too are counted for each, by blocks of their hashes: two documents have
   no more in common than the sum of the lesser counts of the blocks. Pairs below
   the threshold by this bound are not made, and a pair that shares several buckets
   is made in the first of them only.
   Rounds go on until every bucket holds one component or all its members
   have been hubs, so no pair of a bucket that could join two components is
   left out.
3. Candidates are compared batch by batch of their signatures. After each
   batch a pair is dropped if the posterior probability that its similarity
   reaches the threshold is below ``MISS``; the prior is uniform.
4. What survives is verified on the whole texts: sets of shingles of words,
   100 * intersection >= 80 * union. Only texts of survivors are joined.
5. Components are labelled by repeated hooking to the smallest neighbouring
   label, with tables in the shared folder between the rounds.

With 25 bands of 5 rows a pair of similarity 0.8 shares no band with
probability 5e-5, one of 0.9 with 1e-10. Over all five batches together, step 3
drops a pair of similarity 0.80 with probability 8.0e-6, one of 0.81 with
2.8e-6, of 0.82 with 9.7e-7 and of 0.9 with 8.5e-11; a pair that was dropped is
dropped again in every round. Nothing is capped or sampled.

Cases: a null or empty text, or one of blanks only, has no shingles and is
linked with nothing; a text of fewer words than a shingle is one shingle;
rows that share a ``doc_id`` are in one component, whatever their texts, and
each is returned; a null ``doc_id`` is linked with nothing; an empty table gives no rows; other columns
are not read (``drop_near_duplicates`` passes them through).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import fresh, in_arrow, remove, scratch, stored, table

SHINGLE = 4
BANDS, ROWS = 25, 5
BATCH = 25
PERMUTATIONS = BANDS * ROWS
THRESHOLD_PERCENT = 80
#: Probability at which a pair is given up although it might reach the threshold.
MISS = 1e-6
HUB_GROWTH = 8
#: Blocks of shingles that are counted for the bounds (a power of 2).
BLOCKS = 128

_SEED = np.random.Generator(np.random.PCG64(20240607))
_FACTORS = _SEED.integers(1, 2 ** 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str) -> list[bytes]:
    """Lower-cased words; bytes methods know ASCII letters and blanks only."""
    return text.encode().lower().split()


def shingles(words: list[bytes], size: int = SHINGLE):
    """The shingles of a text, repeated ones too. Words hold no blanks, so the
    joined strings are equal only for equal words."""
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return map(b" ".join, zip(*(words[k:] for k in range(size))))


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_64_intdigest

    for whole in batches:
        for b in (whole.slice(k, 500) for k in range(0, whole.num_rows, 500)):
            n, key, signature = [], [], []
            for text in b.column(1).to_pylist():
                words = words_of(text or "")
                x = np.fromiter(set(map(xxh3_64_intdigest, shingles(words, size))), np.uint64)
                n.append(len(x))
                key.append(hashlib.sha256(b" ".join(words)).digest())
                low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
                for part in (x[k:k + 4096] for k in range(0, len(x), 4096)):
                    hashed = (part * _FACTORS[:, None]) >> np.uint64(32)
                    low = np.minimum(low, hashed.min(axis=1).astype(np.uint32))
                signature.append(low.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                                              pa.array(signature, pa.binary())], ["id", "n", "key", "signature"])


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, n, key, signature) of each row: one pass, no shuffle."""
    return in_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")),
                    lambda batches: _sign(batches, size), "id long, n long, key binary, signature binary")


def least_matches(percent: int = THRESHOLD_PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, matches needed to go on): with m of n equal, the
    posterior of the similarity is Beta(m + 1, n - m + 1), and the probability
    that it reaches t is that of at most m successes in n + 1 trials of t."""
    t, out = percent / 100, []
    for n in range(BATCH, PERMUTATIONS + 1, BATCH):
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _likely(batches: Iterator[pa.RecordBatch], bounds: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        left, right = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint32).reshape(b.num_rows, -1) for k in (2, 3))
        alive, matches, done = np.arange(b.num_rows), np.zeros(b.num_rows, int), 0
        for n, least in bounds:
            matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(1)
            alive, done = alive[matches[alive] >= least], n
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(alive)), b.column(1).take(pa.array(alive))], ["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep, last = [], (None, frozenset())
        for k, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
            one = set(shingles(words_of(x or ""), size))
            two = last[1] if last[0] == y else set(shingles(words_of(y or ""), size))
            last, common = (y, two), len(one & two)
            if common and 100 * common >= percent * (len(one) + len(two) - common):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())),
                                          b.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])


def _texts(ids: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, text) of the nodes ``ids``. ``docs``: doc_id and text. Of the rows
    that share a doc_id, only those with the words of the node are its texts."""

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [k for k, (key, text) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
                    if hashlib.sha256(b" ".join(words_of(text or ""))).digest() == key]
            yield pa.RecordBatch.from_arrays([b.column(j).take(pa.array(keep, pa.int64())) for j in (0, 2)], ["id", "text"])

    wanted = reps.join(ids, "id", "left_semi").select("id", "key", F.col("rep").alias("doc_id"))
    return in_arrow(docs.join(wanted, "doc_id").select("id", "key", "text"), same, "id long, text string")


def _verified(pairs: DataFrame, signed: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of (a, b) that are linked. ``docs``: doc_id and text of the rows."""
    bounds = least_matches(percent)
    one, two = (signed.select(F.col("id").alias(k), F.col("signature").alias(f"s{k}")) for k in "ab")
    likely = stored(in_arrow(pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb"),
                             lambda x: _likely(x, bounds), "a long, b long"), "likely-pairs")
    wanted = likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = stored(_texts(wanted, signed, docs), "likely-texts")
    one, two = (texts.select(F.col("id").alias(k), F.col("text").alias(f"t{k}")) for k in "ab")
    return in_arrow(likely.join(one, "a").join(two, "b").select("a", "b", "ta", "tb"),
                    lambda x: _linked(x, size, percent), "a long, b long")


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label): each node of ``nodes`` (id, label) gets the smallest label
    that ``links`` (a, b) connect it with. Labels hook to the smallest
    neighbouring label, and chains of hooks are halved until they are flat."""
    labels = nodes
    while True:
        a, b = (labels.select(F.col("id").alias(k), F.col("label").alias(f"l{k}")) for k in "ab")
        joined = links.join(a, "a").join(b, "b").where("la != lb")
        hooks = stored(joined.select(F.greatest("la", "lb").alias("label"), F.least("la", "lb").alias("to"))
                       .groupBy("label").agg(F.min("to").alias("to")), "hooks")
        if hooks.isEmpty():
            return labels
        while True:  # pointer jumping
            up = hooks.select(F.col("label").alias("to"), F.col("to").alias("top"))
            jumped = stored(hooks.join(up, "to", "left").select(
                "label", F.coalesce("top", "to").alias("to"), F.col("top").isNotNull().alias("moved")), "hooks")
            hooks = jumped.select("label", "to")
            if jumped.where("moved").isEmpty():
                break
        labels = stored(labels.join(hooks, "label", "left")
                        .select("id", F.coalesce("to", "label").alias("label")), "labels")


def _bands() -> Column:
    """array<long>: the buckets of a signature, one for each band."""
    width = 4 * ROWS
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda k: F.xxhash64(k, F.substring(F.col("signature"), k * width + 1, F.lit(width))))


def _band_rows(signed: DataFrame) -> DataFrame:
    """(bucket, id): a row for each band; signatures are little-endian words."""
    return signed.select(F.explode(_bands()).alias("bucket"), "id")


def _shared_shingles(texts: DataFrame, size: int) -> DataFrame:
    """(id, shared): how many shingles of each text another of these texts has, in each
    of ``BLOCKS`` blocks of their hashes. Two texts have no more in common than the sum
    of the lesser counts. Hashes that collide make counts larger, never smaller."""

    def hashes(text: str | None) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        return np.fromiter(set(map(xxh3_64_intdigest, shingles(words_of(text or ""), size))), np.uint64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = hashes(text)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), doc_id, np.int64)), pa.array(x.view(np.int64))],
                                                 ["id", "shingle"])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.bincount((hashes(t) % np.uint64(BLOCKS)).astype(np.int64), minlength=BLOCKS) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], ["id", "total"])

    found = in_arrow(texts, rows, "id long, shingle long")
    # min and max differ if two texts have the shingle, not if a text has two rows.
    alone = found.groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("other")).where("id = other")
    block = F.pmod(F.col("shingle"), F.lit(BLOCKS)).cast("int")  # 2^64 is a multiple of BLOCKS
    own = (alone.groupBy("id", block.alias("block")).agg(F.count(F.lit(1)).cast("int").alias("n"))
           .groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("block", "n"))).alias("own")))
    total = in_arrow(texts, totals, "id long, total array<int>").dropDuplicates(["id"])
    shared = F.transform("total", lambda x, k: x - F.coalesce(F.element_at("own", k), F.lit(0)))
    return total.join(own, "id", "left").select("id", shared.alias("shared"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row."""
    signed = stored(sign(docs, id_col, text_col, size), "signatures")
    known = signed.where("n > 0 AND id IS NOT NULL")
    # Nodes are classes, numbered: an id may have rows of several. Equal words
    # have equal signatures.
    reps = stored(known.groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"),
                                           F.first("signature").alias("signature"))
                  .withColumn("id", F.monotonically_increasing_id()), "representatives")
    members = (known.select("id", "key").join(reps.select("key", F.col("id").alias("node")), "key")
               .select("id", "node").distinct())
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")

    rows = _band_rows(reps)
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    several = stored(rows.join(shared, "bucket"), "buckets")
    degrees = several.groupBy("id").agg(F.sum("mates").alias("degree"))
    buckets = stored(several.join(degrees, "id").select("bucket", "id", "degree"), "buckets")
    # Classes of one smallest id start as one component.
    labels = stored(reps.select("id", F.col("rep").alias("label")), "labels")
    bounds = reps.select("id", "n")
    done, count = 0, 1
    while True:
        with scratch() as spent:
            now = buckets.join(labels, "id")
            # Buckets of several components.
            mixed = now.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                              F.count(F.lit(1)).alias("n"))
            left = stored(now.join(mixed.where(f"low != high AND n > {done}").select("bucket"), "bucket", "left_semi"),
                          "open-buckets")
            if left.isEmpty():
                break
            if done:
                now = left.select("id").distinct()
                shared = _shared_shingles(stored(_texts(now, reps, texts), "open-texts"), size)
                bounds = stored(reps.join(now, "id", "left_semi").select("id", "n", _bands().alias("bands"))
                                .join(shared, "id"), "shared-shingles")
            left = left.join(bounds, "id")
            turn = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("degree"), "id"))
            hubs = (left.withColumn("turn", turn).where(f"turn <= {done + count}").where(f"turn > {done}")
                    .select("bucket", F.col("id").alias("hub"), F.col("label").alias("hub_label"), F.col("n").alias("hub_n"),
                            *(F.col(c).alias(f"hub_{c}") for c in ("shared", "bands") if done)))
            # At most this many shingles are common, so at least the rest are in the union.
            common, first = F.least("n", "hub_n"), F.lit(True)
            if done:
                common = F.aggregate(F.zip_with("shared", "hub_shared", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
                # A pair that shares several buckets is made in the first of them.
                before = F.slice("bands", F.lit(1), F.array_position("bands", F.col("bucket")).cast("int") - 1)
                first = ~F.arrays_overlap(before, F.col("hub_bands"))
            possible = 100 * common >= percent * (F.col("n") + F.col("hub_n") - common)
            pairs = (left.join(hubs, "bucket").where((F.col("label") != F.col("hub_label")) & first & possible)
                     .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())
            links = stored(_verified(pairs, reps, texts, size, percent), "links")
            labels = connected(labels, links)
            done, count = done + count, count * HUB_GROWTH
            # All but the labels of the round was read for the last time.
            old = [p for p in spent if "/labels-" not in p]
        remove(docs.sparkSession, old)

    nodes = members.join(labels.withColumnRenamed("id", "node"), "node").select("id", "label")
    several = stored(nodes.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")), "members")
    # An id whose rows have texts of several classes joins their components.
    joins = several.where("label != other").select(F.col("label").alias("a"), F.col("other").alias("b"))
    top = several.select("id", "label")
    if not joins.isEmpty():
        both = nodes.join(several.where("label != other").select("id", F.col("label").alias("a")), "id")
        whole = connected(nodes.select(F.col("label").alias("id"), "label").distinct(),
                          both.select("a", F.col("label").alias("b")).distinct())
        top = top.join(whole.select(F.col("id").alias("label"), F.col("label").alias("to")), "label").select(
            "id", F.col("to").alias("label"))
    return (signed.select("id", "n").join(top, "id", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("label", "id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                         percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``docs`` with one document of each component; rows without an id stay."""
    [gone] = fresh(docs, "gone_id")
    out = (near_duplicates(docs, id_col, text_col, size, percent).where("NOT kept")
           .select(F.col("doc_id").alias(gone)).distinct())
    return docs.join(out, F.col(id_col) == F.col(gone), "left_anti")


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
