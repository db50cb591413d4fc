"""Document fingerprints that subtract: invertible Bloom lookup sketches.

A text is a multiset of paragraphs: lines, cut after their first ``HEAD`` characters
and wherever a hash of the three characters before says so, in every script, so that
an edit moves no cut but those next to it. Each paragraph's digest, with its number among
equal ones, is added to one cell in each of three parts of a small table; a
cell holds the count, the sum of digests and the sum of check digests. The
tables of two versions are subtracted cell by cell. What they share cancels,
and peeling - taking the digest of a cell that holds one, and removing it from
its other cells - recovers the digests only one of them has. If peeling gets
stuck, both tables are built again four times as large, until it ends. The
likeness is that of the multisets, shared over all, and exact once peeled.

The fingerprint is the smallest table, so it has one size for all texts.

To pair each document with the next in ascending order of ids, rows are dealt
out once by ranges of ids; the first row of a range goes to the range before
as well, that of the first to the last.

Cases: a null text counts as empty; two empty texts are alike (1), an empty
and another are not (0); null ids come first; rows that share an id follow each
other in the order of a hash of their texts; a single row is its own next; an
empty table gives no rows; texts may be of any length; only the id and text
columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import in_arrow, let, shuffle_partitions, table

#: Cells of the smallest table (three parts), and the growth on failure.
CELLS = 24
GROWTH = 4
#: Characters of the first paragraph of a line; of the others on average (a power of 2).
HEAD = 8
LENGTH = 32
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M[k % 4]
    return x ^ (x >> np.uint64(29))


def _cuts(text: str) -> tuple[bytes, list[int]]:
    """The text in UTF-32 and the places at which it is cut, both ends among them."""
    encoded = text.encode("utf-32-le")
    x = np.frombuffer(encoded, np.uint32)
    rolled = x * np.uint32(0x9E3779B1)
    rolled[1:] += x[:-1] * np.uint32(0x85EBCA77)
    rolled[2:] += x[:-2] * np.uint32(0xC2B2AE3D)
    rolled ^= rolled >> np.uint32(15)
    after = (rolled * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - LENGTH.bit_length() + 1) == 0
    line = np.flatnonzero(x == 10)
    after[line] = True
    starts = np.concatenate([[0], line + 1])
    ends = np.concatenate([line, [len(x)]])
    heads = starts + HEAD - 1
    after[heads[heads < ends]] = True
    return encoded, [0, *(np.flatnonzero(after) + 1).tolist(), len(x)]


def paragraphs(text: str) -> list[bytes]:
    """The paragraphs in UTF-32, without their line ends."""
    encoded, cuts = _cuts(text)
    found = (encoded[4 * i:4 * j].removesuffix(b"\n\0\0\0") for i, j in zip(cuts, cuts[1:]))
    return [x for x in found if x]


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all texts, ordered by text, and the number of the text of each."""
    from xxhash import xxh3_64_intdigest

    flat: list[int] = []
    counts = []
    for text in texts:
        found = paragraphs(text)
        flat.extend(map(xxh3_64_intdigest, found))
        counts.append(len(found))
    h, owner = np.array(flat, np.uint64), np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((h, owner))
    h, at = h[order], np.arange(len(h))
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    number = at - np.maximum.accumulate(np.where(again, 0, at)) if len(h) else at
    return _mix(h + number.astype(np.uint64) * _M[0], 1), owner


class Tables:
    """Tables of ``cells`` cells for ``n`` texts, side by side."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int64)
        self.key = np.zeros(n * cells, np.uint64)
        self.check = np.zeros(n * cells, np.uint64)

    def add(self, h: np.ndarray, owner: np.ndarray, weight) -> None:
        part = self.cells // 3
        times = np.broadcast_to(np.asarray(weight, np.int64), h.shape)
        wrapped = times.astype(np.uint64)
        for j in range(3):
            at = owner * self.cells + j * part + (_mix(h + np.uint64(self.cells), j + 1) % np.uint64(part)).astype(np.int64)
            np.add.at(self.count, at, times)
            np.add.at(self.key, at, h * wrapped)
            np.add.at(self.check, at, _mix(h, 3) * wrapped)

    def minus(self, other: Tables) -> Tables:
        out = Tables(self.n, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key - other.key, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which tables peel off whole, and (digest, table, weight) of what came off."""
        found = []
        while True:
            one = np.flatnonzero(np.abs(self.count) == 1)
            weight = self.count[one]
            h = self.key[one] * weight.astype(np.uint64)
            pure = self.check[one] == _mix(h, 3) * weight.astype(np.uint64)
            h, owner, weight = h[pure], one[pure] // self.cells, weight[pure]
            if not len(h):
                break
            order = np.lexsort((h, owner))
            h, owner, weight = h[order], owner[order], weight[order]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            h, owner, weight = h[first], owner[first], weight[first]
            self.add(h, owner, -weight)
            found.append((h, owner, weight))
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        whole = ~left.reshape(self.n, self.cells).any(axis=1)
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.uint64), *([np.zeros(0, np.int64)] * 2)]
        return whole, *parts

    def strings(self) -> list[str]:
        rows = np.concatenate([x.view(np.uint64).reshape(self.n, self.cells) for x in (self.count, self.key, self.check)], 1)
        return [base64.b64encode(r.astype("<u8").tobytes()).decode() for r in rows]


def built(h: np.ndarray, owner: np.ndarray, n: int, cells: int = CELLS) -> Tables:
    out = Tables(n, cells)
    out.add(h, owner, 1)
    return out


def differences(one, two, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of digests that only the first, and only the second of each pair
    of texts has: small tables first, larger ones for the pairs that fail."""
    only = np.zeros((2, n), np.int64)
    todo, cells = np.arange(n), CELLS
    while len(todo):
        place = np.full(n, -1)
        place[todo] = np.arange(len(todo))
        tables = []
        for h, owner in (one, two):
            at = place[owner]
            tables.append(built(h[at >= 0], at[at >= 0], len(todo), cells))
        whole, _, owner, weight = tables[0].minus(tables[1]).peel()
        for k, sign in enumerate((1, -1)):
            only[k, todo] = np.bincount(owner[weight == sign], minlength=len(todo))
        todo, cells = todo[~whole], cells * GROWTH
    return only[0], only[1]


def likeness(one, two, n: int) -> np.ndarray:
    sizes = np.bincount(one[1], minlength=n)
    mine, theirs = differences(one, two, n)
    union = sizes + theirs
    return np.where(union == 0, 1.0, (sizes - mine) / np.maximum(union, 1))


def _described(rows: list[tuple]) -> pa.RecordBatch:
    """Of (id, text) rows, all but the last, which is only the next of the one before."""
    ids, texts = [r[0] for r in rows[:-1]], [r[1] for r in rows]
    n = len(ids)
    edited = [t[:len(t) - len(t) // 4] + after[:len(t) // 4] for t, after in zip(texts, texts[1:])]
    h, owner = digests(texts)
    changed = digests(edited)
    mine, following = (h[owner < n], owner[owner < n]), (h[owner > 0], owner[owner > 0] - 1)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array(built(*mine, n).strings()), pa.array(built(*changed, n).strings()),
        pa.array(likeness(mine, changed, n)), pa.array(likeness(mine, following, n))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _in_order(batches: Iterator[pa.RecordBatch], most_rows: int = 400, most_chars: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    part, guest, chars = None, False, 0
    for b in batches:
        for p, g, doc_id, text in zip(*(b.column(k).to_pylist() for k in range(4))):
            if p != part:
                rows, part, guest, chars = [], p, False, 0
            if guest:
                continue  # the next of the last row is known
            guest = g
            rows.append((doc_id, text))
            chars += len(text)
            if len(rows) > 1 and (g or len(rows) > most_rows or chars > most_chars):
                yield _described(rows)
                rows, chars = rows[-1:], len(text)


def _literal(numbers: list[int | None]) -> Column:
    """A literal array of numbers (folded from JSON)."""
    return F.from_json(F.lit(json.dumps(numbers)), "array<bigint>")


def _range_of(place: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are not above ``place``, by halving."""
    steps = [2 ** k for k in reversed(range(len(bounds).bit_length()))]
    if not steps:
        return F.lit(0)

    def searched(given: Column) -> Column:
        def step(at: Column, size: Column) -> Column:
            return F.when(F.coalesce(F.get(given, at + size - 1) <= place, F.lit(False)), at + size).otherwise(at)
        return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), step)

    return let(_literal(bounds), searched)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and its edited text, and their likenesses."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.coalesce("id", F.lit(-2 ** 63)))
    probabilities = [k / (4 * parts) for k in range(1, 4 * parts)]
    bounds = sorted({int(x) for x in rows.approxQuantile("place", probabilities, 1 / (16 * parts))})
    # A row a range: the place of its first document.
    firsts = {r["part"]: r["place"] for r in rows.select("place", _range_of(F.col("place"), bounds).alias("part"))
              .groupBy("part").agg(F.min("place").alias("place")).collect()}
    filled = sorted(firsts)
    before = dict(zip(filled, [*filled[-1:], *filled]))
    every = range(len(bounds) + 1)

    def dealt_to(part: Column) -> Column:
        first = F.get(_literal([firsts.get(k) for k in every]), part) == F.col("place")
        guest = F.when(first, F.get(_literal([before.get(k) for k in every]), part).cast("int"))
        return F.array(F.struct(part.alias("part"), F.lit(False).alias("guest")),
                       F.struct(guest.alias("part"), F.lit(True).alias("guest")))

    dealt = (rows.withColumn("dealt", F.explode(let(_range_of(F.col("place"), bounds), dealt_to))).where("dealt.part IS NOT NULL")
             .select("dealt.part", "dealt.guest", "id", "text", "place")
             .repartition(parts, "part")
             .sortWithinPartitions("part", "guest", "place", F.xxhash64("text"))
             .select("part", "guest", "id", "text"))
    return in_arrow(dealt, _in_order, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                      "edited_fingerprint string, near_edited double, near_next double")


def op5_sketch_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
