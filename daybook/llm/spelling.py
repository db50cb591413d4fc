"""Spelling variants by a bit-sliced position index.

1. A pass over whole texts counts the words of each batch in the task; Spark adds up
   the counts. Words are ``WORD`` runs, lower-cased in A-Z, of ``LEAST_LENGTH``
   characters or more that occur ``LEAST_COUNT`` times or more.
2. Two words one edit apart agree in their first or in their last half: with k the
   length of the shorter and h = k // 2, an edit before place h leaves the last
   h characters alone, any other the first h. So each word joins four groups: by
   its first and last k // 2 characters, for k its own length and one less. All near
   pairs meet in a group, and in one only: a pair with equal first halves is left out of
   the group of the last halves.
3. A group's vocabulary is indexed by a bit set for each (position, letter). A query
   word is read letter by letter, and six recurrences of bit sets move all words of
   the group at once: those without an error so far, those with one replaced letter
   (same position), one letter more (position one ahead) or one less (one behind).
   A set of Python integers holds as many words as the group has.
4. A group of more than ``BLOCK`` words is cut into blocks by a hash; its queries go
   to each block, so no task holds more than a block of index at a time.
5. Of each word and block only the number of near words and the best of them leave
   the task; Spark adds these up. Forms are followed to their roots by pointer
   jumping: a form has at least ten times the count of its word, so a chain is
   short.

Cases: null and empty texts have no words; runs are hashed with their own ``doc_id``
(a null one as an empty string); repeated rows count each time; of near words with equal
counts the smallest by code points is the form; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import in_arrow, stored, table

#: Fixed by the contract.
WORD = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LENGTH = 7
LEAST_COUNT = 2
MUCH_MORE = 10
DROP_EVERY = 31
#: Words of an index block; words a task counts before it hands them on.
BLOCK = 1 << 16
HELD = 100_000
_LOWER = {c: c + 32 for c in range(65, 91)}


def variant(doc_id: str, run: str) -> str:
    """The lower-cased run as the contract reads it: every 31st lacks a character."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % DROP_EVERY else run[:h % len(run)] + run[h % len(run) + 1:]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs, total = re.compile(WORD.replace("+", f"{{{LEAST_LENGTH},}}")), Counter()

    def handed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                         ["word", "n"])
        total.clear()
        return out

    for b in batches:
        for doc_id, text in zip(b.column(0), b.column(1)):
            if text.is_valid:
                name = doc_id.as_py() if doc_id.is_valid else ""
                for run, n in Counter(runs.findall(text.as_py())).items():
                    total[variant(name, run.translate(_LOWER))] += n
            if len(total) > HELD:
                yield handed()
    yield handed()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all documents."""
    texts = docs.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").alias("text"))
    return (in_arrow(texts, _counted, "word string, n long").where(F.char_length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


def groups(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, block, indexed, word, n): the words of each group; a group of more than
    ``block`` words has several blocks, each with all words as queries."""
    length = F.char_length("word")

    def keys(k):
        half = F.floor(k / 2).cast("int")
        return [F.concat_ws(":", F.lit("first"), k, F.substring("word", F.lit(1), half)),
                F.concat_ws(":", F.lit("last"), k, F.substring("word", length - half + 1, half))]

    every = F.array(*keys(length), *(F.when(length > LEAST_LENGTH, x) for x in keys(length - 1)))
    members = words.select(F.explode(F.filter(every, lambda x: x.isNotNull())).alias("key"), "word", "n")
    large = (members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
             .select("key", F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    several = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word"), several).cast("int")
    return (members.join(large, "key", "left")
            .select("key", F.explode(F.sequence(F.lit(0), several - 1)).alias("block"), own.alias("own"), "word", "n")
            .select("key", "block", (F.col("block") == F.col("own")).alias("indexed"), "word", "n"))


class SlicedIndex:
    """Bit sets over the words of a block, one for each (position, letter)."""

    def __init__(self, key: str, words: list[str], counts: list[int]):
        kind, k, _ = key.split(":", 2)
        self.last, self.k = kind == "last", int(k)
        self.words, self.counts = words, counts
        places: dict[tuple[int, str], list[int]] = {}
        for j, w in enumerate(words):
            for at in enumerate(w):
                places.setdefault(at, []).append(j)
        self.sets = {at: self._set(js) for at, js in places.items()}
        self.same = self._set([j for j, w in enumerate(words) if len(w) == self.k])
        self.all = (1 << len(words)) - 1

    def _set(self, places: list[int]) -> int:
        if len(places) < 64:
            return sum(1 << j for j in places)
        bits = bytearray(len(self.words) // 8 + 1)
        for j in places:
            bits[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(bits, "little")

    def near(self, word: str) -> int:
        """The words one edit from ``word``; of pairs of the longer length none."""
        sets, half = self.sets, self.k // 2
        exact, halved = self.all, 0  # no error so far; the same first half
        other = more = less = 0  # one letter replaced, one more in the indexed word, one less
        if len(word) == self.k:
            for i, letter in enumerate(word):
                here = sets.get((i, letter), 0)
                other = other & here | exact & ~here
                more = (more | exact) & sets.get((i + 1, letter), 0)
                exact &= here
                if i + 1 == half:
                    halved = exact
            found = other & self.same | (more | exact) & ~self.same
        else:
            for i, letter in enumerate(word):
                less = less & sets.get((i - 1, letter), 0) | exact
                exact &= sets.get((i, letter), 0)
                if i + 1 == half:
                    halved = exact
            found = less & self.same
        return found & ~halved if self.last else found


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, best_n, best) of each query and block; rows come by key and
    block, the indexed ones first."""
    at, words, counts, index, out = None, [], [], None, []

    def ask(index: SlicedIndex, word: str) -> None:
        found, near, best = index.near(word), 0, None
        while found:
            j = (found & -found).bit_length() - 1
            found &= found - 1
            near += 1
            one = (-index.counts[j], index.words[j])
            best = one if best is None else min(best, one)
        if near:
            out.append((word, near, -best[0], best[1]))

    def answered() -> SlicedIndex:
        made = SlicedIndex(at[0], words, counts)
        if len(words) > 1:
            for w in words:
                ask(made, w)
        return made

    def handed() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(
            zip(*out) if out else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "near", "best_n", "best"])
        out.clear()
        return made

    for b in batches:
        for key, block, indexed, word, n in zip(*(c.to_pylist() for c in b.columns)):
            if (key, block) != at:
                if at and index is None and len(words) > 1:
                    answered()
                at, words, counts, index = (key, block), [], [], None
            if indexed:
                words.append(word)
                counts.append(n)
            else:
                index = index or answered()
                ask(index, word)
        yield handed()
    if at and index is None and len(words) > 1:
        answered()
    yield handed()


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of the words that have near words. ``words``: word, n."""
    dealt = groups(words, block).repartition("key", "block").sortWithinPartitions("key", "block", F.desc("indexed"))
    found = in_arrow(dealt, _near, "word string, near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("first"))
            .select("word", "n_near", F.col("first.word").alias("best"), (-F.col("first.n")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last by pointer jumping."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("top"))
        now = stored(now.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root"),
                                                         F.col("top").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", much_more: int = MUCH_MORE,
                      block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word."""
    words = stored(vocabulary(docs, id_col, text_col), "vocabulary")
    grown = F.col("best_n") >= much_more * F.col("n")
    near = stored(words.join(near_words(words, block), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(grown, F.col("best")).alias("form"),
        F.when(grown, F.col("best_n")).alias("form_n")), "near-words")
    return near.join(roots(near.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
