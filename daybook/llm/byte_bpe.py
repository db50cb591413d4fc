"""Byte-level BPE encoding and decoding with a file of ranks.

Texts are split by the pattern into words, and distinct words are encoded, not
occurrences: ranked merges are folded over the bytes of all of a batch's new words at once.

1. The commonest words of a sample of the texts (``COMMON`` words at most, of about
   ``SAMPLE`` characters) are folded once for the corpus. They are a memory of answers
   only: a word that is not among them is folded where it stands.
2. One pass without a shuffle encodes all texts. It numbers the words of a part of the
   documents (a part has ``PART_WORDS`` further distinct words or ``PART_ITEMS`` words in all
   at most, or is a block), folds those that are neither common nor known to the part,
   and gathers the ids of each document by its words' numbers.

Nothing is dealt or stored, so disk and memory do not grow with the input. A rare word
is folded once for each part that has it. The texts are read three times (their length, the
sample, the pass), so ``docs`` should be a stored table.

A step of the fold takes the lowest rank of a word's pairs and merges it
wherever it stands, left to right, for each word at the same time; a merge makes no pair of a
lower rank in a vocabulary that its own merges reproduce, so this equals one merge at a
time. Only pairs beside a merge are looked up again, and a word without a pair to merge
leaves the fold. A word of n bytes takes as many steps as it has different merges, n - 1 at
most; words of any length are folded as all others.

The pattern is the JVM's; texts with characters that its Unicode tables lack are split in Python.

Cases: a null text counts as empty and has no ids; a byte without a rank has a null id; texts and
words may be of any length; every row is encoded by itself, so repeated ids do no harm; other
columns pass through, whatever their names (where one has the name of the new
column, see ``fresh``, the new one is still the last); an empty table gives no rows.
Decoding concatenates the pieces of the ids; null ids decode to nothing.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import fresh, in_arrow, ranges, table

PART_WORDS = 200_000
PART_ITEMS = 4_000_000
#: Documents whose words are numbered together.
BLOCK = 500
#: Words that are folded once for the corpus; characters of the sample that they are taken from.
COMMON = 50_000
SAMPLE = 8_000_000
#: The rank of a pair that makes no piece.
NONE = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """The pairs of ids whose pieces make a piece of the vocabulary, and its rank, which is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.end = ranks, max(ranks.values(), default=-1) + 1
        # Bytes without a rank have numbers from ``end`` on, so that they can be merged.
        ids = {bytes([k]): self.end + k for k in range(256)} | ranks
        found = {(one << 32) + two: rank for piece, rank in ranks.items() for k in range(1, len(piece))
                 if (one := ids.get(piece[:k])) is not None and (two := ids.get(piece[k:])) is not None}
        self.pairs = np.array(sorted(found), np.int64)
        self.made = np.array([found[k] for k in self.pairs.tolist()], np.int32)
        self.single = np.array([ids[bytes([k])] for k in range(256)], np.int32)
        self.double = self.rank(np.repeat(self.single, 256), np.tile(self.single, 256))

    def rank(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        pair = (one.astype(np.int64) << 32) + two
        if not len(self.pairs):
            return np.full(len(pair), NONE, np.int32)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.made[at], NONE)

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, values) of the lists of ids of ``words``."""
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int32)
        known, rest = np.flatnonzero(whole >= 0), np.flatnonzero(whole < 0)
        done = [(known, whole[known])]
        others = [words[k] for k in rest.tolist()]
        of = np.repeat(rest, np.array([len(w) for w in others], np.int64))
        data = np.frombuffer(b"".join(others), np.uint8)
        ids, rank = self.single[data], np.full(len(data), NONE, np.int32)
        # rank[i] is that of the pieces i and i + 1, if they are of one word.
        rank[:-1] = np.where(of[1:] == of[:-1], self.double[data[:-1] * np.int32(256) + data[1:]], NONE)
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(of)))
            more = least != NONE
            if not more.all():
                done.append((of[~more], ids[~more]))
                of, ids, rank, least = of[more], ids[more], rank[more], least[more]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == least)
            # Of pairs that share pieces every other one is merged, from the left.
            k = np.arange(len(at))
            at = at[(k - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, k, 0))) % 2 == 0]
            ids[at] = least[at]
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            of, ids, rank = of[kept], ids[kept], rank[kept]
            at -= np.arange(len(at))
            at = np.concatenate([at, at[at > 0] - 1])
            after = np.minimum(at + 1, len(ids) - 1)
            rank[at] = np.where((after > at) & (of[after] == of[at]), self.rank(ids[at], ids[after]), NONE)
        of, values = (np.concatenate(x) for x in zip(*done))
        return np.bincount(of, minlength=len(words)), values[np.argsort(of, kind="stable")]


def _split(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0))


def common_words(texts: DataFrame, pattern: str) -> list[str]:
    """The commonest words of a sample of ``texts`` (one column), ``COMMON`` at most."""
    text = F.col(f"`{texts.columns[0]}`")
    size = texts.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    part = texts.sample(SAMPLE / size, seed=1) if size > SAMPLE else texts
    counts = part.select(F.explode(_split(text, pattern)).alias("word")).groupBy("word").count()
    return counts.orderBy(F.desc("count"), "word").limit(COMMON).select("word").toArrow().column(0).to_pylist()


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", ids_col: str = "token_ids",
           keep_text: bool = True) -> DataFrame:
    """``docs`` and, as the last column, the ids of the text (array of int)."""
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    part, word, ids = fresh(docs, "part", "word", ids_col)
    n, columns = len(kept), [F.col(f"`{f.name}`") for f in kept]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # Characters that are unassigned to the JVM may be letters to others.
    strange = F.rlike(text, F.lit(r"\p{Cn}"))
    given = docs.select(*columns, F.when(~strange, _split(text, pattern)).alias(part), F.when(strange, text).alias(word))
    merges = Merges(ranks)
    common_texts = common_words(docs.select(F.col(f"`{text_col}`")), pattern)
    common_sizes, common_values = merges.fold([w.encode() for w in common_texts])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, common = regex.compile(pattern), {w: k for k, w in enumerate(common_texts)}
        seen, items, sizes, values = {}, 0, common_sizes, common_values
        starts = np.cumsum(sizes) - sizes
        for whole in batches:
            for b in (whole.slice(k, BLOCK) for k in range(0, whole.num_rows, BLOCK)):
                if len(seen) > PART_WORDS or items > PART_ITEMS:
                    seen, items, sizes, values = {}, 0, common_sizes, common_values
                    starts = np.cumsum(sizes) - sizes
                lists = b.column(n)
                if lists.null_count:
                    lists = pa.array([split.findall(o) if w is None else w for w, o in
                                      zip(lists.to_pylist(), b.column(n + 1).to_pylist())], pa.list_(pa.string()))
                coded, before = pc.dictionary_encode(lists.flatten()), len(common) + len(seen)
                distinct = coded.dictionary.to_pylist()
                of = np.array([k if (k := common.get(w)) is not None else seen.setdefault(w, len(common) + len(seen))
                               for w in distinct], np.int64)
                items += len(coded)
                if len(common) + len(seen) > before:
                    more, found = merges.fold([w.encode() for w, k in zip(distinct, of.tolist()) if k >= before])
                    sizes, values = np.concatenate([sizes, more]), np.concatenate([values, found])
                    starts = np.cumsum(sizes) - sizes
                flat = of[coded.indices.to_numpy()]
                of_word = sizes[flat]
                words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)])
                ends = np.concatenate([[0], np.cumsum(of_word)])[words]
                got = values[ranges(starts[flat], of_word)]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(got, pa.int32(), mask=got >= merges.end))
                yield pa.RecordBatch.from_arrays([*b.columns[:n], lists], [*(f.name for f in kept), ids])

    return in_arrow(given, encoded, T.StructType([*(T.StructField(f.name, f.dataType) for f in kept),
                                                  T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def _concatenated(lists: pa.ListArray, pieces: pa.BinaryArray) -> pa.BinaryArray:
    """The pieces that the numbers of each list name, one after another."""
    taken = pieces.take(lists.flatten())
    ends = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, taken.offset * 4)
    bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
    return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends[bounds]), taken.buffers()[2]])


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str | None = None, bytes_col: str = "decoded",
           decimal_col: str | None = None) -> DataFrame:
    """``encoded`` with the concatenated binary pieces of its ids (of the last column,
    if none is named) and, if named, the ids in decimal with commas between."""
    names = encoded.columns
    at = names.index(ids_col or names[-1])
    table_of = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        table_of[rank] = piece
    new = fresh(encoded, bytes_col, *([decimal_col] if decimal_col else []))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in encoded.schema.fields),
                           *(T.StructField(c, t) for c, t in zip(new, (T.BinaryType(), T.StringType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(table_of, pa.binary())
        decimals = pa.array([b"%d," % i for i in range(len(table_of))], pa.binary())
        for whole in batches:
            for b in (whole.slice(k, BLOCK) for k in range(0, whole.num_rows, BLOCK)):
                out = [_concatenated(b.column(at), pieces)]
                if decimal_col:
                    out.append(pa.array([x[:-1].decode() for x in _concatenated(b.column(at), decimals).to_pylist()], pa.string()))
                yield pa.RecordBatch.from_arrays([*b.columns, *out], [*names, *new])

    return in_arrow(encoded, run, schema)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, ranks, public_tokenizers.PATTERN, keep_text=False)
    return decode(encoded, ranks, decimal_col="decimals").select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2("decimals", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
