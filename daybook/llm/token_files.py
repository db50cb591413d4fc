"""Token ids in Arrow files of equal-length sequences.

Documents are dealt into shards by ranges of their ids and sorted; each task
encodes its documents and writes one shard. A shard is an Arrow IPC file of
record batches with two fixed-size-list columns, ``ids`` and ``mask``: the ids
of its documents end to end, cut into sequences of ``SEQUENCE`` ids, the last
one padded and masked. All batches but the last hold ``BATCH`` sequences, so
sequence k lies at a known place, and a memory-mapped shard is read without a
copy. Beside it an Arrow file lists the documents: id, first id in the shard,
number of ids. The manifest, a row per shard, names the files of the attempts
that succeeded; files of lost attempts are not in it.

Texts are split at ASCII blanks, which no token of these vocabularies spans;
each distinct word of a task is numbered, normalised, split and encoded once by
the model of the tokenizers library; documents gather the ids of their words. A tokenizer of
another make is called on whole texts, and so is this one on texts that hold the
content of an added token (as ``<|endoftext|>``), which the library takes for that
token. Ids are those of the library with no option changed.

Cases: a null or empty text has the end id only; a text of any length is
written across batches; rows that share an id are written in the order of a
hash of their texts, null ids first; an empty table gives no shards and no
rows; only the id and text columns are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import in_arrow, partitions_for, ranges, stored, table
from daybook.session import scratch_path

SEQUENCE = 2048
BATCH = 64
END_ID = 2
MAX_WORDS = 600_000
#: Bytes of text in a shard: larger ones encode fewer words in several tasks.
SHARD_BYTES = 32 << 20
#: Bytes of text that are encoded together, or one longer document.
BLOCK = 8 << 20


class Encoder:
    """Ids of whole texts, with the words of a task remembered."""

    def __init__(self, tokenizer_json: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        parts = json.loads(tokenizer_json)
        self.added = [x["content"] for x in parts.get("added_tokens") or [] if x["content"]]
        normal = [x.get("type") for x in (parts.get("normalizer") or {}).get("normalizers", [])]
        pre = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        split, level = pre[0], pre[-1]
        self.by_words = (normal == ["NFC", "Replace", "Lowercase"] and len(pre) == 2 and parts["model"]["type"] == "BPE"
                         and split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert")
                         and level.get("type") == "ByteLevel" and not level.get("add_prefix_space"))
        if self.by_words:
            self.split = regex.compile(split["pattern"]["Regex"])
            # The printable alphabet of byte-level models.
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            other = [b for b in range(256) if b not in plain]
            self.alphabet = {b: b for b in plain} | {b: 256 + k for k, b in enumerate(other)}
        self._forget()

    def _forget(self) -> None:
        """Words by number, with the number of ids of each, and all ids end to end."""
        self.words: dict[str, int] = {}
        self.sizes, self.values = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.pieces: dict[str, list[int]] = {}

    def _piece(self, piece: str) -> list[int]:
        if (ids := self.pieces.get(piece)) is None:
            mapped = piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(self.alphabet)
            ids = self.pieces[piece] = [t.id for t in self.model.tokenize(mapped)]
        return ids

    def _word(self, word: str) -> list[int]:
        if word.isascii():
            word = word.lower()
            if word.isalpha():  # letters are one piece
                return self._piece(word)
        else:
            word = "".join(c.lower() for c in normalize("NFC", word))
        pieces = self.split.findall(word)
        return self._piece(pieces[0]) if len(pieces) == 1 else [i for piece in pieces for i in self._piece(piece)]

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts end to end, number of ids of each); no nulls."""
        if not self.by_words:
            return self._whole(texts.to_pylist())
        marked = np.zeros(len(texts), bool)
        for content in self.added:
            marked |= pc.match_substring(texts, content, ignore_case=True).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._by_words(texts)
        (one, n), (two, m) = self._by_words(texts.filter(pa.array(~marked))), self._whole(texts.filter(pa.array(marked)).to_pylist())
        sizes = np.empty(len(texts), np.int64)
        sizes[~marked], sizes[marked] = n, m
        flat = np.empty(sizes.sum(), np.uint32)
        whole = np.repeat(marked, sizes)
        flat[~whole], flat[whole] = one, two
        return flat, sizes

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > MAX_WORDS:
            self._forget()
        lists = pc.ascii_split_whitespace(texts)
        coded, known = pc.dictionary_encode(lists.flatten()), len(self.words)
        distinct = coded.dictionary.to_pylist()
        numbers = np.array([self.words.setdefault(w, len(self.words)) for w in distinct], np.int64)
        new = [self._word(w) for w, k in zip(distinct, numbers.tolist()) if k >= known]
        if new:
            self.sizes = np.concatenate([self.sizes, np.array([len(x) for x in new], np.int64)])
            self.values = np.concatenate([self.values, np.fromiter(chain.from_iterable(new), np.uint32)])
        at = numbers[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        flat = self.values[ranges((np.cumsum(self.sizes) - self.sizes)[at], sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        return flat, np.diff(upto[words])


def _blocks(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about ``BLOCK`` bytes of text (column 1) each."""
    block = np.cumsum(pc.fill_null(pc.binary_length(whole.column(1)), 0).to_numpy().astype(np.int64)) // BLOCK
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), whole.num_rows]
    return (whole.slice(i, j - i) for i, j in zip(cuts, cuts[1:]) if j > i)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without means Spark's default file system, not the
    disk of the executor."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = given.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(given).toString().replace("s3a://", "s3://", 1)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _Shard:
    """Writes one shard: ids end to end, in batches of equal-length sequences."""

    def __init__(self, path: str, kind: pa.DataType):
        self.system, at = _open(path)
        self.system.create_dir(at.rpartition("/")[0], recursive=True)
        self.kind = kind
        self.schema = pa.schema([("ids", pa.list_(kind, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])
        self.sink = self.system.open_output_stream(at)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.size = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        if self.size >= BATCH * SEQUENCE:
            flat = np.concatenate(self.held)
            full = len(flat) // (BATCH * SEQUENCE) * (BATCH * SEQUENCE)
            for k in range(0, full, BATCH * SEQUENCE):
                self._write(flat[k:k + BATCH * SEQUENCE])
            self.held, self.size = [flat[full:]], len(flat) - full

    def _write(self, flat: np.ndarray) -> None:
        padded = np.zeros(-(-len(flat) // SEQUENCE) * SEQUENCE, self.kind.to_pandas_dtype())
        padded[:len(flat)] = flat
        mask = np.arange(len(padded)) < len(flat)
        self.file.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(padded, self.kind), SEQUENCE),
            pa.FixedSizeListArray.from_arrays(pa.array(mask, pa.bool_()), SEQUENCE)], schema=self.schema))

    def close(self) -> None:
        if self.size:
            self._write(np.concatenate(self.held))
        self.file.close()
        self.sink.close()


def write_tokens(docs: DataFrame, tokenizer_json: str, root: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int | None = END_ID) -> DataFrame:
    """Writes the shards below ``root`` (a shared folder) in ascending order of
    ids and returns their manifest: shard, path, n_docs, n_tokens, start."""
    size = max(json.loads(tokenizer_json)["model"]["vocab"].values()) + 1
    kind = pa.uint16() if max(size, (end_id or 0) + 1) <= 2 ** 16 else pa.uint32()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # The rows of one id may fill several shards.
    order = ["doc_id", F.xxhash64("text")]
    ordered = texts.repartitionByRange(partitions_for(total, SHARD_BYTES, 1), *order).sortWithinPartitions(*order)
    root = _qualified(docs.sparkSession, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        path = f"{root}/shard-{task.partitionId():06d}-{task.taskAttemptId()}.arrow"
        shard, encoder, ids, sizes = None, None, [], []
        for whole in batches:
            for b in _blocks(whole):
                shard, encoder = shard or _Shard(path, kind), encoder or Encoder(tokenizer_json)
                flat, n = encoder.encode(pc.fill_null(b.column(1), ""))
                if end_id is not None:
                    flat, n = np.insert(flat, np.cumsum(n), end_id), n + 1
                shard.add(flat)
                ids.append(b.column(0))
                sizes.append(n)
        if shard is None:
            return
        shard.close()
        n = np.concatenate(sizes)
        listed = pa.record_batch([pa.concat_arrays(ids), pa.array(np.cumsum(n) - n), pa.array(n)],
                                 ["doc_id", "start", "n_tokens"])
        system, at = _open(f"{path}.docs")
        with system.open_output_stream(at) as sink, pa.ipc.new_file(sink, listed.schema) as file:
            file.write_batch(listed)
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([path]),
                                          pa.array([len(n)], pa.int64()), pa.array([shard.total], pa.int64())],
                                         ["shard", "path", "n_docs", "n_tokens"])

    manifest = stored(in_arrow(ordered, write, "shard int, path string, n_docs long, n_tokens long"), "token-manifest")
    # One row a shard: as many as the writing job had tasks.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return stored(manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-manifest")


def open_shard(path: str) -> pa.ipc.RecordBatchFileReader:
    """The shard memory-mapped if it is local: its sequences are views."""
    from pyarrow import fs

    system, at = _open(path)
    return pa.ipc.open_file(pa.memory_map(at) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(at))


def _values(column: pa.FixedSizeListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=column.type.value_type != pa.bool_())


def read_documents(manifest: DataFrame, crc_only: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, token_ids) of the files, ``start`` counting the
    ids of all documents before; with ``crc_only`` the CRC-32 of the ids, as
    little-endian words of 32 bits, stands for them."""
    last = "ids_crc32 long" if crc_only else "token_ids array<int>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                shard, (system, at) = open_shard(row["path"]), _open(f"{row['path']}.docs")
                with system.open_input_file(at) as source:
                    listed = pa.ipc.open_file(source).read_all().combine_chunks()
                span, batch, held = BATCH * SEQUENCE, -1, None
                starts, sizes = (listed.column(k).to_numpy() for k in ("start", "n_tokens"))
                for k in range(0, len(sizes), 500):
                    out = []
                    for start, size in zip(starts[k:k + 500].tolist(), sizes[k:k + 500].tolist()):
                        parts, at = [], start
                        while at < start + size:
                            if at // span != batch:
                                batch = at // span
                                held = _values(shard.get_batch(batch).column(0))
                            upto = min(start + size, (batch + 1) * span)
                            parts.append(held[at - batch * span:upto - batch * span])
                            at = upto
                        ids = np.concatenate(parts) if len(parts) != 1 else parts[0]
                        out.append(zlib.crc32(ids.astype("<u4").tobytes()) if crc_only else ids.astype(np.int32))
                    cut = listed.slice(k, 500)
                    yield pa.RecordBatch.from_arrays(
                        [cut.column("doc_id").combine_chunks(), pa.array(starts[k:k + 500] + row["start"]),
                         pa.array(sizes[k:k + 500]), pa.array(out, pa.int64() if crc_only else pa.list_(pa.int32()))],
                        ["doc_id", "start", "n_tokens", last.split()[0]])

    shards = manifest.select("path", "start").repartition(max(1, manifest.count()))
    return in_arrow(shards, read, f"doc_id long, start long, n_tokens long, {last}")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        tokenizer_json = f.read()
    manifest = write_tokens(table(spark, sf_dir, "documents"), tokenizer_json, scratch_path(spark, "tokens"))
    return read_documents(manifest, crc_only=True)
