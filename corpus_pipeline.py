"""A corpus pipeline over ``documents``.

Each stage works on the whole of what the one before kept, written as Parquet
in the shared folder and read again:

1. language ID: documents without a letter, or whose language is in doubt, go;
2. line dedup: repeated runs of two lines or more are cut from the texts;
3. MinHash near-dedup: one document of each group of near copies stays;
4. source mix: each document is repeated to the target weights and shuffled;
5. byte-level BPE: texts become ids, which are decoded again.

All but the last return the columns of ``documents``. SQL cannot express
stages 1, 3 and 5; the rows are tested against the stages' brute-force
versions instead.

What a stage returns must be written before the next one is called, as ``run`` does: a
stage begins by deleting the scratch tables of the one before.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.byte_bpe import decode, encode, read_ranks
from daybook.llm.common import remove, scratch, stored, table
from daybook.llm.language_id import UNKNOWN, predict, train_on_documents
from daybook.llm.line_chunks import dedup_line_runs
from daybook.llm.near_dup import drop_near_duplicates
from daybook.llm.source_mix import mix_sources

#: A language is in doubt whose score is less than this share of the way from the
#: lowest score it can have to 1 (0.4 for two families of several languages).
MIN_CERTAINTY = 0.2
#: Words of a shingle in near-dedup.
SHINGLE = 5
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch tables of the last stage, by application.
_left: dict[str, list[str]] = {}


def _clearing(stage: Stage) -> Stage:
    """``stage``, which first deletes the scratch tables of the stage before."""
    @functools.wraps(stage)
    def cleared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        remove(spark, _left.pop(application, []))
        with scratch() as own:
            out = stage(spark, docs, sf_dir)
        _left[application] = own
        return out
    return cleared


@_clearing
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train_on_documents(docs)
    least = {lang: low + MIN_CERTAINTY * (1 - low) for lang, low in model.lowest_scores().items()} | {UNKNOWN: 1.0}
    needed = F.create_map(*(F.lit(x) for pair in least.items() for x in pair))
    found = predict(docs, model)
    lang, score = found.columns[-2:]
    sure = (F.col(lang) != UNKNOWN) & (F.col(score) >= F.element_at(needed, F.col(lang)))
    return found.where(sure).select(*(F.col(f"`{c}`") for c in docs.columns))


@_clearing
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_line_runs(docs)


@_clearing
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, size=SHINGLE)


@_clearing
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


@_clearing
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids, and the text decoded from them."""
    ranks = read_ranks(public_tokenizers.path(RANK_FILE))
    encoded = encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN, keep_text=False)
    return decode(encoded, ranks).select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"),
                                         "token_ids", F.col("decoded").cast("string").alias("text"))


STAGES = [("language ID", identify_language), ("line dedup", drop_repeated_lines),
          ("near dedup", drop_near_copies), ("source mix", mix), ("byte BPE", tokenize)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
