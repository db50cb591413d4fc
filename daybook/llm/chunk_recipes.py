"""Exact dedup by recipes of content-defined chunks.

1. A text without its blanks is cut into chunks where its own bytes say so: a
   chunk has ``MIN_CHUNK`` bytes at least and ends after the first pair of bytes
   from two fixed sets, so an edit moves only the cuts next to it. Its recipe is
   the ordered list of the chunks' 64-bit hashes.
2. Every distinct chunk crosses the network once (combined before the shuffle, so a
   chunk that a third of all rows hold is a row per task). Chunks are grouped by
   hash and bytes. A hash that stands for one text is a verified identifier; where
   two texts share a hash, each gets a number and the recipes that hold this hash
   are written anew with (hash, number).
3. Recipes, a few bytes for each chunk, are grouped: equal lists of verified
   identifiers are equal texts. Whole texts do not move, and nothing is decided by
   a hash alone.

Cases: a null text counts as empty; empty texts and those of blanks only are equal;
a text of fewer bytes than a chunk is one chunk; of rows that repeat doc_id and text
one is kept; a null ``doc_id`` comes after all others, and ``kept`` tells whether
such a row stays; an empty table gives no rows; other columns are not read
(``drop_exact_duplicates`` passes them through, whatever their names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import fresh, let, stored, table

#: Deleted before texts are compared.
BLANK = "[\\x20\\x09-\\x0D]+"
MIN_CHUNK = 511
#: Bits of a chunk's hash (fewer in tests, so that texts share hashes).
HASH_BITS = 64


def _some_bytes(step: int, rest: int) -> str:
    """A set of one in ``step`` bytes, spread over all scripts, as a class of a pattern."""
    return "[" + "".join(f"\\x{b:02X}" for b in range(256) if b * 151 % 256 % step == rest) + "]"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def chunks_of(plain: Column, min_chunk: int = MIN_CHUNK) -> Column:
    """array<string>: the chunks of a text in order. A character stands for a byte,
    so that cuts follow the bytes in every script."""
    pattern = f"(?s).{{{min_chunk},}}?{_some_bytes(8, 3)}{_some_bytes(8, 6)}|.+"
    return F.regexp_extract_all(F.decode(F.encode(plain, "UTF-8"), "ISO-8859-1"), F.lit(pattern), F.lit(0))


def _hash(chunk: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits) if bits < 64 else F.xxhash64(chunk)


def _clashing(texts: DataFrame, min_chunk: int, bits: int) -> DataFrame:
    """(hash, chunk, number): the chunks whose hash another chunk has too, numbered
    by their bytes within it. As a rule there are none."""
    chunk = texts.select(F.explode(chunks_of(normalised(F.col("text")), min_chunk)).alias("chunk"))
    distinct = (chunk.select(_hash(F.col("chunk"), bits).alias("hash"), "chunk")
                .groupBy("hash", "chunk").agg(F.count(F.lit(1)).alias("times")))
    several = stored(distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("chunks")).where("chunks > 1").select("hash"),
                     "clashing-hashes")
    if several.isEmpty():
        return several.select("hash", F.lit("").alias("chunk"), F.lit(0).alias("number"))
    number = F.row_number().over(Window.partitionBy("hash").orderBy("chunk"))
    return stored(distinct.join(several, "hash").select("hash", "chunk", number.alias("number")), "clashing-chunks")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chunk: int = MIN_CHUNK,
            bits: int = HASH_BITS) -> DataFrame:
    """(id, row, n_chars, sha256, recipe, numbers) of each row: texts without blanks
    are equal if and only if recipe and numbers are. ``numbers`` holds (position,
    number) of the chunks whose hash is not theirs alone."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    plain = normalised(F.col("text"))
    whole = texts.select("id", F.monotonically_increasing_id().alias("row"),
                         F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                         F.unhex(F.sha2(plain, 256)).alias("sha256"),
                         F.transform(chunks_of(plain, min_chunk), lambda c: _hash(c, bits)).alias("recipe"))
    found = stored(whole, "recipes")
    clashes = _clashing(texts, min_chunk, bits)
    none = F.array().cast("array<struct<at:int,number:int>>")
    if clashes.isEmpty():
        return found.withColumn("numbers", none)
    # Only documents that hold such a hash are cut again.
    holders = (found.select("row", "id", "sha256", F.explode("recipe").alias("hash"))
               .join(clashes.select("hash").distinct(), "hash", "left_semi").select("row", "id", "sha256").distinct())
    numbered = (texts.withColumn("sha256", F.unhex(F.sha2(plain, 256)))
                .join(holders.select("id", "sha256").distinct()
                      .withColumnsRenamed({"id": "holder", "sha256": "holder_sha256"}),
                      F.col("id").eqNullSafe(F.col("holder")) & (F.col("sha256") == F.col("holder_sha256")), "left_semi")
                .dropDuplicates(["id", "sha256"])
                .select("id", "sha256", F.posexplode(chunks_of(plain, min_chunk)).alias("at", "chunk"))
                .withColumn("hash", _hash(F.col("chunk"), bits)).join(clashes, ["hash", "chunk"])
                .groupBy(F.col("id").alias("holder"), F.col("sha256").alias("holder_sha256"))
                .agg(F.sort_array(F.collect_list(F.struct("at", "number"))).alias("numbers")))
    return (found.join(numbered, F.col("id").eqNullSafe(F.col("holder")) & (F.col("sha256") == F.col("holder_sha256")), "left")
            .select(*found.columns, F.coalesce("numbers", none).alias("numbers")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chunk: int = MIN_CHUNK,
                     bits: int = HASH_BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row: of equal texts
    the row of most characters stays, then of smallest id."""
    made = recipes(docs, id_col, text_col, min_chunk, bits)
    # ~x falls as x grows, for every x; the row of a null id is the last.
    order = F.struct("n_chars", F.bitwise_not("id").alias("id"), F.bitwise_not("row").alias("row"))
    groups = (made.groupBy("recipe", "numbers").agg(F.max(order).alias("first"), F.count(F.lit(1)).alias("size"))
              .where("size > 1"))
    joined = made.join(groups, ["recipe", "numbers"], "left")
    alone = F.col("size").isNull()
    return joined.select(
        F.col("id").alias("doc_id"), F.when(alone, F.col("id")).otherwise(F.bitwise_not(F.col("first.id"))).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.bitwise_not(F.col("first.row")) == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the ids that another row stays for; rows without an id stay."""
    [gone] = fresh(docs, "gone_id")
    out = (exact_duplicates(docs, id_col, text_col).groupBy("doc_id").agg(F.max("kept").alias("stays"))
           .where("NOT stays").select(F.col("doc_id").alias(gone)))
    return docs.join(out, F.col(f"`{id_col}`") == F.col(gone), "left_anti")


def op13_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE = """
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS p FROM documents),
ranked AS (
  SELECT doc_id, p, first_value(doc_id) OVER (PARTITION BY p ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY p) AS group_size FROM plain)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(p) AS text_sha256 FROM ranked
"""
