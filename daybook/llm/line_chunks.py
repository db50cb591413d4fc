"""Line dedup by content-defined line chunks.

Each line is hashed, a rolling hash runs over the hashes of two lines, and a
chunk ends after a line whose rolling hash is divisible by ``DIVISOR``. The
boundaries follow from the lines around them alone, so an inserted line moves
only those next to it. Chunks of two lines or more that occur again anywhere
are removed; of equal chunks the first of the smallest ``doc_id`` stays.
Equality is of bytes: chunks are grouped by their digest and their text, and a
digest that two texts share removes nothing.

Texts cross the network twice: as chunks, for the grouping (combined before
the shuffle, so a chunk that a third of all rows hold is one row per task),
and as documents, to be rebuilt. Chunks return to their documents by digest.

Cases: a null text stays null, an empty one empty; a text of which every chunk
is removed becomes empty; rows that share a ``doc_id`` count as one document
and are each rebuilt; rows with a null ``doc_id`` are left as they are; an
empty table gives no rows; other columns pass through, whatever their names.

``dedup_line_chunks`` compares no other chunks than these, as its SQL does, so
a repeated passage goes only as far as whole chunks lie in it.
``dedup_line_runs`` also compares every two consecutive lines that are not
blank, with the blank ones between them. These overlap, so every repeated run of
two such lines or more goes whole from all documents but the first, wherever the
boundaries of chunks are. Equality is that of SHA-256 digests there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import fresh, let, stored, table

DIVISOR = 2
MIN_LINES = 2
#: Fixed values of the rolling hash.
FACTOR = 1000003
PRIME = 2147483647


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _ends(h: Column) -> Column:
    """The numbers of the lines that end a chunk, from the hashes of lines."""
    last = F.size(h) - 1
    rolled = F.transform(h, lambda x, i: F.when(
        (i == last) | ((F.coalesce(F.get(h, i - 1), F.lit(0)) * FACTOR + x) % PRIME % DIVISOR == 0), i))
    return F.filter(rolled, lambda x: x.isNotNull())


def line_chunks(text: Column) -> Column:
    """array<struct(n, chunk)>: the chunks of a text and their numbers of lines.
    Joined by line ends they are the text."""

    def cut(lines: Column) -> Column:
        def chunks(e: Column) -> Column:
            def one(end: Column, k: Column) -> Column:
                start = F.coalesce(F.get(e, k - 1) + 1, F.lit(0))
                return F.struct((end - start + 1).alias("n"),
                                F.array_join(F.slice(lines, start + 1, end - start + 1), "\n").alias("chunk"))
            return F.transform(e, one)

        return let(let(F.transform(lines, _line_hash), _ends), chunks)

    return let(F.split(text, "\n"), cut)


def _first_chunks(chunks: Column, min_lines: int) -> Column:
    """array<struct(chunk, at)>: of the long chunks, the first of each text."""
    long_ones = F.filter(F.transform(chunks, lambda c, i: F.struct(c["n"].alias("n"), c["chunk"].alias("chunk"),
                                                                   i.alias("at"))), lambda c: c["n"] >= min_lines)
    ordered = F.sort_array(F.transform(long_ones, lambda c: F.struct(c["chunk"].alias("chunk"), c["at"].alias("at"))))
    return let(ordered, lambda s: F.filter(s, lambda c, i: ~F.get(s, i - 1)["chunk"].eqNullSafe(c["chunk"])))


def repeated_chunks(occurrences: DataFrame) -> DataFrame:
    """(digest, keeper): digests of chunks that several documents hold, byte for
    byte, and the smallest id of these."""
    by_text = occurrences.groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("keeper"))
    return (by_text.groupBy("digest")
            .agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"), F.min("keeper").alias("keeper"))
            .where("texts = 1 AND n > 1").select("digest", "keeper"))


def dedup_line_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with repeated chunks of ``min_lines`` lines or more removed from
    their texts; columns and rows as given."""
    first = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("id"),
                     F.explode(_first_chunks(line_chunks(F.col(text_col)), min_lines)).alias("c"))
             .select("id", "c.at", "c.chunk", F.md5("c.chunk").alias("digest")))
    again = repeated_chunks(first.select("id", "digest", "chunk"))
    gone_name, key = fresh(docs, "gone", "gone_id")
    gone = (first.select("id", "at", "digest").join(again, "digest").where("id != keeper")
            .groupBy(F.col("id").alias(key)).agg(F.collect_set("at").alias(gone_name)))

    def rebuilt(chunks: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(chunks) - 1)
        short = F.filter(every, lambda i: F.get(chunks, i)["n"] < min_lines)
        firsts = F.transform(_first_chunks(chunks, min_lines), lambda c: c["at"])
        keep = F.sort_array(F.array_except(F.concat(short, firsts), F.coalesce(F.col(gone_name), F.array().cast("array<int>"))))
        return F.array_join(F.transform(keep, lambda i: F.get(chunks, i)["chunk"]), "\n")

    text = F.when(F.col(id_col).isNull(), F.col(text_col)).otherwise(let(line_chunks(F.col(text_col)), rebuilt))
    joined = docs.join(gone, F.col(id_col) == F.col(key), "left")
    return joined.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def _spans(text: Column) -> Column:
    """array<struct(digest, a, b, again)>: the lines a to b of each chunk of two
    lines or more and of each two consecutive lines that are not blank; again: an
    equal span that does not overlap it is before it in this text."""

    def cut(lines: Column) -> Column:
        def chunks(e: Column) -> Column:
            spans = F.transform(e, lambda end, k: F.struct(F.coalesce(F.get(e, k - 1) + 1, F.lit(0)).alias("a"), end.alias("b")))
            return F.filter(spans, lambda s: s["b"] - s["a"] + 1 >= MIN_LINES)

        def pairs(filled: Column) -> Column:
            spans = F.transform(filled, lambda a, k: F.struct(a.alias("a"), F.get(filled, k + 1).alias("b")))
            return F.filter(spans, lambda s: s["b"].isNotNull())

        def digest(s: Column) -> Column:
            whole = F.array_join(F.slice(lines, s["a"] + 1, s["b"] - s["a"] + 1), "\n")
            return F.struct(F.unhex(F.sha2(whole, 256)).alias("digest"), s["a"].alias("a"), s["b"].alias("b"))

        filled = F.filter(F.transform(lines, lambda x, i: F.when(F.trim(x) != "", i)), lambda i: i.isNotNull())
        every = F.array_distinct(F.concat(let(filled, pairs), let(let(F.transform(lines, _line_hash), _ends), chunks)))
        return F.sort_array(F.transform(every, digest))

    def marked(spans: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            before = F.get(spans, i - 1)
            again = before["digest"].eqNullSafe(s["digest"]) & (before["b"] < s["a"])
            return F.struct(s["digest"].alias("digest"), s["a"].alias("a"), s["b"].alias("b"),
                            F.coalesce(again, F.lit(False)).alias("again"))
        return F.transform(spans, one)

    return let(let(F.split(text, "\n"), cut), marked)


def dedup_line_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines of spans (see ``_spans``) that a document of
    smaller id or the text itself holds before; columns and rows as given. What
    is removed is left somewhere: each line goes for an equal one further to the
    front, by (id, line). Positions belong to (id, hash of the text), as rows may
    share an id."""
    found = stored(docs.where(F.col(id_col).isNotNull())
                   .select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"),
                           F.explode(_spans(F.col(text_col))).alias("s")).select("id", "version", "s.*"), "line-spans")
    repeated = (found.groupBy("digest").agg(F.min("id").alias("keeper"), F.max("id").alias("last"))
                .where("keeper < last").select("digest", "keeper"))
    across = found.where("NOT again").join(repeated, "digest").where("id != keeper")
    gone_name, key, version = fresh(docs, "gone", "gone_id", "gone_version")
    gone = (across.select("id", "version", "a", "b").unionByName(found.where("again").select("id", "version", "a", "b"))
            .groupBy(F.col("id").alias(key), F.col("version").alias(version))
            .agg(F.collect_set(F.struct("a", "b")).alias(gone_name)))

    def rebuilt(lines: Column) -> Column:
        out = F.flatten(F.transform(F.col(gone_name), lambda s: F.sequence(s["a"], s["b"])))
        keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), out)
        return F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col(gone_name).isNull(), F.col(text_col)).otherwise(let(F.split(F.col(text_col), "\n"), rebuilt))
    joined = docs.join(gone, (F.col(id_col) == F.col(key)) & (F.xxhash64(text_col) == F.col(version)), "left")
    return joined.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after the removal."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (dedup_line_chunks(docs)
            .select("doc_id", F.length("text").cast("long").alias("n_chars_left"), F.col("text").alias("text_left")))


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
ends AS (SELECT *, (coalesce(lag(h) OVER d, 0) * {FACTOR} + h) % {PRIME} % {DIVISOR} = 0 AS is_end
         FROM hashed WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, line, coalesce(sum(is_end::INT) OVER (PARTITION BY doc_id ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM ends),
chunks AS (SELECT doc_id, k, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk
           FROM numbered GROUP BY doc_id, k),
ranked AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, k) AS r FROM chunks),
kept AS (SELECT doc_id, string_agg(chunk, chr(10) ORDER BY k) AS text_left
         FROM ranked WHERE n < {MIN_LINES} OR r = 1 GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN length(coalesce(text_left, '')) END::BIGINT AS n_chars_left,
       CASE WHEN d.text IS NOT NULL THEN coalesce(text_left, '') END AS text_left
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
