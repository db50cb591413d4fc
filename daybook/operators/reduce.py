"""Semi-join reduction: rows of a large table cut down to those whose key may be in a
small one, before they are dealt.

The small side's keys are hashed into a bitmap of ``BITS`` bits, kept as a table of 64-bit
words and broadcast: 262,144 words at most, however many keys there are. A row
whose bit is not set has no partner. Some others pass that have none either (about
the share of bits set), so an exact join, merge or aggregate must follow. NULL is a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24
_WORD, _HELD = "_word", "_held"


def _slot(key: str) -> Column:
    # A mask is never NULL, pmod may be: Spark would hash each row again to test that.
    return F.xxhash64(F.col(key).cast("string")).bitwiseAND(F.lit(BITS - 1)).cast("int")


def key_words(rows: DataFrame, key: str) -> DataFrame:
    """The bitmap of the keys of ``rows``: (word number, its 64 bits)."""
    slot = rows.select(_slot(key).alias("_slot"))
    # A bit set by the sign: 1 << 63 is the least long, which bit_or treats as any other.
    bit = F.expr("shiftleft(1L, _slot & 63)")
    return slot.groupBy(F.shiftright("_slot", 6).alias(_WORD)).agg(F.bit_or(bit).alias(_HELD))


def may_match(rows: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """``rows`` without those whose key is surely not among the keys of ``words``."""
    marked = rows.withColumn("_slot", _slot(key)).withColumn(_WORD, F.shiftright("_slot", 6))
    kept = marked.join(F.broadcast(words), _WORD).where(F.expr(f"(shiftright({_HELD}, _slot & 63) & 1L) = 1L"))
    return kept.select(*(F.col(f"`{c}`") for c in rows.columns))
