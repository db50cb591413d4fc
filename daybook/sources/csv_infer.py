"""CSV with inferred types and kept rejects.

``infer`` reads the text of a sample of rows and finds, in one aggregate, the narrowest type
of each column that reads all its values back as they are written; the result is a
contract that can be stored. ``read_typed`` then reads every row under it: a row that does
not fit is not lost and does not fail the load, its text goes to ``rejected``.

The lattice, from narrow to wide: bigint, double, date, timestamp, boolean, string.
Only canonical whole numbers are numbers ("007" and "+1" stay text); a column without
values is text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTED = "rejected"
_WHOLE = r"^(0|-?[1-9][0-9]{0,17})$"
_DECIMAL = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"

#: Types from narrow to wide and what a text must satisfy to be one.
LATTICE = [
    ("bigint", lambda c: c.rlike(_WHOLE)),
    ("double", lambda c: c.rlike(_DECIMAL)),
    ("date", lambda c: c.rlike(_DAY) & c.try_cast("date").isNotNull()),
    ("timestamp", lambda c: c.rlike(_INSTANT) & c.try_cast("timestamp").isNotNull()),
    ("boolean", lambda c: F.lower(c).isin("true", "false")),
]


def _options(reader, multi_line: bool):
    # Quoted fields as this library writes them; multi-line files are not split.
    return (reader.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][XXX]"))


def read_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text; names from the header."""
    return _options(spark.read, multi_line).csv(path)


def infer(text: DataFrame, sample: float = 1.0, seed: int = 1) -> T.StructType:
    """The narrowest contract that the values of a share ``sample`` of the rows allow; what
    a later row breaks is rejected by ``read_typed``, so a small sample loses nothing."""
    rows = text if sample >= 1 else text.sample(sample, seed)

    def narrowest(name: str) -> Column:
        c = F.col(f"`{name}`")
        fits = [(kind, F.bool_and(F.when(c.isNotNull(), F.coalesce(test(c), F.lit(False))))) for kind, test in LATTICE]
        return F.coalesce(*(F.when(fit, F.lit(kind)) for kind, fit in fits), F.lit("string"))

    if not text.columns:
        return T.StructType()
    found = rows.agg(F.array(*(narrowest(c) for c in text.columns))).first()[0]
    return T.StructType([T.StructField(c, T._parse_datatype_string(kind)) for c, kind in zip(text.columns, found)])


def save_contract(spark: SparkSession, contract: T.StructType, path: str) -> None:
    spark.createDataFrame([(contract.json(),)], "contract string").coalesce(1).write.mode("overwrite").text(path)


def load_contract(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def read_typed(spark: SparkSession, path: str, contract: T.StructType, multi_line: bool = False) -> DataFrame:
    """Every row under the contract and ``rejected``: the text of a row that does not
    fit (a value of another type, too many or too few fields), else NULL. What could be
    read of a rejected row is in its other columns."""
    whole = T.StructType([*contract.fields, T.StructField(REJECTED, T.StringType())])
    return (_options(spark.read, multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
            .schema(whole).csv(path))
