"""Data tests as queries. Every test reports (test, table_name, column_name,
failures); zero failures means the test passes. ``check_table`` runs all tests of a
table that need no other table - not-null, rules and every uniqueness key set - in one
scan of it and one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import reduce as R

REPORT = ["test", "table_name", "column_name", "failures"]


def _row(test: str, table: str, column: str | None, failures) -> list:
    return [F.lit(test).alias("test"), F.lit(table).alias("table_name"),
            F.lit(column).cast("string").alias("column_name"), failures.cast("bigint").alias("failures")]


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return check_table(df, table, not_null=columns)


def check_table(df: DataFrame, table: str, not_null: list[str] | None = None,
                rules: dict[str, F.Column] | None = None, unique: list[list[str]] | None = None) -> DataFrame:
    """All these tests of one table in one scan.

    Without key sets it is a single aggregate. With them it is one aggregate over
    ``GROUPING SETS``: each key set and, for the counts, the empty set; a second, small
    one counts the keys held by more than one row. NULL is a key value. Rows are
    combined before the shuffle, so a key that a third of them hold is a row a task."""
    not_null, rules, unique = not_null or [], rules or {}, unique or []
    counted = [("not_null", c, F.col(c).isNull()) for c in not_null] + [("rule", n, p) for n, p in rules.items()]
    keys = list(dict.fromkeys(k for ks in unique for k in ks))
    flags = [f"_flag{i}" for i in range(len(counted))]
    slim = df.select(*keys, *(F.coalesce(p, F.lit(False)).cast("int").alias(f) for f, (_, _, p) in zip(flags, counted)))
    sums = [F.sum(f).cast("bigint").alias(f) for f in flags]
    if not unique:
        found = slim.agg(*sums)
    else:
        # In the group of a key set the others' keys are NULL; grouping_id tells the sets apart.
        sets = [[F.col(k) for k in ks] for ks in unique] + [[]]
        grouped = slim.groupingSets(sets, *(F.col(k) for k in keys)).agg(
            F.grouping_id(*(F.col(k) for k in keys)).alias("_set"), F.count(F.lit(1)).alias("_n"), *sums)
        ids = [sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in ks) for ks in [*unique, []]]
        found = grouped.agg(
            *(F.count_if((F.col("_set") == ids[i]) & (F.col("_n") > 1)).alias(f"_key{i}") for i in range(len(unique))),
            *(F.max(F.when(F.col("_set") == ids[-1], F.col(f))).alias(f) for f in flags))
    rows = [(test, name, flag) for (test, name, _), flag in zip(counted, flags)]
    rows += [("unique", ",".join(ks), f"_key{i}") for i, ks in enumerate(unique)]
    report = F.array(*(F.struct(F.lit(test).alias("test"), F.lit(table).alias("table_name"), F.lit(name).alias("column_name"),
                                F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("failures")) for test, name, c in rows))
    return found.select(F.inline(report))


def check_tables(tables: list[tuple[DataFrame, str, list[str], dict[str, F.Column]]]) -> DataFrame:
    """``check_table`` of several tables, given as (table, name, columns that are not NULL, rules), in one
    aggregate: each table is scanned once, and a task deals a row a table."""
    tested = [[("not_null", c, F.col(c).isNull()) for c in not_null] + [("rule", n, p) for n, p in rules.items()]
              for _, _, not_null, rules in tables]
    flags = [f"_flag{i}" for i in range(max(map(len, tested)))]
    frames = []
    for i, ((df, *_), found) in enumerate(zip(tables, tested)):
        preds = [F.coalesce(p, F.lit(False)).cast("int") for _, _, p in found]
        preds += [F.lit(0)] * (len(flags) - len(preds))
        frames.append(df.select(F.lit(i).alias("_table"), *(p.alias(f) for p, f in zip(preds, flags))))
    # A row of zeros for each table, which may be empty.
    none = tables[0][0].sparkSession.range(0, len(tables), 1, 1)
    frames.append(none.select(F.col("id").cast("int").alias("_table"), *(F.lit(0).alias(f) for f in flags)))
    sums = union_all(frames).groupBy("_table").agg(*(F.sum(f).cast("bigint").alias(f) for f in flags))
    report = F.lit(None)
    for i, ((_, table, *_), found) in enumerate(zip(tables, tested)):
        rows = F.array(*(F.struct(F.lit(test).alias("test"), F.lit(table).alias("table_name"), F.lit(name).alias("column_name"),
                                  F.col(f).alias("failures")) for f, (test, name, _) in zip(flags, found)))
        report = F.when(F.col("_table") == i, rows).otherwise(report)
    return sums.select(F.inline(report))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    p = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")


def check_relationship(child: DataFrame, parent: DataFrame, table: str, child_key: str,
                       parent_key: str) -> DataFrame:
    """The number of ``orphans``, see ``check_relationships``."""
    return check_relationships([(child, parent, table, child_key, parent_key)])


def check_relationships(related: list[tuple[DataFrame, DataFrame, str, str, str]]) -> DataFrame:
    """The number of ``orphans`` of each (child, parent, child's name, child key, parent key), all
    in one aggregate: children and parents are counted by key, and only parents whose key a
    child may hold are dealt."""
    frames = []
    for i, (child, parent, _, child_key, parent_key) in enumerate(related):
        keyed = child.select(F.col(child_key).cast("string").alias("_key")).where(F.col("_key").isNotNull())
        near = R.may_match(parent.select(F.col(parent_key).cast("string").alias("_key")), "_key", R.key_words(keyed, "_key"))
        frames += [rows.select(F.lit(i).alias("_relation"), "_key", F.lit(n).alias("_child"), F.lit(1 - n).alias("_parent"))
                   for rows, n in ((keyed, 1), (near, 0))]
    by_key = (union_all(frames).groupBy("_relation", "_key")
              .agg(F.sum("_child").alias("_n"), F.max("_parent").alias("_found")))
    lost = [F.sum(F.when((F.col("_relation") == i) & (F.col("_found") == 0), F.col("_n"))) for i in range(len(related))]
    counts = by_key.agg(*(F.coalesce(n, F.lit(0)).cast("bigint").alias(f"_lost{i}") for i, n in enumerate(lost)))
    return counts.select(F.inline(F.array(*(
        F.struct(*_row("relationships", table, child_key, F.col(f"_lost{i}")))
        for i, (_, _, table, child_key, _) in enumerate(related)))))


def check_unique(df: DataFrame, table: str, *key_sets: list[str]) -> DataFrame:
    """Number of key values held by more than one row, for each key set."""
    return check_table(df, table, unique=list(key_sets))


def check_one_active(dim: DataFrame, table: str, key: str) -> DataFrame:
    """Keys with more than one active version (expected 0 in strict mode)."""
    a = dim.where(F.col("is_active")).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return a.agg(*_row("one_active", table, key, F.count(F.lit(1))))


def check_validity(dim: DataFrame, table: str) -> DataFrame:
    """Versions whose end is not after their start, or whose flag disagrees
    with the end date."""
    bad = ((F.col("end_date").isNotNull() & (F.col("end_date") <= F.col("effective_date")))
           | (F.col("is_active") != F.col("end_date").isNull()))
    return dim.agg(*_row("validity", table, "end_date", F.count_if(bad)))


def check_accepted(df: DataFrame, table: str, column: str, values: list[str]) -> DataFrame:
    return df.agg(*_row("accepted_values", table, column,
                        F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))))


def check_rules(df: DataFrame, table: str, rules: dict[str, F.Column]) -> DataFrame:
    """Business rules: the number of rows violating each predicate."""
    return check_table(df, table, rules=rules)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
