"""Data-quality checks Q1-Q5 as DataFrames.

Orphan counting pre-aggregates the child side to one row per distinct key
(a map-side partial aggregate) before joining it to the parent keys.  A key shared by a
third of all child rows then costs one row per map task in the shuffle,
and the join that follows has unique keys on both sides, so it cannot be
skewed.  All relations are checked in one plan (a union of per-relation
aggregates), so one job answers them all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import specs
from ledgerline.specs import Relation

Tables = Callable[[str], DataFrame]


def row_counts(tables: Tables, names: Iterable[str]) -> DataFrame:
    """Q1: ``(table_name, row_count)`` for each table, by UNION ALL."""
    parts = [tables(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphans(tables: Tables, relation: Relation) -> DataFrame:
    """Q2 for one relation: ``(child, column, parent, checked, orphans)``.

    ``checked`` counts child rows with a non-null key; null keys are
    skipped for nullable relations and counted as orphans otherwise (the
    reading of the published LEFT JOIN ... IS NULL check).

    Child keys are counted first (partial aggregation on the map side),
    then left-joined to the distinct parent keys: both join sides have
    unique keys.  An outer join is used on purpose: Catalyst pushes a
    left-anti join below the aggregate, which would join raw child rows.
    """
    from ledgerline.plans.corpus import columns_of

    child = columns_of(tables, relation.child, relation.column).select(F.col(relation.column).alias("k"))
    if relation.nullable:
        child = child.filter(F.col("k").isNotNull())
    per_key = child.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    parent = (columns_of(tables, relation.parent, relation.parent_column).select(F.col(relation.parent_column).alias("k")).distinct()
              .withColumn("_hit", F.lit(True)))
    joined = per_key.join(parent, "k", "left")
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("checked"),
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("orphans"),
    ).select(F.lit(relation.child).alias("child"), F.lit(relation.column).alias("column"),
             F.lit(relation.parent).alias("parent"), "checked", "orphans")


def orphans_all(tables: Tables, relations: Iterable[Relation] = specs.RELATIONS) -> DataFrame:
    """Q3: orphan counts for every declared relation, one row each.

    Every table is read once: a child row gives one (relation, key) pair per
    relation it has, the pairs are counted with partial sums, and one outer
    join meets them with the distinct keys of all parents.
    """
    from ledgerline.plans.corpus import columns_of

    rels = list(enumerate(relations))
    counted = None
    for child in dict.fromkeys(r.child for _, r in rels):
        own = [(i, r) for i, r in rels if r.child == child]
        pairs = F.array(*[F.struct(F.lit(i).alias("rel"), F.col(r.column).cast("bigint").alias("k")) for i, r in own])
        df = columns_of(tables, child, *dict.fromkeys(r.column for _, r in own)).select(F.explode(pairs).alias("p")).select("p.*")
        df = df.groupBy("rel", "k").agg(F.count(F.lit(1)).alias("n"))
        counted = df if counted is None else counted.unionByName(df)
    keys = None
    parents = dict.fromkeys((r.parent, r.parent_column) for _, r in rels)
    for parent, column in parents:
        own = F.array(*[F.lit(i) for i, r in rels if (r.parent, r.parent_column) == (parent, column)])
        df = columns_of(tables, parent, column).select(F.col(column).cast("bigint").alias("key")).distinct().select(F.explode(own).alias("of"), "key")
        keys = df if keys is None else keys.unionByName(df)
    nullable = F.array(*[F.lit(i) for i, r in rels if r.nullable] or [F.lit(-1)])
    found = (counted.filter(F.col("k").isNotNull() | ~F.array_contains(nullable, F.col("rel")))
             .join(keys, (F.col("rel") == F.col("of")) & (F.col("k") == F.col("key")), "left")
             .groupBy("rel").agg(F.sum("n").alias("checked"), F.sum(F.when(F.col("key").isNull(), F.col("n"))).alias("orphans")))
    names = tables(rels[0][1].child).sparkSession.createDataFrame(
        [(i, r.child, r.column, r.parent) for i, r in rels], "rel int, child string, column string, parent string")
    zero = F.lit(0).cast("bigint")
    return names.join(found, "rel", "left").select(
        "child", "column", "parent", F.coalesce("checked", zero).alias("checked"), F.coalesce("orphans", zero).alias("orphans"))


def schema_diff(spark, expected: T.StructType, actual: T.StructType) -> DataFrame:
    """Q4: compare two schemas column by column.

    ``status`` is ``ok``, ``type_mismatch``, ``missing`` (expected, not
    present) or ``unexpected`` (present, not expected).
    """
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    act = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for i, name in enumerate(list(exp) + [n for n in act if n not in exp], start=1):
        e, a = exp.get(name), act.get(name)
        status = ("missing" if a is None else "unexpected" if e is None
                  else "ok" if e == a else "type_mismatch")
        rows.append((i, name, e, a, status))
    return spark.createDataFrame(rows, "ordinal int, column_name string, expected string, actual string, status string")


def completeness(spark, planned: dict[str, int], actual: DataFrame) -> DataFrame:
    """Q5: planned vs landed rows per table; ``ok`` when equal.

    ``actual`` has ``(table_name, row_count)``, e.g. from :func:`row_counts`.
    """
    plan = spark.createDataFrame(sorted(planned.items()), "table_name string, planned_rows bigint")
    return (plan.join(actual.withColumnRenamed("row_count", "actual_rows"), "table_name", "left")
            .select("table_name", "planned_rows",
                    F.coalesce(F.col("actual_rows"), F.lit(0)).cast("bigint").alias("actual_rows"))
            .withColumn("ok", F.col("planned_rows") == F.col("actual_rows")))
