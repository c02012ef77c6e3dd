"""Relational building blocks whose order and null rules differ from SQL's defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.operators.storage import settle


# ---------- order ----------


def top1(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by a total order. Spark keeps one row per key and task before the exchange."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")


def first_value(value: Column | str, order: Column | str) -> Column:
    """Aggregate: the value of the smallest ``order`` among rows where it is not null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.min_by(value, F.when(value.isNotNull(), F.col(order) if isinstance(order, str) else order))


def file_order(df: DataFrame, key: str) -> Column:
    """Order of the input: ``ord`` where readers recorded it, else the numeric key."""
    return F.col("ord") if "ord" in df.columns else F.struct(F.col(key).try_cast("bigint"), F.col(key))


def dense_ids(df: DataFrame, key: str, out: str, form: str) -> DataFrame:
    """(key, out): numbers from 1 over the sorted distinct keys, as text in ``form``.

    Keys are sorted by range over all tasks; a task's rows are numbered from the number of keys before it, so no task
    sees all keys. The table of offsets has a row per task.
    """
    keys = settle(df.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(key).sortWithinPartitions(key))
    tagged = keys.withColumn("_tag", F.monotonically_increasing_id())
    part, place = F.shiftright("_tag", 33), F.col("_tag").bitwiseAND(F.lit((1 << 33) - 1))
    tagged = tagged.select(key, part.alias("_part"), place.alias("_place"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = tagged.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    number = (F.col("_before") + F.col("_place") + 1).cast("bigint")
    return tagged.join(F.broadcast(sizes), "_part").select(key, F.format_string(form, number).alias(out))


# ---------- groups ----------


def with_group_size(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """``out``: size of a row's group; null where a key is null.

    Sizes are counted with partial sums and joined back where they are above 1, so a hot key is no single task: the join
    broadcasts them if they are few, and else splits the key as any skewed join does.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    many = df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)
    joined = df.join(many, keys, "left")
    return joined.select(*df.columns, F.when(known, F.coalesce(out, F.lit(1).cast("bigint"))).alias(out))


def with_repeated(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """``out``: whether other rows have the same keys; null counts as a value."""
    rows = df.withColumn("_group", F.struct(*keys))
    many = rows.groupBy("_group").count().where("count > 1").select("_group", F.lit(True).alias(out))
    return rows.join(many, "_group", "left").select(*df.columns, F.coalesce(out, F.lit(False)).alias(out))


def weighted_mean(value: str, weight: str) -> Column:
    """Aggregate: mean by weight over rows that have a value and a positive weight; null without any."""
    rated = F.col(value).isNotNull() & (F.col(weight) > 0)
    return F.sum(F.when(rated, F.col(value) * F.col(weight))) / F.sum(F.when(rated, F.col(weight)))


def smallest_mode(value: str | Column) -> Column:
    """Aggregate: the most frequent value, of equally frequent ones the smallest; nulls don't count."""
    return F.mode(value, True)


def sorted_set(value: str | Column) -> Column:
    """Aggregate: distinct values, sorted; nulls don't count."""
    return F.array_sort(F.collect_set(value))


def sorted_list(value: str | Column) -> Column:
    """Aggregate: values with repeats, sorted; nulls don't count."""
    return F.array_sort(F.collect_list(value))


def sorted_union(values: Column) -> Column:
    """Aggregate: distinct elements of arrays, sorted, without empty texts."""
    return F.array_sort(F.filter(F.array_distinct(F.flatten(F.collect_set(values))), lambda x: x != ""))


def first_present(values: Column, order: tuple[str, ...]) -> Column:
    """Aggregate: the first of ``order`` that occurs in the group."""
    rank = F.lit(None).cast("int")
    for i, v in enumerate(order):
        rank = F.when(values == v, i).otherwise(rank)
    return F.try_element_at(F.array(*map(F.lit, order)), F.min(rank) + 1)


def in_conflict(value: Column) -> Column:
    """Aggregate: more than one value that isn't empty."""
    return F.count_distinct(F.when(value != "", value)) > 1


def joined_without(values: Column, without: str) -> Column:
    """Aggregate: sorted distinct values but one, joined by bars; null if none is left."""
    text = F.array_join(F.array_except(F.array_sort(F.collect_set(values)), F.array(F.lit(without))), "|")
    return F.when(text != "", text)


# ---------- lookups ----------


def lookup(df: DataFrame, dim: DataFrame, key: str, columns: list[str], dim_key: str | None = None, order: Column | None = None) -> DataFrame:
    """Columns of the first row per key of ``dim``, all of one row; null where there is none. Spark picks the join by measured sizes.

    First is by ``order``, else by the input order that readers record as ``ord``, else by the columns themselves.
    """
    if order is None:
        order = F.col("ord") if "ord" in dim.columns else F.struct(*columns)
    one = dim.groupBy(F.col(dim_key or key).alias(key)).agg(F.min_by(F.struct(*columns), order).alias("_first"))
    return df.join(one, key, "left").select(*df.columns, *(F.col(f"_first.{c}").alias(c) for c in columns))


def is_member(df: DataFrame, other: DataFrame, key: str, out: str, other_key: str | None = None) -> DataFrame:
    """``out``: whether the key occurs in ``other``."""
    known = other.select(F.col(other_key or key).alias(key)).distinct().withColumn(out, F.lit(True))
    return df.join(known, key, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def same_set(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables of one column hold the same values."""
    a, b = left.distinct(), right.distinct()
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """Exactly n rows (or all), chosen by a digest of key and seed: stable whatever the partitions. The limit is the feature."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def true_names(flags: list[tuple[str, Column]]) -> Column:
    """The names of those flags that are true, in order."""
    return F.filter(F.array(*(F.when(flag, name) for name, flag in flags)), lambda r: r.isNotNull())


def value_counts(df: DataFrame, column: str, nulls: bool = False) -> DataFrame:
    rows = df if nulls else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
