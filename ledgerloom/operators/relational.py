"""Generic table operators: nesting, first rows, offsets, counts, enrichment, composition, comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import normalize_key


def nest_children(df: DataFrame, keys: list[str], fields: list[Column | str], name: str = "children", sort_by: list[str] | None = None) -> DataFrame:
    """One row a key with the array of its children. The array is sorted by ``sort_by`` (then by all fields), so it doesn't
    depend on the order of the rows. Children meet on the keys; a key's children must fit in a task."""
    order = F.struct(*(sort_by or []), F.struct(*fields).alias("__child"))
    # no element is null, so the order is that of array_sort, without its comparator's lambda
    nested = df.groupBy(*keys).agg(F.sort_array(F.collect_list(order)).alias(name))
    return nested.withColumn(name, F.col(name)["__child"])


def nest_pieces(df: DataFrame, keys: list[str], fields: list[Column | str], most: int, name: str = "children", sort_by: list[str] | None = None) -> DataFrame:
    """(keys, ``piece``, children): a key's children in rows of at most ``most``, which follow one another by ``piece`` (0, 1, ...).

    No key is one task's work: the children of all keys are cut into ranges by key and order, so a hot one is sorted, numbered and nested by several tasks.
    The order is that of ``nest_children``; equal children may be any number.
    """
    order = F.struct(*(sort_by or []), F.struct(*fields).alias("__child")).alias("__row")
    rows = df.select(*keys, order)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the row's own number last, so that equal children are cut too
    ranged = rows.withColumn("__id", F.monotonically_increasing_id()).repartitionByRange(n, *keys, "__row", "__id").withColumn("__range", F.spark_partition_id())
    at = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy("__row", "__id")) - 1
    cut = ranged.withColumn("__cut", F.floor(at / most)).groupBy(*keys, "__range", "__cut").agg(F.array_sort(F.collect_list("__row")).alias(name))
    piece = F.row_number().over(Window.partitionBy(*keys).orderBy("__range", "__cut")) - 1  # a row a piece
    return cut.select(*keys, piece.alias("piece"), F.transform(name, lambda x: x["__child"]).alias(name))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key; nulls come last in the order."""
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def running_offsets(df: DataFrame, prefix: str = "prefix", key: str = "key", value: str = "value", stretch: int = 6) -> DataFrame:
    """(prefix, key, ordinal, offset, length): the place of each line in its shard; length counts UTF-8 bytes and the newline.

    A shard isn't one task's work: keys that share their first ``stretch`` characters are numbered together, and a row for each such
    stretch says what the stretches before it hold. Rows are shuffled once, without their values. Null prefixes and keys are values of their own.
    """
    size = (F.octet_length(value) + 1).cast("int").alias("length")
    at = F.struct(F.col(prefix).alias("p"), F.substring(key, 1, stretch).alias("s")).alias("__at")
    rows = df.select(at, F.col(key), size).repartition("__at")
    totals = rows.groupBy("__at").agg(F.min(key).alias("__first"), F.count("*").alias("__n"), F.sum("length").alias("__bytes"))
    earlier = Window.partitionBy("__at.p").orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    starts = totals.select("__at", sum_of("__n", earlier).alias("__n"), sum_of("__bytes", earlier).alias("__bytes"))
    w = Window.partitionBy("__at").orderBy(key)
    placed = rows.select("*", F.row_number().over(w).alias("__row"), sum_of("length", w.rowsBetween(Window.unboundedPreceding, -1)).alias("__off")).join(starts, "__at")
    return placed.select(F.col("__at.p").alias(prefix), key, (F.col("__n") + F.col("__row") - 1).cast("int").alias("ordinal"), (F.col("__bytes") + F.col("__off")).cast("long").alias("offset"), "length")


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def count_by(df: DataFrame, dims: list[str], where: Column | str | None = None, name: str = "n", ordered: bool = True) -> DataFrame:
    """Rows for each combination of dimensions, most first, ties by the dimensions."""
    out = (df if where is None else df.where(where)).groupBy(*dims).agg(F.count("*").alias(name))
    return out.orderBy(F.desc(name), *dims) if ordered else out


def count_each(df: DataFrame, dims: list[str], name: str = "n") -> DataFrame:
    """Counts by each dimension on its own, in long form (dimension, value, n), in one pass over the rows."""
    sets = df.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])).alias("e"))
    return sets.groupBy("e.dimension", "e.value").agg(F.count("*").alias(name))


def explode_count(df: DataFrame, items: Column | str, dims: list[str] | None = None, item: str = "item", name: str = "n") -> DataFrame:
    """Rows for each item of a list column."""
    items = F.col(items) if isinstance(items, str) else items
    return df.select(*(dims or []), F.explode(items).alias(item)).groupBy(*(dims or []), item).agg(F.count("*").alias(name))


def lead_list(df: DataFrame, limit: int | None = None, order: list[str] | None = None, at_least: dict[str, float] | None = None, **equal: object) -> DataFrame:
    """Rows that fulfil every condition given; text compares without case. ``None`` leaves a condition out."""
    for name, value in equal.items():
        if value is not None:
            c = F.col(name)
            df = df.where(F.upper(c) == value.upper() if isinstance(value, str) else c == F.lit(value))
    for name, value in (at_least or {}).items():
        df = df.where(F.col(name) >= value)
    df = df.orderBy(*order) if order else df
    return df.limit(limit) if limit else df


def enrich(keys: DataFrame, flat: DataFrame, key: str, columns: list[str], raw: str = "raw") -> DataFrame:
    """A user's list of keys (column ``raw``, any mask or case) with columns of a flat table, null where the key is unknown.

    Spark broadcasts whichever side is small enough.
    """
    wanted = keys.withColumn("__key", normalize_key(raw))
    side = flat.select(F.col(key).alias("__k"), *columns)
    return wanted.join(side, F.col("__key") == F.col("__k"), "left").drop("__k").withColumnRenamed("__key", key)


def compose(base: DataFrame, modules: dict[str, DataFrame], selection: list[str] | None = None, key: str = "cnpj", payload: str = "payload_json", include_base: bool = True) -> DataFrame:
    """Base rows with one payload column for each selected module, null where the module has none for the key.

    Modules that aren't selected are not read. ``selection`` None takes all.
    """
    out = base if include_base else base.select(key)
    for name in sorted(modules) if selection is None else [m for m in selection if m in modules]:
        out = out.join(modules[name].select(key, F.col(payload).alias(name)), key, "left")
    return out


def carry_forward(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key ``new`` lacks."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"))


def hash_diff(previous: DataFrame, current: DataFrame, key: str = "cnpj", content: str = "content_hash", trusted: bool = True) -> DataFrame:
    """(key, change, previous hash, current hash) of keys that were added, changed or removed.

    If the previous state isn't trusted it counts as empty, so every current key is added.
    """
    old = previous.select(F.col(key), F.col(content).alias("previous_hash"), F.lit(True).alias("__old"))
    if not trusted:
        old = old.limit(0)
    new = current.select(F.col(key), F.col(content).alias("current_hash"), F.lit(True).alias("__new"))
    both = old.join(new, key, "full")
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(~F.col("previous_hash").eqNullSafe(F.col("current_hash")), "changed")
    return both.select(key, change.alias("change"), "previous_hash", "current_hash").where("change IS NOT NULL")
