"""Readers. Every one imposes its schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas
from .records import csv_records, parse_records


def _hadoop_exists(spark: SparkSession, path: str, pattern: str | None = None) -> bool:
    """Whether a path (or a file below it that the pattern matches) exists, on any Hadoop file system."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return False
    if not pattern:
        return True
    import fnmatch

    files = fs.listFiles(root, True)
    while files.hasNext():
        if fnmatch.fnmatchcase(files.next().getPath().getName().upper(), pattern.upper()):
            return True
    return False


def exists(spark: SparkSession, path: str) -> bool:
    return _hadoop_exists(spark, path)


def empty_like(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A typed relation without rows."""
    return spark.createDataFrame([], schema)


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def read_registry_csv(spark: SparkSession, paths: str | list[str], table: str, newlines: bool = True) -> DataFrame:
    """A registry family: semicolons, no header, Windows-1252, quotes doubled inside quotes. Rows with another number of
    columns are dropped (``registry_records`` gives them too). Needs ``spark.sql.legacy.javaCharsets`` (see ``session``).

    ``newlines``: values may hold line breaks. Without them a file is read once, else two or three times, the first of them at once; large files are split either way."""
    if newlines:
        return registry_records(spark, paths, table)[0]
    schema = schemas.registry_schema(table)
    read = spark.read.schema(schema).options(sep=";", encoding="windows-1252", quote='"', escape='"', mode="DROPMALFORMED", pathGlobFilter=schemas.REGISTRY[table][0], recursiveFileLookup=True)
    return read.csv(paths)


def registry_records(spark: SparkSession, paths: str | list[str], table: str, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of a registry family, and (file, value, reason) of the records that were rejected. ``pattern``: of file names, if not the family's own."""
    return parse_records(csv_records(spark, paths, "windows-1252", pattern or schemas.REGISTRY[table][0]), schemas.registry_schema(table), ";")


def discover_tables(spark: SparkSession, folder: str) -> dict[str, bool]:
    """Which table families have files below a folder."""
    return {table: _hadoop_exists(spark, folder, pattern) for table, (pattern, _) in schemas.REGISTRY.items()}


def _side_csv(spark: SparkSession, paths, columns: str, sep: str) -> DataFrame:
    read, _ = side_records(spark, paths, columns, sep)
    return read


def side_records(spark: SparkSession, paths, columns: str, sep: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a file with a header, in Latin-1, empty values as null; and (file, value, reason) of the records that were rejected."""
    return parse_records(csv_records(spark, paths, "ISO-8859-1", header=True), schemas.strings(columns), sep, empty_is_null=True)


def read_works_csv(spark: SparkSession, paths) -> DataFrame:
    """Construction works: commas, a header whose names are replaced, Latin-1, empty is null."""
    return _side_csv(spark, paths, schemas.WORKS, ",")


def read_links_csv(spark: SparkSession, paths) -> DataFrame:
    return _side_csv(spark, paths, schemas.LINKS, ",")


def read_carriers_csv(spark: SparkSession, paths) -> DataFrame:
    """Road carriers: semicolons, a header, all values quoted, Latin-1."""
    return _side_csv(spark, paths, schemas.CARRIERS, ";")


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None, prefixes: Iterable[str] | None = None, key: str = "cnpj_prefix") -> DataFrame:
    """Parquet partitioned by a text prefix. ``prefixes`` prune partitions; unknown ones give no rows."""
    if schema is not None and key not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(key, T.StringType())])
    read = spark.read.schema(schema) if schema is not None else spark.read
    df = read.parquet(path)
    if schema is None:
        df = df.withColumn(key, F.col(key).cast("string"))
    return df if prefixes is None else df.where(F.col(key).isin(list(prefixes)))


def load_lookups(spark: SparkSession, paths: dict[str, str], register: bool = True) -> dict[str, DataFrame]:
    """Small code tables by name; each also becomes a temporary view."""
    found = {}
    for name, path in paths.items():
        found[name] = spark.read.parquet(path)
        if register:
            found[name].createOrReplaceTempView(name)
    return found


def list_prefixes(df: DataFrame, key: str = "cnpj_prefix") -> DataFrame:
    """Distinct prefixes that are neither null nor empty, in byte order."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != "")).select(key).distinct().orderBy(key)


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Newline-delimited JSON documents."""
    return spark.read.schema(schema).json(path)


def read_shard_lines(spark: SparkSession, path: str, key: str = "prefix") -> DataFrame:
    """(value, prefix) of shard files as ``write_shards`` lays them out, one row a line."""
    return spark.read.schema(f"value string, {key} string").option("recursiveFileLookup", False).text(path)


def manifest_datasets(manifests: DataFrame, text: str = "value") -> DataFrame:
    """One row for each dataset of manifest documents. Datasets without a release are left out; missing fields get defaults,
    and text that is no manifest gives no rows."""
    parsed = manifests.select(F.from_json(F.col(text), schemas.MANIFEST_SCHEMA).alias("m"))
    d = parsed.select("m.total", "m.shard_count", F.col("m.storage_release_id").alias("base_release"), F.explode("m.datasets").alias("dataset", "d"))
    v = lambda name, default: F.coalesce(F.col(f"d.{name}"), F.lit(default)).alias(name)
    return d.where(F.trim(F.coalesce("d.storage_release_id", F.lit(""))) != "").select(
        "dataset",
        F.col("d.storage_release_id").alias("storage_release_id"),
        F.coalesce("d.json_property_name", "dataset").alias("json_property_name"),
        v("schema_version", ""),
        F.col("d.source_version").alias("source_version"),
        F.col("d.updated_at").alias("updated_at"),
        v("record_count", 0),
        v("zip_available", False),
        v("zip_size", 0),
        v("zip_url", ""),
        v("zip_md5checksum", ""),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_datasets(spark.read.text(path, wholetext=True))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Hash state (module, cnpj, content_hash); a state that doesn't exist yet is empty."""
    if not exists(spark, path):
        return empty_like(spark, schemas.STATE_SCHEMA)
    return spark.read.schema(schemas.STATE_SCHEMA).parquet(path)


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each group in the given order (which puts it first)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def latest_resource(catalog: DataFrame, text: str = "value") -> DataFrame:
    """The newest CSV resource of catalog documents: highest position, then latest change."""
    parsed = catalog.select(F.from_json(F.col(text), schemas.CATALOG_SCHEMA).alias("c")).where("c.success")
    r = parsed.select(F.explode("c.result.resources").alias("r")).select("r.*").where(F.upper("format") == "CSV")
    order = [F.expr("try_cast(position AS bigint)").desc_nulls_last(), F.col("last_modified").desc_nulls_last(), F.col("url").desc_nulls_last()]
    return r.orderBy(*order).limit(1)


def select_period(periods: DataFrame, requested: str | None = None, current: str | None = None, name: str = "period") -> DataFrame:
    """One row: the latest period, whether the requested and the current one exist, and which one to use.

    Only text of the form yyyy-MM counts. A requested period that doesn't exist is an error; without one the current one is used where it
    exists, else the latest.
    """
    p = F.col(name)
    found = periods.where(p.rlike(r"^[0-9]{4}-[0-9]{2}\z"))
    has = lambda x: F.coalesce(F.bool_or(p == F.lit(x)), F.lit(False)) if x else F.lit(False)
    one = found.agg(F.max(p).alias("latest"), has(requested).alias("requested_present"), has(current).alias("current_present"))
    missing = F.raise_error(F.lit(f"the requested period {requested} is not there"))
    use = F.when(F.col("requested_present"), requested).otherwise(missing.cast("string")) if requested else F.when(F.col("current_present"), current).otherwise(F.col("latest"))
    return one.withColumn("selected", use)
