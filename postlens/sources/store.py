"""Tables on shared storage: scans, full-refresh publishing, checks and statistics.

A published table is a store with one table (see ``manifest``): a refresh writes a
new version and then commits it, so readers never see a half-written table and
a failed refresh leaves the old one in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.numbers import exact_round
from postlens.schema import INDEX_SCHEMA, schema_differences
from postlens.sources import manifest

TABLE = "table"


class EmptyTable(ValueError):
    """There is nothing to publish; the current version stays."""


class SchemaMismatch(ValueError):
    """The stored table has another schema than expected."""


def scan(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A table by path; filters and column choices of the caller reach the scan."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def exists(spark: SparkSession, root: str, name: str = TABLE) -> bool:
    """True if a published table is at ``root``."""
    return bool(manifest.read(spark, root).tables.get(name))


def current_version(spark: SparkSession, root: str, name: str = TABLE) -> str | None:
    """Folder of the current version, or None."""
    folders = manifest.read(spark, root).tables.get(name)
    return f"{root}/{folders[0]}" if folders else None


def publish(
    df: DataFrame,
    root: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    allow_empty: bool = False,
    name: str = TABLE,
) -> str:
    """Replace the table at ``root`` by ``df`` and return the new version's folder.

    ``sort_by`` orders the rows inside each file, so that the row-group
    statistics of these columns can skip data. ``manifest.remove_old`` deletes earlier versions.
    """
    spark = df.sparkSession
    folder = manifest.write(df.sortWithinPartitions(*sort_by) if sort_by else df, root, name, partition_by)
    if not allow_empty and spark.read.parquet(f"{root}/{folder}").isEmpty():
        raise EmptyTable(root)
    manifest.commit(spark, root, lambda tables: {**tables, name: [folder]})
    return f"{root}/{folder}"


def read_published(spark: SparkSession, root: str, name: str = TABLE) -> DataFrame:
    found = manifest.table(spark, root, name)
    if found is None:
        raise FileNotFoundError(root)
    return found


def publish_posts(df: DataFrame, root: str) -> str:
    """Full refresh of the post table, ordered for filters on label and type."""
    return publish(df, root, sort_by=["label", "type"])


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save ``df`` as a catalog table bucketed and sorted by ``key``.

    Updates and anti-joins on the key between tables with the same number of
    buckets need no shuffle.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of ``schema``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def publish_index(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Full refresh of the search documents with the fixed index schema."""
    return publish(to_schema(df, INDEX_SCHEMA), root, partition_by=partition_by)


def check_schema(df: DataFrame, expected: T.StructType = INDEX_SCHEMA) -> DataFrame:
    """``df`` itself if it has the expected fields and types, else an error that lists them."""
    differences = schema_differences(df.schema, expected)
    if any(differences.values()):
        raise SchemaMismatch(str(differences))
    return df


def store_stats(df: DataFrame) -> DataFrame:
    """One row ``(total_documents, index_size, index_size_mb)`` of a file-backed table.

    Only file metadata and row counts are read, no column.
    """
    files = df.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("n"))
    size = F.coalesce(F.sum("size"), F.lit(0)).cast("bigint")
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_documents"),
        size.alias("index_size"),
    ).withColumn("index_size_mb", exact_round("index_size / 1048576D", 2))
