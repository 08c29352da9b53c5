"""Reading and writing the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def scan(spark: SparkSession, path: str, where: Column | str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A stored table, filtered and projected in the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The same over JDBC; pass partitionColumn and bounds for a parallel read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def scan_documents(
    spark: SparkSession, path: str, schema: T.StructType, not_in: DataFrame | None = None, key: str = "auction_id"
) -> DataFrame:
    """JSON documents, optionally without those whose key is already known."""
    df = spark.read.schema(schema).json(path)
    return df if not_in is None else df.join(not_in.select(key).distinct(), key, "left_anti")


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; full-precision timestamps."""
    df.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path, header=True)


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path, header=True)
    )


def modulo_batch(df: DataFrame, n: int, of: int = 100, key: str = "auctionid") -> DataFrame:
    """One of `of` batches by key remainder."""
    return df.where(F.col(key) % of == n)
