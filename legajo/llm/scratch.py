"""Tables written on the way, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from legajo.session import scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage so that a lost executor costs a read and not the work behind it,
    and so that a table used more than once is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
