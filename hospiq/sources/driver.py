"""Access to the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table. Column pruning / filter pushdown happen in the scan."""
    if name not in DRIVER_TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
