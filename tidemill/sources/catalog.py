"""Catalog statements for dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The dictionary dimension's columns.
DIMENSION_COLUMNS = "rk STRING, info STRUCT<dic_name: STRING, parent_code: STRING>"


def use_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create a namespace if needed and make it current."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`{place}")
    spark.sql(f"USE `{namespace}`")


def create_dimension_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """A dictionary dimension table; that `rk` is unique is kept by the job that writes it."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({DIMENSION_COLUMNS}) USING parquet{place}")


def show_tables(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    """Tables of a namespace (the current one by default), without the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN `{namespace}`" if namespace else "SHOW TABLES").where("NOT isTemporary")
