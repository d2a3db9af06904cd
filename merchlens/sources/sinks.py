"""Sinks: Parquet or CSV tables, JSON documents, key lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        # CSV has no nested types: maps, arrays and structs travel as JSON text.
        nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("map", "array", "struct")]
        flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
        flat.write.mode(mode).option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def as_json_rows(df: DataFrame, out: str = "document") -> DataFrame:
    """One JSON document per row; timestamps as ISO text, numbers as numbers."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))


def lookup(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Every requested key with the table's row, and whether it was found."""
    hit = table.withColumn("found", F.lit(True))
    return requests.join(hit, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def coerce_numeric(c: Column | str) -> Column:
    """Best-effort number: unreadable text is NULL here, its text stays in the source column."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")
