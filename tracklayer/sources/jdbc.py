"""Relational sink."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append a frame to a table over JDBC. Credentials come in ``properties``; failures surface."""
    df.write.mode("append").jdbc(url, table, properties=properties or {})
