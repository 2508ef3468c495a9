"""Sinks: CSV exports, JSON, and tables."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame

from boutlake.operators.reports import table_signature

ROWS_PER_FILE = 50_000
_MODE = threading.Lock()


def write_csv(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, gzip: bool = False, mode: str = "overwrite") -> None:
    """CSV parts with header, every value quoted, quotes doubled; no empty parts for no rows."""
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).csv(path, header=True, quoteAll=True, escape='"', compression="gzip" if gzip else "none")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, name: str, partition: Sequence[str] = (), mode: str = "overwrite") -> None:
    """A Parquet table; with partitions, an overwrite of a table that exists replaces only those that df holds."""
    if partition and mode == "overwrite" and df.sparkSession.catalog.tableExists(name):
        # insertInto takes columns by place and its mode from the session, which gets its own back; one write at a time does so.
        spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
        with _MODE:
            before = spark.conf.get(key)
            spark.conf.set(key, "dynamic")
            try:
                df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
            finally:
                spark.conf.set(key, before)
        return
    writer = df.write.format("parquet").mode(mode)
    (writer.partitionBy(*partition) if partition else writer).saveAsTable(name)


def backup_table(df: DataFrame, name: str) -> None:
    df.write.format("parquet").mode("errorifexists").saveAsTable(name)


def sync_table(df: DataFrame, name: str, updated: str | None = None, force: bool = False) -> bool:
    """The table made equal to df, columns included; left alone if rows, latest update and checksum agree. Whether it was written."""
    spark = df.sparkSession
    if not force and spark.catalog.tableExists(name):
        there = spark.table(name)
        if there.schema.simpleString() == df.schema.simpleString() and table_signature(there, updated).first() == table_signature(df, updated).first():
            return False
    write_table(df, name)
    return True
