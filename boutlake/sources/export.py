"""CSV exports with a commit: an export is there as a whole or not at all, and the one before stays readable until then.

The data source "csv_export" writes each task's rows as files of a new folder under path, every value quoted, quotes
doubled, nulls empty and unquoted, each file with a header and a byte order mark once. The commit writes
``manifest.json`` (files, their rows and bytes), which readers go by, and moves the folder of the run before to
``archive``. A run that fails removes its own files and leaves the others as they are.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

ROWS_PER_FILE = 50_000
MARK = b"\xef\xbb\xbf"


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path.rstrip("/")))


@dataclass
class Exported(WriterCommitMessage):
    part: int
    files: list[dict]


class CsvWriter(DataSourceArrowWriter):
    """Files of one run; options rows_per_file, bom and gzip."""

    def __init__(self, options: dict[str, str]):
        self.path, self.run = options["path"], f"run-{uuid.uuid4().hex}"
        self.rows_per_file = int(options.get("rows_per_file", ROWS_PER_FILE))
        self.mark = MARK if options.get("bom", "true").lower() == "true" else b""
        self.gzip = options.get("gzip", "false").lower() == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Exported:
        part, files = TaskContext.get().partitionId(), []
        fs, root = opened(self.path)
        plain = pa.csv.WriteOptions(include_header=False, quoting_style="all_valid")
        attempt, out = uuid.uuid4().hex, None

        def close() -> None:
            if out is not None:
                out.close()

        for batch in iterator:
            at = 0
            while at < len(batch):
                if out is None or files[-1]["rows"] == self.rows_per_file:
                    close()
                    name = f"{self.run}/part-{part:05}-{len(files):05}-{attempt}.csv" + ".gz" * self.gzip
                    out = fs.open_output_stream(f"{root}/{name}", compression="gzip" if self.gzip else None)
                    head = self.mark + (",".join('"' + n.replace('"', '""') + '"' for n in batch.schema.names) + "\n").encode()
                    out.write(head)
                    files.append({"name": name, "rows": 0, "bytes": len(head)})
                rows = batch.slice(at, self.rows_per_file - files[-1]["rows"])
                text = pa.BufferOutputStream()
                pa.csv.write_csv(pa.Table.from_batches([rows]), text, plain)
                text = text.getvalue()
                out.write(text)
                files[-1]["rows"] += len(rows)
                files[-1]["bytes"] += text.size
                at += len(rows)
        close()
        return Exported(part, files)

    def commit(self, messages: list[Exported | None]) -> None:
        fs, root = opened(self.path)
        before = manifest(self.path)
        files = [f for m in sorted((m for m in messages if m is not None), key=lambda m: m.part) for f in m.files]
        names = {f"{root}/{f['name']}" for f in files}
        for x in fs.get_file_info(pa.fs.FileSelector(f"{root}/{self.run}")):  # of attempts that did not succeed
            if x.path not in names:
                fs.delete_file(x.path)
        made = f"{root}/_{uuid.uuid4().hex}"
        with fs.open_output_stream(made) as f:
            f.write(json.dumps({"run": self.run, "rows": sum(x["rows"] for x in files), "bytes": sum(x["bytes"] for x in files), "files": files}).encode())
        fs.move(made, f"{root}/manifest.json")
        if before is not None and before["files"]:
            fs.create_dir(f"{root}/archive")
            fs.move(f"{root}/{before['run']}", f"{root}/archive/{before['run']}")

    def abort(self, messages: list[Exported | None]) -> None:
        fs, root = opened(self.path)
        if fs.get_file_info(f"{root}/{self.run}").type == pa.fs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.run}")


class CsvExport(DataSource):
    """The sink "csv_export"; rows are text columns, see export_csv."""

    @classmethod
    def name(cls) -> str:
        return "csv_export"

    def writer(self, schema: StructType, overwrite: bool) -> CsvWriter:
        if not overwrite:
            raise ValueError('csv_export takes mode("overwrite") only; the run before goes to the archive')
        found = CsvWriter(dict(self.options))
        fs, root = opened(found.path)
        fs.create_dir(f"{root}/{found.run}", recursive=True)
        return found


def manifest(path: str) -> dict | None:
    """Run, rows, bytes and files of the export at path; None if there is none."""
    fs, root = opened(path)
    if fs.get_file_info(f"{root}/manifest.json").type != pa.fs.FileType.File:
        return None
    with fs.open_input_file(f"{root}/manifest.json") as f:
        return json.loads(f.read())


def export_csv(df: DataFrame, path: str, order: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE, bom: bool = True, gzip: bool = False) -> dict:
    """Exports df in files of rows_per_file rows at most and about that many, in order if one is named; the manifest.

    Booleans are true and false, dates and numbers as Spark writes them.
    """
    spark = df.sparkSession
    spark.dataSource.register(CsvExport)
    parts = max(1, ceil(df.count() / rows_per_file))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order) if order else df.repartition(parts)
    text = rows.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))
    options = {"rows_per_file": rows_per_file, "bom": str(bom).lower(), "gzip": str(gzip).lower()}
    text.write.format("csv_export").mode("overwrite").options(**options).save(path)
    return manifest(path)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the last export at path that was committed."""
    found = manifest(path)
    files = [f"{path.rstrip('/')}/{f['name']}" for f in found["files"]] if found else []
    return spark.read.csv(files, schema=schema, header=True, escape='"', multiLine=True) if files else spark.createDataFrame([], schema)
