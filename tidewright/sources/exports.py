"""A data source that writes CSV for spreadsheets: byte-order mark and CRLF, one folder a run, committed whole or not at all."""

from __future__ import annotations

import csv
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "run_csv"
#: A byte-order mark tells spreadsheets that the text is UTF-8.
MARK, LINE_END = b"\xef\xbb\xbf", "\r\n"
_FLUSH = 1 << 20


@dataclass
class _Part(WriterCommitMessage):
    staged: str | None
    rows: int


class RunCsvWriter(DataSourceWriter):
    """Tasks write to a hidden folder of their own job; commit moves the parts that have rows into ``run=<id>`` and drops runs beyond ``keep``; abort leaves nothing.

    A task that is tried again writes another file: only those that Spark commits are moved.
    """

    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        if "path" not in options or not re.fullmatch(r"[A-Za-z0-9_.-]+", options.get("run", "")):
            raise ValueError("Give path and run, a name of letters, digits, '_', '.' and '-'")
        self.names = schema.fieldNames()
        self.path, self.run, self.keep = options["path"].rstrip("/"), options["run"], int(options.get("keep", "0"))
        self.overwrite = overwrite
        self.job = f"_job-{uuid.uuid4().hex}"
        files, root = self._files()
        # Made here and never by a task: what still runs when the job is given up finds no folder to write to.
        files.create_dir(f"{root}/{self.job}", recursive=True)

    def _files(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")

    def write(self, rows: Iterator[Row]) -> _Part:
        files, root = self._files()
        name, count, out = f"{root}/{self.job}/part-{uuid.uuid4().hex}.csv", 0, None
        text = io.StringIO(newline="")
        table = csv.writer(text, lineterminator=LINE_END)
        table.writerow(self.names)
        for row in rows:
            if out is None:
                out = files.open_output_stream(name)
                out.write(MARK)
            table.writerow(["" if v is None else v for v in row])
            count += 1
            if text.tell() > _FLUSH:
                out.write(text.getvalue().encode())
                text.seek(0)
                text.truncate()
        if out is None:
            return _Part(None, 0)
        out.write(text.getvalue().encode())
        out.close()
        return _Part(name, count)

    def commit(self, messages: list[_Part | None]) -> None:
        files, root = self._files()
        parts = [m for m in messages if m is not None and m.rows]
        target = f"{root}/run={self.run}"
        if self.overwrite and files.get_file_info(target).type != fs.FileType.NotFound:
            files.delete_dir(target)
        if parts:
            files.create_dir(target, recursive=True)
            for i, m in enumerate(parts):
                files.move(m.staged, f"{target}/{self.job[5:13]}-{i:05}.csv")
        self._drop(files, root)
        if self.keep and parts:
            found = [f for f in files.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("run=")]
            for old in sorted(found, key=lambda f: f.base_name, reverse=True)[self.keep :]:
                files.delete_dir(old.path)

    def abort(self, messages: list[_Part | None]) -> None:
        self._drop(*self._files())

    def _drop(self, files: fs.FileSystem, root: str) -> None:
        if files.get_file_info(f"{root}/{self.job}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/{self.job}")


class RunCsv(DataSource):
    """``df.write.format("run_csv").options(path=..., run=..., keep=...)``: rows of one run as CSV parts under ``path/run=<run>``.

    ``mode("append")`` adds parts to a run, ``mode("overwrite")`` replaces that run only. A run without rows leaves no folder, and with ``keep`` only the last so many
    runs by name stay. The path is any that pyarrow's file systems open and all executors share. Values are written as text, nulls as nothing.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return RunCsvWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RunCsv)


def write_run(df: DataFrame, path: str, run: str, keep: int = 0, one_file: bool = False, mode: str = "overwrite") -> None:
    """Write the rows of a run; ``one_file`` for reports that people open, which must be small."""
    register(df.sparkSession)
    rows = df.coalesce(1) if one_file else df
    rows.write.format(NAME).mode(mode).options(path=path, run=run, keep=str(keep)).save()
