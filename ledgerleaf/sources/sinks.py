"""CSV outputs, byte for byte as pandas writes them.

`write_one` and `write_files` write any table: tasks write parts, in a folder beside the output, and the commit puts
them together in order, a batch of rows at a time, with one header, and only then under the output's name. A run that
fails leaves no file. `write_csv` and those on it take the table through the driver, for tables of one report.
`write_distributed` leaves one CSV file a task.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tarfile
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ledgerleaf.operators.holdings import union_jobs

#: Columns of a table to be written that say which file a row goes to, and the order of rows; they are not written.
FILE, ORDER = "_file", "_order"


def write_csv(table: DataFrame, out: str | None = None) -> None:
    """One CSV file with a header; to standard output if no file is named."""
    table.toPandas().to_csv(out or sys.stdout, index=False)


def write_merged(tables: list[tuple[DataFrame, str, str | None]], out: str | None = None) -> None:
    write_csv(union_jobs(tables), out)


def file_name(format_name: str, prefix: str | None) -> str:
    return f"{prefix}-{format_name}.csv" if prefix else f"{format_name}.csv"


def write_separate(tables: list[tuple[DataFrame, str, str | None]], out: str) -> list[str]:
    """A file for each job in the directory out, or in an archive if out ends in .tar.gz; equal names overwrite each other."""
    packed = out.endswith(".tar.gz")
    folder = Path(out.removesuffix(".tar.gz"))
    made = not folder.exists()
    folder.mkdir(exist_ok=True)
    names = []
    for table, format_name, prefix in tables:
        names.append(file_name(format_name, prefix))
        write_csv(table, str(folder / names[-1]))
    if packed:
        with tarfile.open(out, "w:gz") as tar:
            tar.add(folder, arcname=folder.name)
        if made:
            shutil.rmtree(folder)
    return names


def write_distributed(table: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = table.write.option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


@dataclass
class PartWritten(WriterCommitMessage):
    """A part of a task, and how many nulls it has by file and whole-number column, which pandas then writes as decimals."""

    part: int
    path: str
    nulls: dict[tuple[str, str], int]


class CsvFiles(DataSource):
    """Options: folder (of the parts, seen by driver and executors), files (JSON: file of each name to path)."""

    @classmethod
    def name(cls) -> str:
        return "csv_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return CsvWriter(self.options["folder"], json.loads(self.options["files"]))


class CsvWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, files: dict[str, str]) -> None:
        self.folder, self.files = folder, files

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartWritten:
        task = TaskContext.get()
        path, nulls = f"{self.folder}/{task.partitionId()}-{task.taskAttemptId()}.arrow", Counter()
        with ExitStack() as stack:
            out = None
            for batch in iterator:
                out = out or stack.enter_context(pa.ipc.new_file(path, batch.schema))
                out.write_batch(batch)
                for name in self.files:
                    own = batch.filter(pc.equal(batch[FILE], name))
                    nulls.update({(name, f.name): own[f.name].null_count for f in batch.schema if pa.types.is_integer(f.type)})
        return PartWritten(task.partitionId(), path if out else "", dict(nulls))

    def commit(self, messages: Sequence[PartWritten | None]) -> None:
        """Each file under another name first: all of them appear, or none."""
        nulls: Counter = sum((Counter(m.nulls) for m in messages if m), Counter())
        made = {}
        try:
            for name, path in self.files.items():
                made[name] = path if path.startswith("/dev/") else f"{path}.part-{uuid.uuid4().hex}"
                with open(made[name], "w", newline="") as out:
                    started = False
                    for m in sorted((m for m in messages if m and m.path), key=lambda m: m.part):
                        with pa.ipc.open_file(m.path) as part:
                            for i in range(part.num_record_batches):
                                batch = part.get_batch(i)
                                rows = batch.filter(pc.equal(batch[FILE], name)).drop_columns([c for c in (FILE, ORDER) if c in batch.schema.names])
                                if rows.num_rows or not started:
                                    frame = pa.Table.from_batches([rows]).to_pandas()
                                    frame.astype({c: "float64" for c in frame.columns if nulls[name, c]}).to_csv(out, index=False, header=not started)
                                    started = True
                    if not started:
                        out.write(self.header())
            for name, path in self.files.items():
                if made[name] != path:
                    os.replace(made[name], path)
        finally:
            shutil.rmtree(self.folder, ignore_errors=True)
            for name, path in made.items():
                if name in self.files and made[name] != self.files[name] and os.path.exists(made[name]):
                    os.remove(made[name])

    def header(self) -> str:
        with open(f"{self.folder}/header.csv") as f:
            return f.read()

    def abort(self, messages: Sequence[PartWritten | None]) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def _write_parts(table: DataFrame, files: dict[str, str], beside: Path | None) -> None:
    spark = table.sparkSession
    if beside is None:  # standard output has no folder
        shared = (spark.conf.get("spark.checkpoint.dir", None) or "").removeprefix("file:")
        beside = Path(shared if shared.startswith("/") else tempfile.gettempdir())
    folder = beside / f".parts-{uuid.uuid4().hex}"
    folder.mkdir(parents=True)
    columns = [c for c in table.columns if c not in (FILE, ORDER)]
    import pandas as pd

    pd.DataFrame(columns=columns).to_csv(folder / "header.csv", index=False)
    spark.dataSource.register(CsvFiles)
    ordered = table.orderBy(ORDER).drop(ORDER) if ORDER in table.columns else table
    ordered.write.format(CsvFiles.name()).option("folder", str(folder)).option("files", json.dumps(files)).mode("append").save()


def write_one(table: DataFrame, out: str) -> None:
    """One CSV file of a table, in the order of its column ORDER if it has one."""
    beside = None if out.startswith("/dev/") else Path(out).resolve().parent
    _write_parts(table.withColumn(FILE, F.lit("one")), {"one": out}, beside)


def write_files(table: DataFrame, out: str, names: Sequence[str]) -> None:
    """A CSV file for each name, of the rows with that name in FILE, in the directory out, or in an archive if out ends in .tar.gz."""
    packed = out.endswith(".tar.gz")
    folder = Path(out.removesuffix(".tar.gz"))
    made = not folder.exists()
    folder.mkdir(exist_ok=True)
    try:
        _write_parts(table, {n: str(folder / n) for n in names}, folder.resolve().parent)
        if packed:
            with tarfile.open(part := f"{out}.part-{uuid.uuid4().hex}", "w:gz") as tar:
                tar.add(folder, arcname=folder.name)
            os.replace(part, out)
    finally:
        if packed and made:
            shutil.rmtree(folder, ignore_errors=True)
