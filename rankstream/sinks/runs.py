"""A batch sink with a commit protocol: a run's rows appear whole, once, or not at all.

Tasks write files of their own into a working folder of the write's attempt. When all have ended, the
files of the successful tasks become the run's folder ``run_id=...`` by a rename, in place of what an
earlier write of the same run left; a failed write drops its working folder and leaves the run as it was.
So a repeated run replaces its rows, and speculative or repeated tasks leave no second copy.

Targets are paths of any file system that Arrow reaches (local, HDFS, object stores); without a scheme
they are local paths, which on a cluster must be a shared mount.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "runs"
_WORK = "_writing"


def _place(target: str) -> tuple[fs.FileSystem, str]:
    made = fs.FileSystem.from_uri(target) if ":/" in target else (fs.LocalFileSystem(), target)
    return made[0], made[1].rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    """A task's file and its rows; no file for a task without rows."""

    file: str | None
    rows: int


class RunWriter(DataSourceArrowWriter):
    """Made on the driver, copied to the tasks: all of one write share ``attempt``."""

    def __init__(self, target: str, run_id: str):
        if not run_id or "/" in run_id:
            raise ValueError(f"not a run id: {run_id!r}")
        self.target, self.run_id, self.attempt = target, run_id, uuid.uuid4().hex

    def _work(self, root: str) -> str:
        return f"{root}/{_WORK}/{self.attempt}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _place(self.target)
        task = TaskContext.get()
        file = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.parquet"
        writer, rows = None, 0
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(f"{self._work(root)}/rows")
                writer = pq.ParquetWriter(f"{self._work(root)}/rows/{file}", batch.schema, filesystem=system)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
        return Written(file if rows else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _place(self.target)
        work, final = self._work(root), f"{root}/run_id={self.run_id}"
        system.create_dir(f"{work}/rows")
        wanted = {m.file for m in messages if m is not None}
        for found in system.get_file_info(fs.FileSelector(f"{work}/rows")):
            if found.base_name not in wanted:  # of a task that was run again
                system.delete_file(found.path)
        if system.get_file_info(final).type != fs.FileType.NotFound:
            system.move(final, f"{work}/before")
        system.move(f"{work}/rows", final)
        system.delete_dir(work)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _place(self.target)
        if system.get_file_info(self._work(root)).type != fs.FileType.NotFound:
            system.delete_dir(self._work(root))


class RunSink(DataSource):
    """``df.write.format("runs").mode("append").option("run_id", ...).save(target)``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> RunWriter:
        return RunWriter(self.options["path"], self.options.get("run_id", ""))


def write_run(df: DataFrame, target: str, run_id: str) -> None:
    """Writes ``df`` as the run's rows, in place of an earlier write of the run."""
    df.sparkSession.dataSource.register(RunSink)
    df.write.format(FORMAT).mode("append").option("run_id", run_id).save(target)
