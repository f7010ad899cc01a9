"""A sink for alerts that shows a batch as a whole or not at all, and never twice.

``alerts.write.format("tidemark_alerts")`` writes one JSON payload a line. Every task attempt writes a
file of its own below ``_staged``; what an attempt that failed or was repeated left there is named by no commit
message. When all tasks have ended, the named files are put together in one folder, which is renamed to the name
of the batch: from then on the batch can be seen. A batch that is there already is left as it is, so a job that
is run again after its commit delivers nothing a second time. An aborted write takes its files away.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tidemark.operators.alerts import with_payload

FORMAT = "tidemark_alerts"
_STAGED = "_staged"


@dataclass
class Written(WriterCommitMessage):
    """The file of a task attempt and how many alerts it holds."""

    name: str
    alerts: int


class AlertWriter(DataSourceWriter):
    def __init__(self, folder: str, batch: str):
        if not batch or "/" in batch or batch.startswith(("_", ".")):
            raise ValueError(f"not a name for a batch: {batch!r}")
        self.folder, self.batch = folder.rstrip("/"), batch
        self.token = uuid.uuid4().hex

    def _places(self):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.folder)
        return system, f"{base}/{_STAGED}/{self.batch}-{self.token}", f"{base}/{self.batch}"

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get()
        part = "0" if task is None else f"{task.partitionId():06d}"
        name = f"part-{part}-{uuid.uuid4().hex}.jsonl"
        system, staged, _ = self._places()
        system.create_dir(f"{staged}/attempts", recursive=True)
        count = 0
        with system.open_output_stream(f"{staged}/attempts/{name}") as out:
            for row in iterator:
                out.write(row["payload"].replace("\n", " ").encode() + b"\n")
                count += 1
        return Written(name, count)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, staged, final = self._places()
        system.create_dir(f"{staged}/whole", recursive=True)
        if system.get_file_info(final).type == fs.FileType.NotFound:
            for message in messages:
                if message is not None and message.alerts:
                    system.move(f"{staged}/attempts/{message.name}", f"{staged}/whole/{message.name}")
            system.move(f"{staged}/whole", final)
        system.delete_dir(staged)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, staged, _ = self._places()
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)


class AlertSink(DataSource):
    """Options: ``path``, a folder with its scheme that all executors reach, and ``batch``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "payload string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("delivered alerts are not overwritten: use mode append")
        return AlertWriter(self.options["path"], self.options["batch"])


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the file system that Spark takes for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    plain = whole.removeprefix("file:")
    return f"file://{plain}" if whole.startswith("file:/") and not whole.startswith("file://") else whole


def deliver_to(alerts: DataFrame, folder: str, batch: str) -> None:
    """Write alerts (``schemas.ALERT``) as the payloads of one batch."""
    spark = alerts.sparkSession
    spark.dataSource.register(AlertSink)
    rows = with_payload(alerts).select("payload")
    rows.write.format(FORMAT).option("path", qualified(spark, folder)).option("batch", batch).mode("append").save()


def sink(folder: str, batch: str) -> Callable[[DataFrame], None]:
    """A handler for ``alerts.deliver``."""
    return lambda alerts: deliver_to(alerts, folder, batch)
