"""Stream outputs of our own: a row writer that opens and closes, and a sink that publishes a micro-batch whole or not at all.

Their classes are made in functions on purpose, as the kernels are: they travel to the executors by value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

MANIFEST = "owner string, batch long, file string, rows long"


def _trigger(writer, available_now: bool, every: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


# --- a writer of rows ------------------------------------------------------------------------------


def row_writer(path: str, line: Callable[[T.Row], str]):
    """An object with ``open``, ``process`` and ``close`` that writes a line of text for each row.

    It is opened for every partition of every epoch on the executor that has its rows, and writes to a file that has its
    name only once the partition is closed without an error. A partition of an epoch that has been closed so refuses to
    be opened again: a replay writes what is missing and nothing twice. That a replay deals the rows out as the first
    run did is up to the source; files, topics and tables do.
    """

    class RowWriter:
        def open(self, partition_id: int, epoch_id: int) -> bool:
            import uuid

            from pyarrow.fs import FileSystem, FileType

            self.fs, folder = FileSystem.from_uri(path)
            self.final = f"{folder}/epoch={epoch_id}/part-{partition_id:05d}.txt"
            if self.fs.get_file_info(self.final).type != FileType.NotFound:
                return False
            self.open_name = f"{folder}/_open/{epoch_id}-{partition_id}-{uuid.uuid4().hex}"
            for name in (self.final, self.open_name):
                self.fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
            self.out = self.fs.open_output_stream(self.open_name)
            return True

        def process(self, row) -> None:
            self.out.write(line(row).encode() + b"\n")

        def close(self, error) -> None:
            if not hasattr(self, "out"):
                return
            self.out.close()
            if error is None:
                self.fs.move(self.open_name, self.final)
            else:
                self.fs.delete_file(self.open_name)
            del self.out

    return RowWriter()


def write_rows(df: DataFrame, writer, checkpoint: str, available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Hand a stream's rows one by one to a writer with ``open``, ``process`` and ``close``."""
    return _trigger(df.writeStream.foreach(writer).option("checkpointLocation", checkpoint), available_now, every).start()


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """``value`` (a line) and ``epoch`` of all that closed partitions have written."""
    return spark.read.schema("value string, epoch long").text(path, pathGlobFilter="part-*.txt")


# --- a sink that publishes ---------------------------------------------------------------------------


def published_sink(name: str = "published"):
    """A data source whose stream writer publishes each micro-batch with one manifest.

    Tasks write files that no reader looks at and report their names. When all tasks of a micro-batch have reported, the
    driver writes a manifest that lists them, under a name that is the query's and the batch's: from then on, and not
    before, the batch is there. A batch that fails is aborted and its files go. A batch that is replayed after it was
    published finds its manifest; the new files go. With the option ``by``, each value of that column has files of its own.
    """
    from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

    class Files(WriterCommitMessage):
        def __init__(self, files):
            self.files = files

    class Writer(DataSourceStreamArrowWriter):
        def __init__(self, options):
            self.path, self.owner, self.by = options["path"], options["owner"], options.get("by")
            self.fail_batch = int(options.get("failbatch", -1))

        def _fs(self):
            from pyarrow.fs import FileSystem

            return FileSystem.from_uri(self.path)

        def write(self, iterator):
            import uuid

            import pyarrow as pa
            import pyarrow.compute as pc
            import pyarrow.parquet as pq

            fs, folder = self._fs()
            open_files = {}
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                groups = {"all": table}
                if self.by:
                    groups = {v: table.filter(pc.equal(table[self.by], v)) for v in pc.unique(table[self.by]).to_pylist()}
                for value, rows in groups.items():
                    if value not in open_files:
                        name = f"{uuid.uuid4().hex}.parquet"
                        fs.create_dir(f"{folder}/data/{value}", recursive=True)
                        open_files[value] = [pq.ParquetWriter(f"{folder}/data/{value}/{name}", rows.schema, filesystem=fs), f"{value}/{name}", 0]
                    open_files[value][0].write_table(rows)
                    open_files[value][2] += rows.num_rows
            for writer, _, _ in open_files.values():
                writer.close()
            return Files([(name, rows) for _, name, rows in open_files.values()])

        def _remove(self, messages):
            fs, folder = self._fs()
            for message in messages:
                for name, _ in message.files if message is not None else ():
                    fs.delete_file(f"{folder}/data/{name}")

        def commit(self, messages, batchId):
            import json
            import uuid

            from pyarrow.fs import FileType

            if batchId == self.fail_batch:
                raise RuntimeError("lost between the tasks' commits and the publication")
            fs, folder = self._fs()
            manifest = f"{folder}/manifests/{self.owner}-{batchId}.json"
            if fs.get_file_info(manifest).type != FileType.NotFound:
                self._remove(messages)
                return
            unseen = f"{folder}/unpublished/{uuid.uuid4().hex}"
            for name in (manifest, unseen):
                fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(unseen) as out:
                for message in messages:
                    for name, rows in message.files if message is not None else ():
                        entry = {"owner": self.owner, "batch": batchId, "file": name, "rows": rows}
                        out.write(json.dumps(entry).encode() + b"\n")
            fs.move(unseen, manifest)

        def abort(self, messages, batchId):
            self._remove(messages)

    class Published(DataSource):
        @classmethod
        def name(cls):
            return name

        def streamWriter(self, schema, overwrite):
            return Writer(dict(self.options))

    return Published


def write_published(
    df: DataFrame,
    path: str,
    checkpoint: str,
    by: str | None = None,
    available_now: bool = False,
    every: str | None = None,
    fail_batch: int | None = None,
) -> StreamingQuery:
    """Append a stream to a published table. The checkpoint names the query: one with another checkpoint publishes beside it.

    ``fail_batch`` makes the publication of that micro-batch fail, for tests.
    """
    spark = df.sparkSession
    spark.dataSource.register(published_sink())
    options = {"path": path, "owner": hashlib.sha256(checkpoint.encode()).hexdigest()[:16], "checkpointLocation": checkpoint}
    options |= {"by": by} if by else {}
    options |= {"failbatch": str(fail_batch)} if fail_batch is not None else {}
    return _trigger(df.writeStream.format("published").outputMode("append").options(**options), available_now, every).start()


def read_published(spark: SparkSession, path: str, schema: str | T.StructType, output: str = "*") -> DataFrame:
    """The rows of all published micro-batches, or those of one ``output`` where the sink wrote several.

    Files that no manifest names, those of a running or lost micro-batch, are not part of the table. Which files are is
    joined, not collected.
    """
    manifests = spark.read.schema(MANIFEST).option("ignoreMissingFiles", "true").json(f"{path}/manifests")
    rows = spark.read.schema(schema).parquet(f"{path}/data/{output}")
    parts = F.split(F.col("_metadata.file_path"), "/")
    named = rows.withColumn("_file", F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)))
    return named.join(manifests.select(F.col("file").alias("_file")), "_file", "left_semi").drop("_file")
