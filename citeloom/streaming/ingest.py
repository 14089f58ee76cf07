"""Pick up new corpus files as a stream and apply them to a store."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from citeloom.functions.files import GZ_SUFFIX
from citeloom.operators import changes
from citeloom.plans.store import KEYED, Store


CHANGE_ROW = "pmid bigint, op string, file_name string, seq bigint"
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, path: str, max_files_per_trigger: int) -> DataFrame:
    """Stream of file paths; contents are not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", "*" + GZ_SUFFIX)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
        .select("path")
    )


def ingest(
    store: Store,
    path: str,
    checkpoint: str,
    max_files_per_trigger: int = 100,
    tables: Iterable[str] = KEYED,
    compact_after: int = 50,
) -> StreamingQuery:
    """Apply every file once and stop when none is left.

    The checkpoint says which files a micro-batch has, the store's ledger
    which are applied: a micro-batch that is run again does nothing.  After
    `compact_after` deltas they are folded into a new base, so that neither
    commits nor paths grow with the number of micro-batches.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        # at most `max_files_per_trigger` names
        paths = [r.path for r in batch.collect()]
        if paths:
            store.apply(paths, tables=tables)
            store.compact(compact_after)

    return (
        new_files(store.spark, path, max_files_per_trigger)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class ChangeLog:
    """Change rows appended by a stream; state is read from the whole log.

    Rows carry their order, so arrival order does not matter.  A micro-batch
    writes its own folder, named by its stream and epoch, overwrites it when
    run again, and is first reduced to one row per key.  A stream's name comes
    from its checkpoint: streams with other checkpoints write beside it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = None

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
        self.schema = stream.schema

        def append(batch: DataFrame, epoch: int) -> None:
            changes.latest(batch).write.mode("overwrite").parquet(
                f"{self.root}/stream={name}/epoch={epoch}"
            )

        return (
            stream.writeStream.foreachBatch(append)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def snapshot(self) -> DataFrame:
        """Rows alive; none of a log without epochs, in the columns of a change row."""
        try:
            log = self.spark.read.parquet(self.root).drop("stream", "epoch")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            log = self.spark.createDataFrame([], self.schema or CHANGE_ROW)
        return changes.snapshot(log)


class ChangeState:
    """The winning change of every key as the state of a stream, deletes kept as tombstones.

    The state has one row per key, and survives restarts with the checkpoint.  Late rows of older files reach it and
    change nothing.  Each micro-batch writes the winners of the keys it touched, in a folder of its epoch that is written
    anew when the epoch is run again; ranks only grow, so a key's greatest row is its newest.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = None

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        self.schema = stream.schema

        def put(winners: DataFrame, epoch: int) -> None:
            winners.write.mode("overwrite").parquet(f"{self.root}/epoch={epoch}")

        return (
            changes.latest(stream)
            .writeStream.outputMode("update")
            .foreachBatch(put)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def winners(self) -> DataFrame:
        try:
            rows = self.spark.read.parquet(self.root).drop("epoch")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            rows = self.spark.createDataFrame([], self.schema or CHANGE_ROW)
        return changes.latest(rows)

    def snapshot(self) -> DataFrame:
        """Rows alive."""
        return self.winners().filter(~changes.is_delete())


def deletion_log_once(deletes: DataFrame) -> DataFrame:
    """(pmid, file_name) of a stream of delete lists, each entry once however often its file is delivered.

    The state holds a key per entry, which is as much as the log itself.
    """
    return deletes.filter(F.col("pmid").isNotNull()).select("pmid", "file_name").dropDuplicates()


def deletion_log_stream(stream: DataFrame) -> DataFrame:
    """Delete entries of a change stream."""
    return stream.filter(changes.is_delete()).select(
        F.col("pmid"), F.col("file_name")
    )
