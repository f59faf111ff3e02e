"""Running Structured Streaming queries to durable sinks.

Sources are file streams over a table's own folder, or over the folder that
holds the table as one file (picked with ``pathGlobFilter``); sinks and checkpoints live in fresh folders of the
shared storage, so a restarted query resumes from its checkpoint and an
executor loss replays only the failed tasks.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from riskframe.session import scratch_path
from riskframe.sources.tables import load


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A table, one file or a folder of files, read as a file stream (schema from the table; new files arrive as micro-batches)."""
    schema = load(spark, sf_dir, name).schema
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hp.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hp).isDirectory():
        return r.parquet(path)
    # a stream takes folders only
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def disk_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (on disk, changes only per batch); the session's own setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def run_available_now(df: DataFrame, name: str, mode: str = "append", fmt: str = "parquet",
                      partition_by: list[str] | None = None, out: str | None = None, checkpoint: str | None = None) -> str:
    """Process everything available, write it to a sink folder, return that folder.

    Sink and checkpoint are fresh folders unless named; with the folders of an earlier run the query goes on where that ended.
    """
    spark = df.sparkSession
    out = out or scratch_path(spark, f"{name}-out")
    w = (df.writeStream.format(fmt).outputMode(mode)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-ckpt"))
         .option("path", out).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    _finish(w)
    return out


def run_foreach_batch(df: DataFrame, name: str, fn, mode: str = "append", checkpoint: str | None = None) -> None:
    """``foreachBatch`` with an availableNow trigger; ``fn(batch_df, batch_id)`` does the writes."""
    _finish(df.writeStream.outputMode(mode).foreachBatch(fn)
            .option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, f"{name}-ckpt"))
            .trigger(availableNow=True))


def _finish(writer) -> None:
    with disk_state(SparkSession.active()):
        q = writer.start()
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
