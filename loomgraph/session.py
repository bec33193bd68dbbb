"""Session helpers: checkpoint folder and lineage cutting."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where it is unset, a local master gets a folder of its own;
    on a cluster that is an error, as its executors would write where no other machine can read."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    jsc = spark.sparkContext._jsc.sc()
    current = jsc.getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not configured and not jsc.isLocal():
        raise ValueError(f"{CHECKPOINT_CONF} names no folder that all executors share")
    folder = configured or tempfile.mkdtemp(prefix="loomgraph-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def cancellable(spark: SparkSession, tag: str):
    """Jobs begun in this thread within the block end when any thread calls ``cancel`` with the tag."""
    spark.sparkContext.addJobTag(tag)
    try:
        yield
    finally:
        spark.sparkContext.removeJobTag(tag)


def cancel(spark: SparkSession, tag: str) -> None:
    """Ends the running jobs of a tag; what they had not committed is not there."""
    spark.sparkContext.cancelJobsWithTag(tag)


class Scratch:
    """Tables written in the shared checkpoint folder to cut lineage, and removed together.

    ``remove`` deletes what is not kept; what a returned frame still reads goes when the process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._written: list[str] = []
        atexit.register(self._end)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{len(self._written)}-{name}"
        df.write.parquet(path)
        self._written.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, *keep: DataFrame) -> None:
        """Deletes the tables that none of the frames reads."""
        read = [f for df in keep for f in df.inputFiles()]
        for path in self._written:
            last = "/".join(path.rsplit("/", 2)[1:])  # the scheme may be written in several ways
            if not any(f"/{last}/" in f for f in read):
                delete_path(self.spark, path)

    def _end(self) -> None:
        try:
            delete_path(self.spark, self.path)
        except Exception:  # noqa: BLE001 - the session may have ended already
            pass


def ship_file(spark: SparkSession, path: str) -> None:
    """Sends a file of the driver's machine to the executors, once a context."""
    context = spark.sparkContext
    sent = getattr(context, "_loomgraph_files", set())
    if path not in sent:
        context.addFile(path)
        context._loomgraph_files = sent | {path}


def local_copy(path: str) -> str:
    """Where a worker finds a file that ``ship_file`` sent."""
    from pyspark import SparkFiles

    try:
        copy = SparkFiles.get(os.path.basename(path))
    except Exception:  # noqa: BLE001 - no Spark in this process
        return path
    return copy if os.path.exists(copy) else path


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once a context, whatever their search path is."""
    context = spark.sparkContext
    if getattr(context, "_loomgraph_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="loomgraph-"), "loomgraph.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(archive)
    context._loomgraph_shipped = True
