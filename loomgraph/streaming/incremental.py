"""A commit log as a stream: every micro-batch of changes is one ingest run into a store.

``foreachBatch`` may see a batch twice after a failure; reconciling by file makes that harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators.store import FactStore, ParquetStore
from loomgraph.plans.pipeline import ingest

LOG = "repo string, path string, old_path string, status string, content_sha string, commit_no int"


def follow(spark: SparkSession, log_dir: str, files: Callable[[], DataFrame], store_dir: str, checkpoint: str, trigger: dict | None = None):
    """Starts the stream over a folder of Parquet change logs; ``files`` gives the trees as they are now.

    Within a batch the last commit of a path counts. Entities, edges and chunks are kept in stores of
    their own under ``store_dir``, and so are the facts of files: a batch parses what is new alone.
    """
    facts = FactStore(spark, f"{store_dir}/facts")
    stores = {name: ParquetStore(spark, f"{store_dir}/{name}", ["repo", key], ["repo", "entity_id"] if name == "entities" else None) for name, key in (("entities", "file_path"), ("edges", "src_file"), ("chunks", "file_path"))}

    def apply(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        rest = [c for c in batch.columns if c not in ("repo", "path")]
        last = batch.groupBy("repo", "path").agg(F.max_by(F.struct(*rest), "commit_no").alias("s")).select("repo", "path", "s.*")
        run = ingest(files(), last, known_facts=facts)
        for name, column in (("entities", "file_path"), ("edges", "src_file"), ("chunks", "file_path")):
            scope = run.reconcile if name == "chunks" else run.graph_files
            stores[name].apply(getattr(run, name), scope.withColumnRenamed("path", column))

    stream = spark.readStream.schema(LOG).parquet(log_dir)
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
