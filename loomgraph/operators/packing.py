"""Ordered packing of whole files into bounded batches, and items with idempotency keys.

Packing is sequential by nature: where a batch ends depends on where it began. It runs per push over
one small row a file, in one pass that keeps only the places where batches begin.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.functions.scalars import item_key, item_text
from loomgraph.schema import CHUNK_BYTES, CHUNK_FILES, MAX_BATCH_FILES, MAX_BATCH_ROWS


def next_fit(weights, max_weight: int, max_files: int, seed: int = 0) -> list[int]:
    """Batch number of each weight in order. A batch closes before the file that would overfill it;
    ``seed`` weight lies in the first batch, which takes the first file in any case."""
    out, number, weight, files = [], 0, seed, 0
    for w in weights:
        if files and (weight + w > max_weight or files >= max_files):
            number, weight, files = number + 1, 0, 0
        out.append(number)
        weight, files = weight + w, files + 1
    return out


def pack(files: DataFrame, keys: list[str], weight: str, max_weight: int, max_files: int, seed: str | None = None) -> DataFrame:
    """Adds ``batch_no`` to files (keys.., ord, path, weight[, seed]) of each group of keys.

    A group is one push or one run's file list; it is sorted in the shuffle, and a task holds the
    counters of the group at hand and no more.
    """
    cols = [*keys, "ord", "path", weight] + ([seed] if seed else [])
    ordered = files.select(*cols).repartition(*keys).sortWithinPartitions(*keys, "ord", "path")
    schema = T.StructType([*ordered.schema.fields, T.StructField("batch_no", T.IntegerType())])

    def run(batches):
        key, number, load, n = None, 0, 0, 0
        for batch in batches:
            rows = []
            for r in zip(*[batch[c] for c in [*keys, weight] + ([seed] if seed else [])]):
                k, w = r[: len(keys)], int(r[len(keys)])
                if k != key:
                    key, number, load, n = k, 0, int(r[-1]) if seed else 0, 0
                if n and (load + w > max_weight or n >= max_files):
                    number, load, n = number + 1, 0, 0
                rows.append(number)
                load, n = load + w, n + 1
            yield batch.assign(batch_no=pd.Series(rows, index=batch.index, dtype="int32"))

    return ordered.mapInPandas(run, schema)


def graph_rows_per_file(entities: DataFrame, edges: DataFrame, hyperedges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., path, n_rows): rows a file owns; path '' holds the rows without a file."""
    rows = (
        entities.select(*keys, F.coalesce("file_path", F.lit("")).alias("path"))
        .unionByName(edges.select(*keys, F.coalesce("src_file", F.lit("")).alias("path")))
        .unionByName(hyperedges.select(*keys, F.coalesce("src_file", F.lit("")).alias("path")))
    )
    return rows.groupBy(*keys, "path").agg(F.count(F.lit(1)).alias("n_rows"))


def pack_graph(files: DataFrame, owned: DataFrame, keys: list[str], max_rows: int = MAX_BATCH_ROWS, max_files: int = MAX_BATCH_FILES) -> DataFrame:
    """Files (keys.., path) packed by the rows they own; rows of no listed file count into the first batch."""
    listed = files.select(*keys, "path").distinct()
    counted = listed.join(owned, [*keys, "path"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    unfiled = owned.join(listed, [*keys, "path"], "left_anti").groupBy(*keys).agg(F.sum("n_rows").alias("unfiled"))
    rows = counted.join(unfiled, keys, "left").withColumn("unfiled", F.coalesce("unfiled", F.lit(0))).withColumn("ord", F.lit(0))
    return pack(rows, keys, "n_rows", max_rows, max_files, "unfiled").drop("ord")


def pack_files(files: DataFrame, keys: list[str], max_files: int = CHUNK_FILES, max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Files (keys.., path, content) packed into chunks by number and bytes, in order of path."""
    rows = files.select(*keys, "path", F.octet_length("content").cast("bigint").alias("n_bytes"), F.lit(0).alias("ord"))
    return pack(rows, keys, "n_bytes", max_bytes, max_files).withColumnRenamed("batch_no", "chunk_no").drop("ord")


def chunk_items(chunks: DataFrame, order: list[str]) -> DataFrame:
    """Items of chunks by idempotency key: the last row wins and stands where the first stood.

    (repo, idempotency_key, item_no, text, metadata); item_no is the place of the first row in its repo.
    """
    text = item_text(F.col("header"), F.col("body"))
    rows = chunks.withColumn("text", text).withColumn("idempotency_key", item_key(F.col("repo"), F.col("entity_id"), F.col("text")))
    meta = F.create_map(*[x for k, c in (("repo", "repo"), ("entity_id", "entity_id"), ("type", "ent_type"), ("file_path", "file_path"), ("language", "lang")) for x in (F.lit(k), F.coalesce(c, F.lit("")))])
    at = F.struct(*order)
    one = rows.groupBy("repo", "idempotency_key").agg(F.min(at).alias("first"), F.max_by(F.struct("text", meta.alias("metadata"), "ent_type", "file_path"), at).alias("s"))
    return one.select("repo", "idempotency_key", F.col("first").alias("first"), "s.text", "s.metadata", "s.ent_type", "s.file_path")
