"""Processing only new or changed records.

``IncrementalTable`` keeps a partitioned table up to date: each run stores per-partition fingerprints
(row count and the sum of row hashes) of the raw source; the next run compares them with fresh ones,
before anything else is computed, reads and recomputes the partitions that differ, and replaces each by
dynamic partition overwrite. The fingerprints are written last, so a run that dies before that leaves
the old ones and the next run replaces the same partitions again: nothing is skipped and nothing is
applied twice.

``ChangeBacklog`` does so for a change log. A partition is a block of a repo's commits; what is kept of
it is one row a path, with its last change and its last processed change in the block. A late or new
row changes the fingerprint of its block alone; a path's state is put together from its blocks.
``pending_paths`` answers which paths the next run has to process.

Nulls: a row whose repo, path or commit_no is null names no path and is ignored; a null recorded_at
is never known to be covered, so the row is unprocessed. Empty tables give empty results. Repeated
rows count once. Extra columns are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.sizing import broadcast_if_small
from loomgraph.session import Scratch, delete_path, ensure_checkpoint_dir

ABSENT = "absent"
UNKNOWN = "unknown"
#: Commits of a repo that make one partition of the log.
BLOCK_COMMITS = 16
#: Source rows of a partition from which its output is written by several tasks.
ROWS_A_FILE = 1_000_000


def fingerprint(df: DataFrame, keys: Sequence[str], row: Sequence[Column], prefix: str) -> DataFrame:
    """Count and additive 64-bit row hash per partition; partial sums combine before the shuffle."""
    hashed = F.xxhash64(*row).cast("decimal(20,0)")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{prefix}_n"), F.sum(hashed).alias(f"{prefix}_hash"))


def disjoint_windows(windows: list[tuple]) -> list[tuple]:
    """Windows (lo, hi, at) of one repo as disjoint (lo, hi, latest at) that cover the same commits, in order."""
    marks = sorted({x for lo, hi, _ in windows for x in (lo, hi)})
    begin = sorted((w for w in windows if w[0] < w[1]), key=lambda w: w[0])
    out, live, k = [], [], 0
    for a, b in zip(marks, marks[1:]):
        while k < len(begin) and begin[k][0] <= a:
            heappush(live, (-begin[k][2].value, begin[k][1]))
            k += 1
        while live and live[0][1] <= a:
            heappop(live)
        if live:
            at = -live[0][0]
            if out and out[-1][1:] == (a, at):
                out[-1] = (out[-1][0], b, at)
            else:
                out.append((a, b, at))
    return [(a, b, pd.Timestamp(at, tz="UTC")) for a, b, at in out]


def flag_processed(changes: DataFrame, runs: DataFrame, block: int = BLOCK_COMMITS) -> DataFrame:
    """Adds ``processed``: a succeeded run of the repo covers the commit and began once the row was recorded.

    Overlapping runs become disjoint windows with the latest start, so a row meets at most one, by its block.
    """

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        at = pd.to_datetime(pdf["at"], utc=True)
        rows = disjoint_windows(list(zip(pdf["lo"].tolist(), pdf["hi"].tolist(), at)))
        return pd.DataFrame({"repo": pdf["repo"].iloc[0], "lo": [r[0] for r in rows], "hi": [r[1] for r in rows], "at": pd.Series([r[2] for r in rows], dtype="datetime64[ns, UTC]")})

    ran = runs.filter((F.col("status") == "succeeded") & F.col("repo").isNotNull() & F.col("head_no").isNotNull() & F.col("started_at").isNotNull())
    ran = ran.select("repo", F.coalesce("since_no", F.lit(0)).cast("long").alias("lo"), F.col("head_no").cast("long").alias("hi"), F.col("started_at").alias("at"))
    windows = ran.filter("lo < hi").distinct().groupBy("repo").applyInPandas(merge, "repo string, lo bigint, hi bigint, at timestamp")
    blocks = F.explode(F.expr(f"sequence((lo + 1) div {block}, hi div {block})"))
    spread = windows.select(F.col("repo").alias("_repo"), "lo", "hi", "at", blocks.alias("_block"))
    here = (F.col("repo") == F.col("_repo")) & (F.expr(f"commit_no div {block}") == F.col("_block")) & (F.col("lo") < F.col("commit_no")) & (F.col("commit_no") <= F.col("hi"))
    joined = changes.join(broadcast_if_small(spread), here, "left")
    return joined.withColumn("processed", F.coalesce(F.col("at") >= F.col("recorded_at"), F.lit(False))).drop("_repo", "_block", "lo", "hi", "at")


def change_states(changes: DataFrame) -> DataFrame:
    """One row per path a change row touches: (repo, path, commit_no, state, own, processed)."""
    letter = F.upper(F.substring(F.trim("status"), 1, 1))
    sha = F.lower(F.trim("content_sha"))
    state = F.when(letter == "D", ABSENT).when(sha.isNull() | (sha == ""), UNKNOWN).otherwise(sha)
    touched = F.array(
        F.struct(F.col("path").alias("path"), state.alias("state"), F.lit(1).alias("own")),
        F.struct(F.when(letter == "R", F.col("old_path")).alias("path"), F.lit(ABSENT).alias("state"), F.lit(0).alias("own")),
    )
    return (
        changes.withColumn("t", F.explode(touched))
        .select("repo", F.col("t.path").alias("path"), "commit_no", F.col("t.state").alias("state"), F.col("t.own").alias("own"), "processed")
        .filter(F.col("repo").isNotNull() & F.col("path").isNotNull() & F.col("commit_no").isNotNull())
    )


def change_events(changes: DataFrame, runs: DataFrame, block: int = BLOCK_COMMITS) -> DataFrame:
    """The log as rows of paths, with the partition ``part`` (repo and block of commits) of each."""
    cols = ["repo", "path", "old_path", "commit_no", "status", "content_sha", "recorded_at"]
    events = change_states(flag_processed(changes.select(*cols), runs.select("repo", "since_no", "head_no", "status", "started_at"), block))
    return events.withColumn("part", F.concat_ws("@", "repo", F.expr(f"commit_no div {block}")))


def block_digest(events: DataFrame) -> DataFrame:
    """(part, repo, path, last, done, open): a path's last change and last processed one within a block of commits.

    A change's own row outweighs a rename's mark on its old path, and known content outweighs unknown.
    """
    # One shuffle serves both aggregations: rows of one change and of one path share (part, path).
    merged = (
        events.repartition("part", "path")
        .groupBy("part", "repo", "path", "commit_no")
        .agg(
            F.max(F.struct("own", (F.col("state") != UNKNOWN).cast("int").alias("known"), "state")).alias("s"),
            F.max("processed").alias("processed"),
        )
        .select("part", "repo", "path", "commit_no", F.col("s.state").alias("state"), "processed")
    )
    digest = merged.groupBy("part", "repo", "path").agg(
        F.max(F.struct("commit_no", "state", "processed")).alias("last"),
        F.max(F.when(F.col("processed"), F.struct("commit_no", "state"))).alias("done"),
    )
    return digest.withColumn("open", ~F.col("last.processed"))


def path_states(digest: DataFrame) -> DataFrame:
    """Per (repo, path): ``wanted`` state after the latest change, ``held`` after the latest processed one."""
    last = digest.groupBy("repo", "path").agg(F.max("last").alias("last"), F.max("done").alias("done"))
    held = F.coalesce(F.col("done.state"), F.lit(ABSENT))
    wanted = F.when(F.col("last.processed"), held).when(F.col("last.state") == UNKNOWN, F.concat(F.lit("unknown at "), F.col("last.commit_no"))).otherwise(F.col("last.state"))
    return last.select("repo", "path", held.alias("held"), wanted.alias("wanted"))


class ChangeBacklog:
    """The change log of all repos, kept up to date by blocks of commits in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, block: int = BLOCK_COMMITS):
        self.block, self.table = block, IncrementalTable(spark, folder, "part", block_digest)

    def replay(self, events: DataFrame, kept: bool = True) -> dict:
        """Where no run has stored anything yet: what the succeeded runs of the log have left behind.

        In a folder that is not ``kept``, blocks with open changes get their fingerprints only: the refresh
        that follows replaces them anyway.
        """
        whole = None if kept else events.groupBy("part").agg(F.min("processed").alias("p")).filter("p").select("part")
        return self.table.refresh(events.filter("processed"), whole)

    def update(self, changes: DataFrame, runs: DataFrame, kept: bool = True) -> dict:
        """Compares fingerprints and recomputes the blocks that changed. Returns blocks and rows in all and recomputed."""
        events = change_events(changes, runs, self.block)
        if self.table.fingerprints() is None:
            self.replay(events, kept)
        return self.table.refresh(events)

    def pending(self) -> DataFrame:
        """(repo, path) the next run must process. Only paths with an open change in some block are looked at."""
        digest = self.table.read()
        paths = digest.filter("open").select("repo", "path").distinct()
        return path_states(digest.join(paths, ["repo", "path"], "left_semi")).filter(F.col("held") != F.col("wanted")).select("repo", "path")


def pending_paths(changes: DataFrame, runs: DataFrame, folder: str | None = None) -> DataFrame:
    """(repo, path) the next run must process.

    ``folder`` keeps the blocks and their fingerprints from run to run. Without it, the blocks are first
    those that the succeeded runs of the log left behind, and the folder goes after use.
    """
    spark = changes.sparkSession
    backlog = ChangeBacklog(spark, folder or f"{ensure_checkpoint_dir(spark)}/backlog-{uuid.uuid4().hex}")
    backlog.update(changes, runs, kept=folder is not None)
    if folder:
        return backlog.pending()
    found = Scratch(spark, "pending").write(backlog.pending(), "paths")
    delete_path(spark, backlog.table.path)
    return found


class IncrementalTable:
    """A table partitioned by one column, refreshed partition by partition.

    ``partition`` names the partition column of the source; its values must be strings or integers.
    ``build`` maps source rows of some partitions to output rows and keeps the partition column.
    Partitions that vanish from the source leave the fingerprints, and ``read`` no longer shows them.
    A null partition value is the partition of its own that Spark writes for it, and so is an empty string.
    Each recomputed partition gets one row that is no output (``_live`` false), so that one for which
    ``build`` yields nothing is overwritten too.
    """

    def __init__(self, spark: SparkSession, path: str, partition: str, build: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.partition, self.build = spark, path.rstrip("/"), partition, build

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _fs(self, at: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(at)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _versions(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/fingerprints")
        if not fs.exists(p):
            return []
        done = []
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            fs, mark = self._fs(f"{self.path}/fingerprints/{name}/_SUCCESS")
            if name.startswith("v") and name[1:].isdigit() and fs.exists(mark):
                done.append(int(name[1:]))
        return sorted(done)

    def _rows(self) -> DataFrame:
        """All rows with the types they were written with; a partition's name alone would not tell '007' from 7."""
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        fs, p = self._fs(self._data)
        return self.spark.read.schema(schema).parquet(self._data) if fs.exists(p) else self.spark.createDataFrame([], schema)

    def fingerprints(self) -> DataFrame | None:
        """The fingerprints of the last run that ended, or None before the first."""
        v = self._versions()
        return self.spark.read.parquet(f"{self.path}/fingerprints/v{v[-1]}") if v else None

    def refresh(self, source: DataFrame, only: DataFrame | None = None) -> dict:
        """Recompute changed partitions only. Returns partitions and source rows, in all and of those recomputed.

        ``only`` names the partitions to write where the next refresh is known to replace the others.
        """
        row = [F.coalesce(F.to_json(F.struct(F.col(c))), F.lit("")) if isinstance_map(source, c) else F.col(c) for c in source.columns]
        nulls = [F.col(c).isNull() for c in source.columns]
        now = fingerprint(source, [self.partition], [*row, *nulls], "now")
        before = self.fingerprints()
        old_cols = ["old_n", "old_hash"]
        if before is None:
            compared = now.select(self.partition, "now_n", "now_hash", *[F.lit(None).cast(t).alias(c) for c, t in zip(old_cols, ("bigint", "decimal(30,0)"))])
        else:
            old = before.select(F.col(self.partition).alias("_old"), F.col("now_n").alias("old_n"), F.col("now_hash").alias("old_hash"))
            compared = now.join(old, F.col(self.partition).eqNullSafe(F.col("_old")), "left").select(self.partition, "now_n", "now_hash", *old_cols)
        version = (self._versions() or [0])[-1] + 1
        pending = f"{self.path}/pending/v{version}"
        compared.write.mode("overwrite").parquet(pending)
        compared = self.spark.read.schema(compared.schema).parquet(pending)
        differs = ~(F.col("now_n").eqNullSafe(F.col("old_n")) & F.col("now_hash").eqNullSafe(F.col("old_hash")))
        some = compared.agg(F.count(F.lit(1)).alias("partitions"), F.count(F.when(differs, 1)).alias("recomputed"), F.coalesce(F.sum("now_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(differs, F.col("now_n"))), F.lit(0)).alias("rows_read")).first()
        if before is None:
            self.build(source.limit(0)).withColumn("_live", F.lit(True)).limit(0).write.mode("overwrite").parquet(f"{self.path}/schema")
        if some.recomputed:
            changed = compared.filter(differs).select(self.partition)
            if only is not None:
                changed = changed.join(only, self.partition, "left_semi")
            part = source.join(broadcast_if_small(changed.withColumnRenamed(self.partition, "_changed")), F.col(self.partition).eqNullSafe(F.col("_changed")), "left_semi")
            built = self.build(part).withColumn("_live", F.lit(True))
            kind = built.schema[self.partition].dataType
            built = built.unionByName(changed.select(F.col(self.partition).cast(kind).alias(self.partition), F.lit(False).alias("_live")), allowMissingColumns=True)
            # A partition's rows meet in one task and file, those of a hot one in as many as its source rows call for.
            files = compared.filter(differs).select(F.col(self.partition).alias("_of"), F.ceil(F.col("now_n") / ROWS_A_FILE).alias("_files"))
            spread = F.pmod(F.xxhash64(*[c for c in built.columns if not isinstance_map(built, c)]), F.greatest("_files", F.lit(1)))
            tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-some.rows_read // ROWS_A_FILE))
            built = built.join(broadcast_if_small(files), F.col(self.partition).eqNullSafe(F.col("_of")), "left").repartition(tasks, self.partition, spread).drop("_of", "_files")
            built.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self._data)
        compared.select(self.partition, "now_n", "now_hash").write.mode("overwrite").parquet(f"{self.path}/fingerprints/v{version}")
        delete_path(self.spark, pending)
        return some.asDict()

    def read(self) -> DataFrame:
        live = self.fingerprints()
        if live is None:
            raise ValueError("no run has ended yet")
        keys = broadcast_if_small(live.select(F.col(self.partition).alias("_kept")))
        return self._rows().filter("_live").drop("_live").join(keys, F.col(self.partition).eqNullSafe(F.col("_kept")), "left_semi")


def isinstance_map(df: DataFrame, column: str) -> bool:
    """Maps cannot be hashed; they enter a row hash as JSON."""
    return "map" in json.dumps(df.schema[column].jsonValue())
