"""Reconciliation of pushes: per-file replacement, upserts, a Parquet store that swaps versions, and facts kept by content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.extract.facts import extract_facts
from loomgraph.functions.sizing import broadcast_if_small


def reconcile(target: DataFrame, rows: DataFrame, files: DataFrame, keys: list[str], ids: list[str] | None = None) -> DataFrame:
    """``target`` without the rows of ``files``, and the new rows: delete-then-insert per file.

    The last key is the file. Rows without one belong to no file; with ``ids`` they are upserted by
    those: a new one replaces the old, and goes where a kept row of a file has its id.
    """
    kept, new = target.join(files.select(*keys).distinct(), keys, "left_anti"), rows.select(*target.columns)
    if ids:
        free = F.col(keys[-1]).isNull() | (F.col(keys[-1]) == "")
        filed = kept.filter(~free)
        mine = new.filter(free).dropDuplicates(ids).join(filed.select(*ids).distinct(), ids, "left_anti")
        kept = filed.unionByName(kept.filter(free).join(new.select(*ids).distinct(), ids, "left_anti").select(*target.columns))
        new = new.filter(~free).unionByName(mine.select(*target.columns))
    return kept.unionByName(new)


def latest_push(rows: DataFrame, keys: list[str], when: str) -> DataFrame:
    """Rows of a push log that later pushes of the same keys have not replaced."""
    last = rows.groupBy(*keys).agg(F.max(when).alias("_last"))
    return rows.join(last, keys).filter(F.col(when).eqNullSafe(F.col("_last"))).drop("_last")


def upsert(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key."""
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("s"))
    return last.select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest])


class ParquetStore:
    """A table kept in numbered versions, of which each holds the groups (values of the first key) that changed.

    ``apply`` reconciles and rewrites only the groups it touches; a manifest, written last, says in which
    version each group is. A run that dies before that leaves the last good manifest, and running it again
    gives the same result. Versions that the newest two manifests do not name are deleted, so that a reader
    of the one before the newest can end. With more than ``MOST_VERSIONS`` in use all groups are written anew.
    """

    MOST_VERSIONS = 64

    def __init__(self, spark: SparkSession, path: str, keys: list[str], ids: list[str] | None = None):
        self.spark, self.path, self.keys, self.ids = spark, path.rstrip("/"), keys, ids

    def _fs(self, at: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _versions(self, what: str) -> list[int]:
        fs, p = self._fs(f"{self.path}/{what}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit() and fs.exists(self._fs(f"{self.path}/{what}/{n}/_SUCCESS")[1]))

    def version(self) -> int:
        return max(self._versions("manifest"), default=0)

    def _manifest(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/manifest/v{version}")

    def _used(self, version: int) -> list[int]:
        return sorted(r[0] for r in self._manifest(version).select("version").distinct().collect())  # few: they are compacted

    def _of(self, version: int, groups: DataFrame | None = None) -> DataFrame:
        """Rows of a version of the table, or of some of its groups."""
        g, manifest = self.keys[0], self._manifest(version)
        if groups is not None:
            few = groups.select(F.col(g).alias("_want"))
            manifest = manifest.join(few, F.col("group").eqNullSafe(F.col("_want")), "left_semi")
        out = None
        for k in self._used(version) or [version]:
            rows, mine = self.spark.read.parquet(f"{self.path}/data/v{k}"), broadcast_if_small(manifest.filter(F.col("version") == k))
            part = rows.join(mine, F.col(g).eqNullSafe(F.col("group")), "left_semi")
            out = part if out is None else out.unionByName(part)
        return out

    def read(self) -> DataFrame | None:
        v = self.version()
        return self._of(v) if v else None

    def apply(self, rows: DataFrame, files: DataFrame | None) -> DataFrame:
        """Writes the groups of the next version; ``files`` None inserts only, as a first full run does."""
        v, g = self.version(), self.keys[0]
        now, staged = v + 1, f"{self.path}/staging/v{v + 1}"
        rows.write.mode("overwrite").parquet(staged)  # what made the rows is not computed again
        rows = self.spark.read.schema(rows.schema).parquet(staged)
        groups = rows.select(g).unionByName(files.select(g)).distinct() if files is not None else rows.select(g).distinct()
        if v and len(self._used(v)) >= self.MOST_VERSIONS:
            groups = groups.unionByName(self._manifest(v).select(F.col("group").alias(g))).distinct()
        if not v:
            new = rows
        else:
            old = self._of(v, groups)
            new = old.unionByName(rows.select(*old.columns)) if files is None else reconcile(old, rows, files, self.keys, self.ids)
        new.write.mode("overwrite").parquet(f"{self.path}/data/v{now}")
        written = self.spark.read.parquet(f"{self.path}/data/v{now}").select(F.col(g).alias("group")).distinct()
        manifest = written.withColumn("version", F.lit(now))
        if v:
            rest = self._manifest(v)
            manifest = rest.join(groups.select(F.col(g).alias("_now")), F.col("group").eqNullSafe(F.col("_now")), "left_anti").unionByName(manifest)
        manifest.write.mode("overwrite").parquet(f"{self.path}/manifest/v{now}")
        self._clean(now)
        return self._of(now)

    def _clean(self, now: int) -> None:
        kept = [k for k in (now, now - 1) if k > 0]
        used = {x for k in kept for x in [*self._used(k), k]}
        old = [f"data/v{k}" for k in self._versions("data") if k not in used] + [f"manifest/v{k}" for k in self._versions("manifest") if k not in kept] + ["staging"]
        for name in old:
            fs, p = self._fs(f"{self.path}/{name}")
            fs.delete(p, True)


class FactStore:
    """Facts of files by content, kept from run to run: a file is parsed once for every content it has had.

    A run appends the facts of unseen files and, last, their keys; facts without their keys, of a run that
    died, are never read.
    """

    KEYS = ["repo", "path", "analyzer", "sha"]

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _runs(self) -> list[str]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/keys")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        jvm = self.spark.sparkContext._jvm
        return sorted(n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/keys/{n}/_SUCCESS")))

    def _read(self, what: str) -> DataFrame | None:
        runs = self._runs()
        return self.spark.read.parquet(*[f"{self.path}/{what}/{r}" for r in runs]) if runs else None

    def of(self, files: DataFrame) -> DataFrame:
        """Facts of routed files (repo, path, analyzer, content); only those of unseen content are extracted."""
        keyed = files.withColumn("sha", F.coalesce(F.sha2("content", 256), F.lit("unreadable")))
        seen = self._read("keys")
        new = keyed if seen is None else keyed.join(seen, self.KEYS, "left_anti")
        run = f"run-{len(self._runs()) + 1:06}"
        if seen is None or not new.isEmpty():
            shas = new.select(*self.KEYS).distinct()
            facts = extract_facts(new.drop("sha"))
            facts.join(shas, ["repo", "path", "analyzer"]).write.mode("overwrite").parquet(f"{self.path}/facts/{run}")
            shas.write.mode("overwrite").parquet(f"{self.path}/keys/{run}")
        return self._read("facts").join(keyed.select(*self.KEYS).distinct(), self.KEYS, "left_semi").drop("sha")
