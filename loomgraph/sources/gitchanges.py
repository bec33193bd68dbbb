"""Change sets of git repositories as a data source: ``spark.read.format("gitchanges")``.

Options: ``path`` (a working tree), ``since`` (a commit; empty for all tracked files), ``full``. Where the
difference cannot be taken, as after a rewritten history, all tracked files are listed instead; the
column ``full_set`` says which it was. Hashes are of the bytes in the working tree, of a link's text for
links, and null where a file cannot be read. Many trees are many reads, or ``read_changes`` over a table.
"""

from __future__ import annotations

import hashlib
import os
import subprocess
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, old_path string, status string, content_sha string, full_set boolean"


def content_sha(root: str, path: str) -> str | None:
    full = os.path.join(root, path)
    try:
        data = os.readlink(full).encode() if os.path.islink(full) else open(full, "rb").read()
    except OSError:
        return None
    return hashlib.sha256(data).hexdigest()


def parse_name_status(raw: bytes) -> Iterator[tuple[str, str | None, str]]:
    """(path, old path, status) of NUL-separated ``--name-status`` output; cut or unknown records are left out."""
    fields = iter(raw.decode("utf-8", "surrogateescape").rstrip("\0").split("\0"))
    for code in fields:
        letter = code[:1]
        if letter in ("R", "C"):
            old, new = next(fields, None), next(fields, None)
            if new is not None:
                yield (new, old, "R") if letter == "R" else (new, None, "A")
        elif letter in ("A", "M", "D", "T"):
            path = next(fields, None)
            if path is not None:
                yield path, None, "M" if letter == "T" else letter


def _git(root: str, *args: str) -> bytes:
    return subprocess.run(["git", "-C", root, *args], capture_output=True, check=True).stdout


def head_commit(root: str) -> str:
    """The commit at HEAD, empty where there is none."""
    try:
        return _git(root, "rev-parse", "HEAD").decode().strip()
    except (OSError, subprocess.CalledProcessError):
        return ""


def list_changes(root: str, since: str = "", full: bool = False) -> list[tuple]:
    """Rows of ``SCHEMA``, in order of path."""
    found, full_set = None, True
    if since and not full:
        try:
            found, full_set = [*parse_name_status(_git(root, "diff", "-M", "-z", "--name-status", f"{since}..HEAD"))], False
        except subprocess.CalledProcessError:
            found = None
    if found is None:
        found = [(p, None, "A") for p in _git(root, "ls-files", "-z").decode("utf-8", "surrogateescape").split("\0") if p]
    return sorted(((p, o, s, None if s == "D" else content_sha(root, p), full_set) for p, o, s in found), key=lambda r: r[0].encode("utf-8", "surrogateescape"))


class GitChanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gitchanges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.root, self.since, self.full = options["path"], options.get("since", ""), str(options.get("full", "false")).lower() == "true"

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        yield from list_changes(self.root, self.since, self.full)


def read_changes(repos):
    """Changes of many trees in parallel: repos (repo, root, since, full) to (repo, + ``SCHEMA``)."""
    import pandas as pd

    def run(batches):
        for batch in batches:
            rows = [(r.repo, *c) for r in batch.itertuples(index=False) for c in list_changes(r.root, r.since or "", bool(r.full))]
            yield pd.DataFrame(rows, columns=["repo", "path", "old_path", "status", "content_sha", "full_set"])

    return repos.select("repo", "root", "since", "full").repartition("repo").mapInPandas(run, "repo string, " + SCHEMA)
