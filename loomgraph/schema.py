"""Table schemas and the closed vocabulary of the graph."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()  # noqa: E741
PROPS = T.MapType(S, S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


CHANGE = _struct(path=S, old_path=S, status=S, content_sha=S)
ENTITY = _struct(entity_id=S, ent_name=S, ent_type=S, description=S, file_path=S, line_start=I, line_end=I, source_url=S, author=S, captured_at=S, props=PROPS)
EDGE = _struct(src_id=S, dst_id=S, relation=S, src_file=S, confidence_score=D, confidence_tier=S, props=PROPS)
SYMBOL = _struct(symbol=S, lang=S, kind=S, role=S, entity_id=S, src_file=S)
HYPEREDGE = _struct(he_key=S, label=S, relation=S, confidence_score=D, src_file=S, members=T.ArrayType(S), props=PROPS)
CHUNK = _struct(entity_id=S, ent_type=S, file_path=S, lang=S, header=S, body=S)
ITEM = _struct(idempotency_key=S, text=S, metadata=PROPS)

# The scores of the resolution levels, as numbers and as they are printed.
RESOLUTION_SCORES = {
    "type_resolved": (0.98, "0.98"),
    "scoped_name_match": (0.85, "0.85"),
    "imported_name_match": (0.7, "0.7"),
    "global_name_match": (0.45, "0.45"),
    "ambiguous_multi_def": (0.2, "0.2"),
    "unresolved": (0.0, "0"),
}
DEGRADED_CAP = 0.45
# Terminal states of a job.
JOB_TERMINAL = ("succeeded", "failed", "partial")
# Directories never walked.
PRUNED_DIRS = (".git", "node_modules", "vendor", ".venv", "venv", "__pycache__", ".tox", ".mypy_cache", ".pytest_cache")
# Bounds of a push and of a chunk of files.
MAX_BATCH_ROWS, MAX_BATCH_FILES = 2000, 250
CHUNK_FILES, CHUNK_BYTES = 8, 48 * 1024
HISTOGRAM_ROWS = (10, 50, 100, 250, 500, 1000, 2000, 5000, 10000)
HYPEREDGE_CAP, HYPEREDGE_MIN = 3, 3
