"""Counters and histograms over tables of events."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counters(rows: DataFrame, labels: list[str], value: str | None = None) -> DataFrame:
    """Count, or sum of a value, per label."""
    return rows.groupBy(*labels).agg((F.sum(value) if value else F.count(F.lit(1))).alias("n"))


def histogram(rows: DataFrame, labels: list[str], value: str, buckets: Sequence[float]) -> DataFrame:
    """Cumulative counts per bucket bound, and the bucket without a bound, as (labels.., le, n)."""
    v = F.col(value)
    sums = rows.groupBy(*labels).agg(*[F.sum((v <= b).cast("bigint")).alias(f"b{i}") for i, b in enumerate(buckets)], F.count(v).alias("b_inf"))
    cells = F.array(*[F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(buckets)], F.struct(F.lit("+Inf").alias("le"), F.col("b_inf").alias("n")))
    return sums.select(*labels, F.explode(cells).alias("c")).select(*labels, "c.le", "c.n")


def _escape(v) -> str:
    return str(v).replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")


def exposition(name: str, rows: list, labels: list[str], value: str = "n") -> str:
    """Text exposition of a counter: one line a label set, labels escaped."""
    lines = [f"# TYPE {name} counter"]
    for r in rows:
        shown = ",".join(f'{c}="{_escape(r[c])}"' for c in labels)
        lines.append(f"{name}{{{shown}}} {r[value]}" if labels else f"{name} {r[value]}")
    return "\n".join(lines) + "\n"


def push(send, text: str) -> bool:
    """Best effort: a store of metrics that fails does not fail the run."""
    try:
        return send("POST", "/metrics", text.encode()).status < 400
    except OSError:
        return False


# Bounds of durations and of batch rows.
SECONDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10)
ROWS = (10, 50, 100, 250, 500, 1000, 2000, 5000, 10000)
# Metrics of a run, with their labels; those with bounds are histograms.
METRICS = {
    "ingest_runs_total": ((), None),
    "ingest_run_result_total": (("result",), None),
    "push_requests_total": (("path", "result"), None),
    "ingest_stage_duration_seconds": (("stage",), SECONDS),
    "semantic_misses_total": ((), None),
    "llm_calls_total": (("result",), None),
    "code_graph_batches_total": (("result",), None),
    "code_graph_batch_rows": ((), ROWS),
    "push_retries_total": (("path", "reason"), None),
    "push_shed_responses_total": (("path", "status"), None),
    "analyzer_entities_total": (("language",), None),
    "analyzer_edges_total": (("language",), None),
    "analyzer_parse_errors_total": (("language",), None),
    "analyzer_duration_seconds": (("language",), SECONDS),
    "ingest_files_quarantined_total": (("language",), None),
    "scip_entities_total": ((), None),
    "scip_edges_total": ((), None),
    "semantic_chunk_extractions_total": (("result",), None),
}


class Registry:
    """The metrics of one run on the driver: counters and histograms by label, and their text."""

    def __init__(self):
        self.counts: dict[str, dict[tuple, float]] = {}
        self.seen: dict[str, dict[tuple, list]] = {}

    def _key(self, name: str, labels: dict) -> tuple:
        if tuple(sorted(labels)) != tuple(sorted(METRICS[name][0])):
            raise ValueError(f"{name} has the labels {METRICS[name][0]}")
        return tuple(str(labels[c]) for c in METRICS[name][0])

    def inc(self, name: str, n: float = 1, **labels) -> None:
        mine = self.counts.setdefault(name, {})
        key = self._key(name, labels)
        mine[key] = mine.get(key, 0) + n

    def observe(self, name: str, value: float, **labels) -> None:
        bounds = METRICS[name][1]
        cells = self.seen.setdefault(name, {}).setdefault(self._key(name, labels), [[0] * (len(bounds) + 1), 0.0])
        cells[0][bisect_left(bounds, value)] += 1
        cells[1] += value

    def absorb(self, name: str, rows: DataFrame, value: str = "n") -> None:
        """Adds a table of counts by the metric's labels, a row a label set."""
        labels = METRICS[name][0]
        for r in rows.groupBy(*labels).agg(F.sum(value).alias("n")).collect():
            self.inc(name, r["n"] or 0, **{c: r[c] for c in labels})

    def text(self) -> str:
        """Text exposition of everything counted, by name."""
        out = []
        for name in sorted({*self.counts, *self.seen}):
            labels, bounds = METRICS[name]
            if bounds is None:
                out.append(exposition(name, [dict(zip((*labels, "n"), (*k, v))) for k, v in sorted(self.counts[name].items())], list(labels)))
                continue
            out.append(f"# TYPE {name} histogram\n")
            for key, (cells, total) in sorted(self.seen[name].items()):
                so_far, shown = 0, [f'{c}="{_escape(v)}"' for c, v in zip(labels, key)]
                for le, n in zip((*bounds, "+Inf"), cells):
                    so_far += n
                    out.append(f"{name}_bucket{{{','.join([*shown, f'le={chr(34)}{le}{chr(34)}'])}}} {so_far}\n")
                tail = f"{{{','.join(shown)}}}" if shown else ""
                out += [f"{name}_sum{tail} {total:g}\n", f"{name}_count{tail} {so_far}\n"]
        return "".join(out)


def analyzer_counts(facts: DataFrame) -> DataFrame:
    """(language, entities, edges, parse_errors) of a run's facts."""
    of = lambda *kinds: F.count(F.when(F.col("kind").isin(*kinds), 1))
    return facts.groupBy(F.col("analyzer").alias("language")).agg(of("entity", "value", "chart", "package").alias("entities"), of("edge", "call", "value_ref").alias("edges"), of("failed").alias("parse_errors"))
