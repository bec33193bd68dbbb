"""Mixing sources to target weights, by pivotal dependent rounding.

Sizes are tokens of a public tokenizer over the whole text. The total of a mix is the largest at which
no source needs more than ``max_repeats`` copies of its documents (or ``total_tokens``, if that is
smaller); sources without tokens are left out and the other shares keep their proportions. Within a
source every document deserves the same fractional number of copies. Its whole part is given; of the
rest, documents are paired and tokens are moved at random from one to the other until one of them has
a whole number of copies, which keeps every expectation and the source's tokens. Each task rounds its
own rows and keeps one fractional document a source; those residuals are combined in a reduction tree
of ``FAN`` tasks to one, until a single document a source is left, rounded by chance.

Null sources, sources outside the mix, and null or empty texts (no tokens) are not chosen. Source
names are compared without case and surrounding blanks; two targets that become one name add up.
Repeated rows of a doc_id count once, the one with the largest text. Null or negative target shares count as zero, null max_repeats
as one. The same seed gives the same mixture of the same data, in whatever order it is read, for the
same number of partitions.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.sizing import collect_bounded, one_row_each
from loomgraph.session import Scratch, local_copy, ship_file

#: Rank file of a public tokenizer, and the pattern that splits text before its merges.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents a leaf rounds, and residuals a task of the tree combines.
LEAF, FAN = 50_000, 64
#: Bound of the table of targets.
MOST_TARGETS = 100_000
EPS = 1e-9

_ENCODERS: dict = {}


def encoder(ranks: str):
    """One encoder a worker process and rank file."""
    if ranks not in _ENCODERS:
        import tiktoken

        with open(local_copy(ranks), "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODERS[ranks] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return _ENCODERS[ranks]


def source_key(column: str):
    return F.lower(F.trim(F.col(column)))


def token_counts(documents: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, source, n_tokens), one row a document with text and a source."""

    def count(batches):
        encode = encoder(ranks).encode_ordinary
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"], "n_tokens": np.array([len(encode(t)) for t in batch["text"]], np.int64)})

    ship_file(documents.sparkSession, ranks)
    docs = documents.select("doc_id", "text", source_key("source").alias("source")).filter(F.col("text").isNotNull() & (F.col("text") != "") & F.col("source").isNotNull())
    return one_row_each(docs, "doc_id", among=documents.select("doc_id")).mapInPandas(count, "doc_id bigint, source string, n_tokens bigint")


def plan_mix(targets: list, totals: dict[str, int], total_tokens: int | None = None) -> list[tuple]:
    """(mix_name, source, target_share, max_repeats, wanted tokens, copies a document) of every target."""
    merged: dict[tuple, tuple] = {}
    for mix, source, share, repeats in targets:
        if mix is None or source is None:
            continue
        key = (mix, source.strip().lower())
        old = merged.get(key, (0.0, 0))
        merged[key] = (old[0] + max(0.0, share or 0.0), max(old[1], 1 if repeats is None else max(0, repeats)))
    out = []
    for mix in sorted({m for m, _ in merged}):
        rows = [(s, *v) for (m, s), v in sorted(merged.items()) if m == mix]
        live = [(s, w, r) for s, w, r in rows if w > 0 and r > 0 and totals.get(s, 0) > 0]
        weight = sum(w for _, w, _ in live)
        size = min((r * totals[s] * weight / w for s, w, r in live), default=0.0)
        if total_tokens is not None:
            size = min(size, float(total_tokens))
        wanted = {s: size * w / weight for s, w, _ in live}
        out += [(mix, s, w, r, wanted.get(s, 0.0), min(float(r), wanted.get(s, 0.0) / totals[s]) if s in wanted else 0.0) for s, w, r in rows]
    return out


def pivot(rows, state: dict):
    """Rounds rows (group, doc, size, whole copies, fraction, chance) in order; yields (group, doc, size, copies).

    ``state`` holds one fractional document a group. With two, tokens move from one to the other: both
    directions keep the sum, and their chances keep each document's expectation.
    """
    for group, doc, size, whole, p, u in rows:
        if p < EPS or p > 1 - EPS:
            yield group, doc, size, whole + round(p)
            continue
        if group not in state:
            state[group] = [doc, size, whole, p, u]
            continue
        kept = state[group]
        _, b, _, q, _ = kept
        up = min((1 - p) * size, q * b)  # tokens the new one can take
        down = min(p * size, (1 - q) * b)  # and give
        if u * (up + down) < down:
            p, q = p + up / size, q - up / b
        else:
            p, q = p - down / size, q + down / b
        new_done, old_done = p < EPS or p > 1 - EPS, q < EPS or q > 1 - EPS
        if new_done:
            yield group, doc, size, whole + round(p)
        if old_done:
            yield group, kept[0], b, kept[2] + round(q)
        if new_done and old_done:
            del state[group]
        elif new_done:
            kept[3] = q
        else:
            state[group] = [doc, size, whole, p, u]


_SCHEMA = "mix_name string, source string, doc_id bigint, n_tokens bigint, copies bigint, fraction double, chance double"


def _round(batches):
    """Rounds a task's rows; a row with a fraction left is the residual of its mix and source."""
    state: dict = {}
    for batch in batches:
        rows = zip(zip(batch["mix_name"], batch["source"]), batch["doc_id"], batch["n_tokens"], batch["copies"], batch["fraction"], batch["chance"])
        done = [(*g, d, n, c, 0.0, 0.0) for g, d, n, c in pivot(rows, state)]
        yield pd.DataFrame(done, columns=["mix_name", "source", "doc_id", "n_tokens", "copies", "fraction", "chance"])
    left = [(*g, d, n, c, p, u) for g, (d, n, c, p, u) in state.items()]
    yield pd.DataFrame(left, columns=["mix_name", "source", "doc_id", "n_tokens", "copies", "fraction", "chance"])


def mix(documents: DataFrame, targets: DataFrame, ranks: str = RANKS, seed: int = 7, total_tokens: int | None = None) -> DataFrame:
    """(mix_name, source, doc_id, n_tokens, copies) of the chosen documents."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "mixing")
    counts = scratch.write(token_counts(documents, ranks), "tokens")
    wanted = [tuple(r) for r in collect_bounded(targets.select("mix_name", "source", "target_share", "max_repeats"), MOST_TARGETS)]
    names = sorted({w[1].strip().lower() for w in wanted if w[1] is not None})
    known = counts.filter(F.col("source").isin(names)) if names else counts.limit(0)
    totals = {r.source: (r.n, r.docs) for r in known.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("docs")).collect()}
    plan = [(m, s, c) for m, s, _, _, _, c in plan_mix(wanted, {s: n for s, (n, _) in totals.items()}, total_tokens) if c > 0]
    deserved = spark.createDataFrame(plan or [(None, None, 0.0)], "mix_name string, source string, deserved double")
    chance = F.pmod(F.xxhash64(F.lit(seed), "mix_name", "doc_id"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    rows = (
        counts.filter(F.col("n_tokens") > 0)
        .join(F.broadcast(deserved), "source")  # a row a target: bounded by MOST_TARGETS
        .select("mix_name", "source", "doc_id", "n_tokens", F.floor("deserved").alias("copies"), (F.col("deserved") - F.floor("deserved")).alias("fraction"), chance.alias("chance"))
    )
    n = sum(d for _, d in totals.values()) * max(1, len({m for m, _, _ in plan}))
    leaves = max(1, -(-n // LEAF))
    level = rows.repartition(leaves, "doc_id").sortWithinPartitions("mix_name", "source", "doc_id")
    parts = []
    while True:
        rounded = scratch.write(level.mapInPandas(_round, _SCHEMA), "rounded")
        parts.append(rounded.filter(F.col("fraction") == 0))
        left = rounded.filter(F.col("fraction") > 0)
        if leaves == 1:
            break
        leaves = -(-leaves // FAN)
        level = left.repartition(leaves, "doc_id").sortWithinPartitions("mix_name", "source", "doc_id")
    last = F.when(F.pmod(F.xxhash64(F.lit(seed + 1), "mix_name", "doc_id"), F.lit(1 << 52)) / F.lit(float(1 << 52)) < F.col("fraction"), 1).otherwise(0)
    parts.append(left.withColumn("copies", F.col("copies") + last))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.filter(F.col("copies") > 0).select("mix_name", "source", "doc_id", "n_tokens", "copies")
    scratch.remove(out)
    return out


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: documents, tokens with repeats, most copies of one document, and the actual share of the mix."""
    per = mixture.groupBy("mix_name", "source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    every = per.groupBy("mix_name").agg(F.sum("tokens").alias("all"))
    per = per.join(every, "mix_name")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    goal = targets.filter(F.col("mix_name").isNotNull() & F.col("source").isNotNull()).groupBy("mix_name", source_key("source").alias("source")).agg(F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"))
    return goal.join(per, ["mix_name", "source"], "left").select("mix_name", "source", "target_share", zero("n_docs"), zero("tokens"), zero("most_copies"), F.round(F.coalesce(F.col("tokens") / F.col("all"), F.lit(0.0)), 6).alias("actual_share"))
