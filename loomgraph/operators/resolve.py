"""Resolution of names by prioritised joins, and the dedup and index aggregations around it.

Facts come in flat tables: definitions (repo, path, name, entity_id, ord), imports (repo, path, name,
entity_id) and calls (repo, path, caller, callee, ord). Ties are always broken by ``ord``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.scalars import confidence_score, tier_of


def name_table(defs: DataFrame) -> DataFrame:
    """One id per file and name: the last definition wins."""
    return defs.groupBy("repo", "path", "name").agg(F.max(F.struct("ord", "entity_id")).alias("s")).select("repo", "path", "name", F.col("s.entity_id").alias("entity_id"))


def repo_index(table: DataFrame) -> DataFrame:
    """Ids per repo and name, in walk order of their files; one id per file and name."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct(F.split("path", "/").alias("w"), F.col("entity_id")))), lambda x: x["entity_id"])
    return table.groupBy("repo", "name").agg(ids.alias("ids"), F.count(F.lit(1)).alias("n_ids"))


def call_ladder(calls: DataFrame, defs: DataFrame, imports: DataFrame) -> DataFrame:
    """Edges (repo, path, src, dst, resolution, ord) and, with dst null, calls that nothing resolves.

    Same file before import before one definition in the repo before several, each of which gets an
    edge. Only names that neither file nor import resolves reach the index, so a common name's ids are
    looked up for those alone.
    """
    table = name_table(defs)
    scoped = table.select("repo", "path", F.col("name").alias("callee"), F.col("entity_id").alias("scoped_id"))
    imported = imports.groupBy("repo", "path", F.col("name").alias("callee")).agg(F.max("entity_id").alias("imported_id"))
    near = calls.join(scoped, ["repo", "path", "callee"], "left").join(imported, ["repo", "path", "callee"], "left")
    near = near.withColumn("near_id", F.coalesce("scoped_id", "imported_id"))
    named = table.select("repo", F.col("name").alias("callee"), F.col("entity_id").alias("dst"))
    n_ids = named.groupBy("repo", "callee").agg(F.count(F.lit(1)).alias("n_ids"))
    found = near.filter(F.col("near_id").isNotNull()).select(
        "repo", "path", F.col("caller").alias("src"), F.col("near_id").alias("dst"), F.when(F.col("scoped_id").isNotNull(), "scoped_name_match").otherwise("imported_name_match").alias("resolution"), "callee", "ord"
    )
    # One row an id by a join on the name: no list of a common name's ids is ever built.
    far = near.filter(F.col("near_id").isNull()).select("repo", "path", "caller", "callee", "ord").join(n_ids, ["repo", "callee"], "left").join(named, ["repo", "callee"], "left")
    level = F.when(F.col("n_ids") == 1, "global_name_match").when(F.col("n_ids") > 1, "ambiguous_multi_def").otherwise("unresolved")
    wide = far.select("repo", "path", F.col("caller").alias("src"), "dst", level.alias("resolution"), "callee", "ord")
    return found.unionByName(wide)


def call_edges(resolved: DataFrame) -> DataFrame:
    """One edge per caller and target, the first call wins, with score and tier."""
    first = resolved.filter(F.col("dst").isNotNull()).groupBy("repo", "src", "dst").agg(F.min(F.struct("ord", "resolution", "path")).alias("s"))
    score = confidence_score(F.col("s.resolution"))
    return first.select("repo", "src", "dst", F.col("s.path").alias("src_file"), F.col("s.resolution").alias("resolution"), score.alias("confidence_score"), tier_of(score).alias("confidence_tier"))


def dangling_calls(resolved: DataFrame) -> DataFrame:
    """Per caller, the distinct names nothing resolved, in order of first call, joined by commas."""
    first = resolved.filter(F.col("dst").isNull()).groupBy("repo", "src", "callee").agg(F.min("ord").alias("ord"))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "callee"))), lambda x: x["callee"]), ",")
    return first.groupBy("repo", "src").agg(names.alias("dangling_call"))


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in order."""
    rest = [c for c in rows.columns if c not in keys]
    one = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("s"))
    return one.select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest])


def innermost_enclosing(defs: DataFrame, refs: DataFrame) -> DataFrame:
    """Per reference the innermost definition of its file whose lines hold it, half-open, the first on a tie.

    defs: (path keys.., def_id, start, end, ord), refs: (path keys.., ref_id, line, self_id). Files are
    cut into blocks of lines, so that a file of many definitions is many small joins: a definition
    meets only references in the blocks it covers, and one that covers many blocks is one row a block.
    """
    block = 256
    d = defs.filter(F.col("start") < F.col("end")).withColumn("b", F.explode(F.expr(f"sequence(cast(start div {block} as int), cast((end - 1) div {block} as int))")))
    r = refs.withColumn("b", F.expr(f"cast(line div {block} as int)"))
    pairs = r.join(d, ["repo", "path", "b"]).filter((F.col("start") <= F.col("line")) & (F.col("line") < F.col("end")) & ~F.col("self_id").eqNullSafe(F.col("def_id")))
    span = F.struct((F.col("end") - F.col("start")).alias("span"), "ord", "def_id")
    return pairs.groupBy("repo", "path", "ref_id").agg(F.min(span).alias("s")).select("repo", "path", "ref_id", F.col("s.def_id").alias("def_id"))


def placeholders(refs: DataFrame, defs: DataFrame) -> DataFrame:
    """Referenced ids that are defined nowhere: (repo, entity_id)."""
    wanted = refs.filter(F.col("dst_id").isNotNull() & (F.col("dst_id") != "")).select("repo", F.col("dst_id").alias("entity_id")).distinct()
    return wanted.join(defs.select("repo", "entity_id").distinct(), ["repo", "entity_id"], "left_anti")


def link_symbols(provides: DataFrame, requires: DataFrame) -> DataFrame:
    """Requirements of one repo met by another's provisions: (symbol, from_repo, from_id, to_repo, to_id)."""
    p = provides.select("symbol", F.col("repo").alias("to_repo"), F.col("entity_id").alias("to_id")).distinct()
    r = requires.select("symbol", F.col("repo").alias("from_repo"), F.col("entity_id").alias("from_id")).distinct()
    return r.join(p, "symbol").filter(F.col("from_repo") != F.col("to_repo")).select("symbol", "from_repo", "from_id", "to_repo", "to_id")
