"""From files to the graph: facts, joins, tables; ingest runs, symbol indexes and the model stage."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.extract import golang, helm, javascript, python, terraform  # noqa: F401 - they register themselves
from loomgraph.extract.facts import extract_facts, quarantine
from loomgraph.functions import paths as P
from loomgraph.functions import scalars as S
from loomgraph.functions.sizing import broadcast_if_small
from loomgraph.operators import changes as C
from loomgraph.operators import resolve as R
from loomgraph.operators.store import FactStore
from loomgraph.schema import DEGRADED_CAP
from loomgraph.session import cut_lineage


@dataclass
class Graph:
    """The tables of a run; ``graph_files`` and ``reconcile`` are what a store replaces."""

    entities: DataFrame
    edges: DataFrame
    symbols: DataFrame
    chunks: DataFrame
    failed: DataFrame
    graph_files: DataFrame | None = None
    reconcile: DataFrame | None = None
    extra: dict = field(default_factory=dict)


def go_modules(files: DataFrame) -> DataFrame:
    """Module path of every repo from its ``go.mod``."""
    m = F.regexp_extract("content", r"(?m)^\s*module[ \t]+(\S+)", 1)
    return files.filter((F.col("path") == "go.mod") & F.col("content").isNotNull()).groupBy("repo").agg(F.max(m).alias("module"))


def docs_facts(files: DataFrame) -> DataFrame:
    """Document entities with their chunk, by column functions alone."""
    path, block = F.col("path"), S.frontmatter_block(F.col("content"))
    return files.filter((F.col("analyzer") == "docs") & F.col("content").isNotNull()).select(
        "repo", "path", F.concat(F.lit("doc:file:"), path).alias("entity_id"), path.alias("ent_name"), *[S.frontmatter_field(block, f).alias(f) for f in ("source_url", "author", "captured_at")],
        P.doc_language(path).alias("lang"), F.concat(F.lit("[doc] "), path).alias("header"), S.frontmatter_body(F.col("content")).alias("body"),
    )


def _kind(facts: DataFrame, *kinds: str) -> DataFrame:
    return facts.filter(F.col("kind").isin(*kinds))


def imports_of(facts: DataFrame, table: DataFrame) -> DataFrame:
    """Names that imports bind to definitions: (repo, path, name, entity_id).

    Python: the first definition in walk order whose id ends with module and name. JavaScript: the
    definition of that name in the very file. The last import of a local name wins.
    """
    i = _kind(facts, "import").select("repo", "path", "name", "target", "form", "note", "ord")
    d = table.select("repo", F.col("path").alias("def_path"), F.col("name").alias("def_name"), "entity_id")
    py = i.filter(F.col("form") == "suffix").join(d, (i["repo"] == d["repo"]) & (i["note"] == d["def_name"])).filter(F.endswith(d["entity_id"], F.col("target")))
    first = py.groupBy(i["repo"], i["path"], i["name"], i["ord"]).agg(F.min_by(d["entity_id"], F.struct(F.split("def_path", "/"), d["entity_id"])).alias("entity_id"))
    js = i.filter(F.col("form") == "named").join(d, (i["repo"] == d["repo"]) & (i["target"] == d["def_path"]) & (i["name"] == d["def_name"])).select(i["repo"], i["path"], i["name"], i["ord"], d["entity_id"])
    return first.unionByName(js).groupBy("repo", "path", "name").agg(F.max_by("entity_id", "ord").alias("entity_id"))


def external_requires(facts: DataFrame, table: DataFrame) -> DataFrame:
    """Modules that imports name and the repo does not define: (repo, path, symbol, entity_id)."""
    e = _kind(facts, "external").select("repo", "path", "analyzer", "entity_id", "name", "target", "form", "ord")
    known = table.select("repo", F.col("name").alias("known")).distinct()
    own = e.join(known, (e["repo"] == known["repo"]) & (e["name"] == known["known"]) & (e["analyzer"] == "python"), "left_anti")
    names = own.filter(F.col("form") == "from").withColumn("one", F.explode(F.split("target", ",")))
    resolvable = names.join(known, (names["repo"] == known["repo"]) & (names["one"] == known["known"]), "left_semi").select("repo", "path", "name", "ord").distinct()
    return own.join(resolvable, ["repo", "path", "name", "ord"], "left_anti").select("repo", "path", F.col("name").alias("symbol"), "entity_id", F.when(F.col("analyzer") == "python", "python").otherwise("javascript").alias("lang")).distinct()


def _edge(src: Column, dst: Column, relation: Column, path: Column, props: Column, score: Column) -> list[Column]:
    return [F.col("repo"), src.alias("src_id"), dst.alias("dst_id"), relation.alias("relation"), path.alias("src_file"), score.alias("confidence_score"), props.alias("props")]


def _no_props() -> Column:
    return F.lit(None).cast("map<string,string>")


def _no_score() -> Column:
    return F.lit(None).cast("double")


def assemble(files: DataFrame, facts: DataFrame, cross_repo_prefix: str = "") -> Graph:
    """Graph tables of routed files (repo, path, analyzer, content) and their facts.

    With a prefix, Go functions also require the exported names of packages below it that are not of
    their own module.
    """
    code = facts.filter(F.col("analyzer").isin("python", "javascript"))
    defs = _kind(code, "def").select("repo", "path", "name", "entity_id", "ord")
    table = R.name_table(defs)
    imports = imports_of(code, table)
    calls = _kind(code, "call").select("repo", "path", F.col("entity_id").alias("caller"), F.col("name").alias("callee"), "form", "note", "ord")
    language = lambda c: F.split_part(c, F.lit(":"), F.lit(1))
    # A name of one language never means a definition of another: the language is part of the repo key.
    keyed = lambda df, c: df.withColumn("repo", F.concat("repo", F.lit("\x00"), language(F.col(c))))
    resolved = R.call_ladder(keyed(calls.filter(F.col("form") == "name"), "caller").select("repo", "path", "caller", "callee", "ord"), keyed(defs, "entity_id"), keyed(imports, "entity_id"))
    resolved = resolved.withColumn("repo", F.split_part("repo", F.lit("\x00"), F.lit(1)))
    decorated = calls.filter(F.col("note") == "decorator").select("repo", F.col("caller").alias("src")).distinct().withColumn("decorated", F.lit(True))
    call_edges = R.call_edges(resolved).join(decorated, ["repo", "src"], "left")
    plain = S.edge_props(F.col("resolution"))
    call_props = F.when(F.col("decorated"), S.degrade(plain, "decorator")).otherwise(plain)
    call_score = F.when(F.col("decorated"), F.least("confidence_score", F.lit(DEGRADED_CAP))).otherwise(F.col("confidence_score"))
    edges = call_edges.select(*_edge(F.col("src"), F.col("dst"), F.lit("calls"), F.col("src_file"), call_props, call_score))

    # Go: functions of a package by name; the module's path is joined in.
    modules = broadcast_if_small(go_modules(files))
    go_defs = facts.filter((F.col("analyzer") == "go") & (F.col("kind") == "def")).groupBy("repo", "target", "name").agg(F.max_by("entity_id", F.struct("path", "ord")).alias("dst"))
    go_calls = facts.filter((F.col("analyzer") == "go") & (F.col("kind") == "call")).select("repo", "path", "entity_id", "target", "name", "form", "ord").join(modules, "repo", "left")
    # An import of a package of the own module names it by the module's path.
    inside = F.startswith("target", F.concat(F.col("module"), F.lit("/"))) | (F.col("target") == F.col("module"))
    target = F.when((F.col("form") == "imported") & inside, F.concat(F.lit("<module>"), F.expr("substring(target, length(module) + 1)"))).otherwise(F.col("target"))
    go_calls = go_calls.withColumn("target", target).join(go_defs, ["repo", "target", "name"])
    go_calls = go_calls.groupBy("repo", "path", "entity_id", "dst").agg(F.min("ord").alias("ord"), F.max(F.col("form") == "imported").alias("imported"))
    props = F.when(F.col("imported"), S.degrade(S.edge_props(F.lit("imported_name_match")), "no_typecheck")).otherwise(S.degrade(S.edge_props(F.lit("scoped_name_match")), "no_typecheck"))
    edges = edges.unionByName(go_calls.select(*_edge(F.col("entity_id"), F.col("dst"), F.lit("calls"), F.col("path"), props, _no_score())))

    ent = _kind(facts, "entity")
    defines = ent.filter(F.col("parent_id").isNotNull()).select(*_edge(F.col("parent_id"), F.col("entity_id"), F.lit("defines"), F.col("path"), _no_props(), _no_score()))
    known = files.select("repo", F.col("path").alias("target")).distinct()
    module_imports = _kind(code, "import").filter(F.col("form").isin("module", "require")).select("repo", "path", "target").distinct().join(known, ["repo", "target"], "left_semi")
    imported = module_imports.select(*_edge(F.concat(F.lit("js:module:"), F.col("path")), F.concat(F.lit("js:module:"), F.col("target")), F.lit("imports"), F.col("path"), _no_props(), _no_score()))
    typed = S.edge_props(F.lit("type_resolved"))
    direct = _kind(facts, "edge").groupBy("repo", "path", "analyzer", "entity_id", "target", F.col("form").alias("rel")).agg(F.min("ord").alias("ord"))
    direct = direct.select(*_edge(F.col("entity_id"), F.col("target"), F.col("rel"), F.col("path"), typed, F.when(F.col("analyzer") == "helm", F.lit(0.98))))

    # Charts: names by root; entities of a chart that is not among the files keep an empty path.
    charts = _kind(facts, "chart").groupBy("repo", F.col("target").alias("root")).agg(F.max("name").alias("chart"), F.max("path").alias("chart_path"))
    with_chart = lambda df: df.withColumn("root", F.col("target")).join(charts, ["repo", "root"])
    refs = with_chart(_kind(facts, "value_ref")).groupBy("repo", "path", "entity_id", "chart", "name").agg(F.min("ord").alias("ord"))
    refs = refs.select(*_edge(F.col("entity_id"), F.concat(F.lit("helm:value:"), "chart", F.lit("."), "name"), F.lit("value_ref"), F.col("path"), typed, F.lit(0.98)))
    edges = edges.unionByName(defines).unionByName(imported).unionByName(direct).unionByName(refs)
    edges = edges.withColumn("confidence_tier", F.when(F.col("confidence_score").isNotNull(), S.tier_of(F.col("confidence_score"))))

    dangling = calls.filter(F.col("form") != "name").select("repo", F.col("caller").alias("src"), F.lit(None).cast("string").alias("dst"), "callee", "ord").unionByName(resolved.select("repo", "src", "dst", "callee", "ord"))
    lost = R.dangling_calls(dangling)
    dynamic = calls.filter(F.col("note") == "dynamic").select("repo", F.col("caller").alias("src")).distinct().withColumn("dynamic", F.lit("dynamic"))
    props = F.create_map(F.lit("dangling_call"), F.col("dangling_call"), F.lit("degraded_by"), F.col("dynamic"), F.lit("exported"), F.when(F.col("form").isin("go_func", "go_method"), F.col("note")))
    base = ent.join(lost.withColumnRenamed("src", "entity_id"), ["repo", "entity_id"], "left").join(dynamic.withColumnRenamed("src", "entity_id"), ["repo", "entity_id"], "left")
    nothing = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    cols = ["repo", "entity_id", "ent_name", "ent_type", "file_path", "line_start", "line_end", "source_url", "author", "captured_at", "props"]
    entities = base.select(
        "repo", "entity_id", F.col("name").alias("ent_name"), F.col("form").alias("ent_type"), F.col("path").alias("file_path"), "line_start", "line_end", *nothing("source_url", "author", "captured_at"), F.map_filter(props, lambda _, v: v.isNotNull()).alias("p")
    ).withColumn("props", F.when(F.size("p") > 0, F.col("p"))).select(*cols)
    owned = ent.filter(F.col("analyzer") == "go").select("repo", F.col("parent_id").alias("entity_id")).distinct()
    packages = _kind(facts, "package").join(owned, ["repo", "entity_id"], "left_semi").groupBy("repo", "entity_id").agg(F.max("name").alias("ent_name"))
    chart_rows = charts.select("repo", F.concat(F.lit("helm:chart:"), "chart").alias("entity_id"), F.col("chart").alias("ent_name"), F.lit("helm_chart").alias("ent_type"), F.col("chart_path").alias("file_path"))
    of_root = files.filter(F.col("analyzer") == "helm").select("repo", "path", P.chart_root(F.col("path")).alias("root"))
    chart_files = of_root.join(charts, ["repo", "root"]).select("repo", "path", F.concat(F.lit("helm:chart:"), "chart").alias("entity_id"))
    values = with_chart(_kind(facts, "value")).select("repo", F.concat(F.lit("helm:value:"), "chart", F.lit("."), "name").alias("entity_id"), F.col("name").alias("ent_name"), F.lit("helm_value").alias("ent_type"), F.col("path").alias("file_path"))
    docs = docs_facts(files)
    entities = (
        entities.unionByName(packages.withColumn("ent_type", F.lit("go_package")), allowMissingColumns=True)
        .unionByName(chart_rows, allowMissingColumns=True)
        .unionByName(values, allowMissingColumns=True)
        .unionByName(docs.select("repo", "entity_id", "ent_name", F.lit("doc_file").alias("ent_type"), F.col("path").alias("file_path"), "source_url", "author", "captured_at"), allowMissingColumns=True)
    )
    lang = F.when(F.col("analyzer") == "helm", "helm").otherwise(F.col("analyzer"))
    chunks = ent.filter(F.col("header").isNotNull()).select("repo", "entity_id", F.col("form").alias("ent_type"), F.col("path").alias("file_path"), lang.alias("lang"), "header", "body")
    chunks = chunks.unionByName(docs.select("repo", "entity_id", F.lit("doc_file").alias("ent_type"), F.col("path").alias("file_path"), "lang", "header", "body"))
    provides = _kind(facts, "symbol").select("repo", F.col("name").alias("symbol"), F.col("analyzer").alias("lang"), F.col("form").alias("kind"), F.lit("provides").alias("role"), "entity_id", F.col("path").alias("src_file"))
    requires = external_requires(code, table).select("repo", "symbol", "lang", F.lit("module").alias("kind"), F.lit("requires").alias("role"), "entity_id", F.col("path").alias("src_file"))
    symbols = provides.unionByName(requires)
    if cross_repo_prefix:
        r = _kind(facts, "reference").join(modules, "repo", "left").filter(S.emits_reference(F.col("target"), F.coalesce(F.nullif("module", F.lit("")), F.lit("\x00")), F.lit(cross_repo_prefix)))
        wanted = r.select("repo", F.col("name").alias("symbol"), F.lit("go").alias("lang"), F.col("form").alias("kind"), F.lit("requires").alias("role"), "entity_id", F.col("path").alias("src_file"))
        symbols = symbols.unionByName(wanted.dropDuplicates(["repo", "symbol", "entity_id"]))

    def named(df: DataFrame, *columns: str) -> DataFrame:
        """The Go module's path in place of its mark."""
        j = df.join(modules, "repo", "left")
        path = F.coalesce("module", F.lit(""))
        return j.select(*[F.replace(F.col(c), F.lit("<module>"), path).alias(c) if c in columns else F.col(c) for c in df.columns])

    return Graph(
        named(entities, "entity_id"), named(edges, "src_id", "dst_id"), named(symbols, "symbol", "entity_id"), named(chunks, "entity_id", "header"),
        _kind(facts, "failed").select("repo", "path", F.col("note").alias("reason")).distinct(), extra={"facts": facts, "chart_files": chart_files},
    )


def in_scope(graph: Graph, scope: DataFrame) -> Graph:
    """Only rows of files in scope, after names were resolved over all files.

    An entity without a file, such as a package, stays where an edge in scope has it as an end. A chart of
    which any file is in scope stays too; without its manifest in scope its row has an empty path.
    """
    s = broadcast_if_small(scope.select("repo", "path").distinct())

    def keep(df: DataFrame, column: str) -> DataFrame:
        return df.join(s, (df["repo"] == s["repo"]) & (df[column] == s["path"]), "left_semi")

    edges, entities = keep(graph.edges, "src_file"), keep(graph.entities, "file_path")
    ends = edges.select("repo", F.explode(F.array("src_id", "dst_id")).alias("entity_id")).distinct()
    free = graph.entities.filter(F.col("file_path").isNull() | (F.col("file_path") == "")).join(ends, ["repo", "entity_id"], "left_semi")
    entities = entities.unionByName(free.select(*entities.columns))
    if (files := graph.extra.get("chart_files")) is not None:
        manifest = F.col("path").isin("Chart.yaml") | F.endswith("path", F.lit("/Chart.yaml"))
        touched = keep(files, "path").groupBy("repo", "entity_id").agg(F.max(manifest).alias("whole")).filter(~F.col("whole"))
        charts = graph.entities.filter(F.col("ent_type") == "helm_chart").join(touched, ["repo", "entity_id"], "left_semi")
        entities = entities.unionByName(charts.withColumn("file_path", F.lit("")).select(*entities.columns))
    return Graph(entities, edges, keep(graph.symbols, "src_file"), keep(graph.chunks, "file_path"), keep(graph.failed, "path"), extra=graph.extra)


def ingest(files: DataFrame, changes: DataFrame | None = None, full_set: bool = False, failing: list[str] | None = None, cross_repo_prefix: str = "", known_facts: FactStore | None = None) -> Graph:
    """One ingest run over files (repo, path, content) of whole repositories.

    ``changes`` (repo, path, old_path, status, content_sha) limits what is emitted and what a store
    replaces; without it the run is full. Without a change nothing is emitted. Analyzers named in ``failing`` are held back whole. With
    ``known_facts`` only files whose content no earlier run has seen are parsed.
    """
    if changes is not None and changes.isEmpty():
        files = files.limit(0)  # nothing changed: nothing is parsed, emitted or replaced
    routed = C.route(files.filter(~P.pruned(F.col("path"))), ["repo"])
    named = files.select("repo", "path")
    if changes is not None:
        named = named.unionByName(C.scope(C.normalise(changes), ["repo"])).distinct()
    held = quarantine(C.route(named, ["repo"]), failing or [])
    healthy = routed.join(held, ["repo", "path"], "left_anti") if failing else routed
    modules = files.filter(F.col("path") == "go.mod").withColumn("analyzer", F.lit("gomod"))
    facts = cut_lineage(extract_facts(healthy)) if known_facts is None else known_facts.of(healthy)
    graph = assemble(healthy.unionByName(modules.select(*healthy.columns)), facts, cross_repo_prefix)
    if changes is None:
        graph.graph_files = files.select("repo", "path").distinct()
        graph.reconcile = graph.graph_files.limit(0)
        return graph
    known = C.normalise(changes)
    touched = C.touched(known, ["repo"])
    out = in_scope(graph, C.scope(known, ["repo"]))
    out.graph_files = C.without(touched, held, ["repo"])
    out.reconcile = C.reconcile_set(touched, out.failed.select("repo", "path").unionByName(held), ["repo"], full_set)
    return out
