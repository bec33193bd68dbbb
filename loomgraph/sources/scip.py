"""Symbol indexes (SCIP, protobuf): decoded to flat tables, and turned into the graph by joins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.scalars import edge_props, scip_lines
from loomgraph.operators.resolve import first_wins
from loomgraph.session import cut_lineage

# Numbers and names of the symbol kinds that matter here.
KINDS = {
    7: "Class", 9: "Constructor", 15: "Field", 17: "Function", 21: "Interface", 26: "Method", 27: "MethodReceiver", 49: "Struct", 61: "Variable", 66: "AbstractMethod", 67: "MethodSpecification", 74: "MethodAlias",
}
_FUNCTIONS, _TYPES, _VARIABLES = ("Function", "Constructor"), ("Class", "Struct", "Interface"), ("Variable", "Field")
_METHODS = ("Method", "MethodAlias", "MethodReceiver", "MethodSpecification", "AbstractMethod")
OCCURRENCES = "path string, lang string, doc string, symbol string, roles int, span array<int>, enclosing array<int>, ord int"
SYMBOLS = "doc string, path string, symbol string, kind int, display_name string"


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = raw[at]
        value |= (b & 0x7F) << shift
        at += 1
        if b < 0x80:
            return value, at
        shift += 7


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers, or the bytes of what has a length."""
    at = 0
    while at < len(raw):
        tag, at = _varint(raw, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(raw, at)
            yield tag >> 3, value
        elif kind == 2:
            n, at = _varint(raw, at)
            if at + n > len(raw):
                raise ValueError("truncated message")
            yield tag >> 3, raw[at : at + n]
            at += n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            yield tag >> 3, raw[at : at + n]
            at += n
        else:
            raise ValueError(f"wire type {kind}")


def _ints(value: int | bytes) -> list[int]:
    """Numbers of a packed or single field, as 32-bit signed."""
    out = []
    if isinstance(value, int):
        out = [value]
    else:
        at = 0
        while at < len(value):
            x, at = _varint(value, at)
            out.append(x)
    return [x - (1 << 64) if x >= 1 << 63 else x for x in out]


def _symbol(raw: bytes) -> tuple[str, int, str]:
    symbol, kind, name = "", 0, ""
    for n, v in fields(raw):
        if n == 1:
            symbol = v.decode()
        elif n == 5:
            kind = v
        elif n == 6:
            name = v.decode()
    return symbol, kind, name


def decode(raw: bytes) -> tuple[list[tuple], list[tuple]]:
    """Rows of ``OCCURRENCES`` and ``SYMBOLS``; external symbols have no document."""
    occurrences, symbols, doc = [], [], 0
    for n, v in fields(raw):
        if n == 3:
            symbols.append((None, None, *_symbol(v)))
        if n != 2:
            continue
        path = lang = ""
        occ, sym = [], []
        for m, w in fields(v):
            if m == 1:
                path = w.decode()
            elif m == 4:
                lang = w.decode().lower()
            elif m == 2:
                occ.append(w)
            elif m == 3:
                sym.append(_symbol(w))
        doc += 1
        if not path:
            continue
        for k, o in enumerate(occ):
            span, enclosing, symbol, roles = [], [], "", 0
            for m, w in fields(o):
                if m == 1:
                    span += _ints(w)
                elif m == 2:
                    symbol = w.decode()
                elif m == 3:
                    roles = w
                elif m == 7:
                    enclosing += _ints(w)
            occurrences.append((path, lang, doc, symbol, roles, span, enclosing, k))
        symbols += [(doc, path, *s) for s in sym]
        if not occ:
            occurrences.append((path, lang, doc, None, None, None, None, -1))
    return occurrences, symbols


def last_name(symbol: str) -> str:
    """Name of the last descriptor of a symbol; of local ones what stands after the last separator."""
    parts = symbol.split(" ", 4)
    if len(parts) == 5 and not symbol.startswith("local "):
        body, names, i = parts[4], [], 0
        while i < len(body):
            if body[i] == "`":
                e = body.find("`", i + 1)
                while e >= 0 and body.startswith("``", e):
                    e = body.find("`", e + 2)
                if e < 0:
                    break
                name, i = body[i + 1 : e].replace("``", "`"), e + 1
            elif body[i] in "([":
                close = ")" if body[i] == "(" else "]"
                e = body.find(close, i)
                if e < 0:
                    break
                if body[i] == "(" and e + 1 < len(body) and body[e + 1] == "." and names:
                    i = e + 2  # a method's disambiguator
                    continue
                name, i = body[i + 1 : e], e
            else:
                e = i
                while e < len(body) and (body[e].isalnum() or body[e] in "_+-$"):
                    e += 1
                name, i = body[i:e], e
            if name:
                names.append(name)
            if i < len(body) and body[i] == "(":
                continue
            i += 1
        if names:
            return names[-1]
    for sep in ("/", ".", "`"):
        _, found, rest = symbol.rpartition(sep)
        if found and rest.rstrip(".()"):
            return rest.rstrip(".()")
    return symbol


def _short_names(symbols: pd.Series) -> pd.Series:
    """A small grammar, run over distinct symbols only."""
    return symbols.map(last_name)


def read_indexes(spark: SparkSession, path: str, repo: str) -> tuple[DataFrame, DataFrame]:
    """(occurrences, symbols) of the index files at a path, each decoded once, in its task.

    ``doc`` names the index file and the document in it, as every index numbers its own documents.
    """
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("index"), "content")
    both = ("path", "lang", "doc", "symbol", "roles", "span", "enclosing", "ord", "kind", "display_name")

    def decode_all(batches):
        for batch in batches:
            for index, content in zip(batch["index"], batch["content"]):
                for which, (rows, schema) in enumerate(zip(decode(bytes(content)), (OCCURRENCES, SYMBOLS))):
                    out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).reindex(columns=both).astype(object)
                    out = out.where(out.notna(), None)
                    out["doc"] = [None if d is None else f"{index}#{int(d)}" for d in out["doc"]]
                    for c in ("roles", "kind", "ord"):
                        out[c] = out[c].astype("Int32")
                    yield out.assign(which=which)

    columns = dict(c.split(" ", 1) for c in (OCCURRENCES + ", " + SYMBOLS).split(", "))
    decoded = cut_lineage(raw.mapInPandas(decode_all, ", ".join(f"{c} {columns[c]}" for c in both) + ", which int"))
    of = lambda which, schema: decoded.filter(F.col("which") == which).select(*[c.split()[0] for c in schema.split(", ")], F.lit(repo).alias("repo"))
    return of(0, OCCURRENCES), of(1, SYMBOLS)


def kind_name(kind):
    out = F.when(kind == 0, "UnspecifiedKind")
    for number, name in KINDS.items():
        out = out.when(kind == number, name)
    return out.otherwise(F.concat(F.lit("Kind"), kind.cast("string")))


def graph(occurrences: DataFrame, symbols: DataFrame) -> dict[str, DataFrame]:
    """Entities, edges and files of an index.

    Definitions become entities, once a document; references become edges from the innermost
    definition whose body holds them; ids that nothing defines become placeholders.
    """
    occ = occurrences.filter(F.col("symbol").isNotNull())
    local = symbols.filter(F.col("doc").isNotNull()).groupBy("repo", "doc", "symbol").agg(F.max(F.struct("kind", "display_name")).alias("l"))
    outer = symbols.filter(F.col("doc").isNull()).groupBy("repo", "symbol").agg(F.max(F.struct("kind", "display_name")).alias("x"))
    o = occ.join(local, ["repo", "doc", "symbol"], "left").join(outer, ["repo", "symbol"], "left").withColumn("info", F.coalesce("l", "x"))
    names = o.select("symbol").distinct().withColumn("short", F.pandas_udf(_short_names, "string")("symbol"))
    o = o.join(names, "symbol").withColumn("eid", F.concat(F.lit("scip:"), "lang", F.lit(":"), "symbol")).withColumn("kind", F.when(F.col("info").isNotNull(), kind_name(F.col("info.kind"))))
    body = F.when(F.size("enclosing") >= 3, F.col("enclosing")).otherwise(F.col("span"))
    o = o.withColumn("body", body)
    defs = o.filter(F.col("roles").bitwiseAND(1) != 0)
    refs = o.filter((F.col("roles").bitwiseAND(1) == 0) & (F.col("symbol") != ""))
    kind = F.col("kind")
    etype = F.when(kind.isin(*_FUNCTIONS), "scip_function").when(kind.isin(*_METHODS), "scip_method").when(kind.isin(*_TYPES), "scip_type").when(kind.isin(*_VARIABLES), "scip_variable").otherwise("scip_symbol")
    lines = scip_lines(F.col("body"))
    real = first_wins(
        defs.select("repo", "doc", "eid", "ord", F.coalesce(F.nullif("info.display_name", F.lit("")), "short").alias("ent_name"), etype.alias("ent_type"), F.col("path").alias("file_path"), lines["line_start"].alias("line_start"), lines["line_end"].alias("line_end"), F.coalesce("kind", F.lit("unspecified")).alias("scip_kind")),
        ["repo", "doc", "eid"], ["ord"],
    )
    size = F.size("body")
    d = defs.filter(size.isin(3, 4)).select("repo", "doc", F.col("eid").alias("src"), F.col("symbol").alias("dsym"), F.col("span").alias("dspan"), F.col("body")[0].alias("a"), F.when(size == 3, F.col("body")[0] + 1).otherwise(F.col("body")[2]).alias("z"), F.col("ord").alias("dord"))
    r = refs.filter(F.size("span") >= 2).select("repo", "doc", "path", F.col("eid").alias("dst"), "symbol", "span", F.col("span")[0].alias("line"), "ord", "kind", "short", F.col("info.display_name").alias("shown"))
    # Blocks of lines keep a long document from becoming one large join of all with all.
    d = d.filter(F.col("a") < F.col("z")).withColumn("b", F.explode(F.expr("sequence(a div 512, (z - 1) div 512)")))
    pairs = r.withColumn("b", F.expr("line div 512")).join(d, ["repo", "doc", "b"]).filter((F.col("a") <= F.col("line")) & (F.col("line") < F.col("z")) & ~((F.col("symbol") == F.col("dsym")) & (F.col("span") == F.col("dspan"))))
    inner = pairs.groupBy("repo", "doc", "ord").agg(F.min(F.struct((F.col("z") - F.col("a")).alias("span"), "dord", "src")).alias("s"), F.first("path").alias("path"), F.first("dst").alias("dst"), F.first("kind").alias("kind"), F.first("short").alias("short"), F.first("shown").alias("shown"))
    relation = F.when(F.col("kind").isin(*_FUNCTIONS, *_METHODS), "calls").otherwise("references")
    edges = inner.select("repo", "doc", F.col("s.src").alias("src_id"), F.col("dst").alias("dst_id"), relation.alias("relation"), F.col("path").alias("src_file"), "ord", "short", "shown")
    edges = first_wins(edges, ["repo", "doc", "src_id", "dst_id", "relation"], ["ord"])
    missing = edges.join(real.select("repo", F.col("eid").alias("dst_id")).distinct(), ["repo", "dst_id"], "left_anti")
    outside = missing.groupBy("repo", "dst_id").agg(F.min(F.struct("doc", "ord", F.coalesce(F.nullif("shown", F.lit("")), "short").alias("name"))).alias("s"))
    prop = lambda v: F.create_map(F.lit("scip_kind"), v)
    entities = real.select("repo", F.col("eid").alias("entity_id"), "ent_name", "ent_type", "file_path", "line_start", "line_end", prop(F.col("scip_kind")).alias("props")).unionByName(
        outside.select("repo", F.col("dst_id").alias("entity_id"), F.col("s.name").alias("ent_name"), F.lit("scip_external").alias("ent_type"), prop(F.lit("external")).alias("props")), allowMissingColumns=True
    )
    return {
        "entities": entities,
        "edges": edges.select("repo", "src_id", "dst_id", "relation", "src_file", F.lit(1.0).alias("confidence_score"), F.lit("EXTRACTED").alias("confidence_tier"), edge_props(F.lit("type_resolved")).alias("props")),
        "files": occurrences.select("repo", "path").distinct(),
    }
