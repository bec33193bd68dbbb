"""Column functions on repository paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.schema import PRUNED_DIRS


def parts(path: Column) -> Column:
    return F.split(path, "/")


def directories(path: Column) -> Column:
    p = parts(path)
    return F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))


def walk_order(path: Column) -> Column:
    """Sort key of a directory walk: component by component."""
    return parts(path)


def pruned(path: Column) -> Column:
    """Whether a walk never enters the path's directory."""
    return F.arrays_overlap(directories(path), F.array(*[F.lit(d) for d in PRUNED_DIRS]))


def extension(path: Column) -> Column:
    """Extension with its dot, empty where there is none."""
    return F.regexp_extract(path, r"(\.[^./]*)$", 1)


def dirname(path: Column) -> Column:
    return F.when(F.instr(path, "/") == 0, F.lit(".")).otherwise(F.regexp_replace(path, "/[^/]*$", ""))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def is_template(path: Column) -> Column:
    return F.array_contains(parts(path), "templates")


def chart_root(path: Column) -> Column:
    """What stands before the first ``templates`` directory, else the parent directory; ``.`` at the root."""
    at = F.array_position(parts(path), "templates").cast("int")
    before = F.array_join(F.slice(parts(path), 1, F.greatest(at - 1, F.lit(0))), "/")
    return F.when(at > 0, F.coalesce(F.nullif(before, F.lit("")), F.lit("."))).otherwise(dirname(path))


def python_module(path: Column) -> Column:
    return F.replace(F.regexp_replace(path, r"\.py$", ""), F.lit("/"), F.lit("."))


def top_level(module: Column) -> Column:
    return F.split_part(module, F.lit("."), F.lit(1))


def is_doc(path: Column) -> Column:
    return F.lower(extension(path)).isin(".md", ".markdown", ".txt", ".rst")


def doc_language(path: Column) -> Column:
    return F.when(F.lower(extension(path)) == ".txt", "text").otherwise("markdown")


def analyzer_by_suffix(path: Column) -> Column:
    """Analyzer by suffix alone, in order of precedence; charts are decided elsewhere."""
    e = extension(path)
    return F.when(e == ".go", "go").when(e == ".py", "python").when(e.isin(".js", ".mjs", ".cjs"), "javascript").when(e == ".tf", "terraform")


def resolve_module_path(directory: Column, spec: Column) -> Column:
    """Path of an import: bare specifiers stay; relative ones are joined, normalised and given ``.js`` without a dot."""
    relative = F.startswith(spec, F.lit("."))
    joined = F.when(directory == ".", spec).otherwise(F.concat(directory, F.lit("/"), spec))
    steps = F.filter(F.split(joined, "/"), lambda x: (x != "") & (x != "."))
    top = lambda a: F.try_element_at(a, F.lit(-1))
    folded = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda a, x: F.when((x == "..") & (F.size(a) > 0) & (top(a) != ".."), F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(x))),
    )
    path = F.array_join(folded, "/")
    return F.when(~relative, spec).when(F.instr(basename(path), ".") == 0, F.concat(path, F.lit(".js"))).otherwise(path)


def escapes(path: Column) -> Column:
    """Whether a relative path leads out of its root."""
    depth = F.aggregate(
        F.split(path, "/"),
        F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")),
        lambda a, x: F.struct(
            (a["d"] + F.when(x == "..", -1).when((x == ".") | (x == ""), 0).otherwise(1)).alias("d"),
            F.least(a["low"], a["d"] + F.when(x == "..", -1).otherwise(0)).alias("low"),
        ),
    )
    return depth["low"] < 0
