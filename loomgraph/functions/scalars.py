"""Column functions: confidence, hashes, slugs, ids, documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.schema import DEGRADED_CAP, RESOLUTION_SCORES


def confidence_score(resolution: Column) -> Column:
    """Score of a resolution level; 0 for any other and for null."""
    out = F.when(resolution.isNull(), F.lit(0.0))
    for level, (score, _) in RESOLUTION_SCORES.items():
        out = out.when(resolution == level, F.lit(score))
    return out.otherwise(F.lit(0.0))


def confidence_text(resolution: Column) -> Column:
    """The score as it is printed in properties: the shortest digits, 0 without a point."""
    out = F.when(resolution.isNull(), F.lit("0"))
    for level, (_, text) in RESOLUTION_SCORES.items():
        out = out.when(resolution == level, F.lit(text))
    return out.otherwise(F.lit("0"))


def tier_of(score: Column) -> Column:
    """EXTRACTED from 1, INFERRED above 0.3, else AMBIGUOUS; null scores count as 0."""
    s = F.coalesce(score, F.lit(0.0))
    return F.when(s >= 1.0, "EXTRACTED").when(s > 0.3, "INFERRED").otherwise("AMBIGUOUS")


def edge_props(resolution: Column) -> Column:
    return F.create_map(F.lit("resolution"), resolution, F.lit("confidence"), confidence_text(resolution))


def props_score(props: Column) -> Column:
    """Score read back from properties; 0 where it is missing or no number."""
    return F.coalesce(F.try_element_at(props, F.lit("confidence")).try_cast("double"), F.lit(0.0))


def degrade(props: Column, reason: str) -> Column:
    """Caps the confidence and appends a reason to degraded_by."""
    score = props_score(props)
    capped = F.when(score > DEGRADED_CAP, F.lit(str(DEGRADED_CAP))).otherwise(F.try_element_at(props, F.lit("confidence")))
    why = F.concat_ws(",", F.nullif(F.try_element_at(props, F.lit("degraded_by")), F.lit("")), F.lit(reason))
    kept = F.map_filter(F.coalesce(props, F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin("confidence", "degraded_by"))
    return F.map_filter(F.map_concat(kept, F.create_map(F.lit("confidence"), capped, F.lit("degraded_by"), why)), lambda _, v: v.isNotNull())


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def slug(label: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(label), "[^a-z0-9]+", "-"), "^-|-$", "")


def concept_id(repo: Column, label: Column) -> Column:
    s = slug(label)
    return F.concat(F.lit("concept:"), repo, F.lit(":"), F.when(s == "", F.substring(sha256(label), 1, 16)).otherwise(s))


def hyperedge_id(repo: Column, source_file: Column, model_id: Column, label: Column, members: Column) -> Column:
    """Id from the slugs of file and model id; a hash of label and members where either is empty."""
    f, m = slug(F.coalesce(source_file, F.lit(""))), slug(F.coalesce(model_id, F.lit("")))
    hashed = F.substring(sha256(F.concat(F.coalesce(label, F.lit("")), F.array_join(members, ""))), 1, 16)
    return F.concat(F.lit("he:"), repo, F.lit(":"), F.when((f == "") | (m == ""), hashed).otherwise(F.concat(f, F.lit(":"), m)))


def item_text(header: Column, body: Column) -> Column:
    return F.concat(F.coalesce(header, F.lit("")), F.lit("\n---\n"), F.coalesce(body, F.lit("")))


def item_key(repo: Column, entity_id: Column, text: Column) -> Column:
    return F.concat(repo, F.lit(":"), entity_id, F.lit(":"), sha256(text))


def from_first_brace(text: Column) -> Column:
    """The text from its first ``{``; fences and prose before it are dropped."""
    at = F.instr(text, "{")
    return F.when(at > 0, F.substring(text, at, F.length(text))).otherwise(text)


def frontmatter_block(content: Column) -> Column:
    """The header block of a document between its first two ``---`` lines, null without one."""
    text = F.replace(content, F.lit("\r\n"), F.lit("\n"))
    rest = F.substring(text, F.lit(5), F.length(text))
    end = F.instr(rest, "\n---\n")
    return F.when(F.startswith(text, F.lit("---\n")) & (end > 0), F.substring(rest, F.lit(1), end - 1))


def frontmatter_body(content: Column) -> Column:
    """The document without its header block, line ends as ``\\n`` in any case."""
    text = F.replace(content, F.lit("\r\n"), F.lit("\n"))
    rest = F.substring(text, F.lit(5), F.length(text))
    end = F.instr(rest, "\n---\n")
    return F.when(F.startswith(text, F.lit("---\n")) & (end > 0), F.substring(rest, end + 5, F.length(rest))).otherwise(text)


def frontmatter_field(block: Column, name: str) -> Column:
    """A scalar of a header block, without quotes; null where it is missing or empty."""
    v = F.regexp_extract(block, rf"(?m)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    return F.nullif(F.regexp_replace(v, "^[\"'](.*)[\"']$", "$1"), F.lit(""))


def exported(name: Column) -> Column:
    return name.rlike("^[A-Z]")


def emits_reference(package: Column, module: Column, prefix: Column) -> Column:
    """Whether a package outside the module belongs to the organisation; prefixes have no path boundary."""
    return ~F.startswith(package, module) & F.startswith(package, prefix)


def env_key(flag: Column) -> Column:
    return F.upper(F.replace(flag, F.lit("-"), F.lit("_")))


def scip_lines(span: Column) -> Column:
    """(line_start, line_end) from 0-based ranges of three or four numbers; (0, 0) for any other."""
    start = F.try_element_at(span, F.lit(1)) + 1
    end = F.when(F.size(span) == 3, F.try_element_at(span, F.lit(1))).otherwise(F.try_element_at(span, F.lit(3)))
    good = F.size(span).isin(3, 4)
    return F.struct(F.when(good, start).otherwise(0).alias("line_start"), F.when(good, F.greatest(start, end)).otherwise(0).alias("line_end"))


def byte_slice(text: Column, start: Column, end: Column) -> Column:
    """Text between two byte offsets of its UTF-8 form."""
    return F.try_validate_utf8(F.substring(F.encode(text, "UTF-8"), start + 1, end - start).cast("string"))
