"""Splitting oversized items at natural boundaries, by byte ranges.

An item is cut into byte ranges, at least eight times as long as a piece. Each range ends at a seam: the
strongest natural boundary in the last half piece before its nominal end. A task sees its range with a
halo on either side, so that it finds the seam before it and the one behind it by itself, exactly as
its neighbours do, plans the pieces between the two and emits them by offset. No boundary is sent
anywhere and no task holds more than a range: only the number of pieces a range has is summed over the
ranges before it, to number the pieces.

Texts held in rows are unfolded into ranges where they lie and never shuffled; files are read by
seeking, range by range, once to plan and once to emit.

A piece has at most ``max_bytes`` UTF-8 bytes and never breaks a character, unless max_bytes is below
four and a single character is larger; then that character is a piece of its own. The next piece
begins ``overlap_bytes`` before the cut, at the nearest whole character; an overlap of more than half
of max_bytes is reduced to that half. Null and empty texts, and items at or below their limit, are not
oversized and give nothing. Rows without a budget (null max_bytes) are not split. Repeated rows with
one id are one item; if their texts differ, the largest oversized one in byte order is taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.functions.sizing import broadcast_if_small, one_row_each

#: Least bytes of a range, and bytes seen on either side of any place where a boundary is looked for.
RANGE_BYTES = 1 << 18
HALO = 256
#: A cut is looked for in the last part of a piece; the strongest boundary there wins, then the last.
LEAST_FILL = 0.5
#: Ranges of one file whose pieces are counted in one task.
COUNTED = 4096
#: Strengths: 5 before a definition at the start of a line, 4 after a blank line, 3 after a line, 2 after a
#: sentence or statement, 1 after a blank, 0 any character.
_BOUNDARY = re.compile(
    rb"(?P<top>\n(?=(?:def |class |async |func |type |export |function |resource |module |variable |output |#{1,6} |@\w|/\*\*)))"
    rb"|(?P<para>\n[ \t\r]*\n)|(?P<line>\r?\n|\r)|(?P<stop>[.!?;:,][ \t]|[;}])|(?P<blank>[ \t])"
)
_STRENGTH = {"top": 5, "para": 4, "line": 3, "stop": 2, "blank": 1}
_PIECES = "item_kind string, row_id bigint, range_no int, piece_no int, start_byte bigint, end_byte bigint"


def budgets_for(items: DataFrame, budgets: DataFrame, kind: str) -> DataFrame:
    """Adds max_bytes and overlap_bytes of the row's lang; ``*`` holds where lang is null."""
    b = budgets.filter(F.col("item_kind") == kind).groupBy("lang").agg(F.max("max_bytes").alias("max_bytes"), F.max("overlap_bytes").alias("overlap_bytes")).withColumnRenamed("lang", "_lang")
    return items.join(broadcast_if_small(b), F.coalesce("lang", F.lit("*")) == F.col("_lang")).drop("_lang")


def items_of(frame: DataFrame, budgets: DataFrame, kind: str, row_id: str, text: str) -> DataFrame:
    """Oversized items of a table: (item_kind, row_id, body, max_bytes, overlap_bytes), one row an item."""
    rows = frame.select(F.col(row_id).alias("row_id"), F.col(text).alias("body"), F.col("lang").alias("lang"))
    over = budgets_for(rows, budgets, kind).filter(F.octet_length("body") > F.col("max_bytes")).select("row_id", "body", "max_bytes", "overlap_bytes")
    return one_row_each(over, "row_id", among=rows.select("row_id")).select(F.lit(kind).alias("item_kind"), "row_id", "body", "max_bytes", "overlap_bytes")


def stride(range_bytes: int) -> Column:
    """Bytes from one nominal end of a range to the next."""
    return F.greatest(F.lit(range_bytes), F.col("max_bytes") * 8).cast("bigint")


def reach(max_bytes: int) -> int:
    """Bytes before a nominal end among which its seam is looked for."""
    return max(1, int(max_bytes * (1 - LEAST_FILL)))


def _ranges(items: DataFrame, range_bytes: int) -> DataFrame:
    """Adds ``stride`` and, from the size, where each range's bytes with both halos begin and end."""
    sized = items.withColumn("stride", stride(range_bytes)).withColumn("overlap_bytes", F.least(F.greatest(F.coalesce("overlap_bytes", F.lit(0)), F.lit(0)), F.expr("max_bytes div 2")))
    back = F.col("max_bytes") + F.col("overlap_bytes") + 2 * HALO
    n = F.expr("cast((size + stride - 1) div stride as int)")
    begin = lambda i: F.greatest(i * F.col("stride") - back, F.lit(0))
    end = lambda i: F.least((i + 1) * F.col("stride") + 2 * HALO, F.col("size"))
    spans = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("range_no"), begin(i).cast("bigint").alias("base"), end(i).cast("bigint").alias("stop")))
    return sized.withColumn("spans", spans)


def ranges_of_rows(items: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Byte ranges of items held in rows, with their halos, in order; a narrow step."""
    raw = _ranges(items.filter("max_bytes > 0 and body is not null").withColumn("raw", F.encode("body", "UTF-8")).withColumn("size", F.octet_length("raw").cast("bigint")), range_bytes)
    # The slices are made before they are unfolded, so that no row carries the whole text.
    cut = F.transform("spans", lambda s: F.struct(s["range_no"].alias("range_no"), s["base"].alias("base"), F.substring(F.col("raw"), (s["base"] + 1).cast("int"), (s["stop"] - s["base"]).cast("int")).alias("bytes")))
    return raw.select("item_kind", "row_id", "max_bytes", "overlap_bytes", "size", "stride", F.explode(cut).alias("r")).select("item_kind", "row_id", "max_bytes", "overlap_bytes", "size", "stride", "r.*")


def ranges_of_files(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Where the byte ranges of files named by ``path`` lie; ``files`` has item_kind, row_id, path, n_bytes and the budget."""
    over = files.filter("max_bytes > 0").filter(F.col("n_bytes") > F.col("max_bytes")).withColumn("size", F.col("n_bytes").cast("bigint"))
    spread = _ranges(over, range_bytes).withColumn("s", F.explode("spans"))
    return spread.select("item_kind", "row_id", "max_bytes", "overlap_bytes", "size", "stride", "path", "s.range_no", "s.base", "s.stop").repartition(F.col("row_id"), F.col("range_no"))


def read_range(path: str, base: int, stop: int) -> bytes:
    from pyarrow import fs

    source, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    with source.open_input_file(name) as f:
        f.seek(base)
        return f.read(stop - base)


def natural(data: bytes, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Natural boundaries k with lo < k <= hi in ``data``, and their strengths; a cut at k is before byte k."""
    strength: dict[int, int] = {}
    for m in _BOUNDARY.finditer(data, max(0, lo - HALO), min(len(data), hi + HALO)):
        end = m.end()
        if lo < end <= hi:
            s = _STRENGTH[m.lastgroup]
            if s > strength.get(end, -1):
                strength[end] = s
    at = np.array(sorted(strength), np.int64)
    return at, np.array([strength[k] for k in at.tolist()], np.int8)


def best_of(at: np.ndarray, strength: np.ndarray, lo: int, hi: int) -> int | None:
    """The strongest boundary k with lo < k <= hi, the last of equals."""
    a, b = np.searchsorted(at, lo, "right"), np.searchsorted(at, hi, "right")
    return int(at[b - 1 - int(np.argmax(strength[a:b][::-1]))]) if a < b else None


def whole_before(data: bytes, at: int) -> int:
    """The last character boundary up to ``at``."""
    while 0 < at < len(data) and (data[at] & 0xC0) == 0x80:
        at -= 1
    return at


def seam(data: bytes, base: int, nominal: int, size: int, max_bytes: int) -> int:
    """The end of the range that nominally ends at ``nominal``, an offset of the item; the same for every task that sees it."""
    if nominal <= 0 or nominal >= size:
        return max(0, min(nominal, size))
    lo, hi = max(0, nominal - reach(max_bytes) - HALO), min(size, nominal + HALO)
    part = data[lo - base : hi - base]
    at, strength = natural(part, nominal - reach(max_bytes) - lo, nominal - lo)
    best = best_of(at, strength, -1, len(part))
    return lo + (best if best is not None else whole_before(part, nominal - lo))


def plan_range(data: bytes, base: int, size: int, range_no: int, step: int, max_bytes: int, overlap: int) -> list[tuple[int, int]]:
    """Nominal (start, end) of the pieces between a range's seams, as offsets of the item. A start is moved to a
    whole character when the piece is emitted, by at most two bytes; every end leaves room for that."""
    first, last = seam(data, base, range_no * step, size, max_bytes), seam(data, base, (range_no + 1) * step, size, max_bytes)
    if first >= last:
        return []
    at, strength = natural(data, first - base, last - base)
    at = at + base
    slack = 2 if overlap else 0
    pieces, cut, start = [], first, max(0, first - overlap) if first else 0
    while True:
        room = start + max_bytes - (slack if start else 0)
        if last <= room:
            return [*pieces, (start, last)]
        end = best_of(at, strength, max(cut, start + int(max_bytes * LEAST_FILL)), room)
        if end is None:
            end = base + whole_before(data, room - base)
            if end <= cut:  # one character larger than the limit
                end = cut + 1
                while end < last and (data[end - base] & 0xC0) == 0x80:
                    end += 1
        pieces.append((start, end))
        if end >= last:
            return pieces
        cut, start = end, max(end - overlap, start + 1)


def whole_character(data: bytes, at: int) -> int:
    """The character boundary nearest to ``at``, the later of two as near."""
    for d in (0, 1, -1, 2, -2):
        k = at + d
        if 0 <= k < len(data) and (data[k] & 0xC0) != 0x80:
            return k
    return at


def _cut(batches: Iterator[pd.DataFrame], texts: bool, numbered: bool) -> Iterator[pd.DataFrame]:
    """Pieces of the ranges of a task. Ranges of one item that follow each other are numbered on, unless ``first_no`` is there."""
    columns = ["item_kind", "row_id", "range_no", "piece_no", "start_byte", "end_byte", *(["piece"] if texts else [])]
    item, done = None, 0
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            data = read_range(r.path, r.base, r.stop) if hasattr(r, "path") else bytes(r.bytes)
            if numbered:
                done = int(r.first_no)
            elif (r.item_kind, r.row_id) != item or r.range_no == 0:
                item, done = (r.item_kind, r.row_id), 0
            for start, end in plan_range(data, r.base, r.size, r.range_no, r.stride, r.max_bytes, r.overlap_bytes):
                begin = r.base + whole_character(data, start - r.base) if start else 0
                rows.append((r.item_kind, r.row_id, r.range_no, done, begin, end, *([data[begin - r.base : end - r.base].decode("utf-8", "replace")] if texts else [])))
                done += 1
            if texts and sum(len(x[-1]) for x in rows[-64:]) > 1 << 22:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        yield pd.DataFrame(rows, columns=columns)


def plan(ranges: DataFrame) -> DataFrame:
    """Pieces by offset, without their text: (item_kind, row_id, range_no, piece_no, start_byte, end_byte).

    Ranges of rows lie together, and piece_no is that of the item; of files' ranges, it counts within the range.
    """
    return ranges.mapInPandas(lambda b: _cut(b, False, False), _PIECES) if "path" not in ranges.columns else ranges.withColumn("first_no", F.lit(0)).mapInPandas(lambda b: _cut(b, False, True), _PIECES)


def first_numbers(pieces: DataFrame) -> DataFrame:
    """(item_kind, row_id, range_no, first_no): pieces of the item before the range, summed in blocks of ranges."""
    item = ["item_kind", "row_id"]
    counts = pieces.groupBy(*item, "range_no").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.expr(f"range_no div {COUNTED}"))
    blocks = counts.groupBy(*item, "block").agg(F.sum("n").alias("n"))
    before = lambda *by: F.coalesce(F.sum("n").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select(*item, "block", before(*item, "block").alias("before"))
    inside = counts.select(*item, "block", "range_no", before(*item, "block", "range_no").alias("inside"))
    return inside.join(blocks, [*item, "block"]).select(*item, "range_no", (F.col("inside") + F.col("before")).alias("first_no"))


def split_files(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ordered pieces of files read by ranges: (item_kind, row_id, piece_no, start_byte, end_byte, piece)."""
    ranges = ranges_of_files(files, range_bytes)
    numbers = first_numbers(plan(ranges))
    placed = ranges.join(numbers, ["item_kind", "row_id", "range_no"])  # no bytes have been read yet
    return placed.mapInPandas(lambda b: _cut(b, True, True), _PIECES + ", piece string").drop("range_no")


def split_items(items: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ordered pieces of items held in rows: (item_kind, row_id, piece_no, start_byte, end_byte, piece)."""
    return ranges_of_rows(items, range_bytes).mapInPandas(lambda b: _cut(b, True, False), _PIECES + ", piece string").drop("range_no")


def oversized(spark: SparkSession, chunks: DataFrame, files: DataFrame, budgets: DataFrame) -> DataFrame:
    """Oversized chunks and files, one row an item."""
    return items_of(chunks, budgets, "chunk", "chunk_id", "body").unionByName(items_of(files, budgets, "file", "file_id", "content"))
