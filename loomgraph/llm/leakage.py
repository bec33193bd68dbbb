"""Evaluation passages inside training text, by spaced-seed hashing.

Words are compared after lower-casing and removal of markup, escapes, punctuation and line prefixes.
Fixed masks choose word positions of a short window; a window's hash leaves the other position out, so
that a changed word there does not spoil it. The hashes of the documents' windows are joined to those
of the passages, and the surroundings of the hits are aligned, changed, dropped and added words each
costing one change. A document leaks an item when one stretch of the passage of at least ``MIN_SHARE``
of its words occurs with at most one word in ``ONE_IN`` changed.

The masks hit every such stretch of six or more words wherever the changed words lie; passages whose
third is shorter have a mask of that length besides. A pair is aligned when it has as many hits as any
leak of the passage must keep (``least_windows``). Items that share a passage are one until the end.

Documents are read and split into words once. A filter of the passages' hashes, of at most
``FILTER_BITS`` bits, lets a hash through whenever it is one of them, and some others; only places in
documents with enough such hashes are written and joined, with the words around them. There is no bound
on the number of items: with very many the filter lets more through. Common hashes are salted.

Null or empty texts and passages have no words and give nothing; rows whose id is null give nothing.
Repeated rows and items that share a passage each give their own distinct row. Extra columns are not
read.
"""

from __future__ import annotations

import hashlib
import html
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.sizing import BROADCAST_LIMIT, plan_bytes
from loomgraph.session import Scratch

MASKS = ("110111", "111011")
MIN_SHARE = 1 / 3
ONE_IN = 8
#: Words an alignment may drift from a diagonal.
DRIFT = 6
#: Bits of the filter of the passages' hashes: 16 a hash, up to this many.
FILTER_BITS = 1 << 27
#: Parts into which the documents' rows of one hash are split where the passages' side is not broadcast.
SALTS = 8
#: Words of a long document that make one place, at least.
PLACE_WORDS = 4096

_TAG = re.compile(r"</?[a-zA-Z][^<>\n]{0,200}>")
_ESCAPE = re.compile(r"\\[nrt]|\\u[0-9a-fA-F]{4}|[‒-―]|--+")
_NOT_WORD = re.compile(r"[\W_]+")


def words(text: str | None) -> list[str]:
    """Words of a text: split at white space, with everything but letters and digits taken out."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return [w for w in (_NOT_WORD.sub("", x) for x in _ESCAPE.sub(" ", text).lower().split()) if w]


def word_codes(flat: list[str]) -> np.ndarray:
    """A 64-bit hash a word, never 0; the empty string, which is no word, has 0."""
    if not flat:
        return np.empty(0, np.uint64)
    raw = np.array(flat, dtype=object)
    out = pd.util.hash_array(raw, categorize=False).astype(np.uint64) | np.uint64(1)
    out[raw == ""] = 0
    return out


def _codes(ids: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the windows that lie wholly in one text, and where the windows begin."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    code, inside = np.full(n, len(mask), np.uint64), np.ones(n, bool)
    for k, bit in enumerate(mask):
        part = ids[k : k + n]
        inside &= part > 0
        if bit == "1":
            code = code * np.uint64(0x9E3779B97F4A7C15) + part
            code ^= code >> np.uint64(29)
    at = np.flatnonzero(inside)
    return code[at], at


def least_words(n_words: int) -> int:
    return max(1, math.ceil(n_words * MIN_SHARE - 1e-9))


def masks_for(least: int) -> tuple[str, ...]:
    """Masks that hit every leak of a passage of which ``least`` words are enough."""
    return (*MASKS, "1" * least) if least < len(MASKS[0]) else MASKS


def least_windows(least: int, most: int) -> int:
    """Windows of either mask that every stretch of least to most words keeps, n/ONE_IN of its words changed; at least 1.

    A changed word spoils one window for each one of the mask, a dropped or added word one for each place
    within it. A longer stretch may keep fewer, as it may carry one change more; it is never fewer from
    one multiple of ONE_IN to the next.
    """
    wide = len(MASKS[0])
    spoilt = max(wide - 1, *(m.count("1") for m in MASKS))
    return max(1, min(n - wide + 1 - spoilt * (n // ONE_IN) for n in range(least, min(most, least + ONE_IN) + 1)))


def leaked(ids: np.ndarray, passage: np.ndarray) -> bool:
    """Whether the words ``ids`` hold a long enough stretch of a passage, around common windows."""
    least = least_words(len(passage))
    need, found = least_windows(least, len(passage)), []
    for k, mask in enumerate(masks_for(least)):
        mine, where = _codes(ids, mask)
        code, at = _codes(passage, mask)
        order = np.argsort(code, kind="stable")
        code, at = code[order], at[order]
        lo, hi = np.searchsorted(code, mine, "left"), np.searchsorted(code, mine, "right")
        hit = np.flatnonzero(hi > lo)
        count = hi[hit] - lo[hit]
        rows = np.repeat(lo[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        d, p = np.repeat(where[hit], count), at[rows]
        found += zip((d - p).tolist(), d.tolist(), p.tolist())
    if not found:
        return False
    found.sort()
    groups, group = [], [found[0]]
    for h in found[1:]:
        if h[0] - group[-1][0] > DRIFT:
            groups.append(group)
            group = []
        group.append(h)
    groups.append(group)
    for g in groups:
        if len({h[2] for h in g}) < need:
            continue
        low, high = g[0][0] - DRIFT, g[-1][0] + DRIFT
        a, b = max(0, min(h[1] for h in g) - 2 * len(passage)), min(len(ids), max(h[1] for h in g) + 2 * len(passage))
        if longest_stretch(ids[a:b].tolist(), passage.tolist(), low - a, high - a) >= least:
            return True
    return False


def longest_stretch(doc: list[int], passage: list[int], low: int, high: int) -> int:
    """Most passage words in one stretch with at most one in ONE_IN changed, on diagonals low to high.

    Runs of equal words are linked to the best earlier run; a link costs the larger of the words left
    out on either side. The longest linked stretch within the allowed changes counts, from its first
    equal word to its last.
    """
    runs = []
    n, m = len(doc), len(passage)
    for diagonal in range(low, high + 1):
        p = max(0, -diagonal)
        while p < m and p + diagonal < n:
            if doc[p + diagonal] and doc[p + diagonal] == passage[p]:
                q = p
                while q < m and q + diagonal < n and doc[q + diagonal] == passage[q]:
                    q += 1
                runs.append((p, q, diagonal))
                p = q
            else:
                p += 1
    runs.sort()
    best = 0
    # chains[k]: for run k, (start of the stretch, changes) pairs worth keeping
    chains: list[list[tuple[int, int]]] = []
    for k, (p, q, diagonal) in enumerate(runs):
        mine = {p: 0}
        for j in range(k - 1, -1, -1):
            p0, q0, d0 = runs[j]
            if p - q0 > m // ONE_IN + 1:
                continue
            skip = q0 - p if q0 > p else 0  # overlapping passage words are used once
            if p + skip >= q:
                continue
            gap_p, gap_d = p + skip - q0, (p + skip + diagonal) - (q0 + d0)
            if gap_d < 0:
                continue
            cost = max(gap_p, gap_d)
            for start, e in chains[j]:
                if e + cost <= (m - start) // ONE_IN:
                    mine[start] = min(mine.get(start, 10**9), e + cost)
        kept, least = [], 10**9
        for start in sorted(mine):
            if mine[start] < least:
                least = mine[start]
                kept.append((start, least))
        chains.append(kept)
        for start, e in kept:
            if (q - start) >= ONE_IN * e:
                best = max(best, q - start)
    return best


def passages_of(items: DataFrame) -> DataFrame:
    """(item_id, pid, ids, least_hits, short): the words of every item's passage; equal passages have one ``pid``."""

    def read(batches):
        for batch in batches:
            rows = []
            for i, text in zip(batch["item_id"], batch["passage"]):
                w = words(text)
                if w:
                    least = least_words(len(w))
                    rows.append((i, hashlib.sha256(" ".join(w).encode("utf-8", "replace")).hexdigest(), word_codes(w).view(np.int64), least_windows(least, len(w)), least if least < len(MASKS[0]) else 0))
            yield pd.DataFrame(rows, columns=["item_id", "pid", "ids", "least_hits", "short"])

    known = items.select(F.col("item_id").cast("bigint").alias("item_id"), "passage").filter(F.col("item_id").isNotNull() & F.col("passage").isNotNull()).distinct()
    return known.mapInPandas(read, "item_id bigint, pid string, ids array<bigint>, least_hits int, short int")


def windows_of(passages: DataFrame) -> DataFrame:
    """(mask, code, pid): distinct window hashes of the passages; ``mask`` is 0 and 1, or a short mask's negative length."""

    def read(batches):
        for batch in batches:
            parts = []
            for pid, ids, short in zip(batch["pid"], batch["ids"], batch["short"]):
                v = np.asarray(ids, np.int64).view(np.uint64)
                for k, mask in (*enumerate(MASKS), *([(-int(short), "1" * int(short))] if short else [])):
                    code = np.unique(_codes(v, mask)[0])
                    parts.append(pd.DataFrame({"mask": np.full(len(code), k, np.int32), "code": code.view(np.int64), "pid": pid}))
            yield pd.concat(parts) if parts else pd.DataFrame({"mask": np.empty(0, np.int32), "code": np.empty(0, np.int64), "pid": np.empty(0, object)})

    return passages.select("pid", "ids", "short").mapInPandas(read, "mask int, code bigint, pid string")


class HashFilter:
    """A bit table of window hashes with two places a hash: says yes to all of them, and to few others while it is not full."""

    def __init__(self, windows: DataFrame, n: int):
        self.bits = min(FILTER_BITS, 1 << max(16, (16 * n).bit_length()))
        last = F.lit(self.bits - 1)
        places = F.explode(F.array(F.col("code").bitwiseAND(last), F.shiftrightunsigned("code", 33).bitwiseAND(last)))
        slots = windows.select(places.alias("place")).groupBy(F.shiftright("place", 16).alias("slot")).agg(F.collect_set(F.col("place").bitwiseAND(F.lit(0xFFFF)).cast("int")).alias("at"))

        def pack(batches):
            for batch in batches:
                yield pd.DataFrame({"slot": batch["slot"], "part": [self._pack(at) for at in batch["at"]]})

        # At most FILTER_BITS / 8 bytes, however many hashes there are.
        self.table = np.zeros(self.bits // 8, np.uint8)
        for r in slots.mapInPandas(pack, "slot bigint, part binary").collect():
            self.table[r.slot * 8192 : (r.slot + 1) * 8192] = np.frombuffer(r.part, np.uint8)

    @staticmethod
    def _pack(at: np.ndarray) -> bytes:
        bits = np.zeros(65536, np.uint8)
        bits[np.asarray(at, np.int64)] = 1
        return np.packbits(bits, bitorder="little").tobytes()

    def maybe(self, code: np.ndarray) -> np.ndarray:
        """Places in ``code`` of the hashes that may be known."""
        last, eight = np.uint64(self.bits - 1), np.uint64(7)
        one = code & last
        at = np.flatnonzero(self.table[one >> np.uint64(3)] >> (one & eight).astype(np.uint8) & 1)
        two = (code[at] >> np.uint64(33)) & last
        return at[(self.table[two >> np.uint64(3)] >> (two & eight).astype(np.uint8) & 1) > 0]


def places_of(documents: DataFrame, known, longest: int, fewest: int, shorts: list[int]) -> DataFrame:
    """(doc_id, place, ids, masks, codes, counts): stretches of documents with enough hashes that may be a passage's.

    ``known`` is the broadcast filter, ``longest`` the most words of a passage, ``fewest`` the hits that
    any leak keeps. Places of a long document overlap by more than a passage, so that no leak is cut.
    """
    reach = longest + longest // ONE_IN + DRIFT + len(MASKS[0])
    step = max(PLACE_WORDS, 4 * reach)
    masks = [*enumerate(MASKS), *((-n, "1" * n) for n in shorts)]
    margin = [""] * max(len(m) for _, m in masks)

    def scan(batches):
        seeds = known.value
        for batch in batches:
            flat, starts, doc_ids, out = [], [], [], []

            def flush():
                ids = word_codes(flat)
                first = np.array([*starts, len(ids)])
                kinds, codes, where = [], [], []
                for k, mask in masks:
                    code, at = _codes(ids, mask)
                    hit = seeds.maybe(code)
                    kinds.append(np.full(len(hit), k, np.int32)), codes.append(code[hit]), where.append(at[hit])
                kind, code, at = np.concatenate(kinds), np.concatenate(codes), np.concatenate(where)
                order = np.argsort(at, kind="stable")
                kind, code, at = kind[order], code[order], at[order]
                doc = np.searchsorted(first, at, "right") - 1
                for d in np.unique(doc).tolist():
                    lo, hi = np.searchsorted(doc, d, "left"), np.searchsorted(doc, d, "right")
                    k_, c_, a_ = kind[lo:hi], code[lo:hi], at[lo:hi] - first[d]
                    size = first[d + 1] - first[d]
                    for place in range(int(a_[0] // step) - 1, int(a_[-1] // step) + 1):
                        if place < 0 and step:
                            continue
                        x, y = np.searchsorted(a_, place * step, "left"), np.searchsorted(a_, (place + 1) * step + reach, "left")
                        if place and a_[min(y, len(a_)) - 1] < place * step + reach:
                            continue  # the place before holds all of it
                        mine = k_[x:y]
                        if not len(mine) or (not shorts and min((mine == k).sum() for k in range(len(MASKS))) < fewest):
                            continue
                        both, n = np.unique(np.stack([mine.astype(np.int64), c_[x:y].view(np.int64)]), axis=1, return_counts=True)
                        a, b = max(0, int(a_[x]) - reach), min(int(size), int(a_[y - 1]) + 2 * reach)
                        part = ids[first[d] + a : first[d] + b]
                        out.append((doc_ids[d], place, part.view(np.int64), both[0].astype(np.int32), both[1], n.astype(np.int32)))
                flat.clear(), starts.clear(), doc_ids.clear()

            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                starts.append(len(flat))
                doc_ids.append(doc_id)
                flat.extend(words(text))
                flat.extend(margin)
                if len(flat) > 300_000:
                    flush()
            if starts:
                flush()
            yield pd.DataFrame(out, columns=["doc_id", "place", "ids", "masks", "codes", "counts"])

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return docs.mapInPandas(scan, "doc_id bigint, place int, ids array<bigint>, masks array<int>, codes array<bigint>, counts array<int>")


def candidates(places: DataFrame, windows: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, place, pid) of pairs that share as many windows of each mask as a leak must keep."""
    hits = places.select("doc_id", "place", F.explode(F.arrays_zip("masks", "codes", "counts")).alias("h")).select("doc_id", "place", F.col("h.masks").alias("mask"), F.col("h.codes").alias("code"), F.col("h.counts").alias("n"))
    if plan_bytes(windows) <= BROADCAST_LIMIT:
        met = hits.join(F.broadcast(windows), ["mask", "code"])
    else:
        salted = windows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = hits.withColumn("salt", F.pmod(F.xxhash64("doc_id", "place"), F.lit(SALTS)).cast("int")).join(salted, ["mask", "code", "salt"])
    of = lambda k: F.sum(F.when(F.col("mask") == k, F.col("n")).otherwise(0)).alias(f"n{k}")
    counted = met.groupBy("doc_id", "place", "pid").agg(*[of(k) for k in range(len(MASKS))], F.max((F.col("mask") < 0).cast("int")).alias("shorts"))
    enough = (F.col("shorts") > 0) | (F.least(*[F.col(f"n{k}") for k in range(len(MASKS))]) >= F.col("least_hits")) | ((F.col("least_hits") == 1) & (F.greatest(*[F.col(f"n{k}") for k in range(len(MASKS))]) > 0))
    return counted.join(passages.select("pid", "least_hits"), "pid").filter(enough).select("doc_id", "place", "pid")


def find_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (doc_id, item_id) of documents that reproduce enough of an item's passage."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "leakage")
    every = scratch.write(passages_of(items), "items")
    passages = scratch.write(every.drop("item_id").dropDuplicates(["pid"]), "passages")
    windows = scratch.write(windows_of(passages), "windows")
    said = passages.agg(F.max(F.size("ids")).alias("longest"), F.min("least_hits").alias("fewest")).first()
    shorts = sorted(r.short for r in passages.filter("short > 0").select("short").distinct().collect())  # below the masks' length
    known = spark.sparkContext.broadcast(HashFilter(windows, windows.count()))
    # With one hit enough, either mask's will do.
    fewest = said.fewest if said.fewest and said.fewest > 1 else 0
    places = scratch.write(places_of(documents, known, said.longest or 0, fewest, shorts), "places")

    def verify(batches):
        for batch in batches:
            ok = [leaked(np.asarray(d, np.int64).view(np.uint64), np.asarray(p, np.int64).view(np.uint64)) for d, p in zip(batch["ids"], batch["passage"])]
            yield batch.loc[np.array(ok, bool), ["doc_id", "pid"]]

    pairs = candidates(places, windows, passages).join(places.select("doc_id", "place", "ids"), ["doc_id", "place"]).join(passages.select("pid", F.col("ids").alias("passage")), "pid")
    found = pairs.select("doc_id", "pid", "ids", "passage").mapInPandas(verify, "doc_id bigint, pid string").distinct()
    out = scratch.write(found.join(every.select("item_id", "pid"), "pid").select("doc_id", "item_id").distinct(), "leaks")
    scratch.remove(out)
    return out
