import itertools
import random

import numpy as np
import pytest

from loomgraph.llm import leakage as L

R = random.Random(9)
WORDS = [f"w{i}" for i in range(400)] + ["the", "a", "of"] * 20
PASSAGES = {i: " ".join(R.choice(WORDS) for _ in range(90)) for i in range(1, 6)}


def noise(n=60):
    return " ".join(R.choice(WORDS) for _ in range(n))


def changed(words, every):
    return ["other" if i % every == every // 2 else w for i, w in enumerate(words)]


def docs():
    p = {i: t.split() for i, t in PASSAGES.items()}
    third = p[1][10:40]
    return {
        1: (f"{noise()} {PASSAGES[1]} {noise()}", {1}),
        2: (f"{noise()} {' '.join(third)} {noise()}", {1}),
        3: (f"{noise()} {' '.join(p[1][10:32])} {noise()}", set()),
        4: (f"{noise()} {' '.join(changed(p[2], 9))} {noise()}", {2}),
        5: (f"{noise()} {' '.join(changed(p[2], 5))} {noise()}", set()),
        6: ("> " + "\n> ".join(" ".join(p[3][k : k + 7]).upper() for k in range(0, 90, 7)), {3}),
        7: ("<p>" + "</p>\n<p>".join(" ".join(f"<b>{w}</b>," for w in p[3][k : k + 9]) for k in range(0, 45, 9)) + "</p>", {3}),
        8: ('{"t": "' + "\\n".join(" ".join(p[4][k : k + 8]) for k in range(0, 60, 8)) + '"}', {4}),
        9: (" ".join([*p[4][:40], *p[5][20:60]]), {4, 5}),
        10: (f"{' '.join(p[5][:15])} {noise(30)} {' '.join(p[5][20:35])}", set()),
        11: (" ".join(p[1][:20] + ["added"] + p[1][20:40]), {1}),
        12: ("", set()),
        13: (None, set()),
        14: (noise(3000) + PASSAGES[2] + noise(20000), {2}),
        15: (" ".join(third).replace("w", "w\u00ad"), {1}),
    }


def run(spark, d, items=None):
    df = spark.createDataFrame([(i, t, "extra") for i, t in [*d.items(), (None, PASSAGES[1])] for _ in range(2)], "doc_id bigint, text string, item_id string")
    rows = items if items is not None else list(PASSAGES.items()) + [(21, PASSAGES[1].replace(" ", "  ")), (30, None), (31, ""), (None, PASSAGES[1])]
    return {tuple(r) for r in L.find_leaks(df, spark.createDataFrame(rows, "item_id bigint, passage string")).collect()}


@pytest.mark.parametrize("limit", [0, L.BROADCAST_LIMIT])
def test_leaks(spark, limit, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_LIMIT", limit)  # 0: the passages' hashes are salted and shuffled
    d = {i: t for i, (t, _) in docs().items()}
    want = {(i, x) for i, (_, s) in docs().items() for x in s}
    want |= {(i, 21) for i, x in want if x == 1}
    assert run(spark, d) == want


def test_empty_tables(spark):
    assert run(spark, {1: "x"}, [(1, None)]) == set()
    assert L.find_leaks(spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, passage string")).count() == 0


def brute(doc, passage):
    """Longest stretch of a passage in a document, by edit distances of all pairs of stretches on a diagonal."""
    best = 0
    for shift in range(-len(passage), len(doc)):
        same = [(k, 0 <= k + shift < len(doc) and doc[k + shift] == passage[k]) for k in range(len(passage))]
        for a in range(len(passage)):
            if not same[a][1]:
                continue
            bad = 0
            for b in range(a, len(passage)):
                bad += not same[b][1]
                if same[b][1] and 8 * bad <= b - a + 1:
                    best = max(best, b - a + 1)
    return best


def test_stretch_against_brute_force():
    r = random.Random(5)
    for _ in range(60):
        passage = [r.randint(1, 40) for _ in range(30)]
        doc = [x if r.random() > 0.1 else 99 for x in passage[r.randint(0, 10) : r.randint(18, 30)]] + [r.randint(1, 40) for _ in range(10)]
        assert L.longest_stretch(doc, passage, -30, 22) >= brute(doc, passage)


def test_words():
    assert L.words('He said: "No—never!"\\nYes &amp; <i>no_w</i> 4.5') == ["he", "said", "no", "never", "yes", "now", "45"]


def fewest_hits(n: int, changes: int, masks) -> int:
    """Fewest windows of the masks that n words with so many changed ones keep, over all places of the changes."""
    wide = len(masks[0])
    spoils = [sum(1 << (wide - 1 - k) for k, b in enumerate(m) if b == "1") for m in masks]
    best = {(0, 0): 0}  # (which of the last words are changed, changes so far): windows kept
    for k in range(n):
        after: dict = {}
        for (last, used), kept in best.items():
            for c in (0, 1):
                if used + c <= changes:
                    bits = ((last << 1) | c) & ((1 << wide) - 1)
                    more = kept + (sum(not bits & x for x in spoils) if k >= wide - 1 else 0)
                    key = (bits, used + c)
                    after[key] = min(after.get(key, 10**9), more)
        best = after
    return min(best.values())


def test_masks_hit_every_leak():
    """Whatever words are changed, the masks hit every stretch of six or more words, and each keeps least_windows."""
    for n in range(6, 141):
        assert fewest_hits(n, n // 8, L.MASKS) >= 1, n
    for m in (48, 59, 66, 69, 72, 90, 137):
        least = -(-m // 3)
        for n in range(least, min(m, least + 20) + 1):
            for mask in L.MASKS:
                assert fewest_hits(n, n // 8, [mask]) >= L.least_windows(least, m)


@pytest.mark.parametrize("m", [8, 15, 16, 20, 24, 64, 66, 67, 69])
def test_every_place_of_the_changes(m):
    """The shortest leaks with changed words are found wherever those lie."""
    passage = L.word_codes([f"p{i}" for i in range(m)])
    n = max(-(-m // 3), 8 if m < 30 else 24)
    lost = []
    for c in itertools.combinations(range(1, n - 1), n // 8):
        ids = np.concatenate([L.word_codes(["x"] * 9), passage[m - n :], L.word_codes(["y"] * 9)])
        ids[[9 + i for i in c]] = L.word_codes(["other"])[0]
        if not L.leaked(ids, passage):
            lost.append(c)
    assert lost == []


def test_short_passages(spark):
    items = [(1, "one"), (2, "to be or not"), (3, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my ny"), (4, "a b c d e f g h")]
    d = {1: "No one knows.", 2: "That is or not it.", 3: "x x gamma delta epsilon other eta theta iota kappa y", 4: "delta epsilon gamma eta beta", 5: "so c d e then"}
    assert run(spark, d, items) == {(1, 1), (2, 2), (3, 3), (5, 4)}


def test_leak_across_the_places_of_a_long_document(spark, monkeypatch):
    monkeypatch.setattr(L, "PLACE_WORDS", 1)
    step = 4 * (90 + 90 // 8 + L.DRIFT + 6)
    d = {k: " ".join([*["pad"] * k, PASSAGES[3], *["end"] * 2000]) for k in range(step - 100, step + 20, 15)} | {9: " ".join(f"{'pad ' * 400}{PASSAGES[4]}" for _ in range(9))}
    assert run(spark, d) == {(k, 3) for k in d if k != 9} | {(9, 4)}


def test_filter_lets_every_known_hash_through(spark):
    codes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    f = L.HashFilter(spark.createDataFrame([(int(c),) for c in codes], "code bigint"), len(codes))
    assert len(f.maybe(codes.view(np.uint64))) == len(codes)
    other = np.random.default_rng(2).integers(0, 2**63 - 1, 100_000).astype(np.uint64)
    assert len(f.maybe(other)) < 3000
