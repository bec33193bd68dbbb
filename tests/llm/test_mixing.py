import random

from loomgraph.llm import mixing as M

TARGETS = "mix_name string, source string, target_share double, max_repeats int"
DOCS = "doc_id bigint, text string, source string, n_tokens bigint, copies string"


def docs(spark, n=600):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(r.randint(1, 60))), ["big", " Big ", "small", "SMALL", None][min(4, r.randint(0, 12) // 3)] if i % 9 else "small", 0, "x") for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def test_shares_and_caps(spark):
    d = docs(spark)
    t = spark.createDataFrame([("m", "big", 0.6, 1), ("m", "small", 0.4, 3), ("m", "none", 0.1, 2), ("z", "small", 1.0, 2), ("z", "big", 0.0, 1)], TARGETS)
    got = M.mix(d, t)
    rows = got.collect()
    assert {r.source for r in rows} == {"big", "small"}
    assert all(r.copies <= (1 if r.source == "big" else 3 if r.mix_name == "m" else 2) for r in rows)
    assert len({(r.mix_name, r.doc_id) for r in rows}) == len(rows)
    share = {(r.mix_name, r.source): r for r in M.shares(got, t).collect()}
    assert abs(share["m", "big"].actual_share - 0.6) < 0.01 and abs(share["m", "small"].actual_share - 0.4) < 0.01
    assert share["m", "none"].tokens == 0 and share["z", "big"].tokens == 0 and share["z", "small"].actual_share == 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.mix(d, t).collect()))


def test_reduction_tree_keeps_tokens(spark, monkeypatch):
    monkeypatch.setattr(M, "LEAF", 40)
    monkeypatch.setattr(M, "FAN", 3)
    t = spark.createDataFrame([("m", "big", 0.5, 1), ("m", "small", 0.5, 1)], TARGETS)
    got = M.mix(docs(spark), t, total_tokens=4000)
    size = {r.source: r.tokens for r in M.shares(got, t).collect()}
    assert all(abs(v - 2000) <= 70 for v in size.values())  # within one document


def test_expectation_of_each_document():
    r = random.Random(1)
    hits = [0] * 5
    sizes, p = [10, 20, 5, 40, 7], 0.4
    for _ in range(20000):
        state: dict = {}
        out = list(M.pivot([("g", i, n, 0, p, r.random()) for i, n in enumerate(sizes)], state))
        for _, doc, _, copies in out:
            hits[doc] += copies
        for doc, _, whole, q, _ in state.values():
            hits[doc] += whole + (r.random() < q)
    assert all(abs(h / 20000 - p) < 0.02 for h in hits)


def test_nulls_and_empty_tables(spark):
    d = spark.createDataFrame([(1, None, "a", 0, ""), (2, "", "a", 0, ""), (None, "x", "a", 0, ""), (3, "some words", None, 0, ""), (4, "some words", "a", 0, ""), (4, "some words", "a", 0, "")], DOCS)
    t = spark.createDataFrame([("m", "a", 1.0, None), (None, "a", 1.0, 1), ("m", None, 1.0, 1), ("n", "a", None, 1)], TARGETS)
    assert [(r.mix_name, r.doc_id, r.copies) for r in M.mix(d, t).collect()] == [("m", 4, 1)]
    assert M.mix(d.limit(0), t).count() == 0
    assert M.mix(d, t.limit(0)).count() == 0
