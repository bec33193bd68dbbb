import random

from loomgraph.llm import origin as O

R = random.Random(6)
W = "alpha beta gamma delta node queue score bundle layer".split()


def plain(n=6):
    out = ["import os", ""]
    for _ in range(n):
        a, b, c = (R.choice(W) for _ in range(3))
        out += [f"def {a}_{b}({c}):", f'    """{a.title()} the {b} once."""', R.choice([f"    if not {a}:\n        return {b}", f"    for x in {a}:\n        {b}.append(x)", f"    with open({c}) as f:\n        {a} = f.read()", f"    {b} = sorted({a}, key=lambda x: x[1])"]), f"    # {b} before {c}", f"    return {c}"]
    return "\n".join(out)


def machine(n=40):
    return "\n".join(f"    {R.choice(W)}_{i:03} = Field(number={i}, kind={R.randint(1, 9)})" for i in range(n))


def tree():
    """(path, text, is a case) of files in several repositories."""
    rows = []
    for i in range(160):
        rows.append((f"r{i % 6}", f"src/{R.choice(W)}/{R.choice(W)}_{i}.py", plain(), False))
    for i in range(24):
        rows.append((f"r{i % 6}", f"src/{R.choice(W)}/msg_{i}.py", machine(), True))
        rows.append((f"r{i % 6}", f"vendor/lib{i % 4}/{R.choice(W)}_{i}.py", plain(), True))
        rows.append((f"r{i % 6}", f"lib/{R.choice(W)}/tool_{i}.py", f"# Code generated by maker{i % 3}. DO NOT EDIT.\n" + plain(), True))
        rows.append((f"r{i % 6}", f"static/{R.choice(W)}_{i}.min.js", "".join(f"function a{k}(t){{return t?t[{k}]:void 0}}" for k in range(30)), True))
    rows.append(("r1", "src/vendors/pick.py", plain(), False))
    rows.append(("r2", "src/maker.py", plain() + '\nout.write("# Code generated by this. DO NOT EDIT.")\n', False))
    rows.append(("r3", "src/hand.py", "# Hand-written. The stubs are generated from this file, never the other way round.\n" + plain(), False))
    return rows


def frame(spark, rows):
    """Two chunks a file, some rows repeated."""
    chunks = []
    for k, (repo, path, text, _) in enumerate(rows):
        lines = text.split("\n")
        half = len(lines) // 2
        parts = ["\n".join(lines[:half]), "\n".join(lines[half:])]
        chunks += [(2 * k + j, repo, path, "py_func", p, 1.5) for j, p in enumerate(parts)] * (2 if k % 40 == 0 else 1)
    chunks += [(90_001, "r0", "docs/a.md", "doc_file", machine(), 0.0), (90_002, None, None, None, None, 0.0), (90_003, "r0", "src/none.py", None, None, 0.0), (90_004, "r0", "src/empty.py", "py_func", "", 0.0)]
    return spark.createDataFrame(chunks, "chunk_id bigint, repo string, file_path string, ent_type string, body string, total double")


def test_found(spark):
    rows = tree()
    got = {tuple(r) for r in O.find_not_handwritten(frame(spark, rows)).collect()}
    want = {(r, p) for r, p, _, case in rows if case}
    odd = {(r, p) for r, p, t, _ in rows if O.shape_label(t)}  # plain files that chance made as uniform as a machine's
    assert len(got & want) >= 0.97 * len(want) and len(got - want - odd) <= 1 and len(odd - want) <= 3
    assert not {("r1", "src/vendors/pick.py"), ("r2", "src/maker.py"), ("r3", "src/hand.py"), ("r0", "docs/a.md")} & got


def test_held_out_repositories(spark):
    r = O.validate(frame(spark, tree())).first()
    assert r.n_train and r.n_test and (r.both + r.neither) / r.n_test > 0.95


def test_empty_table(spark):
    assert O.find_not_handwritten(frame(spark, tree()[:0]).limit(0)).count() == 0


def test_score_is_additive():
    rows = tree()
    model = O.Model({(r, p): [t] for r, p, t, _ in rows})
    text = "a = 1\n# note one\nb = c(2)\n"
    one, two = model.score([text, None]), model.score(["a = 1\n# note one\nb = c(2)\n", ""])
    assert one[0][0] == two[0][0] and one[1][1] == 0 and one[2][1] < -1e8


def test_validation_counts_every_held_out_file(spark, monkeypatch):
    """The sample bounds what is fitted, never what is tested; long chunks count as well."""
    rows = tree() + [("r0", "src/long.py", plain(2000), False), ("r1", "src/long.py", plain(2000), False)]
    chunks = frame(spark, rows)
    n = len({(r, p) for r, p, *_ in rows if O._hash(r) % 2 == 0})
    n += O._hash("r0") % 2 == 0 and 2  # two files of the frame without a body
    monkeypatch.setattr(O, "training_files", lambda c, f=O.training_files: f(c, 150))
    r = O.validate(chunks).first()
    assert r.n_test == n and r.both + r.neither + r.only_classifier + r.only_weak_label == n
    assert 0 < r.n_train < n


def test_threshold_by_held_out_rows():
    import numpy as np

    y = np.array([1] * 30 + [-1] * 70)
    assert O.choose(np.array([2.0] * 30 + [-1.0] * 70), y) == 0
    assert 0.5 < O.choose(np.array([2.0] * 30 + [0.5] * 70), y) < 2
    assert -1 < O.choose(np.array([-0.5] * 30 + [-1.0] * 70), y) < -0.5
    assert O.choose(np.array([2.0] * 30), y[:30]) == 0


def test_training_files_are_bounded(spark):
    rows = tree()
    some = O.training_files(frame(spark, rows), total_bytes=sum(len(t) for _, _, t, _ in rows) // 4)
    assert 0 < len(some) < len(rows) / 2
    many = [(k, "r0", "src/hot.py", "py_func", f"x = {k}", 0.0) for k in range(O.TRAIN_FILE + 1)]
    assert O.training_files(spark.createDataFrame(many, "chunk_id bigint, repo string, file_path string, ent_type string, body string, total double")) == {}
