"""Sources, sink and stream."""

import json
import os
import subprocess

import pytest

from loomgraph.sources import config, gitchanges, http_sink, scip
from loomgraph.sources.files import read_tree


def git(root, *args):
    subprocess.run(["git", "-C", str(root), "-c", "user.name=t", "-c", "user.email=t@t", "-c", "commit.gpgsign=false", *args], check=True, capture_output=True)


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree"
    root.mkdir()
    git(root, "init", "-q")
    (root / "keep.py").write_text("a = 1\n")
    (root / "gone.py").write_text("b = 1\n")
    (root / "old name.py").write_text("c = 1\n" * 30)
    os.symlink("keep.py", root / "link")
    git(root, "add", "-A")
    git(root, "commit", "-qm", "one")
    first = gitchanges.head_commit(str(root))
    (root / "keep.py").write_text("a = 2\n")
    (root / "gone.py").unlink()
    (root / "old name.py").rename(root / "neü.py")
    (root / "added.txt").write_text("x")
    git(root, "add", "-A")
    git(root, "commit", "-qm", "two")
    (root / "untracked").write_text("x")
    return root, first


def test_git_changes(spark, tree):
    root, first = tree
    rows = {r[0]: r for r in gitchanges.list_changes(str(root), first)}
    assert {p: (r[2], r[1]) for p, r in rows.items()} == {"keep.py": ("M", None), "gone.py": ("D", None), "neü.py": ("R", "old name.py"), "added.txt": ("A", None)}
    assert rows["gone.py"][3] is None and len(rows["keep.py"][3]) == 64 and not rows["keep.py"][4]
    full = gitchanges.list_changes(str(root))
    assert [r[0] for r in full] == sorted([r[0] for r in full], key=str.encode) and all(r[2] == "A" and r[4] for r in full) and "untracked" not in {r[0] for r in full}
    link = next(r for r in full if r[0] == "link")
    assert link[3] == __import__("hashlib").sha256(b"keep.py").hexdigest()
    assert gitchanges.list_changes(str(root), "0" * 40) == full
    spark.dataSource.register(gitchanges.GitChanges)
    df = spark.read.format("gitchanges").option("path", str(root)).option("since", first).load()
    assert {r.path for r in df.collect()} == set(rows)
    many = gitchanges.read_changes(spark.createDataFrame([("r", str(root), None, True)], "repo string, root string, since string, full boolean"))
    assert many.count() == len(full)


def test_name_status_records():
    raw = b"M\0a\0C075\0b\0c\0T\0d\0X\0R100\0e\0f\0D\0g\0R\0only"
    assert list(gitchanges.parse_name_status(raw)) == [("a", None, "M"), ("c", None, "A"), ("d", None, "M"), ("f", "e", "R"), ("g", None, "D")]


def test_read_tree(spark, tree):
    root, _ = tree
    (root / "vendor").mkdir()
    (root / "vendor" / "x.py").write_text("v")
    (root / "bin.py").write_bytes(b"\xff\xfe\x00")
    got = {r.path: r for r in read_tree(spark, str(root), "r", (".py",)).collect()}
    assert {"keep.py", "neü.py", "bin.py"} == set(got) and got["keep.py"].content == "a = 2\n" and got["bin.py"].content is None and got["bin.py"].n_bytes == 3


# symbol indexes, written by a small encoder


def _v(n):
    n &= (1 << 64) - 1
    out = bytearray()
    while True:
        out.append(n & 127 | (128 if n > 127 else 0))
        n >>= 7
        if not n:
            return bytes(out)


def _f(number, value):
    if isinstance(value, int):
        return _v(number << 3) + _v(value)
    raw = value.encode() if isinstance(value, str) else value
    return _v(number << 3 | 2) + _v(len(raw)) + raw


def occ(symbol, roles, span, body=()):
    return _f(2, _f(1, b"".join(map(_v, span))) + _f(2, symbol) + _f(3, roles) + (_f(7, b"".join(map(_v, body))) if body else b""))


def sym(symbol, kind, name=""):
    return _f(1, symbol) + _f(5, kind) + _f(6, name)


def document(path, *parts):
    return _f(2, _f(1, path) + b"".join(parts) + _f(4, "Go"))


A, B, T, X = "s g p v pkg/A().", "s g p v pkg/B().", "s g p v pkg/T#", "s g x v other/`Ext Name`#m()."
INDEX = (
    document("a.go", occ(A, 1, (0, 5, 6), (0, 0, 20, 1)), occ(B, 1, (5, 5, 6), (5, 0, 15, 1)), occ(T, 1, (30, 5, 30, 6)), occ(A, 0, (8, 1, 2)), occ(X, 0, (3, 1, 2)), occ(B, 0, (20, 1, 2)), occ(T, 0, (1,)), occ(T, 0, (2, 0, 1)), occ(T, 0, (2, 4, 5)), occ(A, 0, (2, 0, 1)), _f(3, sym(A, 17)), _f(3, sym(B, 26, "Bee")), _f(3, sym(T, 7)))
    + document("b.go", occ(A, 0, (1, 0, 1)))
    + document("", occ(A, 1, (0, 0, 1)))
    + _f(3, sym(X, 17, "Ext"))
)


def test_scip(spark, tmp_path):
    (tmp_path / "i.scip").write_bytes(INDEX)
    g = scip.graph(*scip.read_indexes(spark, str(tmp_path / "i.scip"), "r"))
    ent = {e.entity_id.split(":", 2)[2]: e for e in g["entities"].collect()}
    assert {k: (e.ent_name, e.ent_type) for k, e in ent.items()} == {A: ("A", "scip_function"), B: ("Bee", "scip_method"), T: ("T", "scip_type"), X: ("Ext", "scip_external")}
    assert (ent[A].line_start, ent[A].line_end, ent[B].line_start, ent[B].line_end, ent[T].line_start, ent[T].line_end) == (1, 20, 6, 15, 31, 31)
    edges = {(e.src_id.split(":", 2)[2], e.dst_id.split(":", 2)[2], e.relation) for e in g["edges"].collect()}
    assert edges == {(B, A, "calls"), (A, X, "calls"), (A, T, "references"), (A, A, "calls")}
    assert {r.path for r in g["files"].collect()} == {"a.go", "b.go"}
    assert all(e.confidence_score == 1.0 and e.props["confidence"] == "0.98" for e in g["edges"].collect())


def test_indexes_of_one_folder_stay_apart(spark, tmp_path):
    """Every index numbers its documents from one: a definition of one must not hold a reference of another."""
    (tmp_path / "1.scip").write_bytes(document("a.go", occ(A, 1, (0, 5, 6), (0, 0, 20, 1)), _f(3, sym(A, 17))))
    (tmp_path / "2.scip").write_bytes(document("b.go", occ(B, 0, (3, 1, 2)), _f(3, sym(B, 17))))
    g = scip.graph(*scip.read_indexes(spark, str(tmp_path), "r"))
    assert g["edges"].count() == 0 and {r.path for r in g["files"].collect()} == {"a.go", "b.go"}


def test_tokens_are_kept_until_they_expire():
    now, asked = [0.0], []

    def post(url, body):
        asked.append(body)
        return json.dumps({"access_token": f"t{len(asked)}", "expires_in": 60}).encode()

    token = http_sink.client_credentials("http://issuer/token", "me", "s&1", "store", post=post, clock=lambda: now[0])
    assert token() == token() == "t1" and asked == [b"grant_type=client_credentials&client_id=me&client_secret=s%261&audience=store"]
    now[0] = 51.0
    assert token() == "t2"


def test_batches_are_sent_as_they_come():
    server, made = Server(R(200, {"files": 1}), R(400)), []
    with pytest.raises(RuntimeError, match="batch 2: "):
        http_sink.Sink(server, sleep=lambda _: None).push_graph(made.append(k) or {"n": k} for k in range(9))
    assert made == [0, 1]


def test_last_name():
    assert [scip.last_name(s) for s in ("s m p v a/b/T#m().", "s m p v a/b/T#", "s m p v a/`x y`.", "s m p v a/f(+1).", "local 12", "odd/thing().")] == ["m", "T", "x y", "f", "local 12", "thing"]
    with pytest.raises(ValueError):
        list(scip.fields(b"\x12\x05ab"))


# sink


class Server:
    def __init__(self, *answers):
        self.answers, self.seen = list(answers), []

    def __call__(self, method, path, body):
        self.seen.append((method, path, body and json.loads(body)))
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a


def R(status, body=None, **headers):
    return http_sink.Response(status, json.dumps(body or {}).encode(), {k.replace("_", "-"): v for k, v in headers.items()})


def test_retries_and_totals():
    waits = []
    server = Server(OSError(), R(429, Retry_After="7"), R(503), R(500), R(200, {"files": 2, "edges_upserted": 3}), R(200, {"files": 1}))
    sink = http_sink.Sink(server, waits.append)
    assert sink.push_graph([{"n": 1}, {"n": 2}]) == {"files": 3, "edges_upserted": 3}
    assert waits == [0.2, 7.0, 0.8, 1.6] and sink.retries == {"network": 1, "shed_429": 1, "shed_503": 1, "server_5xx": 1}
    with pytest.raises(RuntimeError, match="batch 2/2"):
        http_sink.Sink(Server(R(200), R(400)), waits.append).push_graph([{}, {}])
    with pytest.raises(ConnectionError):
        http_sink.Sink(Server(*[OSError()] * 5), waits.append).call("GET", "/x")


def test_jobs():
    sleep = lambda s: None
    assert http_sink.Sink(Server(), sleep).push_items("r", [], []) is None
    server = Server(R(202, {"id": "j", "status": "running"}), R(200, {"id": "j", "status": "running"}), R(200, {"id": "j", "status": "succeeded"}))
    assert http_sink.Sink(server, sleep).push_items("r", ["a"], [{"text": "t"}])["status"] == "succeeded" and len(server.seen) == 3
    for status in ("failed", "partial", "running"):
        with pytest.raises(RuntimeError):
            http_sink.Sink(Server(R(200, {"status": status})), sleep).push_items("r", ["a"], [])
    with pytest.raises(TimeoutError):
        http_sink.Sink(lambda *a: R(202, {"id": "j", "status": "running"}), sleep, poll=600).push_items("r", ["a"], [])


def test_retry_after():
    now = 1_700_000_000
    assert [http_sink.retry_after(v, now) for v in ("5", "900", "-1", "x", "", None, "1.5")] == [5, 60, 0, None, None, None, None]
    assert http_sink.retry_after("1.5", fractions=True) == 1.5
    assert http_sink.retry_after("Tue, 14 Nov 2023 22:13:40 GMT", now) == 20
    assert [http_sink.backoff(i) for i in (0, 1, 5, 9)] == [0.2, 0.4, 6.4, 10]


def test_compact_and_model():
    assert http_sink.compact({"a": "", "b": 0, "c": [], "d": {"e": None}, "f": [{"g": ""}], "h": "x", "i": False}) == {"f": [{}], "h": "x", "i": False}
    ok = R(200, {"choices": [{"message": {"content": "{}"}}]})
    assert http_sink.complete(Server(R(500), ok), "p", sleep=lambda s: None) == "{}"
    for bad in ((R(400),), (R(500), R(500)), (R(200, {"choices": []}),)):
        with pytest.raises(RuntimeError):
            http_sink.complete(Server(*bad), "p", sleep=lambda s: None)


def test_options():
    o = config.load({"repo-root": "/x/name/"}, {"SINCE": "abc", "HTTP_TIMEOUT": "3"})
    assert (o.repo_name, o.since, o.http_seconds, o.poll_seconds) == ("name", "abc", 3.0, 2.0)
    assert config.load({"scip": "i", "scip-repo": "r", "since": "f"}, {"SINCE": "e"}).since == "f"
    for flags in ({}, {"scip": "i"}, {"repo-root": "x", "token-url": "t"}):
        with pytest.raises(ValueError):
            config.load(flags, {})


def test_stream_of_changes(spark, tmp_path):
    from loomgraph.operators.store import ParquetStore
    from loomgraph.streaming.incremental import LOG, follow

    files = {"a.py": "def f(): g()\ndef g(): pass\n", "b.md": "text"}
    current = lambda: spark.createDataFrame([("r", p, c) for p, c in files.items()], "repo string, path string, content string")

    def commit(*rows):
        spark.createDataFrame(list(rows), LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        follow(spark, str(tmp_path / "log"), current, str(tmp_path / "store"), str(tmp_path / "ckpt")).awaitTermination()
        return {e.entity_id for e in ParquetStore(spark, str(tmp_path / "store/entities"), ["repo", "file_path"]).read().collect()}

    assert commit(("r", "a.py", None, "A", "1", 1), ("r", "b.md", None, "A", "1", 1)) == {"py:module:a", "py:func:a.f", "py:func:a.g", "doc:file:b.md"}
    files["a.py"] = "def f(): pass\n"
    del files["b.md"]
    assert commit(("r", "a.py", None, "M", "2", 2), ("r", "b.md", None, "D", None, 2)) == {"py:module:a", "py:func:a.f"}
