import random

import pytest

from loomgraph.llm import split

SCHEMA = "item_kind string, row_id bigint, body string, max_bytes bigint, overlap_bytes bigint"


def texts():
    r = random.Random(5)
    words = ["alpha", "beta", "größer", "日本語の文", "x" * 90, "😀😀", "if (a) {", "}", "return 1;"]
    return ["".join(r.choice(words) + r.choice([" ", "\n", "\r\n", "\n\n", ". "]) for _ in range(n)) for n in (40, 300, 900)] + ["z" * 5000, "é" * 3000, "😀" * 999]


@pytest.mark.parametrize("range_bytes", [512, 1 << 18])
def test_pieces_cover_the_text(spark, range_bytes):
    rows = [("file", i, t, m, o) for i, t in enumerate(texts()) for m, o in [(400, 60)]]
    pieces = split.split_items(spark.createDataFrame(rows, SCHEMA), range_bytes).collect()
    for _, i, text, m, o in rows:
        raw = text.encode()
        mine = sorted((p for p in pieces if p.row_id == i), key=lambda p: p.piece_no)
        assert [p.piece_no for p in mine] == list(range(len(mine)))
        assert mine[0].start_byte == 0 and mine[-1].end_byte == len(raw)
        for p in mine:
            assert raw[p.start_byte : p.end_byte].decode() == p.piece
            assert len(p.piece.encode()) <= m
        for p, q in zip(mine, mine[1:]):
            assert abs(p.end_byte - q.start_byte - o) <= 2 and q.end_byte > p.end_byte


def test_cuts_at_natural_boundaries(spark):
    body = "\n\n".join("word " * 15 + "end." for _ in range(40))
    pieces = split.split_items(spark.createDataFrame([("chunk", 1, body, 300, 0)], SCHEMA)).orderBy("piece_no").collect()
    assert all(p.piece.endswith("\n\n") for p in pieces[:-1])
    assert "".join(p.piece for p in pieces) == body


def test_same_pieces_for_any_range_size(spark):
    df = spark.createDataFrame([("file", i, t, 500, 50) for i, t in enumerate(texts())], SCHEMA)
    a, b = (sorted(map(tuple, split.split_items(df, n).collect())) for n in (1024, 1 << 18))
    assert [x[:5] for x in a] and {x[1] for x in a} == {x[1] for x in b}
    assert all(len(x[5].encode()) <= 500 for x in a + b)


def test_nulls_empties_and_repeats(spark):
    frame = spark.createDataFrame([(1, None, "python"), (2, "", "python"), (3, "a" * 11, None), (3, "a" * 11, None), (4, "b" * 11, "other"), (5, "c" * 10, None), (None, None, None)], "chunk_id bigint, body string, lang string")
    budgets = spark.createDataFrame([("chunk", "python", 4, 1), ("chunk", "*", 10, 4)], "item_kind string, lang string, max_bytes bigint, overlap_bytes bigint")
    items = split.items_of(frame.withColumn("max_bytes", frame.chunk_id), budgets, "chunk", "chunk_id", "body")
    assert [r.row_id for r in items.collect()] == [3]
    assert split.split_items(items).count() == 2
    assert split.split_items(items.limit(0)).count() == 0


def test_character_larger_than_the_limit(spark):
    got = split.split_items(spark.createDataFrame([("chunk", 1, "😀😀", 3, 0)], SCHEMA)).orderBy("piece_no").collect()
    assert [p.piece for p in got] == ["😀", "😀"]


def test_files_are_read_by_ranges(spark, tmp_path):
    body = "line of text äöü\n" * 3000
    path = tmp_path / "big.txt"
    path.write_text(body, encoding="utf-8", newline="")
    n = len(body.encode())
    files = spark.createDataFrame([("file", 7, str(path), n, 1000, 100)], FILES)
    pieces = split.split_files(files, 4096).orderBy("piece_no").collect()
    raw = body.encode()
    assert [p.piece_no for p in pieces] == list(range(len(pieces)))
    assert pieces[0].start_byte == 0 and pieces[-1].end_byte == n
    assert all(raw[p.start_byte : p.end_byte].decode() == p.piece and len(p.piece.encode()) <= 1000 for p in pieces)
    assert all(abs(p.end_byte - q.start_byte - 100) <= 2 for p, q in zip(pieces, pieces[1:]))
    rows = split.split_items(spark.createDataFrame([("file", 7, body, 1000, 100)], SCHEMA), 4096).orderBy("piece_no").collect()
    assert [tuple(r) for r in rows] == [tuple(r) for r in pieces]


FILES = "item_kind string, row_id bigint, path string, n_bytes bigint, max_bytes bigint, overlap_bytes bigint"


def test_pieces_are_numbered_across_blocks_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(split, "COUNTED", 3)
    rows = [("file", 1, k, 0, 0, 0) for k in range(20) for _ in range(k % 4)]
    got = {r.range_no: r.first_no for r in split.first_numbers(spark.createDataFrame(rows, split._PIECES)).collect()}
    assert got == {k: sum(j % 4 for j in range(k)) for k in range(20) if k % 4}


def test_a_file_larger_than_memory_allows(tmp_path):
    """Ranges of a sparse file of 4 GB are planned one by one; each is read with its halos only."""
    import os
    import tracemalloc

    path, size, limit, step = tmp_path / "sparse", 4 << 30, 1 << 20, 8 << 20
    with open(path, "wb") as f:
        f.truncate(size)
        f.seek(3 << 30)
        f.write(b"one line\n" * 1000)
    tracemalloc.start()
    last, pieces = None, 0
    for k in [0, 1, 2, 383, 384, 385, size // step - 1]:
        base, stop = max(0, k * step - limit - limit // 2 - 2 * split.HALO), min(size, (k + 1) * step + 2 * split.HALO)
        found = split.plan_range(split.read_range(str(path), base, stop), base, size, k, step, limit, 0)
        assert all(0 < b - a <= limit for a, b in found) and all(x[1] == y[0] for x, y in zip(found, found[1:]))
        assert last is None or last[0] != k - 1 or last[1] == found[0][0]
        last, pieces = (k, found[-1][1]), pieces + len(found)
    assert last[1] == size and tracemalloc.get_traced_memory()[1] < 1 << 26 and os.stat(path).st_size == size
