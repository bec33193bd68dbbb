import os

import pytest

from loomgraph.llm import queries
from tests.oracle import FOLDER, connect, same

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
COLUMNS = {
    "p1_found": {"file_id"}, "p2_found": {"item_kind", "row_id", "line_no"}, "p4_found": {"repo", "file_path"}, "p6_found": {"item_kind", "row_id"}, "p7_found": {"doc_id", "item_id"}, "p9_found": {"doc_id", "subject"},
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    if name in COLUMNS:
        assert set(df.columns) == COLUMNS[name]
        assert df.count() == df.distinct().count()
    if name in queries.SQL:
        pytest.importorskip("duckdb")
        same(spark, connect(), queries.QUERIES[name], queries.SQL[name])
    else:
        df.count()


def rows(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


def test_redacted_texts_hold_no_credential(spark):
    """As many credentials are replaced as lines were found or more, and nothing is found in what is left."""
    from loomgraph.llm import secrets

    found: dict = {}
    for r in rows(spark, "p2_found"):
        found.setdefault((r.item_kind, r.row_id), set()).add(r.line_no)
    done = {(r.item_kind, r.row_id): r for r in rows(spark, "p2_redacted")}
    assert set(found) == set(done) and all(done[k].n_credentials >= len(v) for k, v in found.items())
    f = secrets.finder(secrets.VOCABULARY)
    assert not [k for k, r in done.items() if f.lines(r.redacted)]


def test_pieces_put_together_are_the_text(spark):
    chunks = {r.chunk_id: r.body for r in spark.read.parquet(f"{FOLDER}/chunks.parquet").collect()}
    files = {r.file_id: r.content for r in spark.read.parquet(f"{FOLDER}/source_files.parquet").collect()}
    pieces: dict = {}
    for r in rows(spark, "p6_pieces"):
        pieces.setdefault((r.item_kind, r.row_id), []).append(r)
    assert set(pieces) == {tuple(r) for r in rows(spark, "p6_found")}
    for (kind, i), mine in pieces.items():
        raw = (chunks if kind == "chunk" else files)[i].encode()
        mine.sort(key=lambda r: r.piece_no)
        assert [r.piece_no for r in mine] == list(range(len(mine)))
        assert mine[0].start_byte == 0 and mine[-1].end_byte == len(raw) and all(a.end_byte >= b.start_byte for a, b in zip(mine, mine[1:]))
        assert all(raw[r.start_byte : r.end_byte].decode() == r.piece for r in mine)


def test_leaked_items_are_those_of_the_documents(spark):
    count: dict = {}
    for r in rows(spark, "p7_found"):
        count[r.item_id] = count.get(r.item_id, 0) + 1
    assert {r.item_id: r.n_docs for r in rows(spark, "p7_items")} == count


def test_shares_are_those_of_the_mixture(spark):
    tokens: dict = {}
    targets = {(r.mix_name, r.source.strip().lower()): r for r in spark.read.parquet(f"{FOLDER}/mix_targets.parquet").collect()}
    for r in rows(spark, "p8_mixture"):
        assert 1 <= r.copies <= targets[r.mix_name, r.source].max_repeats
        tokens[r.mix_name, r.source] = tokens.get((r.mix_name, r.source), 0) + r.copies * r.n_tokens
    for r in rows(spark, "p8_shares"):
        mine = tokens.get((r.mix_name, r.source), 0)
        assert r.tokens == mine and abs(r.actual_share - mine / sum(v for (m, _), v in tokens.items() if m == r.mix_name)) < 1e-5


def test_composition_counts_the_documents(spark):
    found: dict = {}
    for r in rows(spark, "p9_found"):
        found.setdefault(r.subject, set()).add(r.doc_id)
    assert {r.subject: r.n_docs for r in rows(spark, "p9_composition")} == {k: len(v) for k, v in found.items()}


def test_rates_count_the_files(spark):
    bad = {r.file_id for r in rows(spark, "p1_found")}
    assert sum(r.n_failed for r in rows(spark, "p1_rates")) == len(bad) > 0
