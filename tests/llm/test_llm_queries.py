"""Every corpus query on the given tables: against its SQL, or for its shape."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from coinstrata.llm.oracle import ORACLE
from coinstrata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels", "embeddings"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, SF)
    result = database.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == expected


def test_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "pipeline" in names
    assert set(contract.oracle_sql()) <= set(names)


def test_pipeline_is_its_stages(spark, database):
    """The stages, composed by hand from what the operators report."""
    kept = {r.doc_id: r.pieces for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, SF)
        assert docs.columns == corpus_pipeline.COLUMNS
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before, name
        if name == "line_dedup":
            assert after == before
    assert after == set(kept)
    clean = database.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert len(kept) > 0.7 * clean
    import sentencepiece

    from coinstrata.llm.pieces import default_model

    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    for row in docs.collect():
        assert kept[row.doc_id] == library.encode(row.text)


def test_stages_handle_edge_rows(spark, edges):
    """Every stage takes null and empty texts, repeated and null ids, and empty tables."""
    columns = corpus_pipeline.COLUMNS
    docs = edges.selectExpr("doc_id", "text", "lang", "source", "cast(null as long) n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == docs.count(), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        if name != "tokenize":
            assert out.columns == columns


def test_repeated_ids_with_other_texts_are_judged_by_row(spark):
    one = " ".join(f"word{i}" for i in range(200))
    two = " ".join(f"other{i}" for i in range(200))
    rows = [(1, one), (2, one + " more"), (2, two), (3, two), (3, two), (None, one), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == sorted([(1, one), (2, two), (0, one), (4, ""), (5, "")])
