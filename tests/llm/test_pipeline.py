import duckdb
import pytest

import corpus_pipeline
from datasheaf.llm import queries


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data).cache()
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
        if name == "toxicity":
            assert sum(labels.get(r.doc_id) == 1 for r in docs.collect()) <= 0.5 * sum(x == 1 for x in labels.values())
    texts = [" ".join(r.text.split()) for r in docs.collect()]
    assert len(texts) == len(set(texts))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}


def test_run_equals_stages(spark, data):
    packed = corpus_pipeline.run(spark, data)
    assert packed.columns[:2] == ["doc_id", "start"] and packed.count() > 0


def long_text(seed):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice("the of and a to in that is was for it with as his on be at by".split() if rng.random() < 0.4 else ["".join(rng.choice("abcdefgh") for _ in range(5))]) + ("." if i % 12 == 11 else "") for i in range(200))


@pytest.fixture
def folder(spark, edges, tmp_path):
    """Edge rows, with good texts among them: a null id, copies, near copies, repeated rows, clashing column names."""
    good = [long_text(i) for i in range(4)]
    rows = [(20, good[0]), (21, good[0]), (22, good[0].replace("the", "tho", 1)), (23, good[1]), (23, good[1]), (None, good[2]), (24, good[2] + "  "), (25, good[3])]
    more = spark.createDataFrame([(i, x, "x", 7, True, "y", 1.0, "z") for i, x in rows], edges.schema)
    edges.unionByName(more).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(20, 1, 0), (1, 0, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    return f"file://{tmp_path}"


def test_edge_rows_through_all_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
    assert sorted(str(r.doc_id) for r in docs.collect() if r.doc_id != 7) == ["20", "23", "24", "25"]
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_no_rows_through_all_stages(spark, folder, tmp_path):
    empty = f"file://{tmp_path}/empty"
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    df = queries.QUERIES[name](spark, data)
    cursor = con.execute(queries.SQL[name])
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(at) == sorted(df.columns)
    assert sorted(tuple(str(r[c]) for c in sorted(at)) for r in df.collect()) == sorted(tuple(str(r[at[c]]) for c in sorted(at)) for r in cursor.fetchall())


def test_guard(monkeypatch):
    """Without the subpackage the entry module still has the other queries."""
    import builtins
    import importlib

    import __spark_entry__

    real = builtins.__import__

    def without(name, globals=None, locals=None, fromlist=(), level=0):
        if name.startswith("datasheaf.llm"):
            raise ImportError(name)
        return real(name, globals, locals, fromlist, level)

    monkeypatch.setattr(builtins, "__import__", without)
    entry = importlib.reload(__spark_entry__)
    assert "flagship" in entry.queries() and not [q for q in entry.queries() if q.startswith("op")]
    monkeypatch.undo()
    assert "op1_url_filters" in importlib.reload(__spark_entry__).queries()
