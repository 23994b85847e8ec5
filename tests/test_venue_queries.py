"""Every query over the smallest driver tables: against its SQL in DuckDB where it has one, else that it runs."""

import os

import pytest

from placeloom import job_queries, queries

SF = "/root/testdata/sf0.001"
assert job_queries.QUERIES is queries.QUERIES
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def plain(v):
    return "" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)


def against_sql(spark, query, sql):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = con.sql(sql)
    names = sorted(want.columns)
    got = query(spark, SF)
    assert sorted(got.columns) == names
    rows = lambda it: sorted(tuple(map(plain, r)) for r in it)
    assert rows(got.select(*names).collect()) == rows(con.sql(f"SELECT {', '.join(names)} FROM want").fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    against_sql(spark, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_fold_texts_is_whole(spark):
    from placeloom.functions import text

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.folded for r in queries.QUERIES["fold_texts"](spark, SF).collect()}
    assert got == {r.doc_id: r.f for r in docs.select("doc_id", text.fold(docs.text).alias("f")).collect()}
    assert len(got) == docs.count() and max(len(x or "") for x in got.values()) > 80


def test_clean_emails_finds_hidden_addresses(spark, tmp_path):
    rows = [(1, "write to info [at] redlion [dot] test today"), (2, "nothing here"), (3, "a@b"), (4, None), (5, "me@redlion.test")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.emails for r in queries.QUERIES["clean_emails"](spark, str(tmp_path)).collect()}
    assert got == {1: "info@redlion.test", 3: "", 5: "me@redlion.test"}


def test_log_follow_keeps_the_last_record(spark):
    want = {}
    for r in sorted(spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_id").collect(), key=lambda r: r.event_id):
        status = {0: "unknown", 1: "dead"}.get(r.event_id % 5, "ok")
        want[f"u{'/' * (r.user_id % 3 == 0)}{r.user_id}"] = (r.event_id, status, r.event_id % 4 + 1)
    got = queries.QUERIES["log_follow"](spark, SF).collect()
    assert len(got) == len(want) and {r.key: (r.pos, r.status, r.v) for r in got} == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 25
