"""Every registered query of the training-data operators: against its SQL where there is some, else its columns and rows."""

import duckdb
import pytest

from strataforge.llm import queries

COLUMNS = {
    "op2_bpe": (["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], "documents"),
    "op3_url_filter": (["page_id", "host", "path", "rule", "verdict"], "pages"),
    "op6_packing": (["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], None),
    "op7_toxicity": (["doc_id", "held_out", "score", "predicted"], "documents"),
    "op9_quality": (["doc_id", "held_out", "score", "predicted"], "documents"),
    "op10_ivfpq": (["query_id", "rank", "vec_id", "score"], None),
}


def test_all_are_covered():
    assert set(queries.SQL) | set(COLUMNS) == set(queries.QUERIES) and not set(queries.SQL) & set(COLUMNS)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    out = con.execute(queries.SQL[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in df.columns) for r in out.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_what_it_should(spark, sf, name):
    columns, table = COLUMNS[name]
    df = queries.QUERIES[name](spark, sf)
    assert df.columns == columns
    if table:
        assert df.count() == spark.read.parquet(f"{sf}/{table}.parquet").count()
