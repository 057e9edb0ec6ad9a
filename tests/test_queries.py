"""Registered queries against their DuckDB SQL at the smallest scale, and the driver contract."""

import datetime
import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from strataforge.plans import catalogue, standard
from strataforge.plans.standard_queries import _bundle
from strataforge.plans.registry import Tables

ROOT = Path(__file__).resolve().parent.parent
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = catalogue.QUERIES[name](spark, sf)
    out = con.execute(catalogue.SQL[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(norm(r[names.index(c)]) for c in df.columns) for r in out.fetchall()), key=repr)
    assert sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr) == want


def test_contract():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and set(catalogue.QUERIES) <= set(queries)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1


@pytest.mark.parametrize("gone", [("strataforge/llm", "tests/llm"), ("strataforge/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_stands_without_the_training_data_operators(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for p in gone:
        if (copy / p).is_dir():
            shutil.rmtree(copy / p)
        else:
            (copy / p).unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [k for k in q if k.startswith('op') and k[2:3].isdigit()] and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    env = {"PATH": os.environ["PATH"], "HOME": str(tmp_path), "PYTHONPATH": str(copy)}
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=env)
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, check=True, env=env, capture_output=True, text=True).stdout
    assert "test_query_equals_sql" in found


def test_chain_gates_and_repeats(spark, sf):
    bundle = _bundle(Tables(spark, sf))
    a = standard.sample(bundle, 500, 1)
    assert a.count() == 500 and a.select("id").distinct().count() == 500
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, standard.sample(bundle, 500, 1).collect()))
    frozen, report = standard.release(bundle, 500, 60, 1, tv_limit=0.2, backoff_limit=1.0, correlation_limit=0.5)
    assert frozen.count() == 60 and report.filter("not passed").count() == 0
    with pytest.raises(ValueError, match="gates failed"):
        standard.release(bundle, 500, 60, 1, tv_limit=0.0)
