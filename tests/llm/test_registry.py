"""The entry module registers the queries of this subpackage, and works without this subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tillwise.llm import queries

TOP = Path(entry.__file__).parent


def test_every_operator_has_a_query():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == [] and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("embeddings", "conversations", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    found = queries.queries()[name](spark, sf)
    want = con.execute(queries.oracle_sql()[name])
    assert [d[0] for d in want.description] == found.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_entry_without_the_subpackage():
    code = "import sys; sys.modules['tillwise.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=TOP, check=True)


def test_nothing_else_imports_it():
    own = [p for p in (TOP / "tillwise").rglob("*.py") if "llm" not in p.parts]
    assert own and not any("tillwise.llm" in p.read_text() for p in own)
