import importlib
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parents[1]
DATA = Path("/root/testdata/sf0.001")
CORE = {n: q for m in entry.MODULES for n, q in importlib.import_module(m).QUERIES.items()}
SQL = {n: q for m in entry.MODULES for n, q in importlib.import_module(m).SQL.items()}


def test_names_agree():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert {f"p{n}_found" for n in (1, 2, 3, 4, 5, 6, 7)} <= set(queries)


def test_core_stands_without_the_text_subpackage():
    code = "import sys; sys.modules['quillstone.llm'] = None; import __spark_entry__ as e; assert 'p7_found' in e.queries() and not any(n.startswith('p8') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
    for path in (REPO / "quillstone").rglob("*.py"):
        if "llm" not in path.parts:
            assert "quillstone.llm" not in path.read_text(), path


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    return str(v)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, oracle, name):
    df = CORE[name](spark, str(DATA))
    columns = sorted(df.columns)
    relation = oracle.execute(SQL[name])
    got_columns = [d[0] for d in relation.description]
    assert sorted(got_columns) == columns
    at = [got_columns.index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(set(CORE) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    df = CORE[name](spark, str(DATA))
    assert len(set(df.columns)) == len(df.columns) and df.count() >= 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
