import ast
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from wickwork.llm import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    return None if v is None else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = c.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    theirs = sorted(str([plain(r[names.index(x)]) for x in columns]) for r in result.fetchall())
    assert sorted(names) == columns and sorted(str([plain(r[x]) for x in columns]) for r in df.collect()) == theirs


def test_all_are_registered():
    found = entry.queries()
    assert "pipeline" in found and all(any(k.startswith(f"op{n}_") for k in found) for n in range(1, 11))


def test_nothing_else_imports_this_subpackage():
    root = Path(entry.__file__).parent
    for f in (root / "wickwork").rglob("*.py"):
        if "llm" not in f.parts:
            for node in ast.walk(ast.parse(f.read_text())):
                if isinstance(node, (ast.Import, ast.ImportFrom)):
                    assert "llm" not in ast.unparse(node), f
