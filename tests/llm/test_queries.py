"""The registered queries: names, SQL twins, and the rest without this subpackage."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as E
from fieldstack.llm import queries as Q

REPO = os.path.dirname(os.path.abspath(E.__file__))


def test_names():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(Q.ORACLE) <= set(Q.QUERIES)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql_twins(spark, documents, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{documents[0]}/{t}.parquet')")
    got = Q.QUERIES[name](spark, documents[0])
    rel = con.execute(Q.ORACLE[name])
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(got.columns)
    key = lambda rows: sorted(map(repr, rows))      # noqa: E731
    assert key(tuple(r) for r in got.select(*cols).collect()) == key(rel.fetchall())


def test_the_rest_stands_alone(tmp_path):
    """Without the subpackage and the pipeline the registry holds the other queries."""
    import shutil
    for name in ("__spark_entry__.py", "fieldstack"):
        src = os.path.join(REPO, name)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(
            src, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if os.path.isdir(src) else {}))
    code = "import __spark_entry__ as e; n = set(e.queries()); assert 'field_stack' in n and not any(x[:2] == 'op' for x in n); assert 'pipeline' not in n; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
