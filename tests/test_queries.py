"""Every query against its SQL, over the smallest tables."""

import datetime

import __spark_entry__ as entry
import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return float(v) if type(v).__name__ == "Decimal" else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    """Imports of everything else in a copy without the subpackage and the pipeline."""
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(entry.__file__).parent
    shutil.copytree(root / "ledgerleaf", tmp_path / "ledgerleaf", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import re, __spark_entry__ as e; assert not [n for n in e.queries() if re.match(r'op[0-9]', n) or n == 'pipeline']; print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)
    assert int(out.stdout.strip().splitlines()[-1]) > 15
