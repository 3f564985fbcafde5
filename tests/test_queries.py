"""Every registered query equals its checking SQL in DuckDB."""

import glob
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402
from orderloom.plans.oracle import ORACLES  # noqa: E402
from orderloom.plans.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def _sorted(rows):
    return sorted(rows, key=repr)


FAMILY = {"tinyint": "int", "smallint": "int", "integer": "int", "bigint": "bigint", "varchar": "string"}


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_matches_sql(spark, duck, name):
    found = driver.queries()[name](spark, SF_DIR)
    names = sorted(found.columns)
    expected = duck.sql(driver.oracle_sql()[name])
    assert sorted(expected.columns) == names
    kinds = {c: FAMILY.get(str(t).lower(), str(t).lower()) for c, t in zip(expected.columns, expected.types)}
    assert dict(found.dtypes) == kinds
    rows = [tuple(row) for row in found.select(*names).collect()]
    wanted = duck.sql(f"select {', '.join(names)} from expected").fetchall()
    assert len(rows) == len(wanted)
    assert _sorted(rows) == _sorted(wanted)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_works_without_the_subpackage_for_training_data(tmp_path):
    """Also where only compiled leftovers of it are in place."""
    top = os.path.dirname(os.path.abspath(driver.__file__))
    shutil.copytree(f"{top}/orderloom", tmp_path / "orderloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(driver.__file__, tmp_path)
    for leftover in (False, True):
        if leftover:
            (tmp_path / "orderloom" / "llm" / "__pycache__").mkdir(parents=True)
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
        found = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True, check=True)
        assert found.stdout.split() == [str(len(QUERIES))] * 2


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
