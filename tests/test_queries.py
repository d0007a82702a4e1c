"""Every registered query against its SQL on DuckDB, over whole tables."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from widerow.plans import oracles  # noqa: E402
from widerow.plans import queries as plans  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "customer orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(plans.queries()) == set(oracles.oracle_sql())


def test_all_are_registered():
    assert set(plans.queries()) <= set(contract.queries())
    assert set(oracles.oracle_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_matches_sql(spark, duck, name):
    df = plans.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(r) for r in df.select(columns).collect())
    result = duck.execute(oracles.oracle_sql()[name])
    assert sorted(d[0] for d in result.description) == columns
    order = [[d[0] for d in result.description].index(c) for c in columns]
    expected = sorted(tuple(row[i] for i in order) for row in result.fetchall())
    assert got
    assert got == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_core_without_the_subpackage_or_its_dependencies():
    """Whatever of the optional part is missing, the core queries are there."""
    script = """
        import sys
        sys.path.insert(0, {root!r})
        class Missing:
            def find_spec(self, name, path=None, target=None):
                if name == {name!r}:
                    raise ModuleNotFoundError(f"No module named {{name}}", name=name)
        sys.meta_path.insert(0, Missing())
        import __spark_entry__ as e
        print("GOT", len(e.queries()), len(e.oracle_sql()))
    """
    root = str(Path(contract.__file__).parent)
    n = len(plans.queries())
    for name, there in (
        ("regex", True), ("xxhash", True), ("widerow.llm", True), ("corpus_pipeline", True),
        ("widerow.sources.base", False),
    ):
        code = textwrap.dedent(script.format(root=root, name=name))
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
        assert (f"GOT {n} {n}" in done.stdout) == there, (name, done.stderr[-500:])
