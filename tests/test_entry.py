from __future__ import annotations

import os
import subprocess
import sys
import textwrap

import duckdb
import pytest

import __spark_entry__ as entry
from terraloom import cli
from terraloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(rows):
    return sorted(repr(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows, names = df.collect(), sorted(df.columns)
    assert rows
    if name in catalog.ORACLE_SQL:
        out = duck.execute(f"SELECT {', '.join(names)} FROM ({catalog.ORACLE_SQL[name]})").fetchall()
        assert comparable([[r[n] for n in names] for r in rows]) == comparable(out)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_everything_but_the_training_operators_stands_alone():
    code = """
        import sys, importlib.abc
        class Block(importlib.abc.MetaPathFinder):
            def find_spec(self, name, path, target=None):
                if name == "corpus_pipeline" or name.startswith("terraloom.llm"):
                    raise ModuleNotFoundError("gone", name="terraloom.llm" if name.startswith("terraloom.llm") else name)
        sys.meta_path.insert(0, Block())
        import __spark_entry__ as e
        assert "closure_full" in e.queries() and "pipeline" not in e.queries() and not any(k.startswith("op") for k in e.oracle_sql() if k[2:3].isdigit())
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=os.path.dirname(entry.__file__))


def test_command_line():
    a = cli.parser().parse_args(["diff", "--changes", "/c/AAA/BBB/CCC.osc", "--root", "/r", "--range", "1,-1"])
    assert a.range == "1,-1" and a.compact_every == 5
    assert cli.parser().parse_args(["index", "--snapshot", "s", "--root", "r"]).command == "index"
