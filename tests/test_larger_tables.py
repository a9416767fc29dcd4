"""What only shows with more rows or other ids than the test tables have."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from terraloom.operators import history
from terraloom.operators.closure import reachable
from terraloom.plans import adapter as ad
from terraloom.scratch import WorkTables

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture
def tables(tmp_path):
    """A maker of copies of the test tables, some replaced by what SQL over all of them gives: its folder, and DuckDB over it."""

    def make(**changed):
        con = duckdb.connect()
        con.execute("SET TimeZone = 'UTC'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        for t in TABLES:
            con.execute(f"COPY ({changed.get(t, 'FROM ' + t)}) TO '{tmp_path}/{t}.parquet'")
        for t in TABLES:
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        return str(tmp_path), con

    return make


def assert_as_sql(spark, made, name):
    folder, con = made
    df = entry.queries()[name](spark, folder)
    names = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in df.select(*names).collect()]
    assert got
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_ways_between_nodes_in_one_place_are_open(spark, tables):
    twin = "SELECT * REPLACE (l_partkey + CASE WHEN l_linenumber > 1 THEN 612000 ELSE 0 END AS l_partkey) FROM lineitem"
    one = f"SELECT * REPLACE (CASE WHEN l_partkey < 612000 THEN 7 ELSE 612007 END AS l_partkey) FROM ({twin})"
    made = tables(part="FROM part UNION ALL SELECT * REPLACE (p_partkey + 612000 AS p_partkey) FROM part", lineitem=one)
    assert_as_sql(spark, made, "way_vertex_stats")


def test_members_without_a_row_of_their_own_are_wanted_too(spark, tables):
    made = tables(customer="FROM customer UNION ALL SELECT * REPLACE (c_custkey + 700000 AS c_custkey) FROM customer WHERE c_custkey < 3", part="FROM part WHERE p_partkey <> 41")
    assert_as_sql(spark, made, "augment_rows")


def test_members_of_relations_are_not_compared_in_pairs(spark, monkeypatch):
    plans, keep = [], WorkTables.keep
    monkeypatch.setattr(WorkTables, "keep", lambda self, df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(self, df, name))
    assert entry.queries()["relation_complete"](spark, SF).count()
    assert any("explode(members" in p for p in plans) and not any("array_distinct(transform(members" in p for p in plans)


def test_lines_of_relations_are_kept_if_all_are_empty(spark, tables):
    made = tables(lineitem="SELECT lineitem.* FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey % 8 <> 1")
    assert_as_sql(spark, made, "relation_multiline_wkt")


def test_customers_with_ids_of_nations_are_drawn_too(spark, tables):
    made = tables(orders=f"SELECT * REPLACE (o_custkey + CASE WHEN o_custkey < 99 THEN {ad.NATION} ELSE 0 END AS o_custkey) FROM orders")
    assert_as_sql(spark, made, "relation_multiline_wkt")


@pytest.mark.parametrize("name", ["augmented_routes", "relation_multiline_wkt"])
def test_only_what_is_asked_for_is_drawn(spark, monkeypatch, name):
    kept, keep = {}, WorkTables.keep

    def noted(self, df, table):
        kept[table] = keep(self, df, table)
        return kept[table]

    monkeypatch.setattr(WorkTables, "keep", noted)
    assert entry.queries()[name](spark, SF).count()
    assert "ready-0" not in kept  # no level of relations of relations
    assert [r.type for r in kept["level-0"].select("type").distinct().collect()] == ["way"]


@pytest.mark.parametrize("name", ["histories_by_id", "relation_before_window", "relation_complete"])
def test_vertices_are_not_listed_only_to_be_taken_apart(spark, monkeypatch, name):
    plans, keep = [], WorkTables.keep
    monkeypatch.setattr(WorkTables, "keep", lambda self, df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(self, df, name))
    assert entry.queries()[name](spark, SF).count()
    assert any("l_partkey" in p for p in plans) and not any("collect_list" in line and "l_partkey" in line for p in plans for line in p.split("\n"))


def test_vertices_apart_are_those_of_the_rows(spark):
    lists, apart = history.way_uses(ad.working_set(spark, SF)), ad.way_uses(spark, SF).distinct()
    assert sorted(map(tuple, lists.collect())) == sorted(map(tuple, apart.select(*lists.columns).collect()))


def test_several_searches_take_the_rounds_of_one(spark):
    seeds, steps = spark.createDataFrame([(1, "x"), (4, "y")], "v LONG, k STRING"), spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 2)], "src LONG, dst LONG")
    assert sorted(map(tuple, reachable(seeds, steps).collect())) == [(1, "x"), (1, "y"), (2, "x"), (2, "y"), (3, "x"), (3, "y"), (4, "y")]
