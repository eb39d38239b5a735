"""Registered queries against their SQL in DuckDB, and the shape of their plans."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def table(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["all_stages", "refine_topics"])
def test_query_without_sql_returns_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["topic_counts", "match_existing", "doc_topics", "grounding_hallucinated", "apply_corrections", "contingency", "merge_counts", "similar_topics", "topic_pairs", "assign_topics"]
)
def test_plans_have_no_product_of_tables(spark, name):
    plan = physical(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # one task may only ever combine what the others have aggregated
    after = re.findall(r"Exchange SinglePartition.*\n(.*)\n", plan)
    assert all("partial_" in line for line in after), after


def test_scans_read_only_what_they_need(spark):
    plan = physical(entry.queries()["error_rows"](spark, SF))
    assert re.search(r"ReadSchema: struct<doc_idx:bigint,responses:string>", plan)
    sizes = physical(entry.queries()["token_counts"](spark, SF))
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", sizes)
