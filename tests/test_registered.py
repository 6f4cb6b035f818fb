from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as registered
from earshot.registered import duckdb_sql, spark_queries
from tests.oracle import connect, differences
from tests.plans import plan_of, shuffle_keys

# Text operators have tests of their own beside their subpackage's.
QUERIES, SQL = dict(spark_queries.QUERIES), dict(duckdb_sql.ORACLE_SQL)
PACKAGE = Path(__file__).resolve().parent.parent / "earshot"


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(spark, db, sf_dir, name):
    n, found = differences(spark, db, QUERIES[name], SQL[name], sf_dir)
    assert not found
    assert n > 0


def test_every_query_has_sql_and_is_registered():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= registered.queries().items()
    assert SQL.items() <= registered.oracle_sql().items()


@pytest.mark.parametrize("name", ["model_save_load", "als_coverage", "als_optimality", "cold_pairs_filled"])
def test_ratings_are_derived_once(spark, sf_dir, name):
    """What is read after a fit comes from a stored table, not from the join behind it."""
    assert "lineitem" not in plan_of(QUERIES[name](spark, sf_dir))


def test_unrated_recommendations_are_checked_without_a_second_join(spark, sf_dir):
    assert "lineitem" not in plan_of(QUERIES["job_recommend_unrated"](spark, sf_dir))


def test_optimality_sums_where_users_meet_their_pairs(spark, sf_dir):
    """Without a shuffle of the sums, of which there would be nearly one for each pair."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = shuffle_keys(plan_of(QUERIES["als_optimality"](spark, sf_dir)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    by = [[name.split("#")[0] for name in key.split(", ")[:-1]] for key in keys]
    assert by and all(key in (["userId"], ["sourceId"], ["id"]) for key in by), by


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["userId", "recommendations"]
    assert frame.count() == 150


def test_no_rows_pass_through_the_driver():
    """Only counts, shard summaries and metric rows are ever collected."""
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.parts:
            continue
        text = path.read_text()
        banned = r"\.rdd\b|toPandas|toLocalIterator|localCheckpoint|\.cache\("
        assert not re.search(banned, text), path
        collects = text.count(".collect()")
        bounded = {"jobs.py": 2, "topk.py": 2, "split.py": 1, "cell_store.py": 1}
        # The users that a query looks up, and the days it writes folders for.
        bounded["spark_queries.py"] = 2
        assert collects <= bounded.get(path.name, 0), path


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_pairs_everything_with_everything(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
