"""Shapes of physical plans, without broadcasts: what is read and what is shuffled."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries
from cinestar.sources.fixtures import raw_credits

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark, no_broadcast):
    return lambda name: queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def columns_read(text):
    return set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*)>", text))))


def test_ratings_read_two_columns(plan):
    text = plan("fact_ratings")
    assert columns_read(text) == {"l_partkey", "l_quantity"} and "Exchange" not in text


def test_votes_shuffle_each_side_once(plan):
    """Unique films and totals both arrive partitioned by film; the join adds no exchange."""
    text = plan("film_votes")
    assert text.count("Exchange hashpartitioning") == 2 and "partial_avg" in text


def test_dimensions_shuffle_for_the_choice_of_a_copy_only(plan):
    for name in ("dim_popularity", "dim_status", "film_keywords"):
        assert plan(name).count("Exchange hashpartitioning") == 1, name
    assert "Exchange" not in plan("event_props")


def test_star_reads_the_bucketed_table_and_nothing_else(plan):
    """Parts and line items are read once, when the table is saved; its reassembly shuffles nothing."""
    text = plan("star_films")
    assert "Exchange" not in text and "part.parquet" not in text and "lineitem.parquet" not in text
    for name in ("star_by_genre", "star_by_country", "star_by_language"):
        assert plan(name).count("Exchange hashpartitioning") == 1, name


def test_printed_texts_join_after_the_line_items(plan):
    """Only keys cross the join of line items and orders."""
    text = plan("dim_cast")
    orders = re.search(r"FileScan parquet .*orders\.parquet.*ReadSchema: struct<([^>]*)>", text)
    assert set(re.findall(r"(\w+):", orders[1])) == {"o_orderkey", "o_custkey", "o_orderstatus"}
    assert text.index("customer.parquet") > 0 and text.count("lineitem.parquet") == 1


def test_top_films_sorts_no_whole_table(plan):
    assert "TakeOrderedAndProject(limit=20" in plan("top_films")


def test_no_cross_joins(plan):
    lazy = ("star_films", "star_by_genre", "star_by_company", "poster_labels", "film_posters", "dim_cast")
    for name in lazy:
        text = plan(name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


KEYS = ("o_custkey", "l_orderkey")


def test_members_are_printed_per_order_not_per_line_item(spark):
    """Customers join the orders, which are fewer, below the join of the line items."""
    plan = raw_credits(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = {key: min(line.index("Join") for line in plan if f"Join Inner, ({key}" in line) for key in KEYS}
    assert depth["o_custkey"] > depth["l_orderkey"]
