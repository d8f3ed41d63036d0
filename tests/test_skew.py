"""Hot keys: a third of the line items each on one order, one part and one supplier; copied parts."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from cinestar.plans import registry
from cinestar.sources import fixtures as raw
from tests.compare import TABLES, connect, differences

SF_DIR = "/root/testdata/sf0.001"

SKEWED = {
    "lineitem": """
SELECT CASE WHEN n % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
       CASE WHEN n % 3 = 1 THEN 9 ELSE l_partkey END AS l_partkey,
       CASE WHEN n % 3 = 2 THEN 0 ELSE l_suppkey END AS l_suppkey,
       * EXCLUDE (n, l_orderkey, l_partkey, l_suppkey)
FROM (SELECT *, row_number() OVER () AS n FROM source)""",
    "part": """
SELECT * FROM source
UNION ALL
SELECT copy.* FROM source copy, range(0, (SELECT count(*) // 2 FROM source)) WHERE p_partkey = 12
UNION ALL
SELECT p_partkey, NULL AS p_name, 'Brand#7' AS p_brand, 'ZZZ' AS p_type, p_size, p_retailprice - 500
FROM source WHERE p_partkey IN (12, 13)
UNION ALL
SELECT p_partkey, 'a ' || p_name, p_brand, 'AAA', NULL, p_retailprice FROM source
WHERE p_partkey BETWEEN 13 AND 40""",
    "orders": """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey, * EXCLUDE (o_custkey)
FROM source""",
}

# Every query over films, credits or ratings; the remapped ratings are left out
# where copies of a part disagree on the brand that the mapping is made of.
QUERIES = sorted(
    set(oracle_sql()) & set(registry.QUERIES)
    - {"event_props", "conversation_turns", "csv_roundtrip", "parquet_stage", "daily_rerun"}
)
UNIQUE = {
    "dim_countries": "country_id",
    "dim_companies": "company_id",
    "dim_languages": "id",
    "film_keywords": "id",
    "hash_keys": "row_key",
    "dim_cast": "id",
    "dim_status": "id",
    "dim_overview": "id",
    "dim_homepages": "homepage_id",
    "star_films": "film_id",
    "fact_films": "id",
    "poster_locations": "film_id",
}


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in TABLES:
        sql = SKEWED.get(name, "SELECT * FROM source")
        connection.execute(
            f"COPY (WITH source AS (SELECT * FROM '{SF_DIR}/{name}.parquet') {sql}) "
            f"TO '{folder}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)"
        )
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_with_hot_keys(spark, skewed_dir, name):
    result = queries()[name](spark, skewed_dir)
    assert differences(result, connect(skewed_dir), oracle_sql()[name]) == []
    if name in UNIQUE:
        keys = result.select(UNIQUE[name])
        assert keys.count() == keys.distinct().count() > 0


def test_the_hot_film_keeps_its_whole_cast_and_its_companies(spark, skewed_dir):
    connection = connect(skewed_dir)
    members = connection.execute(
        "SELECT count(DISTINCT (o_custkey, o_orderstatus)) FROM lineitem "
        "JOIN orders ON o_orderkey = l_orderkey WHERE l_partkey = 9"
    ).fetchall()[0][0]
    suppliers = connection.execute(
        "SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_partkey = 9"
    ).fetchall()[0][0]
    cast = queries()["dim_cast"](spark, skewed_dir)
    companies = queries()["dim_companies"](spark, skewed_dir)
    assert cast.where("film_id = 9").count() == members > 40
    assert companies.where("film_id = 9").count() == suppliers > 2


def test_hot_order_is_split_among_join_tasks(spark, skewed_dir):
    """Without broadcasts and at a scaled-down threshold, AQE cuts the hot partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.files.maxPartitionBytes": "16KB",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        credits = raw.raw_credits(spark, skewed_dir)
        credits.collect()
        plan = credits._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
