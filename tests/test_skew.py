"""Every registered query against its SQL where one key holds a third of all rows, or values are missing."""

import duckdb
import pytest

from feedloom.suite import ORACLES, QUERIES
from tests.oracle import compare, sql_session

SF_DIR = "/root/testdata/sf0.001"

# One leg key, customer, user, host and source with a third of all rows each.
HOT = {
    "lineitem": """* replace (case when l_orderkey % 3 = 0 then 7 else l_partkey end as l_partkey,
        case when l_orderkey % 3 = 0 then 1 else l_linenumber end as l_linenumber,
        case when l_orderkey % 3 = 0 then 5.0 else l_quantity end as l_quantity)""",
    "orders": """* replace (case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey,
        case when o_orderkey % 3 = 0 then '1-URGENT' else o_orderpriority end as o_orderpriority)""",
    "events": "* replace (case when event_id % 3 = 0 then 7 else user_id end as user_id)",
    "pages": """* replace (case when page_id % 3 = 0 then concat('https://hot.example.com/en/', page_id, '?page=1')
        else url end as url)""",
    "documents": "* replace (case when doc_id % 3 = 0 then 'src0' else source end as source)",
}


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    out = tmp_path_factory.mktemp("hot")
    for file in sql_files():
        columns = HOT.get(file.stem, "*")
        duckdb.sql(f"copy (select {columns} from read_parquet('{file}')) to '{out / file.name}' (format parquet)")
    return str(out)


def sql_files():
    from pathlib import Path

    return sorted(Path(SF_DIR).glob("*.parquet"))


@pytest.fixture(params=["broadcasts", "shuffles"])
def joined(spark, request):
    """Joins as Spark likes them, and with all of them shuffled."""
    if request.param == "shuffles":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_hot_keys(spark, hot_dir, joined, name):
    (kinds, rows), (sql_kinds, sql_rows) = compare(QUERIES[name](spark, hot_dir), sql_session(hot_dir), ORACLES[name])
    assert kinds == sql_kinds
    assert rows - sql_rows == sql_rows - rows
