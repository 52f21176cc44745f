import pytest
from oracle import compare, views

import __spark_entry__ as entry
from ledgerloom.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return views(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    assert name in catalog.ORACLE_SQL
    compare(catalog.QUERIES[name](spark, sf_dir), con, catalog.ORACLE_SQL[name])


def test_entry(spark):
    assert entry.entry(spark).columns == ["prefix", "key", "value"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["entity_documents", "validate_key", "hash_diff", "batch_lookup", "conformance_report", "shard_index"])
def test_no_python_in_plans(spark, sf_dir, name):
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_partition_filters_and_broadcast(spark, sf_dir):
    plan = lambda n: catalog.QUERIES[n](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pfx" in plan("scan_partitioned_orders") or "pfx#" in plan("scan_partitioned_orders").split("PartitionFilters: [")[1].split("]")[0]
    assert "BroadcastHashJoin" in plan("chained_lookup")
