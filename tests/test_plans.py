"""Plan checks: the physical plans are the ones meant for scale."""

import pytest

from spark_recs.plans import catalog
from spark_recs.plans.inspect import executed_plan, final_plan

from conftest import SF_SMALL


def test_dense_ids_have_no_single_partition_exchange(spark):
    plan = executed_plan(catalog.item_id_map(spark, SF_SMALL))
    assert "SinglePartition" not in plan


def test_sequence_is_numbered_by_user_and_day(spark):
    import re
    plan = executed_plan(catalog.Tables(spark, SF_SMALL).seq)
    assert re.search(r"row_number\(\) windowspecdefinition\(user_id#\w+, _cell#", plan)
    assert "SinglePartition" not in plan
    # rows and cells come from one shuffle of the log, which is read once
    final = final_plan(catalog.Tables(spark, SF_SMALL).seq)
    assert final.count("FileScan") == 3 and "ReusedExchange" in final


@pytest.mark.parametrize("key, most", [("user_sequence", 3), ("split_temporal_train", 3), ("popularity_damped", 3), ("metrics_per_user", 6),
                                       ("metrics_at_k", 6), ("eval_topk_left", 6), ("eval_popularity", 6), ("als_train_counts", 3)])
def test_tables_are_scanned_a_few_times(spark, key, most):
    assert 0 < final_plan(catalog.QUERIES[key](spark, SF_SMALL)).count("FileScan") <= most


def test_topk_is_partial_before_exchange(spark):
    # global top-k: per-task partial top-k, then a k-row merge
    plan = executed_plan(catalog.popularity_interactions(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan or "WindowGroupLimit" in plan
    # top-k per key: partial WindowGroupLimit below the exchange
    plan = executed_plan(catalog.popularity_beta_sweep(spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_scan_prunes_columns(spark):
    plan = executed_plan(catalog.canonical_items(spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_cutoff_filter_pushed_to_scan(spark):
    plan = executed_plan(catalog.canonical_items(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan


def test_partitioned_write_prunes(spark):
    from pyspark.sql import functions as F
    from spark_recs.operators import split
    from spark_recs.session import scratch_path
    from spark_recs.sources import schemas
    t = catalog.Tables(spark, SF_SMALL)
    path = scratch_path(spark, "prune")
    schemas.write_parquet(split.with_split_column(t.seq), path, partition_by=["split"])
    df = spark.read.parquet(path).filter(F.col("split") == "train")
    plan = executed_plan(df)
    assert "PartitionFilters: [isnotnull(split" in plan


def test_no_cross_joins_or_row_udfs_in_any_query(spark):
    import __spark_entry__ as E
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
    found = {}
    for key, fn in E.queries().items():
        if key == "als_sweep":  # fits models eagerly; its parts are covered by other keys
            continue
        plan = executed_plan(fn(spark, SF_SMALL))
        hit = [b for b in banned if b in plan]
        if hit:
            found[key] = hit
    assert found == {}
