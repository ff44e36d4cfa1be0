"""Plan properties that matter at scale, read from the physical plans."""

import re

import pytest

from paneltide.plans import catalog as C
from paneltide.sources import tables as T

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(C.QUERIES))
def test_no_cartesian_product(spark, name):
    """Grids are expanded from a broadcast 1-row table; no query plans a cartesian join."""
    p = plan_of(C.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p


def test_panel_reads_only_needed_columns_and_shuffles_once_for_windows(spark):
    p = plan_of(C.QUERIES["cumulative_panel"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in schemas
    assert all("props" not in s and "value" not in s for s in schemas)
    # densify + running sums share one exchange on the series keys
    series_exchanges = re.findall(r"Exchange hashpartitioning\(entity#\d+L?, source#\d+, \d+\)", p)
    assert len(series_exchanges) == 1, p


@pytest.mark.parametrize("name", ["latest_one", "latest_with_ties"])
def test_latest_rows_are_map_side_group_limits(spark, name):
    """Top-1 per group (with or without ties) is cut map-side before the shuffle."""
    p = plan_of(C.QUERIES[name](spark, SF))
    assert "WindowGroupLimit" in p and ", Partial" in p


def test_broadcast_nested_loop_only_against_one_row_sides(spark):
    """Every BroadcastNestedLoopJoin's build side is a global aggregate or a literal row."""
    for name in ["cumulative_panel", "entity_date_frame", "complete_grid", "tracker_change"]:
        p = plan_of(C.QUERIES[name](spark, SF))
        for m in re.finditer(r"BroadcastNestedLoopJoin BuildRight, (\w+)", p):
            assert m.group(1) in ("Cross", "Inner"), p
        # build sides of the nested-loop joins are keyless aggregates (one row)
        assert "BroadcastExchange IdentityBroadcastMode" in p or "BroadcastNestedLoopJoin" not in p


def _above_scan(plan, table):
    """For each scan of a table the operators between it and the first shuffle above it."""
    lines = plan.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*")) for x in lines]
    for i, line in enumerate(lines):
        if "FileScan parquet" in line and f"{table}.parquet" in line:
            chain, at = [], depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    at = depth[j]
                    if "Exchange hashpartitioning" in lines[j]:
                        break
                    chain.append(lines[j])
            yield chain


@pytest.mark.parametrize(
    "table, build",
    [
        ("events", T.daily_counts),
        ("events", C.QUERIES["cumulative_panel"]),
        ("events", C.QUERIES["snapshot_cumulative"]),
        ("events", C.QUERIES["snapshot_to_daily"]),
        ("events", C._daily_by_type),
        ("events", lambda s, d: T.hospital_feeds(s, d)[0]),
        ("orders", C.QUERIES["gappy_panel_lags"]),
    ],
)
def test_raw_rows_combine_map_side(spark, table, build):
    """Every shuffle of raw rows is preceded by a partial aggregation (the plans before any
    checkpoint are read), so a key holding a third of all rows ships one row per map task and
    day instead of its raw rows.  A join with a dimension may come first."""
    chains = list(_above_scan(plan_of(build(spark, SF)), table))
    assert len(chains) == 1
    assert any("partial_" in x for x in chains[0]) or any("SortMergeJoin" in x for x in chains[0]), chains


def test_one_scan_of_the_events_for_snapshots(spark):
    for name in ("snapshot_cumulative", "snapshot_to_daily"):
        assert len(list(_above_scan(plan_of(C.QUERIES[name](spark, SF)), "events"))) == 1


def test_skewed_key_keeps_results_whole(spark):
    """One entity with a third of all rows: the daily panel and the snapshot still hold every
    day of every series (no rows dropped or capped)."""
    from pyspark.sql import functions as F

    from paneltide.operators import reshape as R
    from paneltide.operators import series as S

    hot = spark.range(0, 30000).select(F.lit(1).cast("long").alias("user_id"), (F.col("id") % 30).alias("d"))
    cold = spark.range(0, 60000).select((F.col("id") % 500 + 2).alias("user_id"), (F.col("id") % 23).alias("d"))
    ev = hot.unionByName(cold).withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int")))
    daily = ev.groupBy("user_id", "date").agg(F.count(F.lit(1)).alias("n"))
    dense = R.complete_calendar(daily, ["user_id"], "date", ["n"]).fillna(0, subset=["n"])
    cum = S.running_sum(dense, ["user_id"], "date", {"n": "cum"})
    assert cum.count() == 501 * 30
    last = cum.filter(F.col("date") == F.lit("2024-01-30").cast("date")).agg(F.sum("cum")).first()[0]
    assert last == 90000
