"""Readers and sinks: CSV round trips with explicit schemas."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from paneltide.sources import readers as RD
from paneltide.sources import sinks as SK
from paneltide.sources import tables as TB

SF = "/root/testdata/sf0.001"


def scratch():
    return tempfile.mkdtemp(prefix="paneltide-test-")


def test_csv_round_trip_nulls_and_na(spark):
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.LongType())])
    df = spark.createDataFrame([("NA", 1), (None, 2), ("AF", None)], schema)
    path = os.path.join(scratch(), "t")
    SK.write_table(df, path)
    keep = sorted(rows(RD.read_csv(spark, path, schema)), key=str)
    assert keep == [("AF", None), ("NA", 1), (None, 2)]  # "NA" text survives (N10)
    both = sorted(rows(RD.read_csv(spark, path, schema, ("", "NA"))), key=str)
    assert both == [("AF", None), (None, 1), (None, 2)]  # S2: blank and NA -> null


def test_partitioned_and_filtered_sinks(spark):
    df = spark.createDataFrame([("x", "Count", 1.0), ("y", "Rate", 2.5)], "k string, count_or_rate string, v double")
    base = scratch()
    SK.write_table(df, os.path.join(base, "p"), fmt="parquet", partition_by="count_or_rate")
    back = spark.read.parquet(os.path.join(base, "p")).filter(F.col("count_or_rate") == "Rate")
    assert rows(back, "k", "v") == [("y", 2.5)]
    paths = SK.write_split(df, os.path.join(base, "s"), "count_or_rate", ["Count", "Rate"])
    assert set(paths) == {"Count", "Rate"}
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("count_or_rate", T.StringType()), T.StructField("v", T.DoubleType())])
    assert rows(RD.read_csv(spark, paths["Count"], schema)) == [("x", "Count", 1.0)]


def test_wide_file_round_trip_through_pipeline(spark):
    """Wide cumulative files written as CSV, read back positionally, and run through A3:
    the result equals the pipeline run on the in-memory wide tables."""
    from paneltide.plans import catalog as C
    from paneltide.plans import totals as TT

    cases, deaths = TB.wide_cumulative(spark, SF, "A")
    base = scratch()
    SK.write_table(cases, os.path.join(base, "cases"))
    SK.write_table(deaths, os.path.join(base, "deaths"))
    c2 = RD.read_wide_csv(spark, os.path.join(base, "cases"))
    d2 = RD.read_wide_csv(spark, os.path.join(base, "deaths"))
    assert c2.columns[:4] == ["Province/State", "Country/Region", "Lat", "Long"]
    assert c2.columns[4] == "1/1/24"
    frame, aliases = C._frame(spark, SF), TB.nation_aliases(spark, SF)
    from_files = TT.panel_from_wide_cumulative(c2, d2, frame, aliases)
    in_memory = TT.panel_from_wide_cumulative(cases, deaths, frame, aliases)
    assert sorted(rows(from_files)) == sorted(rows(in_memory))


def test_first_column_and_lower_names(spark):
    df = spark.createDataFrame([("2020-01-01", 1)], "`﻿Date_reported` string, X long")
    out = RD.lower_names(RD.first_column_as(df, "Date_reported"))
    assert out.columns == ["date_reported", "x"]


def test_tracker_job_writes_every_table(spark):
    """A14 end to end: five tables written (one source, as published) and read back."""
    from paneltide.plans import catalog as C
    from paneltide.plans import tracker_job as TJ

    b = TB.event_bounds(spark, SF)
    tables = TJ.tracker_tables(TB.daily_panel(spark, SF), b, C._names(spark, SF), C._frame(spark, SF, b))
    out = scratch()
    paths = TJ.write_tracker_outputs(tables, out, source="B", fmt="parquet")
    assert set(paths) == {"cross_cases_deaths", "cross_cases_deaths_table", "cross_delta_cases_deaths",
                          "series_delta_cases_deaths", "lookup_country_date"}
    for name, path in paths.items():
        back = spark.read.parquet(path)
        want = tables[name]
        if "data_source" in want.columns:
            want = TJ.source_rows(want, "B")
            assert back.select("data_source").distinct().collect() == [("B",)]
        assert back.count() == want.count(), name
    # the job's tables equal the registered queries
    assert sorted(map(tuple, tables["cross_delta_cases_deaths"].collect())) == sorted(
        map(tuple, C.QUERIES["tracker_change"](spark, SF).collect()))


def test_dashboard_job_builds_and_writes_every_table(spark):
    """A15 end to end on driver-derived inputs: every table builds, writes and reads back."""
    from pyspark.sql import functions as F

    from paneltide.plans import catalog as C
    from paneltide.plans import dashboard as DB
    from paneltide.plans import tracker_job as TJ

    cases = TB.cumulative_panel(spark, SF).join(C._names(spark, SF), "country_code", "left")
    first, second = TB.hospital_feeds(spark, SF)
    tables = DB.dashboard_tables(
        TB.nation_dim(spark, SF), cases, C._amounts_wide(spark, SF), "user_id", C.TYPES, C.TYPE_META, C.TYPE_FAMILIES,
        first, second, TB.policy_feed(spark, SF),
    )
    paths = TJ.write_tracker_outputs(tables, scratch(), fmt="parquet")
    for name, path in paths.items():
        assert spark.read.parquet(path).count() == tables[name].count(), name
    assert tables["vaccinations_all_rates"].count() == 0  # the binding's indicators are all counts
    assert tables["onetable"].filter("id = 'OTH'").count() == 1


def test_cli_jobs_write_csv(spark):
    from paneltide import cli

    out = scratch()
    paths = cli.run_tracker(spark, SF, os.path.join(out, "tracker"), source="B")
    schema = spark.read.option("header", True).csv(paths["cross_delta_cases_deaths"]).columns
    assert "traj_cat_simple" in schema and "changecat_order" in schema
    paths = cli.run_dashboard(spark, SF, os.path.join(out, "dashboard"), fmt="parquet")
    assert spark.read.parquet(paths["onetable"]).filter("id = 'OTH'").count() == 1
    assert len(paths) == 13
    places = spark.read.parquet(paths["vaccinations_rollout"])
    assert places.count() > 0 and places.filter("location is null or location in ('Wales', '') or iso_code is null").count() == 0


def test_values_that_do_not_fit_fail_and_whole_fractions_are_whole(spark):
    import pytest

    base = scratch()
    for name, cell in (("ok", "12.0"), ("bad", "12.5"), ("text", "x")):
        spark.createDataFrame([("p", "c", "1", "2", cell)], "prov string, ctry string, lat string, lon string, `1/22/20` string").write.option(
            "header", True
        ).csv(os.path.join(base, name))
    assert rows(RD.read_wide_csv(spark, os.path.join(base, "ok"))) == [("p", "c", 1.0, 2.0, 12)]
    for name in ("bad", "text"):
        with pytest.raises(Exception, match="cannot hold"):
            RD.read_wide_csv(spark, os.path.join(base, name)).collect()


def test_a_session_without_a_shared_folder_is_refused(monkeypatch):
    import pytest

    from paneltide import session as SE

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SE.ensure_checkpoint_dir(Session())


def test_days_are_replaced_one_by_one_and_survive_a_failed_write(spark):
    import datetime as dt

    import pytest
    from pyspark.sql import functions as F

    path = os.path.join(scratch(), "days")
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
    first = spark.createDataFrame([(day(i % 4), -i, f"v{i}") for i in range(400)], "date date, k long, v string").repartition(5)
    SK.write_days(first, path, "date", ["k"])
    read = lambda: sorted(map(str, spark.read.parquet(path).select("date", "k", "v").collect()))
    want = sorted(map(str, first.collect()))
    assert read() == want
    # every file is in order
    for f in spark.read.parquet(path).inputFiles():
        ks = [r["k"] for r in spark.read.parquet(f).collect()]
        assert ks == sorted(ks)
    again = first.where(F.col("date") == F.lit(day(2))).withColumn("v", F.lit("new"))
    broken = again.withColumn("v", F.when(F.col("k") == -202, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        SK.write_days(broken, path, "date", ["k"])
    assert read() == want
    for _ in range(2):
        SK.write_days(again, path, "date", ["k"])
        assert read() == sorted(map(str, first.where(F.col("date") != F.lit(day(2))).union(again).collect()))


def test_a_clip_prunes_the_days_of_a_partitioned_table(spark):
    import datetime as dt

    from paneltide.operators import joins as J

    path = os.path.join(scratch(), "clip")
    rows_ = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), i) for i in range(20)]
    SK.write_days(spark.createDataFrame(rows_, "date date, k long"), path, "date")
    seen = spark.createDataFrame([(rows_[5][0], "a"), (rows_[9][0], "b"), (None, "c")], "day date, x string")
    got = J.clip_to_range(spark.read.parquet(path), "date", seen, "day")
    assert sorted(r["k"] for r in got.collect()) == [5, 6, 7, 8, 9]
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("\n")[0].split("PushedFilters")[0]
    assert "(date" in filters and ">= " in filters and "subquery" in filters.lower(), plan
    assert J.clip_to_range(spark.read.parquet(path), "date", seen.limit(0), "day").count() == 0
