"""Binding of the operators to the driver's tables.

The reference reads remote country-level feeds that are not available here; the operators
are schema-parametric, and this module maps the driver tables onto the same shapes:

* entity        = ``events.user_id`` (users play the role of countries)
* date          = the calendar day of ``events.ts``
* source        = a two-way source tag derived from the event id parity ("A" / "B"):
                  every event is kept and belongs to exactly one source
* cases         = count of ``view`` and ``click`` events per entity/day/source
* deaths        = count of ``error`` events per entity/day/source
* population    = ``customer.c_acctbal`` of the user (``c_custkey = user_id``)
* entity name   = ``customer.c_name``; region = nation / region names

A second, coarser panel uses the user's nation as the entity, so counts are large enough
to exercise the sparse-count rules; its population is the sum of ``c_acctbal`` over all
customers of the nation.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import daily_sequence
from ..operators.reshape import complete_calendar
from ..operators.series import running_sum
from ..operators.wide import WideTable, pack_arrays
from ..session import cut_lineage

# Fixed values of the binding (event types per indicator, source tags).
CASE_TYPES = ["view", "click"]
DEATH_TYPES = ["error"]
SOURCES = ["A", "B"]


# Explicit schemas of the driver tables this binding reads: no schema-inference job per
# read, and a changed file fails loudly instead of silently changing types.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def source_tag(event_id: str = "event_id"):
    return F.when(F.col(event_id) % 2 == 0, F.lit(SOURCES[0])).otherwise(F.lit(SOURCES[1]))


def daily_counts(spark: SparkSession, sf_dir: str, entity: str = "user") -> DataFrame:
    """Sparse daily panel ``(entity, date, source, cases_new, deaths_new)``.

    One hash aggregation; the partial step combines each map task's rows per
    entity/day/source before the shuffle, so a hot entity costs at most one row per day
    per task.  Only the four needed columns are read from the scan.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    if entity == "nation":
        cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        ev = ev.join(cust, ev.user_id == cust.c_custkey, "left").withColumn("entity", F.col("c_nationkey").cast("long"))
    else:
        ev = ev.withColumn("entity", F.col("user_id"))
    return ev.groupBy("entity", F.to_date("ts").alias("date"), source_tag().alias("source")).agg(
        F.count(F.when(F.col("event_type").isin(CASE_TYPES), 1)).alias("cases_new"),
        F.count(F.when(F.col("event_type").isin(DEATH_TYPES), 1)).alias("deaths_new"),
    )


def entity_dim(spark: SparkSession, sf_dir: str, entity: str = "user") -> DataFrame:
    """``(country_code, country, pop, region)`` for the chosen entity level."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", F.col("r_name").alias("region")
    )
    if entity == "nation":
        pop = cust.groupBy("c_nationkey").agg(F.round(F.sum("c_acctbal"), 2).alias("pop"))
        return geo.join(pop, geo.n_nationkey == pop.c_nationkey, "left").select(
            F.col("n_nationkey").cast("long").alias("country_code"), F.col("n_name").alias("country"), "pop", "region"
        )
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left").select(
        F.col("c_custkey").alias("country_code"), F.col("c_name").alias("country"), F.col("c_acctbal").alias("pop"), "region"
    )


def population(spark: SparkSession, sf_dir: str, entity: str = "user") -> DataFrame:
    """``(__k, pop)``: the entity key and its population, read from customer only."""
    cust = read_table(spark, sf_dir, "customer")
    if entity == "nation":
        return cust.groupBy(F.col("c_nationkey").cast("long").alias("__k")).agg(F.round(F.sum("c_acctbal"), 2).alias("pop"))
    return cust.select(F.col("c_custkey").alias("__k"), F.col("c_acctbal").alias("pop"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-event rows ``(country_code, Date, data_source, cases_new, deaths_new)`` with 0/1
    counts: summing them per entity and source equals summing the daily table, so
    cross-section aggregations can read the events directly (one aggregation, map-side
    combine) instead of aggregating to days first."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return ev.select(
        F.col("user_id").alias("country_code"),
        F.to_date("ts").alias("Date"),
        source_tag().alias("data_source"),
        F.when(F.col("event_type").isin(CASE_TYPES), 1).otherwise(0).cast("long").alias("cases_new"),
        F.when(F.col("event_type").isin(DEATH_TYPES), 1).otherwise(0).cast("long").alias("deaths_new"),
    )


def population_table(spark: SparkSession, sf_dir: str, entity: str = "user") -> DataFrame:
    """``(country_code, pop)`` per entity."""
    return population(spark, sf_dir, entity).select(F.col("__k").alias("country_code"), "pop")


def daily_panel(spark: SparkSession, sf_dir: str, entity: str = "user") -> DataFrame:
    """Sparse daily panel with population: ``(country_code, Date, data_source, cases_new,
    deaths_new, pop)``, days with events only.  With :func:`event_bounds` it describes the
    same dense panel as :func:`cumulative_panel` without materialising the missing days."""
    daily = daily_counts(spark, sf_dir, entity)
    dim = population(spark, sf_dir, entity)
    daily = daily.join(dim, F.col("entity") == F.col("__k"), "left").drop("__k")
    return daily.select(
        F.col("entity").alias("country_code"), F.col("date").alias("Date"), F.col("source").alias("data_source"),
        "cases_new", "deaths_new", "pop",
    )


def cumulative_panel(spark: SparkSession, sf_dir: str, entity: str = "user", bounds: DataFrame | None = None) -> DataFrame:
    """Dense cumulative panel ``(country_code, Date, data_source, cases_new, deaths_new,
    cases_cum, deaths_cum, pop)``.

    Each observed (entity, source) series is completed to the global calendar of the
    data (R7) by the narrow fill pass, missing days count 0 (P19), and the cumulative
    columns are running sums over the same window spec, so densify, running sums and any
    later lag windows share one exchange on (entity, source).
    """
    daily = daily_counts(spark, sf_dir, entity)
    # Population is an entity attribute: join it before the fill so it is carried onto
    # the added days, and so a shuffled join on the entity already satisfies the
    # (entity, source) window distribution.
    dim = population(spark, sf_dir, entity)
    daily = daily.join(dim, F.col("entity") == F.col("__k"), "left").drop("__k")
    b = bounds if bounds is not None else event_bounds(spark, sf_dir)
    dense = complete_calendar(daily, ["entity", "source"], "date", ["cases_new", "deaths_new"], bounds=b)
    dense = dense.fillna(0, subset=["cases_new", "deaths_new"])
    cum = running_sum(dense, ["entity", "source"], "date", {"cases_new": "cases_cum", "deaths_new": "deaths_cum"})
    return cum.select(
        F.col("entity").alias("country_code"),
        F.col("date").alias("Date"),
        F.col("source").alias("data_source"),
        "cases_new",
        "deaths_new",
        "cases_cum",
        "deaths_cum",
        "pop",
    )


def order_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second sparse panel of the same columns as :func:`daily_panel`, over the order days:
    entity = the customer's nation, cases = orders, deaths = orders of status F.  An order of
    an unknown customer counts under a null entity."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("country_code"))
    pop = population(spark, sf_dir, "nation")
    daily = o.join(cust, o.o_custkey == cust.c_custkey, "left").groupBy(
        "country_code", F.to_date("o_orderdate").alias("Date"), source_tag("o_orderkey").alias("data_source")
    ).agg(F.count(F.lit(1)).alias("cases_new"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("deaths_new"))
    return daily.join(pop, F.col("country_code") == F.col("__k"), "left").drop("__k")


def order_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-row calendar bounds (``__lo``, ``__hi``) of the order days, as literals."""
    o = read_table(spark, sf_dir, "orders")
    r = o.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi")).first()
    return spark.range(1).select(F.lit(r["lo"]).cast("date").alias("__lo"), F.lit(r["hi"]).cast("date").alias("__hi"))


def order_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`order_daily` completed to its calendar (R7, P19), with running sums."""
    keys, new = ["country_code", "data_source"], ["cases_new", "deaths_new"]
    dense = complete_calendar(order_daily(spark, sf_dir), keys, "Date", new, bounds=order_bounds(spark, sf_dir)).fillna(0, subset=new)
    return running_sum(dense, keys, "Date", {"cases_new": "cases_cum", "deaths_new": "deaths_cum"})


# ------------------------------------------------------------------ country-level feeds


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity dimension in the reference's shape (country, iso3code, iso2code, who_region,
    pop_2020yr, Continent_Name), one row per nation."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    cust = read_table(spark, sf_dir, "customer")
    pop = cust.groupBy("c_nationkey").agg(F.round(F.sum("c_acctbal"), 2).alias("pop_2020yr"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return geo.join(pop, geo.n_nationkey == pop.c_nationkey, "left").select(
        F.col("n_name").alias("country"),
        F.col("n_nationkey").cast("string").alias("iso3code"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("iso2code"),
        F.col("r_name").alias("who_region"),
        "pop_2020yr",
        F.col("r_name").alias("Continent_Name"),
    )


# Fixed values of the binding: attribute values of the published tables per region name.
_WHO = {"AFRICA": "AFRO", "AMERICA": "AMRO", "EUROPE": "EURO", "MIDDLE EAST": "EMRO"}
_STATE = {
    "AFRICA": "Sub-Saharan Africa", "AMERICA": "Western Hemisphere", "EUROPE": "Europe and Eurasia",
    "MIDDLE EAST": "Near East (Middle East and Northern Africa)",
}
_INCOME = ["High income", "Upper middle income", "Lower middle income", "Low income", "Not classified"]


def nation_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`nation_dim` with a region code, state region, income level and adult population
    for each nation, some of them missing."""
    from ..functions.classify import lookup

    dim, key = nation_dim(spark, sf_dir), F.col("iso3code").cast("int")
    odd = key % 2 == 1
    who = F.when(F.col("who_region") == "ASIA", F.when(odd, "WPRO").otherwise("SEARO")).otherwise(lookup("who_region", _WHO))
    asia = F.when(odd, "East Asia and the Pacific").otherwise("South and Central Asia")
    state = F.when(F.col("country") == "NATION_1", "US").when(F.col("who_region") == "ASIA", asia).otherwise(lookup("who_region", _STATE))
    return dim.withColumns(
        {
            "state_region": F.when(key % 7 != 6, state),
            "who_region": F.when(key != 10, who),
            "incomelevel_value": F.when(key % 6 < 5, F.get(F.array(*map(F.lit, _INCOME)), key % 6)),
            "eighteenplus": F.col("pop_2020yr") * 0.75,
        }
    )


def event_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-row calendar bounds (``__lo``, ``__hi``) of the event days.

    The two dates are computed once (one aggregation of the ``ts`` column; two scalars
    reach the driver) and handed back as a literal row.  Every later use - frame calendar,
    densify bounds, as-of date, incomplete-day drop - is then a constant, with no further
    scan of the event table, and Catalyst can fold it into filters.
    """
    ev = read_table(spark, sf_dir, "events")
    r = ev.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi")).first()
    return spark.range(1).select(F.lit(r["lo"]).cast("date").alias("__lo"), F.lit(r["hi"]).cast("date").alias("__hi"))


def nation_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias table for name standardisation: nation name -> code."""
    nation = read_table(spark, sf_dir, "nation")
    return nation.select(F.col("n_name").alias("alias"), F.col("n_nationkey").cast("string").alias("iso3code"))


def _user_cumulative(spark: SparkSession, sf_dir: str, source: str | None, bounds: DataFrame | None = None) -> DataFrame:
    """Dense per-user cumulative cases/deaths over the event calendar (one source or all)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    if source is not None:
        ev = ev.filter(source_tag() == F.lit(source))
    daily = ev.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        F.count(F.when(F.col("event_type").isin(CASE_TYPES), 1)).alias("cases_new"),
        F.count(F.when(F.col("event_type").isin(DEATH_TYPES), 1)).alias("deaths_new"),
    )
    b = bounds if bounds is not None else event_bounds(spark, sf_dir)
    dense = complete_calendar(daily, ["user_id"], "date", ["cases_new", "deaths_new"], bounds=b)
    dense = dense.fillna(0, subset=["cases_new", "deaths_new"])
    return running_sum(dense, ["user_id"], "date", {"cases_new": "cases_cum", "deaths_new": "deaths_cum"})


WIDE_IDS = ["Province/State", "Country/Region", "Lat", "Long"]


def _located(spark: SparkSession, sf_dir: str, users: DataFrame) -> DataFrame:
    """Rows of users with the id columns of the wide files: series = user (``Province/State``)
    within its nation (``Country/Region``); ``Lat`` / ``Long`` are the region / nation keys."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    geo = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.col("n_name").alias("Country/Region"),
        F.col("n_regionkey").cast("double").alias("Lat"),
        F.col("n_nationkey").cast("double").alias("Long"),
    )
    return users.join(geo, "user_id", "left").withColumn("Province/State", F.col("user_id").cast("string"))


def wide_cumulative(
    spark: SparkSession, sf_dir: str, source: str | None = None, bounds: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Two wide files (cases, deaths) as columns: 4 id columns, then one column per day
    ``M/d/yy``.  A pivot needs the date headers, one small driver read bounded by the days."""
    import datetime as _dt

    from ..operators.reshape import long_to_wide

    bounds = bounds if bounds is not None else event_bounds(spark, sf_dir)
    # Both files are pivots of the same per-user cumulative table: build it once.
    cum = cut_lineage(_located(spark, sf_dir, _user_cumulative(spark, sf_dir, source, bounds)))
    cum = cum.withColumn("hdr", F.date_format("date", "M/d/yy"))
    b = bounds.first()
    days = [b["__lo"] + _dt.timedelta(days=i) for i in range((b["__hi"] - b["__lo"]).days + 1)]
    labels = [f"{d.month}/{d.day}/{d.strftime('%y')}" for d in days]
    return long_to_wide(cum, WIDE_IDS, "hdr", "cases_cum", labels), long_to_wide(cum, WIDE_IDS, "hdr", "deaths_cum", labels)


def wide_arrays(
    spark: SparkSession, sf_dir: str, source: str | None = None, bounds: DataFrame | None = None
) -> tuple[WideTable, WideTable]:
    """The same two wide files as arrays of values under one row of headers (S4, R5).  A user's
    days meet in one array where the running sums left them, so nothing is shuffled for it; the
    place is joined to one row per user."""
    bounds = bounds if bounds is not None else event_bounds(spark, sf_dir)
    header = bounds.select(F.transform(daily_sequence("__lo", "__hi"), lambda d: F.date_format(d, "M/d/yy")).alias("labels"))
    cum = _user_cumulative(spark, sf_dir, source, bounds)
    files = ["cases_cum", "deaths_cum"]
    rows = cut_lineage(_located(spark, sf_dir, pack_arrays(cum, ["user_id"], "date", files, header)))
    cases, deaths = (WideTable(rows.select(*WIDE_IDS, F.col(f).alias("values")), header) for f in files)
    return cases, deaths


def long_daily(spark: SparkSession, sf_dir: str, source: str | None = None) -> DataFrame:
    """Long daily file: ``Date_reported`` text first, then names, then daily and cumulative
    counts per nation on the days it reported (sparse)."""
    from pyspark.sql import Window

    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    if source is not None:
        ev = ev.filter(source_tag() == F.lit(source))
    dim = nation_dim(spark, sf_dir)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("iso3code"))
    ev = ev.join(cust, ev.user_id == cust.c_custkey, "left")  # events of unknown users count under a null code
    daily = ev.groupBy("iso3code", F.to_date("ts").alias("date")).agg(
        F.count(F.when(F.col("event_type").isin(CASE_TYPES), 1)).alias("New_cases"),
        F.count(F.when(F.col("event_type").isin(DEATH_TYPES), 1)).alias("New_deaths"),
    )
    w = Window.partitionBy("iso3code").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = daily.withColumn("Cumulative_cases", F.sum("New_cases").over(w)).withColumn(
        "Cumulative_deaths", F.sum("New_deaths").over(w)
    )
    out = daily.join(dim.select("iso3code", "iso2code", "country", "who_region"), "iso3code", "left")
    return out.select(
        F.date_format("date", "yyyy-MM-dd").alias("Date_reported"),
        F.col("iso2code").alias("Country_code"),
        F.col("country").alias("Country"),
        F.col("who_region").alias("WHO_region"),
        "New_cases", "Cumulative_cases", "New_deaths", "Cumulative_deaths",
    )


def policy_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy-index feed with the published mixed-case headers: orders as national
    (status F) and sub-national rows per nation, ``yyyymmdd`` integer dates."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return o.join(cust, o.o_custkey == cust.c_custkey, "left").join(nation, cust.c_nationkey == nation.n_nationkey, "left").select(
        F.col("n_name").alias("CountryName"),
        F.col("n_nationkey").cast("string").alias("CountryCode"),
        F.when(F.col("o_orderstatus") == "F", F.lit("NAT_TOTAL")).otherwise(F.lit("STATE_TOTAL")).alias("Jurisdiction"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("Date"),
        F.col("o_totalprice").alias("StringencyIndex"),
    )


def hospital_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two long indicator feeds ``(iso_code, indicator, date, value[, url])``: per user,
    event type and day, the summed amounts of each source tag; the first carries an extra
    column so the union is ragged."""
    ev = read_table(spark, sf_dir, "events")
    long = ev.groupBy(
        F.col("user_id").alias("iso_code"), F.col("event_type").alias("indicator"), source_tag().alias("__src"),
        F.to_date("ts").alias("date"),
    ).agg(F.round(F.sum("value"), 2).alias("value"))
    first = long.filter(F.col("__src") == SOURCES[0]).drop("__src").withColumn("url", F.lit("source-a"))
    second = long.filter(F.col("__src") == SOURCES[1]).drop("__src")
    return first, second
