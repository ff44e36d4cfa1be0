"""DuckDB oracle SQL for the registered queries (independent re-statement in SQL).

Each string runs on the driver's pre-registered views.  Shared CTEs (the daily counts and
the dense cumulative panel) are built from small Python templates; grid cells that the
Spark side produces with one ``inline`` are spelled out as ``UNION ALL`` branches here.
"""

from __future__ import annotations

SOURCE_TAG = "CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END"
P6 = [1 / 6, 2 / 6, 3 / 6, 4 / 6, 5 / 6]


def _daily(entity: str = "user") -> str:
    if entity == "orders":
        return f"""daily AS (
  SELECT CAST(c.c_nationkey AS BIGINT) AS entity, CAST(o.o_orderdate AS DATE) AS date,
         {SOURCE_TAG.replace('event_id', 'o.o_orderkey')} AS source, count(*) AS cases_new,
         count(*) FILTER (WHERE o.o_orderstatus = 'F') AS deaths_new
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3)"""
    if entity == "nation":
        src = "events e LEFT JOIN customer c ON e.user_id = c.c_custkey"
        ent = "CAST(c.c_nationkey AS BIGINT)"
    else:
        src = "events e"
        ent = "e.user_id"
    return f"""daily AS (
  SELECT {ent} AS entity, CAST(e.ts AS DATE) AS date, {SOURCE_TAG.replace('event_id', 'e.event_id')} AS source,
         CAST(count(*) FILTER (WHERE e.event_type IN ('view', 'click')) AS BIGINT) AS cases_new,
         CAST(count(*) FILTER (WHERE e.event_type = 'error') AS BIGINT) AS deaths_new
  FROM {src} GROUP BY 1, 2, 3)"""


def _pop(entity: str = "user") -> str:
    if entity in ("nation", "orders"):
        return "popt AS (SELECT CAST(c_nationkey AS BIGINT) AS k, round(sum(c_acctbal), 2) AS pop FROM customer GROUP BY 1)"
    return "popt AS (SELECT c_custkey AS k, c_acctbal AS pop FROM customer)"


def panel_ctes(entity: str = "user") -> str:
    """daily, bounds, cal, pairs, dense, panel."""
    return f"""{_daily(entity)},
{_pop(entity)},
bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM daily),
cal AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
pairs AS (SELECT DISTINCT entity, source FROM daily),
dense AS (
  SELECT p.entity, p.source, c.date,
         coalesce(d.cases_new, 0) AS cases_new, coalesce(d.deaths_new, 0) AS deaths_new
  FROM pairs p CROSS JOIN cal c
  LEFT JOIN daily d ON d.entity = p.entity AND d.source = p.source AND d.date = c.date),
panel AS (
  SELECT dn.entity AS country_code, dn.date AS Date, dn.source AS data_source, dn.cases_new, dn.deaths_new,
         CAST(sum(dn.cases_new) OVER w AS BIGINT) AS cases_cum,
         CAST(sum(dn.deaths_new) OVER w AS BIGINT) AS deaths_cum,
         popt.pop AS pop
  FROM dense dn LEFT JOIN popt ON popt.k = dn.entity
  WINDOW w AS (PARTITION BY dn.entity, dn.source ORDER BY dn.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def period_label(p: int) -> str:
    return "Cumulative" if p == 999 else ("24 hours" if p == 1 else f"{p} days")


INDICATORS = {"Cases": "cases_cum", "Deaths": "deaths_cum"}


def snapshot_ctes(periods=(1, 7, 14, 30, 999), all_dates: bool = False) -> str:
    """snap (values at max date), cuts, classed, bounds2, crossx (A6 output)."""
    lags = [p for p in periods if p != 999]
    lag_cols = ", ".join(
        f"lag({c}, {p}) OVER w AS l_{i}_{p}" for i, c in enumerate(INDICATORS.values()) for p in lags
    )
    branches = []
    for i, (ind, c) in enumerate(INDICATORS.items()):
        for p in periods:
            raw = c if p == 999 else f"({c} - l_{i}_{p})"
            cnt = f"CAST(CASE WHEN {raw} < 0 THEN 0 ELSE {raw} END AS DOUBLE)"
            branches.append(
                f"SELECT '{ind}' AS Indicator, 'Counts' AS Metric, '{period_label(p)}' AS periodval, data_source, country_code, Date, pop, {cnt} AS valuex FROM atmax"
            )
            branches.append(
                f"SELECT '{ind}' AS Indicator, 'Rate' AS Metric, '{period_label(p)}' AS periodval, data_source, country_code, Date, pop, "
                f"CASE WHEN pop > 0 THEN round({cnt} / pop * 100000, 1) END AS valuex FROM atmax"
            )
    probs = ", ".join(repr(p) for p in P6)
    q = [f"q[{k}]" for k in range(1, 6)]
    cls = f"""CASE
      WHEN valuex < {q[0]} THEN 1
      WHEN valuex = {q[0]} OR (valuex >= {q[0]} AND valuex < {q[1]}) THEN 2
      WHEN valuex = {q[1]} OR (valuex >= {q[1]} AND valuex < {q[2]}) THEN 3
      WHEN valuex = {q[2]} OR (valuex >= {q[2]} AND valuex < {q[3]}) THEN 4
      WHEN valuex = {q[3]} OR (valuex >= {q[3]} AND valuex < {q[4]}) THEN 5
      WHEN valuex >= {q[4]} THEN 6 END"""
    grp = "Indicator, Metric, periodval, data_source"
    return f"""mx AS (SELECT max(Date) AS mx FROM panel),
lagged AS (
  SELECT country_code, data_source, Date, pop, cases_cum, deaths_cum, {lag_cols}
  FROM panel WINDOW w AS (PARTITION BY country_code, data_source ORDER BY Date)),
atmax AS (SELECT * FROM lagged {'' if all_dates else 'WHERE Date = (SELECT mx FROM mx)'}),
snap AS ({' UNION ALL '.join(branches)}),
cuts AS (
  SELECT {grp}, quantile_cont(valuex, [{probs}]) FILTER (WHERE valuex > 0) AS q
  FROM snap GROUP BY {grp}),
classed AS (
  SELECT s.*, CASE WHEN s.valuex IS NULL THEN NULL ELSE {cls.replace('valuex', 's.valuex').replace('q[', 'c.q[')} END AS cls
  FROM snap s JOIN cuts c USING ({grp})),
mins AS (
  SELECT {grp}, {', '.join(f'min(valuex) FILTER (WHERE cls = {k}) AS m{k}' for k in range(2, 7))}
  FROM classed GROUP BY {grp}),
bnd AS (
  SELECT {grp},
    coalesce(CAST(m2 AS DOUBLE), 0.0) AS lw2,
    coalesce(CAST(m3 AS DOUBLE), coalesce(CAST(m2 AS DOUBLE), 0.0)) AS lw3,
    coalesce(CAST(m4 AS DOUBLE), CAST(m3 AS DOUBLE), CAST(m2 AS DOUBLE), 0.0) AS lw4,
    coalesce(CAST(m5 AS DOUBLE), CAST(m4 AS DOUBLE), CAST(m3 AS DOUBLE), CAST(m2 AS DOUBLE), 0.0) AS lw5,
    coalesce(CAST(m6 AS DOUBLE), CAST(m5 AS DOUBLE), CAST(m4 AS DOUBLE), CAST(m3 AS DOUBLE), CAST(m2 AS DOUBLE), 0.0) AS lw6
  FROM mins),
crossx AS (
  SELECT c.Indicator, c.Metric, c.periodval, c.data_source, c.country_code, c.Date, c.pop, c.valuex,
    'cross' AS dftype,
    CASE WHEN c.cls IS NULL THEN 'not estimated'
         WHEN c.cls = 6 THEN regexp_replace(CAST(CAST(b.lw6 AS DECIMAL(38,1)) AS VARCHAR), '\\.0$', '') || '+'
         ELSE regexp_replace(format('{{:,.1f}}', [b.lw2, b.lw3, b.lw4, b.lw5, b.lw6][c.cls]), '\\.0$', '') END AS qcats,
    CASE WHEN c.cls IS NULL THEN 'absent' ELSE 'cat' || CAST(c.cls AS VARCHAR) END AS qvals,
    (CASE WHEN c.periodval = 'Cumulative' THEN 'Global cumulative ' ELSE 'Global ' END)
      || (CASE WHEN c.Indicator = 'Cases' THEN 'cases of ' ELSE 'deaths from ' END)
      || 'COVID-19 reported '
      || (CASE WHEN c.Metric = 'Rate' THEN 'per 100,000 population ' ELSE '' END)
      || (CASE WHEN c.periodval = 'Cumulative' THEN '' ELSE 'in the past ' || c.periodval END) AS maptitle,
    (CASE WHEN c.periodval = 'Cumulative' THEN 'Cumulative ' ELSE '' END)
      || (CASE WHEN c.Indicator = 'Cases' THEN 'Cases reported ' ELSE 'Deaths reported ' END)
      || (CASE WHEN c.Metric = 'Rate' THEN 'per 100,000 population ' ELSE '' END)
      || (CASE WHEN c.periodval = 'Cumulative' THEN '' ELSE 'in the past ' || c.periodval END) AS tabtitle
  FROM classed c JOIN bnd b USING ({grp}))"""


def complete_snapshot_ctes() -> str:
    nested = ["data_source", "Indicator", "Metric", "periodval", "dftype", "Date"]
    on = " AND ".join(f"x.{c} IS NOT DISTINCT FROM g.{c}" for c in ["country_code"] + nested)
    part = "g.country_code, g.Indicator, g.Metric, g.periodval, g.dftype, g.Date"

    def downup(c):
        return (
            f"coalesce(last_value(x.{c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY g.data_source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value(x.{c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY g.data_source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        )

    return f"""grid AS (
  SELECT k.country_code, t.* FROM (SELECT DISTINCT country_code FROM crossx) k,
    (SELECT DISTINCT {', '.join(nested)} FROM crossx) t),
crossc AS (
  SELECT g.Indicator, g.Metric, g.periodval, g.data_source, g.country_code, g.Date, {downup('pop')},
    CASE WHEN x.qvals IS NULL THEN coalesce(x.valuex, 0) ELSE x.valuex END AS valuex,
    g.dftype, x.qcats, coalesce(x.qvals, 'absent') AS qvals, {downup('maptitle')}, {downup('tabtitle')},
    CASE g.periodval WHEN '24 hours' THEN 'x1' WHEN '7 days' THEN 'x2' WHEN '14 days' THEN 'x3'
      WHEN '30 days' THEN 'x4' WHEN 'Cumulative' THEN 'x5' END AS periodvalx
  FROM grid g LEFT JOIN crossx x ON {on})"""


def tracker_snapshot_sql() -> str:
    return f"WITH {panel_ctes()},\n{snapshot_ctes()},\n{complete_snapshot_ctes()}\nSELECT * FROM crossc"


def snapshot_table_sql() -> str:
    keys = "Indicator, periodval, data_source, country_code, Date, pop, dftype"
    return f"""WITH {panel_ctes()},
{snapshot_ctes()},
{complete_snapshot_ctes()}
SELECT {keys},
  max(valuex) FILTER (WHERE Metric = 'Counts') AS Counts,
  max(valuex) FILTER (WHERE Metric = 'Rate') AS Rate,
  (CASE WHEN periodval = 'Cumulative' THEN 'Cumulative ' ELSE '' END)
    || (CASE WHEN Indicator = 'Cases' THEN 'Cases reported ' ELSE 'Deaths reported ' END)
    || (CASE WHEN periodval = 'Cumulative' THEN '' ELSE 'in the past ' || periodval END) AS tabtitlex
FROM crossc WHERE country_code IS NOT NULL
GROUP BY {keys}"""


def gappy_panel_lags_sql() -> str:
    """Row lags over the days that a series has."""
    w = "WINDOW w AS (PARTITION BY entity, source ORDER BY date)"
    cum = "WINDOW w AS (PARTITION BY entity, source ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cells = []
    for ind, c in (("Cases", "cc"), ("Deaths", "dc")):
        for p in (1, 7, 30):
            v = f"CAST(greatest({c} - lag({c}, {p}) OVER w, 0) AS DOUBLE)"
            label = period_label(p)
            known = f"CASE WHEN lag({c}, {p}) OVER w IS NOT NULL THEN {v} END"
            cells.append(f"SELECT '{ind}' AS Indicator, 'Counts' AS Metric, '{label}' AS periodval, *, {known} AS valuex FROM cum {w}")
    counts = " UNION ALL ".join(cells)
    return f"""WITH {_daily('orders')},
{_pop('orders')},
cum AS (SELECT entity, source, date, popt.pop, sum(cases_new) OVER w AS cc, sum(deaths_new) OVER w AS dc
  FROM daily LEFT JOIN popt ON popt.k = daily.entity {cum}),
counts AS ({counts}),
cells AS (SELECT * FROM counts UNION ALL
  SELECT Indicator, 'Rate' AS Metric, periodval, entity, source, date, pop, cc, dc,
    CASE WHEN pop > 0 THEN round(valuex / pop * 100000, 1) END AS valuex FROM counts)
SELECT Indicator, Metric, periodval, source AS data_source, entity AS country_code, date AS Date, pop, valuex FROM cells"""


def quantile_classes_sql(entity: str = "user") -> str:
    return f"WITH {panel_ctes(entity)},\n{snapshot_ctes()}\nSELECT * FROM crossx"


# ------------------------------------------------------------------ change


def _num_text(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(38,1)) AS VARCHAR), '\\.0$', '')"


def change_ctes(periods=(7, 14, 30), entity: str = "user", mode: str = "cross") -> str:
    """chg: period change rows (series or cross at the global max date)."""
    need_cum = sorted({k for p in periods for k in (p, 2 * p)})
    need_date = sorted({k for p in periods for k in (p - 1, p, 2 * p - 1)} - {0})
    lag_c = ", ".join(f"lag({c}, {k}) OVER w AS c_{i}_{k}" for i, c in enumerate(INDICATORS.values()) for k in need_cum)
    lag_d = ", ".join(f"lag(Date, {k}) OVER w AS d_{k}" for k in need_date)
    branches = []
    for i, (ind, c) in enumerate(INDICATORS.items()):
        for p in periods:
            cd = "Date" if p - 1 == 0 else f"d_{p - 1}"
            branches.append(
                f"SELECT '{ind}' AS Indicator, '{period_label(p)}' AS periodval, data_source, country_code, Date, pop, "
                f"coalesce({c} - c_{i}_{p}, 0) AS curr_val, coalesce(c_{i}_{p} - c_{i}_{2 * p}, 0) AS prev_val, "
                f"Date AS curr_date, {cd} AS curr_datex, d_{p} AS prev_date, d_{2 * p - 1} AS prev_datex FROM lagged2"
            )
    where = "WHERE Date = (SELECT max(Date) FROM panel)" if mode == "cross" else ""
    pc = "CASE WHEN prev_val > 0 THEN CAST(curr_val - prev_val AS DOUBLE) / prev_val WHEN curr_val - prev_val > 0 THEN 99999.0 ELSE 0.0 END"
    return f"""lagged2 AS (
  SELECT country_code, data_source, Date, pop, cases_cum, deaths_cum, {lag_c}, {lag_d}
  FROM panel WINDOW w AS (PARTITION BY country_code, data_source ORDER BY Date)),
cells AS ({' UNION ALL '.join(branches)}),
chg0 AS (SELECT *, curr_val - prev_val AS change_val, {pc} AS perc_change FROM cells {where}),
chg AS (
  SELECT Indicator, periodval, data_source, country_code, Date, pop,
    CASE WHEN perc_change <= -0.5 THEN 'decrease of more than 50%' WHEN perc_change <= -0.1 THEN 'decrease of 11-50%'
         WHEN perc_change <= 0 THEN 'decrease of 1-10%' WHEN perc_change <= 0.1 THEN 'increase of 0-9%'
         WHEN perc_change <= 1 THEN 'increase of 10-99%' WHEN perc_change IS NOT NULL THEN 'increase of 100%+' END AS changecat,
    CASE WHEN perc_change <= -0.5 THEN 1 WHEN perc_change <= -0.1 THEN 2 WHEN perc_change <= 0 THEN 3
         WHEN perc_change <= 0.1 THEN 4 WHEN perc_change <= 1 THEN 5 WHEN perc_change IS NOT NULL THEN 6 END AS cls,
    change_val, perc_change,
    CASE WHEN perc_change = 99999.0 THEN 'Zero denominator' ELSE {_num_text('round(perc_change * 100, 1)')} || '%' END AS perc_changex,
    curr_val, prev_val, prev_date, curr_date, prev_datex, curr_datex,
    Indicator || ' reported from ' || coalesce(CAST(curr_datex AS VARCHAR), 'NA') || ' to ' || coalesce(CAST(curr_date AS VARCHAR), 'NA') AS curr_range,
    Indicator || ' reported from ' || coalesce(CAST(prev_datex AS VARCHAR), 'NA') || ' to ' || coalesce(CAST(prev_date AS VARCHAR), 'NA') AS prev_range,
    '{mode}' AS dftype
  FROM chg0)"""


def _trajectory(src: str, daily: bool = False) -> str:
    sparse = "'<10 ' || Indicator || ' in past ' || periodval"
    extra = ", incidence_7days / 7.0 AS incidence_7days_daily" if daily else ""
    return f"""t1 AS (SELECT *, CASE WHEN pop > 0 THEN 100000.0 * curr_val / pop END AS incidence_7days{extra},
    CASE WHEN perc_change > 5 THEN 500.0 WHEN perc_change <= 5 THEN perc_change * 100 END AS perc_change_clean FROM {src}),
t2 AS (SELECT *,
    CASE WHEN curr_val < 10 THEN {sparse} WHEN incidence_7days < 10 THEN 'Low Incidence'
         WHEN incidence_7days >= 10 AND incidence_7days < 50 THEN 'Moderate Incidence'
         WHEN incidence_7days >= 50 AND incidence_7days < 100 THEN 'Substantial Incidence'
         WHEN incidence_7days >= 100 THEN 'High Incidence' END AS inc_cat,
    CASE WHEN curr_val < 10 THEN 'N/A' WHEN perc_change_clean <= -10 THEN 'Decreasing'
         WHEN perc_change_clean > -10 AND perc_change_clean < 0 THEN 'Moderate Decreasing'
         WHEN perc_change_clean >= 0 AND perc_change_clean < 10 THEN 'Moderate Increasing'
         WHEN perc_change_clean >= 10 THEN 'Increasing' END AS perc_change_cat FROM t1),
t3 AS (SELECT *,
    CASE WHEN curr_val < 10 THEN {sparse} WHEN inc_cat IN ('Low Incidence', 'Moderate Incidence') THEN 'Low/Moderate'
         WHEN inc_cat IN ('Substantial Incidence', 'High Incidence') THEN 'High/Substantial' END AS inc_cat_simple,
    CASE WHEN perc_change_cat = 'N/A' THEN 'N/A' WHEN perc_change_cat IN ('Decreasing', 'Moderate Decreasing') THEN 'Decreasing'
         WHEN perc_change_cat IN ('Increasing', 'Moderate Increasing') THEN 'Increasing' END AS perc_change_cat_simple FROM t2),
t4 AS (SELECT *,
    CASE WHEN curr_val < 10 THEN {sparse}
         WHEN inc_cat_simple = 'Low/Moderate' AND perc_change_cat_simple = 'Decreasing' THEN 'Low/Moderate Incidence, Decreasing'
         WHEN inc_cat_simple = 'Low/Moderate' AND perc_change_cat_simple = 'Increasing' THEN 'Low/Moderate Incidence, Increasing'
         WHEN inc_cat_simple = 'High/Substantial' AND perc_change_cat_simple = 'Decreasing' THEN 'Substantial/High Incidence, Decreasing'
         WHEN inc_cat_simple = 'High/Substantial' AND perc_change_cat_simple = 'Increasing' THEN 'Substantial/High Incidence, Increasing' END AS traj_cat_simple,
    CAST(country_code AS VARCHAR) || data_source || ' ' AS country_code_and_data_source FROM t3)"""


def _names(entity: str) -> str:
    if entity in ("nation", "orders"):
        return "names AS (SELECT DISTINCT n_name AS country, CAST(n_nationkey AS BIGINT) AS country_code FROM nation)"
    return "names AS (SELECT DISTINCT c_name AS country, c_custkey AS country_code FROM customer)"


def tracker_change_sql(entity: str = "user") -> str:
    nested = ["data_source", "Indicator", "periodval", "dftype", "Date"]
    on = " AND ".join(f"x.{c} IS NOT DISTINCT FROM g.{c}" for c in ["country_code"] + nested)
    part = "g.country_code, g.Indicator, g.periodval, g.dftype, g.Date"

    def downup(c):
        return (
            f"coalesce(last_value(x.{c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY g.data_source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value(x.{c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY g.data_source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        )

    fills = ["country", "pop", "prev_date", "curr_date", "prev_datex", "curr_datex", "curr_range", "prev_range"]
    return f"""WITH {panel_ctes(entity)},
{change_ctes(mode='cross', entity=entity)},
{_names(entity)},
crossn AS (SELECT chg.*, names.country FROM chg LEFT JOIN names ON names.country_code IS NOT DISTINCT FROM chg.country_code),
grid AS (
  SELECT k.country_code, t.* FROM (SELECT DISTINCT country_code FROM crossn) k,
    (SELECT DISTINCT {', '.join(nested)} FROM crossn) t),
filled AS (
  SELECT g.Indicator, g.periodval, g.data_source, g.country_code, g.Date, g.dftype,
    x.changecat, x.cls, x.change_val, x.perc_change, x.perc_changex,
    coalesce(x.curr_val, 0) AS curr_val, coalesce(x.prev_val, 0) AS prev_val,
    {', '.join(downup(c) for c in fills)}
  FROM grid g LEFT JOIN crossn x ON {on}),
sup AS (
  SELECT Indicator, periodval, data_source, country_code, Date, pop,
    CASE WHEN curr_val < 10 THEN '<10 ' || Indicator || ' in past ' || periodval ELSE changecat END AS changecat,
    CASE WHEN curr_val < 10 THEN NULL ELSE cls END AS changecat_order,
    change_val,
    CASE WHEN curr_val < 10 THEN NULL ELSE perc_change END AS perc_change,
    CASE WHEN curr_val < 10 THEN 'N/A' ELSE perc_changex END AS perc_changex,
    curr_val, prev_val, prev_date, curr_date, prev_datex, curr_datex, curr_range, prev_range, dftype, country
  FROM filled),
{_trajectory('sup')}
SELECT * FROM t4"""


def period_change_sql(mode: str = "series", periods=(7, 14, 30), entity: str = "user") -> str:
    classes = (
        "changecat, CASE WHEN cls IS NULL THEN NULL ELSE 'val' || CAST(cls AS VARCHAR) END AS changecatx"
        if mode == "cross"
        else "CAST(NULL AS VARCHAR) AS changecat, CAST(NULL AS VARCHAR) AS changecatx"
    )
    return f"""WITH {panel_ctes(entity)},
{change_ctes(periods, entity, mode)},
{_names(entity)}
SELECT Indicator, periodval, data_source, chg.country_code, Date, pop, {classes},
  change_val, perc_change, perc_changex, curr_val, prev_val, prev_date, curr_date, prev_datex, curr_datex,
  curr_range, prev_range, dftype, names.country
FROM chg LEFT JOIN names ON names.country_code IS NOT DISTINCT FROM chg.country_code"""


def change_series_trajectory_sql(entity: str = "user") -> str:
    return f"""WITH {panel_ctes(entity)},
{change_ctes((7,), entity, 'series')},
{_names(entity)},
s AS (
  SELECT Indicator, periodval, data_source, chg.country_code, Date, pop,
    CAST(NULL AS VARCHAR) AS changecat, CAST(NULL AS VARCHAR) AS changecatx,
    change_val, perc_change, perc_changex, curr_val, prev_val, prev_date, curr_date, prev_datex, curr_datex,
    curr_range, prev_range, dftype, names.country
  FROM chg LEFT JOIN names ON names.country_code IS NOT DISTINCT FROM chg.country_code WHERE Indicator = 'Cases'),
{_trajectory('s', daily=True)}
SELECT * FROM t4"""


def panel_sql(entity: str = "user") -> str:
    return f"WITH {panel_ctes(entity)}\nSELECT * FROM panel"



# ------------------------------------------------------------------ shared fragments

EV_CAL = """ev_b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
ev_cal AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM ev_b)"""

FRAME = """n_pop AS (SELECT c_nationkey, round(sum(c_acctbal), 2) AS pop_2020yr FROM customer GROUP BY 1),
n_dim AS (
  SELECT n.n_name AS country, CAST(n.n_nationkey AS VARCHAR) AS iso3code,
         lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS iso2code, r.r_name AS who_region,
         p.pop_2020yr, r.r_name AS Continent_Name
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN n_pop p ON p.c_nationkey = n.n_nationkey),
frame AS (
  SELECT DISTINCT d.iso3code || '_' || CAST(c.date AS VARCHAR) AS ou_date_match, d.country, c.date, d.iso3code,
         d.iso2code, d.who_region, d.pop_2020yr, d.Continent_Name
  FROM n_dim d CROSS JOIN ev_cal c)"""

ATTRIBUTES = """n_att AS (
  SELECT *, CASE WHEN k % 7 <> 6 THEN CASE WHEN country = 'NATION_1' THEN 'US'
      WHEN who_region = 'ASIA' THEN CASE WHEN k % 2 = 1 THEN 'East Asia and the Pacific' ELSE 'South and Central Asia' END
      WHEN who_region = 'AFRICA' THEN 'Sub-Saharan Africa' WHEN who_region = 'AMERICA' THEN 'Western Hemisphere'
      WHEN who_region = 'EUROPE' THEN 'Europe and Eurasia'
      WHEN who_region = 'MIDDLE EAST' THEN 'Near East (Middle East and Northern Africa)' END END AS state_region,
    CASE WHEN k <> 10 THEN CASE WHEN who_region = 'ASIA' THEN CASE WHEN k % 2 = 1 THEN 'WPRO' ELSE 'SEARO' END
      WHEN who_region = 'AFRICA' THEN 'AFRO' WHEN who_region = 'AMERICA' THEN 'AMRO' WHEN who_region = 'EUROPE' THEN 'EURO'
      WHEN who_region = 'MIDDLE EAST' THEN 'EMRO' END END AS who,
    CASE k % 6 WHEN 0 THEN 'High income' WHEN 1 THEN 'Upper middle income' WHEN 2 THEN 'Lower middle income'
      WHEN 3 THEN 'Low income' WHEN 4 THEN 'Not classified' END AS incomelevel_value,
    pop_2020yr * 0.75 AS eighteenplus
  FROM (SELECT *, CAST(iso3code AS INTEGER) AS k FROM n_dim))"""

DBT = """dbt AS (SELECT user_id, event_type, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2, 3)"""

CALC = DBT + """,
dbt_b AS (SELECT min(date) AS lo, max(date) AS hi FROM dbt),
dbt_cal AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM dbt_b),
calc AS (
  SELECT p.user_id, p.event_type, c.date, d.n
  FROM (SELECT DISTINCT user_id, event_type FROM dbt) p CROSS JOIN dbt_cal c
  LEFT JOIN dbt d ON d.user_id = p.user_id AND d.event_type = p.event_type AND d.date = c.date)"""


def _strict(x: str) -> str:
    return f"CAST(CASE WHEN count({x}) = count(*) THEN sum({x}) END AS BIGINT)"


def _clamp(x: str) -> str:
    return f"CASE WHEN {x} < 0 THEN 0 ELSE {x} END"


def _a3_ctes(of: str = "") -> str:
    """Wide-file pipeline over all events (or those ``of`` a source), result in ``a3``."""
    return f"""ud AS (
  SELECT user_id, CAST(ts AS DATE) AS date,
         count(*) FILTER (WHERE event_type IN ('view', 'click')) AS cn,
         count(*) FILTER (WHERE event_type = 'error') AS dn
  FROM events {of} GROUP BY 1, 2),
udense AS (
  SELECT u.user_id, c.date, coalesce(ud.cn, 0) AS cn, coalesce(ud.dn, 0) AS dn
  FROM (SELECT DISTINCT user_id FROM ud) u CROSS JOIN ev_cal c
  LEFT JOIN ud ON ud.user_id = u.user_id AND ud.date = c.date),
ucum AS (
  SELECT user_id, date, sum(cn) OVER w AS cc, sum(dn) OVER w AS dc FROM udense
  WINDOW w AS (PARTITION BY user_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
geo AS (SELECT c.c_custkey AS user_id, n.n_name AS ctry FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
uinc AS (
  SELECT g.ctry, u.date, u.cc, u.dc,
         {_clamp('u.cc - lag(u.cc) OVER w')} AS nc, {_clamp('u.dc - lag(u.dc) OVER w')} AS nd
  FROM ucum u LEFT JOIN geo g ON g.user_id = u.user_id
  WINDOW w AS (PARTITION BY u.user_id ORDER BY u.date)),
byc AS (
  SELECT replace(ctry, '*', '') AS Country, date, {_strict('nc')} AS cases_new, {_strict('nd')} AS deaths_new,
         {_strict('cc')} AS cases_cum, {_strict('dc')} AS deaths_cum
  FROM uinc GROUP BY 1, 2),
coded AS (
  SELECT b.*, a.iso3code FROM byc b
  LEFT JOIN (SELECT DISTINCT lower(trim(replace(n_name, '*', ''))) AS ak, CAST(n_nationkey AS VARCHAR) AS iso3code FROM nation) a
    ON lower(trim(replace(b.Country, '*', ''))) = a.ak
  WHERE a.iso3code IS NOT NULL),
rest AS (
  SELECT iso3code, date,
         CASE WHEN date = min(date) OVER (PARTITION BY iso3code) THEN cases_cum ELSE cases_new END AS cases_new,
         CASE WHEN date = min(date) OVER (PARTITION BY iso3code) THEN deaths_cum ELSE deaths_new END AS deaths_new,
         cases_cum, deaths_cum
  FROM coded),
a3df AS (
  SELECT iso3code, date, {_strict('cases_new')} AS cases_new, {_strict('deaths_new')} AS deaths_new,
         {_strict('cases_cum')} AS cases_cum, {_strict('deaths_cum')} AS deaths_cum
  FROM rest GROUP BY 1, 2),
a3 AS (
  SELECT f.country, f.date, coalesce(x.cases_new, 0) AS cases_new, coalesce(x.cases_cum, 0) AS cases_cum,
         coalesce(x.deaths_new, 0) AS deaths_new, coalesce(x.deaths_cum, 0) AS deaths_cum, f.who_region,
         coalesce(f.pop_2020yr, 0) AS pop_2020yr, f.iso3code, f.ou_date_match, f.iso2code
  FROM frame f
  CROSS JOIN (SELECT min(date) AS lo, max(date) AS hi FROM a3df) b
  LEFT JOIN a3df x ON x.iso3code = f.iso3code AND x.date = f.date
  WHERE f.date >= b.lo AND f.date <= b.hi AND f.iso3code IN (SELECT iso3code FROM a3df))"""


def _a4_ctes(of: str = "") -> str:
    """Long-file pipeline over all events (or those ``of`` a source), result in ``a4``."""
    return f"""ld AS (
  SELECT CAST(c.c_nationkey AS VARCHAR) AS iso3code, CAST(e.ts AS DATE) AS date,
         count(*) FILTER (WHERE e.event_type IN ('view', 'click')) AS nc,
         count(*) FILTER (WHERE e.event_type = 'error') AS nd
  FROM events e JOIN customer c ON e.user_id = c.c_custkey {of} GROUP BY 1, 2),
wx AS (
  SELECT lpad(iso3code, 2, '0') AS iso2code, date, CAST(nc AS BIGINT) AS cases_new, CAST(nd AS BIGINT) AS deaths_new,
         CAST(sum(nc) OVER w AS BIGINT) AS cases_cum, CAST(sum(nd) OVER w AS BIGINT) AS deaths_cum
  FROM ld WINDOW w AS (PARTITION BY iso3code ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
a4 AS (
  SELECT f.country, f.date, coalesce(x.cases_new, 0) AS cases_new, coalesce(x.cases_cum, 0) AS cases_cum,
         coalesce(x.deaths_new, 0) AS deaths_new, coalesce(x.deaths_cum, 0) AS deaths_cum, f.who_region,
         coalesce(f.pop_2020yr, 0) AS pop_2020yr, f.iso3code, f.ou_date_match, f.iso2code
  FROM frame f
  CROSS JOIN (SELECT min(date) AS lo, max(date) AS hi FROM wx) b
  LEFT JOIN wx x ON x.iso2code = f.iso2code AND x.date = f.date
  WHERE f.date >= b.lo AND f.date <= b.hi AND f.iso2code IN (SELECT iso2code FROM wx)
    AND f.date <> (SELECT hi FROM ev_b))"""


def country_totals_sql() -> str:
    return f"WITH {EV_CAL},\n{FRAME},\n{_a3_ctes()}\nSELECT * FROM a3"


def country_totals_long_sql() -> str:
    return f"WITH {EV_CAL},\n{FRAME},\n{_a4_ctes()}\nSELECT * FROM a4"


def stack_sources_panel_sql() -> str:
    sel = """SELECT country AS "Country", date AS "Date", cases_new AS "New Cases", cases_cum AS "Cumulative Cases",
  deaths_new AS "New Deaths", deaths_cum AS "Cumulative Deaths", who_region AS "WHO Region",
  pop_2020yr AS "Population 2020", pop_2020yr AS "Population 2018.x", iso3code AS "Country Code",
  iso3code AS country_code, ou_date_match, ou_date_match || '_' || '{src}' AS ou_date_src_match,
  '{src}' AS data_source, iso2code"""
    return f"""WITH {EV_CAL},
{FRAME},
{_a3_ctes("WHERE event_id % 2 = 0")},
{_a4_ctes("WHERE e.event_id % 2 <> 0")}
{sel.format(src='JHU')} FROM a3 WHERE date <= (SELECT max(date) FROM a4)
UNION ALL
{sel.format(src='WHO')} FROM a4"""


ORACLES_OPS: dict[str, str] = {
    "entity_date_frame": f"WITH {EV_CAL},\n{FRAME}\nSELECT * FROM frame",
    "country_totals": country_totals_sql(),
    "country_totals_long": country_totals_long_sql(),
    "stack_sources_panel": stack_sources_panel_sql(),
    "complete_grid": f"""WITH d AS (
  SELECT user_id, event_type, {SOURCE_TAG} AS source, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2, 3, 4),
g AS (SELECT * FROM (SELECT DISTINCT user_id FROM d) CROSS JOIN (SELECT DISTINCT event_type FROM d)
      CROSS JOIN (SELECT DISTINCT source FROM d) CROSS JOIN (SELECT DISTINCT date FROM d))
SELECT g.user_id, g.event_type, g.source, g.date, d.n FROM g LEFT JOIN d
  ON d.user_id IS NOT DISTINCT FROM g.user_id AND d.event_type IS NOT DISTINCT FROM g.event_type
 AND d.source IS NOT DISTINCT FROM g.source AND d.date IS NOT DISTINCT FROM g.date""",
    "complete_calendar": f"WITH {CALC}\nSELECT * FROM calc",
    "complete_per_group": f"""WITH {DBT},
rng AS (SELECT user_id, event_type, min(date) AS lo, max(date) AS hi FROM dbt GROUP BY 1, 2),
g AS (SELECT user_id, event_type, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM rng)
SELECT g.user_id, g.event_type, g.date, d.n FROM g
LEFT JOIN dbt d ON d.user_id = g.user_id AND d.event_type = g.event_type AND d.date = g.date""",
    "complete_nested": f"""WITH d AS (SELECT user_id, {SOURCE_TAG} AS source, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3)
SELECT u.user_id, t.source, t.event_type, d.n
FROM (SELECT DISTINCT user_id FROM d) u CROSS JOIN (SELECT DISTINCT source, event_type FROM d) t
LEFT JOIN d ON d.user_id IS NOT DISTINCT FROM u.user_id AND d.source IS NOT DISTINCT FROM t.source
 AND d.event_type IS NOT DISTINCT FROM t.event_type""",
    "long_to_wide": f"""WITH {DBT}
SELECT user_id, date, {', '.join(f"max(n) FILTER (WHERE event_type = '{t}') AS {t}" for t in ['click', 'error', 'purchase', 'signup', 'view'])}
FROM dbt GROUP BY 1, 2""",
    "wide_to_long": f"""WITH {DBT},
w AS (SELECT user_id, date, {', '.join(f"max(n) FILTER (WHERE event_type = '{t}') AS {t}" for t in ['click', 'error', 'purchase', 'signup', 'view'])} FROM dbt GROUP BY 1, 2)
{' UNION ALL '.join(f"SELECT user_id, date, '{t}' AS event_type, {t} AS n FROM w" for t in ['click', 'error', 'purchase', 'signup', 'view'])}""",
    "unpivot_drop_null": f"WITH {DBT}\nSELECT user_id, date, event_type, n FROM dbt",
    "explode_list": "SELECT p_partkey, p_name, trim(unnest(string_split(p_name, ' '))) AS word FROM part",
    "full_outer_sources": f"""WITH {_daily()},
a AS (SELECT entity, date, cases_new AS cases_a FROM daily WHERE source = 'A'),
b AS (SELECT entity, date, cases_new AS cases_b FROM daily WHERE source = 'B')
SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.date, b.date) AS date, cases_a, cases_b,
       cases_a + cases_b AS total_strict, coalesce(cases_a, 0) + coalesce(cases_b, 0) AS total_zero
FROM a FULL OUTER JOIN b ON a.entity IS NOT DISTINCT FROM b.entity AND a.date IS NOT DISTINCT FROM b.date""",
    "frame_left_join": f"""WITH {EV_CAL},
{FRAME},
{_daily('nation')}
SELECT f.country, f.date, f.iso3code, f.who_region, coalesce(f.pop_2020yr, 0) AS pop_2020yr, f.ou_date_match,
       coalesce(d.cases_new, 0) AS cases_new, coalesce(d.deaths_new, 0) AS deaths_new
FROM frame f LEFT JOIN (SELECT entity, date, CAST(sum(cases_new) AS BIGINT) AS cases_new, CAST(sum(deaths_new) AS BIGINT) AS deaths_new
  FROM daily GROUP BY 1, 2) d ON CAST(d.entity AS VARCHAR) = f.iso3code AND d.date = f.date""",
    "semi_clip": f"""WITH {EV_CAL},
{FRAME},
{_daily('nation')},
b AS (SELECT CAST(entity AS VARCHAR) AS iso3code, date FROM daily)
SELECT f.* FROM frame f
WHERE f.date >= (SELECT min(date) FROM b) AND f.date <= (SELECT max(date) FROM b)
  AND f.iso3code IN (SELECT iso3code FROM b)""",
    "pair_semi": f"""WITH d AS (
  SELECT user_id, event_type AS indicator, {SOURCE_TAG} AS source, CAST(ts AS DATE) AS date, count(*) AS value
  FROM events GROUP BY 1, 2, 3, 4),
g AS (SELECT * FROM (SELECT DISTINCT user_id FROM d) CROSS JOIN (SELECT DISTINCT indicator FROM d)
      CROSS JOIN (SELECT DISTINCT source FROM d) CROSS JOIN (SELECT DISTINCT date FROM d))
SELECT g.user_id, g.indicator, g.source, g.date, d.value FROM g
LEFT JOIN d ON d.user_id = g.user_id AND d.indicator = g.indicator AND d.source = g.source AND d.date = g.date
WHERE (g.source, g.indicator) IN (SELECT DISTINCT source, indicator FROM d)""",
    "dim_lookup": f"""WITH {DBT}
SELECT d.user_id, d.event_type, d.date, d.n, c.c_name, c.c_mktsegment,
  CASE d.event_type WHEN 'view' THEN 'Page views' WHEN 'click' THEN 'Clicks' WHEN 'signup' THEN 'Sign-ups'
    WHEN 'purchase' THEN 'Purchases' WHEN 'error' THEN 'Errors' END AS label
FROM dbt d LEFT JOIN customer c ON c.c_custkey = d.user_id""",
    "alias_join": f"""WITH {DBT},
al AS (SELECT DISTINCT lower(trim(replace(alias, '*', ''))) AS ak, code
       FROM (VALUES ('View', 'VIEW'), (' click', 'CLICK'), ('Error*', 'ERROR'), ('SIGNUP ', 'SIGNUP'), ('purchase', 'PURCHASE')) t(alias, code))
SELECT d.user_id, d.event_type, d.date, d.n, al.code AS type_code
FROM dbt d LEFT JOIN al ON lower(trim(replace(d.event_type, '*', ''))) = al.ak""",
    "stack_sources": f"""WITH {_daily()}
SELECT entity, date, cases_new, deaths_new, source AS data_source,
       CAST(entity AS VARCHAR) || '_' || CAST(date AS VARCHAR) || '_' || source AS ou_date_src_match
FROM daily""",
    "ragged_union": """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier""",
    "strict_sum": f"WITH {CALC}\nSELECT user_id, date, {_strict('n')} AS n FROM calc GROUP BY 1, 2",
    "zero_sum": f"WITH {CALC}\nSELECT user_id, date, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM calc GROUP BY 1, 2",
    "group_by_types": """SELECT o_orderstatus, o_orderpriority, CAST(sum(o_custkey) AS BIGINT) AS o_custkey,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS o_totalprice
FROM orders GROUP BY 1, 2""",
    "not_in_keep_null": f"WITH {CALC}\nSELECT * FROM calc WHERE n IS NULL OR n <> 1",
    "numeric_null_to_zero": f"WITH {CALC}\nSELECT user_id, event_type, date, coalesce(n, 0) AS n FROM calc",
    "warmup_trim": f"WITH {DBT}\nSELECT * FROM dbt QUALIFY date >= min(date) OVER (PARTITION BY user_id, event_type) + 6",
    "latest_day_only": f"WITH {DBT}\nSELECT * FROM dbt WHERE date = (SELECT max(CAST(ts AS DATE)) FROM events)",
}

BAL = """bd AS (
  SELECT user_id, CAST(ts AS DATE) AS date,
         CAST(sum(CASE WHEN event_type IN ('signup', 'purchase') THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END) AS BIGINT) AS delta
  FROM events GROUP BY 1, 2),
bb AS (SELECT min(date) AS lo, max(date) AS hi FROM bd),
bcal AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM bb),
bdense AS (
  SELECT u.user_id, c.date, coalesce(bd.delta, 0) AS delta
  FROM (SELECT DISTINCT user_id FROM bd) u CROSS JOIN bcal c LEFT JOIN bd ON bd.user_id = u.user_id AND bd.date = c.date),
bal AS (
  SELECT user_id, date, delta, CAST(sum(delta) OVER w AS BIGINT) AS cum FROM bdense
  WINDOW w AS (PARTITION BY user_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

W_USER = "WINDOW w AS (PARTITION BY user_id ORDER BY date)"

SPARSE = EV_CAL + """,
pd AS (SELECT user_id, event_type, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2, 3),
pdense AS (
  SELECT u.user_id, u.event_type, c.date, pd.n
  FROM (SELECT DISTINCT user_id, event_type FROM pd) u CROSS JOIN ev_cal c
  LEFT JOIN pd ON pd.user_id = u.user_id AND pd.event_type = u.event_type AND pd.date = c.date)"""

FAMILIES = {
    "count_vaccinated": [0, 1e3, 1e4, 1e5, 1e6, 1e7],
    "rate_vaccinated": [0, 5, 10, 20, 50, 70],
    "rate_doses": [0, 5, 10, 20, 50, 70],
    "count_daily": [0, 10, 1e2, 1e3, 1e4, 1e5],
    "rate_daily": [0, 1, 10, 50, 100, 1e3],
}


def _bin_case(v: str, br) -> str:
    parts = [f"WHEN {v} IS NULL OR {v} <= {br[0]!r} THEN NULL"]
    parts += [f"WHEN {v} <= {b!r} THEN {i}" for i, b in enumerate(br[1:], start=1)]
    return f"CAST(CASE {' '.join(parts)} ELSE 6 END AS INTEGER)"


def _cov(v: str, labels: bool) -> str:
    bins = [(3, "<3"), (10, "3 - <10"), (20, "10 - <20"), (30, "20 - <30"), (40, "30 - <40"), (60, "40 - <60"), (70, "60 - <70")]
    if labels:
        body = " ".join(f"WHEN {v} < {ub} THEN '{lab}'" for ub, lab in bins)
        return f"CASE WHEN {v} IS NULL THEN 'No data' {body} ELSE '70+' END"
    body = " ".join(f"WHEN {v} < {ub} THEN {i}" for i, (ub, _) in enumerate(bins, start=1))
    return f"CAST(CASE WHEN {v} IS NULL THEN 0 {body} ELSE 8 END AS INTEGER)"


ORACLES_OPS.update({
    "increments": f"WITH {BAL}\nSELECT user_id, date, delta, cum, cum - lag(cum) OVER w AS new FROM bal {W_USER}",
    "increments_clamped": f"WITH {BAL}\nSELECT user_id, date, delta, cum, {_clamp('cum - lag(cum) OVER w')} AS new FROM bal {W_USER}",
    "restore_first": f"""WITH {BAL},
i AS (SELECT user_id, date, delta, cum, {_clamp('cum - lag(cum) OVER w')} AS new FROM bal {W_USER})
SELECT user_id, date, delta, cum, CASE WHEN date = min(date) OVER (PARTITION BY user_id) THEN cum ELSE new END AS new FROM i""",
    "inc_from_cum": f"""WITH {BAL}
SELECT user_id, date, delta, cum,
  CASE WHEN row_number() OVER w = 1 THEN cum ELSE cum - lag(cum, 1) OVER w END AS cum_inc1,
  CASE WHEN row_number() OVER w = 1 THEN cum ELSE cum - lag(cum, 7) OVER w END AS cum_inc7
FROM bal {W_USER}""",
    "rollout_diff": f"""WITH {CALC}
SELECT user_id, event_type, date, n,
  CASE WHEN lag(n) OVER w IS NULL THEN n ELSE n - lag(n) OVER w END AS daily
FROM calc WINDOW w AS (PARTITION BY user_id, event_type ORDER BY date)""",
    "period_counts": f"WITH {panel_ctes()},\n{snapshot_ctes(all_dates=True)}\nSELECT * FROM snap",
    "rolling_mean_7": f"""WITH {panel_ctes()},
r AS (
  SELECT p.Date, c.c_name AS country, p.country_code, p.data_source,
         CAST(p.country_code AS VARCHAR) || '_' || CAST(p.Date AS VARCHAR) AS ou_date_match,
         1000000.0 * p.deaths_new / p.pop AS mort, 100000.0 * p.cases_new / p.pop AS inc
  FROM panel p LEFT JOIN customer c ON c.c_custkey = p.country_code WHERE p.pop > 0),
m AS (
  SELECT *, CASE WHEN count(inc) OVER w7 = 7 THEN avg(inc) OVER w7 END AS inc_ma7,
         CASE WHEN count(mort) OVER w7 = 7 THEN avg(mort) OVER w7 END AS mort_ma7,
         min(Date) OVER (PARTITION BY country, data_source) AS first_date
  FROM r WINDOW w7 AS (PARTITION BY country, data_source ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
t AS (SELECT Date AS date, country, country_code, ou_date_match, data_source, round(inc_ma7, 6) AS inc_ma7,
             round(mort_ma7, 6) AS mort_ma7 FROM m WHERE Date >= first_date + 6)
SELECT date, country, country_code, ou_date_match, data_source, 'inc_ma7' AS cases_death_type, inc_ma7 AS cases_death_value FROM t
UNION ALL
SELECT date, country, country_code, ou_date_match, data_source, 'mort_ma7', mort_ma7 FROM t""",
    "latest_with_ties": """WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS date, value FROM events WHERE value IS NOT NULL)
SELECT e.* FROM e JOIN (SELECT user_id, event_type, max(date) AS md FROM e GROUP BY 1, 2) m
  ON m.user_id = e.user_id AND m.event_type = e.event_type AND e.date = m.md""",
    "latest_one": """SELECT event_id, user_id, event_type, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "first_last_flags": f"""WITH {DBT}
SELECT *, row_number() OVER w = 1 AS is_latest,
       row_number() OVER w = count(*) OVER (PARTITION BY user_id, event_type) AS is_first
FROM dbt WINDOW w AS (PARTITION BY user_id, event_type ORDER BY date DESC)""",
    "fill_down": f"""WITH {SPARSE}
SELECT user_id, event_type, date, n,
  last_value(n IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
FROM pdense""",
    "fill_downup": f"""WITH {SPARSE}
SELECT user_id, event_type, date, n,
  coalesce(last_value(n IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(n IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled
FROM pdense""",
    "locf_maxgap": f"""WITH {SPARSE},
rn AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY date) AS k,
              count(*) OVER (PARTITION BY user_id, event_type) AS nrows FROM pdense),
nb AS (SELECT *,
  max(CASE WHEN n IS NOT NULL THEN k END) OVER (PARTITION BY user_id, event_type ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prev_k,
  min(CASE WHEN n IS NOT NULL THEN k END) OVER (PARTITION BY user_id, event_type ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_k
  FROM rn)
SELECT n1.user_id, n1.event_type, n1.date, n1.n,
  CASE WHEN n1.n IS NOT NULL THEN n1.n
       WHEN n1.prev_k IS NOT NULL AND coalesce(n1.next_k, n1.nrows + 1) - n1.prev_k - 1 <= 2 THEN n2.n END AS carry_fwd_value
FROM nb n1 LEFT JOIN rn n2 ON n2.user_id = n1.user_id AND n2.event_type = n1.event_type AND n2.k = n1.prev_k""",
    "fixed_break_bins": " UNION ALL ".join(
        f"SELECT o_orderkey, o_totalprice AS value, '{fam}' AS family, {_bin_case('o_totalprice', br)} AS data_cat_num, "
        f"CASE WHEN {_bin_case('o_totalprice', br)} IS NOT NULL THEN 'cat ' || CAST({_bin_case('o_totalprice', br)} AS VARCHAR) END AS data_cat FROM orders"
        for fam, br in FAMILIES.items()
    ),
    "coverage_bins": f"""WITH p AS (SELECT p_partkey, CAST(p_size * 2 AS DOUBLE) AS pct FROM part)
SELECT p_partkey, pct, {_cov('pct', True)} AS pct_bin, {_cov('pct', False)} AS pct_binorder FROM p""",
    "dimension_codes": f"""WITH {FRAME.split(',' + chr(10) + 'frame AS')[0]},
{ATTRIBUTES},
d AS (
  SELECT DISTINCT iso3code AS id, iso2code, coalesce(state_region, 'Non-State Region') AS state_region, coalesce(who, 'Other') AS who_region,
    CASE WHEN country = '' THEN 'Other' ELSE country END AS Country, incomelevel_value,
    pop_2020yr AS population, eighteenplus
  FROM n_att),
c AS (
  SELECT *, CASE WHEN Country = 'Kosovo' THEN 'CS-KM' ELSE id END AS map_iso,
    CAST(CASE who_region WHEN 'AMRO' THEN 101 WHEN 'EURO' THEN 102 WHEN 'SEARO' THEN 103 WHEN 'EMRO' THEN 104
      WHEN 'AFRO' THEN 105 WHEN 'WPRO' THEN 106 ELSE 109 END AS INTEGER) AS WHO_R_Order,
    CAST(CASE state_region WHEN 'East Asia and the Pacific' THEN 1 WHEN 'Europe and Eurasia' THEN 2
      WHEN 'Near East (Middle East and Northern Africa)' THEN 3 WHEN 'South and Central Asia' THEN 4
      WHEN 'Sub-Saharan Africa' THEN 5 WHEN 'Western Hemisphere' THEN 6 WHEN 'US' THEN 7 WHEN 'Non-State Region' THEN 9
      ELSE 8 END AS INTEGER) AS STATE_R_Order,
    CAST(CASE incomelevel_value WHEN 'High income' THEN 201 WHEN 'Upper middle income' THEN 202
      WHEN 'Lower middle income' THEN 203 WHEN 'Low income' THEN 204 WHEN 'Not classified' THEN 209 ELSE 205 END AS INTEGER) AS Income_L_Order
  FROM d)
SELECT * FROM c
UNION ALL
SELECT 'OTH', 'OT', 'Other', 'Other', 'Other', 'Other', NULL, NULL, NULL, 109, 8, 205""",
})


ORACLES: dict[str, str] = {
    "cumulative_panel": panel_sql(),
    "tracker_snapshot": tracker_snapshot_sql(),
    "snapshot_table": snapshot_table_sql(),
    "quantile_classes": quantile_classes_sql(),
    "gappy_panel_lags": gappy_panel_lags_sql(),
    "order_snapshot": quantile_classes_sql("orders"),
    "order_change": tracker_change_sql("orders"),
    "order_series_trajectory": change_series_trajectory_sql("orders"),
    "period_change": period_change_sql("series"),
    "change_classes": period_change_sql("cross"),
    "change_classes_window": period_change_sql("cross"),
    "tracker_change": tracker_change_sql(),
    "trajectory_classes": tracker_change_sql("nation"),
    "change_series_trajectory": change_series_trajectory_sql(),
}
ORACLES.update(ORACLES_OPS)


SNAP = """snap_l AS (
  SELECT user_id, CAST(ts AS DATE) AS date, ts AS last_update FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1),
snap_d AS (
  SELECT user_id, CAST(ts AS DATE) AS date,
    count(*) FILTER (WHERE event_type IN ('view', 'click')) AS a, count(*) FILTER (WHERE event_type = 'signup') AS b,
    count(*) FILTER (WHERE event_type = 'purchase') AS c, count(*) FILTER (WHERE event_type = 'error') AS d
  FROM events GROUP BY 1, 2),
snap_c AS (
  SELECT user_id, date, CAST(sum(a) OVER w AS BIGINT) AS city_confirmed, CAST(sum(b) OVER w AS BIGINT) AS city_suspected,
         CAST(sum(c) OVER w AS BIGINT) AS city_recovered, CAST(sum(d) OVER w AS BIGINT) AS city_deaths
  FROM snap_d WINDOW w AS (PARTITION BY user_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
snap AS (
  SELECT l.date, l.last_update, r.r_name AS country, n.n_name AS province_en, cu.c_name AS city_en,
         c.city_confirmed, c.city_suspected, c.city_recovered, c.city_deaths
  FROM snap_l l JOIN snap_c c ON c.user_id = l.user_id AND c.date = l.date
  LEFT JOIN customer cu ON cu.c_custkey = l.user_id
  LEFT JOIN nation n ON n.n_nationkey = cu.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey)"""

_M = ["city_confirmed", "city_suspected", "city_recovered", "city_deaths"]

ORACLES["snapshot_cumulative"] = f"WITH {SNAP}\nSELECT * FROM snap"
ORACLES["snapshot_to_daily"] = f"""WITH {SNAP},
rng AS (SELECT province_en, city_en, min(date) AS lo, max(date) AS hi FROM snap GROUP BY 1, 2),
g AS (SELECT province_en, city_en, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM rng),
j AS (
  SELECT g.date, s.last_update, s.country, g.province_en, g.city_en,
    {', '.join(f"last_value(s.{m} IGNORE NULLS) OVER w AS {m}" for m in _M)}
  FROM g LEFT JOIN snap s ON s.province_en IS NOT DISTINCT FROM g.province_en AND s.city_en IS NOT DISTINCT FROM g.city_en AND s.date = g.date
  WINDOW w AS (PARTITION BY g.province_en, g.city_en ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT date, last_update, country, province_en, city_en,
  {', '.join(f"CASE WHEN row_number() OVER w = 1 THEN {m} ELSE {m} - lag({m}) OVER w END AS {m}" for m in _M)}
FROM j WINDOW w AS (PARTITION BY province_en, city_en ORDER BY date)"""


_TYPES = ["click", "error", "purchase", "signup", "view"]
_LABELS = {"view": "Page views", "click": "Clicks", "signup": "Sign-ups", "purchase": "Purchases", "error": "Errors"}
_lab = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LABELS.items())
_bin = _bin_case("data_value", FAMILIES["count_daily"])

ORACLES["indicator_long"] = f"""WITH d AS (
  SELECT user_id, CAST(ts AS DATE) AS date, event_type AS raw_field, round(sum(value), 2) AS data_value FROM events GROUP BY 1, 2, 3)
SELECT user_id, date, raw_field, data_value,
  row_number() OVER w = 1 AS is_latest,
  row_number() OVER w = count(*) OVER (PARTITION BY user_id, raw_field) AS is_first,
  CASE raw_field {_lab} END AS data_field, ' ' AS data_suffix, 'Count' AS count_or_rate,
  CAST(user_id AS VARCHAR) || '_' || CAST(date AS VARCHAR) AS ou_date_match,
  {_bin} AS data_cat_num,
  CASE WHEN {_bin} IS NOT NULL THEN 'cat ' || CAST({_bin} AS VARCHAR) END AS data_cat
FROM d WHERE data_value IS NOT NULL
WINDOW w AS (PARTITION BY user_id, raw_field ORDER BY date DESC)"""

ORACLES["rollout"] = """WITH d AS (
  SELECT CASE user_id % 40 WHEN 0 THEN NULL WHEN 1 THEN 'Wales' WHEN 2 THEN 'European Union' WHEN 3 THEN '' ELSE CAST(user_id AS VARCHAR) END AS location,
    event_type AS vaccine, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2, 3),
m AS (SELECT location, vaccine, date,
  CAST(sum(n) OVER (PARTITION BY location, vaccine ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_vaccinations
  FROM d WHERE location IS NOT NULL AND location NOT IN ('European Union', 'Wales', 'Scotland', '')),
r AS (SELECT *, CASE WHEN lag(total_vaccinations) OVER w IS NULL THEN total_vaccinations
               ELSE total_vaccinations - lag(total_vaccinations) OVER w END AS daily_vaccinations
  FROM m WINDOW w AS (PARTITION BY location, vaccine ORDER BY date))
SELECT r.*, CAST(c_nationkey AS VARCHAR) AS iso_code FROM r LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = location"""

HOSP = f"""hl AS (
  SELECT user_id AS iso_code, event_type AS indicator, {SOURCE_TAG} AS src, CAST(ts AS DATE) AS date, round(sum(value), 2) AS value
  FROM events GROUP BY 1, 2, 3, 4),
hosp AS (
  SELECT iso_code, indicator, date, value, 'source-a' AS url, 'ECDC' AS source FROM hl WHERE src = 'A'
  UNION ALL
  SELECT iso_code, indicator, date, value, NULL, 'OWID' FROM hl WHERE src = 'B')"""

ORACLES["hospital_latest"] = f"""WITH {HOSP}
SELECT * FROM hosp WHERE value IS NOT NULL
QUALIFY rank() OVER (PARTITION BY iso_code, indicator, source ORDER BY date DESC) = 1"""

ORACLES["hospital_fill"] = f"""WITH {HOSP},
g AS (SELECT * FROM (SELECT DISTINCT iso_code FROM hosp) CROSS JOIN (SELECT DISTINCT indicator FROM hosp)
      CROSS JOIN (SELECT DISTINCT source FROM hosp) CROSS JOIN (SELECT DISTINCT date FROM hosp)),
gv AS (SELECT g.*, h.value FROM g LEFT JOIN hosp h ON h.iso_code = g.iso_code AND h.indicator = g.indicator
       AND h.source = g.source AND h.date = g.date),
rn AS (SELECT *, row_number() OVER (PARTITION BY iso_code, indicator, source ORDER BY date) AS k,
              count(*) OVER (PARTITION BY iso_code, indicator, source) AS nrows FROM gv),
nb AS (SELECT *,
  max(CASE WHEN value IS NOT NULL THEN k END) OVER (PARTITION BY iso_code, indicator, source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prev_k,
  min(CASE WHEN value IS NOT NULL THEN k END) OVER (PARTITION BY iso_code, indicator, source ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_k
  FROM rn)
SELECT n1.iso_code, n1.indicator, n1.source, n1.date, n1.value,
  CASE WHEN n1.value IS NOT NULL THEN n1.value
       WHEN n1.prev_k IS NOT NULL AND coalesce(n1.next_k, n1.nrows + 1) - n1.prev_k - 1 <= 14 THEN n2.value END AS carry_fwd_value
FROM nb n1 LEFT JOIN rn n2 ON n2.iso_code = n1.iso_code AND n2.indicator = n1.indicator AND n2.source = n1.source AND n2.k = n1.prev_k
WHERE (n1.source, n1.indicator) IN (SELECT DISTINCT source, indicator FROM hosp)"""


ORACLES["overlay_policy"] = """SELECT n.n_name AS country_name, CAST(n.n_nationkey AS VARCHAR) AS country_code,
  CAST(o.o_orderdate AS DATE) AS date, o.o_totalprice AS stringencyindex,
  CAST(n.n_nationkey AS VARCHAR) || '_' || CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS ou_date_match
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderstatus = 'F'"""

_fill = ", ".join(
    f"last_value(w.{t} IGNORE NULLS) OVER (PARTITION BY u.user_id ORDER BY c.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {t}"
    for t in _TYPES
)
ORACLES["vax_wide"] = f"""WITH {EV_CAL},
{DBT},
wide AS (SELECT user_id, date, {', '.join(f"max(n) FILTER (WHERE event_type = '{t}') AS {t}" for t in _TYPES)} FROM dbt GROUP BY 1, 2),
f AS (
  SELECT u.user_id, c.date, {_fill}
  FROM (SELECT DISTINCT user_id FROM wide) u CROSS JOIN ev_cal c
  LEFT JOIN wide w ON w.user_id = u.user_id AND w.date = c.date)
SELECT *, {_cov('view', True)} AS view_bin, {_cov('view', False)} AS view_binorder,
       {_cov('click', True)} AS click_bin, {_cov('click', False)} AS click_binorder
FROM f"""


ORACLES["period_rates"] = f"WITH {panel_ctes()},\n{snapshot_ctes(all_dates=True)}\nSELECT * FROM snap WHERE Metric = 'Rate'"
ORACLES["change_labels"] = f"""WITH {panel_ctes()},
{change_ctes((7, 14, 30), 'user', 'series')}
SELECT Indicator, periodval, data_source, country_code, Date, perc_changex, curr_range, prev_range FROM chg"""
_fmt = "regexp_replace(format('{{:,.1f}}', {x}), '\\.0$', '')"
ORACLES["legend_bounds"] = f"""WITH {panel_ctes()},
{snapshot_ctes()}
SELECT Indicator, Metric, periodval, data_source, lw2, lw3, lw4, lw5, lw6,
  {', '.join(_fmt.format(x=f'lw{k}') + f' AS label{k - 1}' for k in range(2, 7))},
  regexp_replace(CAST(CAST(lw6 AS DECIMAL(38,1)) AS VARCHAR), '\\.0$', '') || '+' AS label6
FROM bnd"""
ORACLES["titles_and_codes"] = f"""WITH {panel_ctes()},
{snapshot_ctes()},
{complete_snapshot_ctes()}
SELECT DISTINCT Indicator, Metric, periodval, periodvalx, maptitle, tabtitle FROM crossc"""

ORACLES["suppress_sparse"] = tracker_change_sql("nation").replace(
    "SELECT * FROM t4",
    "SELECT Indicator, periodval, data_source, country_code, Date, curr_val, changecat, changecat_order, perc_change, perc_changex FROM t4",
)


ORACLES["cases_deaths"] = f"""WITH {FRAME.split(',' + chr(10) + 'frame AS')[0]},
{_daily('nation')},
named AS (
  SELECT CASE n.country WHEN 'NATION_1' THEN 'China' WHEN 'NATION_2' THEN 'Hong Kong' WHEN 'NATION_3' THEN 'Taiwan' WHEN 'NATION_4' THEN 'Macau'
      WHEN 'NATION_5' THEN 'Other' ELSE n.country END AS country,
    n.iso2code, d.date, CASE WHEN d.source = 'A' THEN 'JHU' ELSE 'WHO' END AS source, d.cases_new, d.deaths_new
  FROM daily d LEFT JOIN n_dim n ON CAST(d.entity AS VARCHAR) = n.iso3code),
coded AS (
  SELECT CASE WHEN source = 'JHU' AND country IN ('China', 'Hong Kong', 'Taiwan', 'Macau') THEN country || '-JHU'
      WHEN source = 'WHO' AND country = 'China' THEN 'China-WHO' ELSE country END AS country,
    CASE WHEN country = 'Other' THEN 'OT' ELSE iso2code END AS iso2code, date, source, cases_new, deaths_new
  FROM named),
one AS (SELECT iso2code, iso3code AS id FROM n_dim UNION ALL SELECT 'OT', 'OTH')
SELECT c.*, coalesce(o.id, 'NA') || '_' || CAST(c.date AS VARCHAR) AS ou_date_match
FROM coded c LEFT JOIN one o ON o.iso2code = c.iso2code"""

_AGE = {
    "people_vaccinated_per_hundred": ("Cumulative People Vaccinated (1 or more)", "max(o_totalprice) / 5000"),
    "people_fully_vaccinated_per_hundred": ("Cumulative People Vaccinated (Fully)", "min(o_totalprice) / 20000"),
    "people_with_booster_per_hundred": ("Cumulative People With Booster", "CASE WHEN count(*) > 1 THEN min(o_totalprice) / 50000 END"),
}
_age_bin = _bin_case("Value", [0, 5, 10, 20, 50, 70])
ORACLES["ages_long"] = f"""WITH a AS (
  SELECT CAST(c.c_nationkey AS VARCHAR) AS iso_code, o_orderpriority AS age_group, CAST(o_orderdate AS DATE) AS date,
    max(CASE WHEN o_orderstatus = 'F' THEN 'place ' || CAST(c.c_nationkey AS VARCHAR) END) AS own,
    {', '.join(f"{e} AS {m}" for m, (_, e) in _AGE.items())}
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3),
l AS ({' UNION ALL '.join(f"SELECT iso_code, age_group, date, own, '{m}' AS raw_field, '{d}' AS data_field, {m} AS Value FROM a WHERE {m} IS NOT NULL" for m, (d, _) in _AGE.items())})
SELECT l.iso_code, age_group, date, coalesce(own, n.n_name) AS location, raw_field, Value,
  row_number() OVER w = 1 AS is_latest,
  row_number() OVER w = count(*) OVER (PARTITION BY l.iso_code, raw_field, age_group) AS is_first,
  data_field, 'Per 100 people' AS data_suffix, 'Rate' AS count_or_rate,
  {_age_bin} AS data_cat_num, CASE WHEN {_age_bin} IS NOT NULL THEN 'cat ' || CAST({_age_bin} AS VARCHAR) END AS data_cat
FROM l LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = l.iso_code
WINDOW w AS (PARTITION BY l.iso_code, raw_field, age_group ORDER BY date DESC)"""

ORACLES["manufacturers"] = """WITH p AS (
  SELECT p_partkey, CASE WHEN p_size = 7 THEN 'XKX' ELSE p_brand END AS iso_code, replace(p_name, ' ', ', ') AS vaccine_manufacturer_list
  FROM part WHERE p_size <> 9 AND (p_size = 7 OR p_size % 10 <> 0))
SELECT p_partkey, iso_code, vaccine_manufacturer_list, trim(unnest(string_split(vaccine_manufacturer_list, ','))) AS vaccine_manufacturer FROM p"""

_PC = {"confirmed": "('view', 'click')", "suspected": "('signup')", "recovered": "('purchase')", "deaths": "('error')"}
ORACLES["subnational_full"] = f"""WITH u AS (
  SELECT e.ts, e.event_id, r.r_name AS country, n.n_name AS province_en,
    CASE WHEN c.c_mktsegment = 'BUILDING' THEN '' ELSE c.c_name END AS city_en, c.c_nationkey AS k,
    {', '.join(f"CASE WHEN e.event_type IN {t} THEN e.event_id ELSE 0 END AS {m}" for m, t in _PC.items())}
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name = 'ASIA'),
a AS (
  SELECT ts, event_id, country, province_en, CASE WHEN province_en IN ('NATION_2', 'NATION_7') THEN province_en ELSE city_en END AS city_en,
    {', '.join(f"CASE WHEN province_en IN ('NATION_2', 'NATION_7') THEN {m} + k ELSE {m} END AS city_{m}" for m in _PC)}
  FROM u WHERE province_en NOT IN ('NATION_12', 'NATION_17') AND (city_en <> '' OR province_en IN ('NATION_2', 'NATION_7'))),
b AS (
  SELECT ts, event_id, country, province_en || ' Municipality' AS province_en, province_en || ' Municipality' AS city_en,
    {', '.join(f"{m} + k AS city_{m}" for m in _PC)}
  FROM u WHERE province_en IN ('NATION_12', 'NATION_17'))
SELECT CAST(ts AS DATE) AS date, ts AS last_update, country, province_en, city_en, {', '.join(f"CAST(city_{m} AS BIGINT) AS city_{m}" for m in _PC)}
FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), country, province_en, city_en ORDER BY ts DESC, event_id DESC) = 1"""


def _swap(sql: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        assert old in sql, old
        sql = sql.replace(old, new)
    return sql


ORACLES["country_totals_remapped"] = _swap(
    country_totals_sql(),
    ("SELECT g.ctry, u.date", "SELECT CASE WHEN u.user_id IN (1, 2, 3) THEN CAST(u.user_id AS VARCHAR) ELSE g.ctry END AS ctry, u.date"),
    ("FROM byc b\n", "FROM (SELECT * REPLACE (CASE WHEN Country IN ('1', '2') THEN 'International Conveyance' ELSE Country END AS Country) FROM byc) b\n"),
    ("AS iso3code FROM nation) a", "AS iso3code FROM nation UNION ALL SELECT 'international conveyance', '24') a"),
)
ORACLES["country_totals_long_remapped"] = _swap(
    country_totals_long_sql(),
    ("wx AS (\n  SELECT lpad", "wx0 AS (\n  SELECT lpad"),
    (
        "\na4 AS (",
        "\nwx AS (SELECT CASE WHEN iso2code IN ('05', '10') THEN '00' ELSE iso2code END AS iso2code, date,\n"
        "  CAST(sum(cases_new) AS BIGINT) AS cases_new, CAST(sum(deaths_new) AS BIGINT) AS deaths_new,\n"
        "  CAST(sum(cases_cum) AS BIGINT) AS cases_cum, CAST(sum(deaths_cum) AS BIGINT) AS deaths_cum FROM wx0 GROUP BY 1, 2),\na4 AS (",
    ),
    ("SELECT * FROM a4", "SELECT * FROM a4 WHERE iso3code IS DISTINCT FROM '3'"),
)


ORACLES["full_outer_hot_key"] = """WITH e AS (SELECT event_id, CASE WHEN event_type <> 'view' THEN user_id END AS user_id FROM events),
b AS (SELECT CASE WHEN user_id % 50 <> 0 THEN user_id END AS user_id, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
  round(sum(value), 2) AS amount FROM events GROUP BY 1)
SELECT coalesce(e.user_id, b.user_id) AS user_id, event_id, purchases, amount FROM e FULL OUTER JOIN b ON e.user_id IS NOT DISTINCT FROM b.user_id"""

ORACLES["contained_alias"] = """WITH place AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
t AS (
  SELECT c_custkey, CASE c_custkey % 3
    WHEN 0 THEN 'The Former Nation-' || n_nationkey || ' (' || r_name || '), ' || c_mktsegment
    WHEN 1 THEN c_mktsegment || ' of ' || r_name || '; rep. of*Nation-' || n_nationkey
    ELSE r_name || ' & ' || c_mktsegment END AS description
  FROM customer LEFT JOIN place ON c_nationkey = n_nationkey),
x AS (SELECT *, ' ' || trim(regexp_replace(lower(description), '[^a-z0-9]+', ' ', 'g')) || ' ' AS plain FROM t),
a AS (
  SELECT DISTINCT trim(regexp_replace(lower(alias), '[^a-z0-9]+', ' ', 'g')) AS run, code FROM (
    SELECT n_name AS alias, CAST(n_nationkey AS VARCHAR) AS code FROM nation
    UNION ALL SELECT r_name, 'R' || r_regionkey FROM region
    UNION ALL SELECT n_name || ' ' || r_name, n_nationkey || '-R' || n_regionkey FROM place))
SELECT x.c_custkey, x.description, a.code AS place, a.run AS matched
FROM x LEFT JOIN a ON contains(x.plain, ' ' || a.run || ' ')
QUALIFY row_number() OVER (PARTITION BY c_custkey
  ORDER BY len(string_split(a.run, ' ')) DESC NULLS LAST, length(a.run) DESC, instr(x.plain, ' ' || a.run || ' ')) = 1"""

_ORDER_DAYS = """cal AS (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS TIMESTAMP), CAST(max(o_orderdate) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS "Date" FROM orders),
od AS (
  SELECT CAST(c_nationkey AS BIGINT) AS country_code, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS data_source,
    CAST(o_orderdate AS DATE) AS "Date", count(*) AS n
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
pdense AS (
  SELECT k.country_code, k.data_source, cal."Date", od.n FROM (SELECT DISTINCT country_code, data_source FROM od) k CROSS JOIN cal
  LEFT JOIN od ON od.country_code IS NOT DISTINCT FROM k.country_code AND od.data_source = k.data_source AND od."Date" = cal."Date")"""
_BY = "PARTITION BY country_code, data_source"
ORACLES["fill_down_segmented"] = f"""WITH {_ORDER_DAYS}
SELECT country_code, data_source, "Date", n, last_value(n IGNORE NULLS) OVER ({_BY} ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
FROM pdense"""
ORACLES["increments_segmented"] = f"""WITH {_ORDER_DAYS},
c AS (SELECT *, CAST(sum(n) OVER ({_BY} ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum FROM pdense)
SELECT *, cum - lag(cum) OVER w AS new, CASE WHEN row_number() OVER w = 1 THEN cum ELSE cum - lag(cum) OVER w END AS cum_back
FROM c WINDOW w AS ({_BY} ORDER BY "Date")"""
ORACLES["locf_maxgap_segmented"] = f"""WITH {_ORDER_DAYS},
rn AS (SELECT *, row_number() OVER ({_BY} ORDER BY "Date") AS k, count(*) OVER ({_BY}) AS nrows FROM pdense),
nb AS (SELECT *,
  max(CASE WHEN n IS NOT NULL THEN k END) OVER ({_BY} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prev_k,
  min(CASE WHEN n IS NOT NULL THEN k END) OVER ({_BY} ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_k
  FROM rn)
SELECT n1.country_code, n1.data_source, n1."Date", n1.n,
  CASE WHEN n1.n IS NOT NULL THEN n1.n
       WHEN n1.prev_k IS NOT NULL AND coalesce(n1.next_k, n1.nrows + 1) - n1.prev_k - 1 <= 2 THEN n2.n END AS carry_fwd_value
FROM nb n1 LEFT JOIN rn n2 ON n2.country_code IS NOT DISTINCT FROM n1.country_code AND n2.data_source = n1.data_source AND n2.k = n1.prev_k"""

ORACLES["complete_grid_large"] = """WITH d AS (
  SELECT c_nationkey, CAST(o_orderdate AS DATE) AS date, o_orderstatus, count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT a.c_nationkey, b.date, c.o_orderstatus, d.n
FROM (SELECT DISTINCT c_nationkey FROM d) a CROSS JOIN (SELECT DISTINCT date FROM d) b CROSS JOIN (SELECT DISTINCT o_orderstatus FROM d) c
LEFT JOIN d ON d.c_nationkey IS NOT DISTINCT FROM a.c_nationkey AND d.date = b.date AND d.o_orderstatus = c.o_orderstatus"""

ORACLES["number_text"] = """WITH v AS (
  SELECT o_orderkey, p, CAST(CASE WHEN o_orderkey % 2 = 0 THEN round(o_totalprice, -3) ELSE o_totalprice END AS DOUBLE) * p AS x
  FROM orders, (SELECT unnest([1e-8, 1e-6, 1e-4, 1e-2, 1e0, 1e2, 1e4, 1e6, 1e8]) AS p)),
f AS (SELECT *, printf('%.14e', abs(x)) AS full_text FROM v),
g AS (SELECT *, CAST(regexp_extract(full_text, 'e([+-][0-9]+)$', 1) AS INTEGER) AS e,
  rtrim(replace(regexp_extract(full_text, '^([0-9.]+)e', 1), '.', ''), '0') AS d FROM f),
h AS (SELECT *, length(d) AS n, greatest(length(d) - e - 1, 0) AS r FROM g),
t AS (SELECT *,
  CASE WHEN x = 0 THEN '0'
    WHEN greatest(e, 0) + 1 + CASE WHEN r > 0 THEN r + 1 ELSE 0 END <= CASE WHEN n > 1 THEN n + 1 ELSE 1 END + 4
    THEN CASE WHEN e < 0 THEN '0.' || repeat('0', -e - 1) || d
              WHEN r > 0 THEN substr(d, 1, e + 1) || '.' || substr(d, e + 2) ELSE rpad(d, e + 1, '0') END
    ELSE substr(d, 1, 1) || CASE WHEN n > 1 THEN '.' || substr(d, 2) ELSE '' END || CASE WHEN e < 0 THEN 'e-' ELSE 'e+' END || lpad(CAST(abs(e) AS VARCHAR), 2, '0')
  END AS text, floor(x * 10) AS lo, ceil(x * 10) AS hi FROM h)
SELECT o_orderkey, p, CASE WHEN x < 0 THEN '-' ELSE '' END || text AS text,
  CASE WHEN abs(x * 10) >= 4503599627370496 THEN x
       WHEN x - lo / 10 < hi / 10 - x THEN lo / 10 WHEN x - lo / 10 > hi / 10 - x THEN hi / 10
       WHEN lo % 2 = 0 THEN lo / 10 ELSE hi / 10 END AS rounded
FROM t"""
