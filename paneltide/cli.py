"""Command line: run the tracker (A14) or dashboard (A15) job over a folder of tables.

    python -m paneltide tracker   --data DIR --out DIR [--source B] [--format csv]
    python -m paneltide dashboard --data DIR --out DIR [--format csv]

``--data`` holds the driver tables as ``<name>.parquet``.  Outputs go to one sub-folder per
table.  On a cluster, submit it with ``spark-submit``; the session's configuration
(including ``spark.checkpoint.dir``) is used as given.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def run_tracker(spark: SparkSession, data: str, out: str, source: str | None = None, fmt: str = "csv") -> dict[str, str]:
    from .plans import catalog as C
    from .plans import tracker_job as TJ
    from .sources import tables as T

    b = T.event_bounds(spark, data)
    tables = TJ.tracker_tables(T.daily_panel(spark, data), b, C._names(spark, data), C._frame(spark, data, b))
    return TJ.write_tracker_outputs(tables, out, source=source, fmt=fmt)


def run_dashboard(spark: SparkSession, data: str, out: str, fmt: str = "csv") -> dict[str, str]:
    from .plans import catalog as C
    from .plans import dashboard as DB
    from .plans import tracker_job as TJ
    from .sources import tables as T

    cases = T.cumulative_panel(spark, data).join(C._names(spark, data), "country_code", "left")
    first, second = T.hospital_feeds(spark, data)
    tables = DB.dashboard_tables(
        T.nation_dim(spark, data), cases, C._amounts_wide(spark, data), "user_id", C.TYPES, C.TYPE_META, C.TYPE_FAMILIES,
        first, second, T.policy_feed(spark, data),
        prepared={
            "cases_deaths": C.cases_deaths(spark, data),
            "vaccinations_ages": C.ages_long(spark, data),
            "vaccinations_manufacturers": C.manufacturers(spark, data),
            "vaccinations_rollout": C.rollout(spark, data),
            "vaccinations_wide": C.vax_wide(spark, data),
        },
    )
    return TJ.write_tracker_outputs(tables, out, fmt=fmt)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="paneltide")
    ap.add_argument("job", choices=["tracker", "dashboard"])
    ap.add_argument("--data", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--source", default=None, help="write only this source's rows (tracker)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"paneltide-{args.job}").getOrCreate()
    from .session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    if args.job == "tracker":
        paths = run_tracker(spark, args.data, args.out, args.source, args.format)
    else:
        paths = run_dashboard(spark, args.data, args.out, args.format)
    for name, path in sorted(paths.items()):
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
