"""Job entry points for ``spark-submit`` (the reference runs these on a schedule).

    zip -r halfhourly.zip halfhourly
    spark-submit --py-files halfhourly.zip halfhourly/jobs.py ingest  --landing L --state S --checkpoint C --quarantine Q
    spark-submit --py-files halfhourly.zip halfhourly/jobs.py build   --state S --out M --as-of 2024-01-15T12:00:00
    spark-submit --py-files halfhourly.zip halfhourly/jobs.py archive --state S --lake K --as-of 2024-01-15T02:00:00
    spark-submit --py-files halfhourly.zip halfhourly/jobs.py tables  --lake K --database lake
    spark-submit --py-files halfhourly.zip halfhourly/jobs.py expire  --state S --as-of 2024-01-15T00:00:00
    spark-submit --py-files halfhourly.zip halfhourly/jobs.py query   --lake K --sql "... region_id = ${R}" --param R=0

Paths must be on shared storage; ``spark.checkpoint.dir`` should name a
shared folder (it is read from the session, never invented on a cluster
unless unset).

Every job takes ``--as-of`` explicitly where the reference reads the clock
(default: now, UTC, truncated to the minute), so reruns are reproducible.
"""

from __future__ import annotations

import argparse
import json
import os
from datetime import datetime, timezone

from halfhourly.operators import lake, quality
from halfhourly.plans import build, reads
from halfhourly.schemas import (
    ARCHIVE_LOOKBACK_DAYS, CARBON_SCHEMA, HOT_RETENTION_DAYS, LAKE_TABLES, MIX_SCHEMA, PRICE_SCHEMA,
)
from halfhourly.functions.columns import utc_naive
from halfhourly.session import get_spark
from halfhourly.sources import payloads
from halfhourly.streaming import ingest

HOT = {"carbon_intensity": CARBON_SCHEMA, "agile_price": PRICE_SCHEMA, "generation_mix": MIX_SCHEMA}


def _as_of(v: str | None) -> str:
    if v:
        return utc_naive(v).isoformat(sep=" ")
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:00")


def run_ingest(spark, a) -> dict:
    qs = ingest.ingest_stream(spark, a.landing, a.state, a.checkpoint, a.quarantine,
                              dim=payloads.region_seed(spark), available_now=not a.continuous)
    for q in qs:
        q.awaitTermination()
    return {"queries": [q.name for q in qs]}


def run_build(spark, a) -> dict:
    raw = {name: lake.read_table(spark, os.path.join(a.state, name), schema) for name, schema in HOT.items()}
    built, report = build.build(spark, raw, payloads.region_seed(spark), _as_of(a.as_of), out_root=a.out)
    report = report.checkpoint(eager=True)  # evaluated once: written and summarised
    report.write.mode("overwrite").parquet(os.path.join(a.out, "_checks"))
    summary = {r.status: r.checks for r in quality.check_summary(report).collect()}
    return {"marts": sorted(built), "checks": summary}


def run_archive(spark, a) -> dict:
    counts = lake.archive_tables(spark, a.state, a.lake, _as_of(a.as_of), a.lookback)
    return {f"{r.table_name}/{r.period_day}": r.rows for r in counts.collect()}


def run_tables(spark, a) -> dict:
    """Register the archive tables in the catalog and take up the days that are stored."""
    return {"created": lake.ensure_tables(spark, a.lake, a.database)}


def run_expire(spark, a) -> dict:
    return {name: lake.expire_partitions(spark, os.path.join(a.state, name), _as_of(a.as_of), a.days)
            for name in HOT}


def run_query(spark, a) -> dict:
    """Ad-hoc SQL over the lake tables; without ``--sql`` the default report:
    national monthly averages for the last 24 months, newest first."""
    views = {name: lake.scan_lake(spark, a.lake, name) for name in LAKE_TABLES}  # with the day column, for pruning
    if a.sql:
        params = dict(p.split("=", 1) for p in a.param)
        df, secs = reads.ad_hoc(spark, a.sql, views, **params)
    else:
        df, secs = reads.monthly_intensity(views["carbon_intensity"], _as_of(a.as_of)), 0.0
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
        return {"rows": spark.read.parquet(a.out).count(), "out": a.out, "plan_seconds": round(secs, 3)}
    # every row, a partition at a time; a preview only when asked for
    print("\t".join(df.columns))
    n = 0
    for r in (df if a.preview is None else df.limit(a.preview)).toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in r))
        n += 1
    return {"rows_shown": n, "complete": a.preview is None, "plan_seconds": round(secs, 3)}


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="halfhourly.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("ingest")
    for k in ("landing", "state", "checkpoint", "quarantine"):
        s.add_argument(f"--{k}", required=True)
    s.add_argument("--continuous", action="store_true", help="processing-time trigger instead of availableNow")
    s = sub.add_parser("build")
    s.add_argument("--state", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--as-of")
    s = sub.add_parser("archive")
    s.add_argument("--state", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--as-of")
    s.add_argument("--lookback", type=int, default=ARCHIVE_LOOKBACK_DAYS)
    s = sub.add_parser("tables")
    s.add_argument("--lake", required=True)
    s.add_argument("--database", default="lake")
    s = sub.add_parser("expire")
    s.add_argument("--state", required=True)
    s.add_argument("--as-of")
    s.add_argument("--days", type=int, default=HOT_RETENTION_DAYS)
    s = sub.add_parser("query")
    s.add_argument("--lake", required=True)
    s.add_argument("--sql", help="default: monthly national averages, last 24 months")
    s.add_argument("--param", action="append", default=[])
    s.add_argument("--as-of")
    s.add_argument("--out", help="write the whole result as Parquet to this path")
    s.add_argument("--preview", type=int, help="print only so many rows")
    a = p.parse_args(argv)
    spark = get_spark(app=f"halfhourly-{a.cmd}")
    out = {"ingest": run_ingest, "build": run_build, "archive": run_archive, "expire": run_expire,
           "tables": run_tables, "query": run_query}[a.cmd](spark, a)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
