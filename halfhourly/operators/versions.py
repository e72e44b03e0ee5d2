"""Replacing days of a stored table so that readers see all of them change at once.

``lake.overwrite_days`` replaces the files of one day after another, so a reader in between may see some new
and some old days.  Here a table is a view over one of its *versions*, and a version is a catalog table that
names the files of each day: days are stored as ``period_day=.../written=<run>``, and a
version registers one such partition a day.

1. **stage** writes the new days under their own ``written``; nobody reads it yet;
2. **build** registers the next version: the staged days, and of all other days the partitions that the current
   version names.  No data is copied;
3. **switch** points the view at it: one catalog operation, the moment of change.

A reader that planned before the switch keeps the old version's files, which stay until ``vacuum``.  A run that
was killed anywhere is repeated with the same ``run``: staging overwrites only its own folders and a half-built version is dropped first.
A replaced day without rows is simply not registered.  Writers of one table take turns, as the archive job does.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halfhourly.operators.lake import DAY, _as_date, _fs

WRITTEN = "written"
PER_STATEMENT = 500  # partitions registered in one statement


def current_version(spark: SparkSession, name: str) -> int:
    """The version that the view ``name`` shows; 0 before the first."""
    if not spark.catalog.tableExists(name):
        return 0
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return int(found["version"])


def _partitions(spark: SparkSession, name: str, version: int) -> dict[date, str]:
    """Day -> run of a version: catalog entries, one a day."""
    if not version:
        return {}
    pairs = [dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}__v{version}").collect()]
    return {date.fromisoformat(p[DAY]): p[WRITTEN] for p in pairs}


def stage(df: DataFrame, root: str, days: Sequence, run: str) -> list[date]:
    """Write the rows of ``days`` under ``run``; returns the days that have any."""
    spark, days = df.sparkSession, [_as_date(d) for d in days]
    fs, _ = _fs(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for d in days:  # of an earlier attempt
        fs.delete(path(f"{root}/{DAY}={d.isoformat()}/{WRITTEN}={run}"), True)
    (df.filter(F.col(DAY).isin(*days)).withColumn(WRITTEN, F.lit(run)).hint("rebalance", DAY)
     .write.mode("append").partitionBy(DAY, WRITTEN).parquet(root))
    return [d for d in days if fs.exists(path(f"{root}/{DAY}={d.isoformat()}/{WRITTEN}={run}"))]


def build(spark: SparkSession, name: str, root: str, schema: T.StructType, days: Sequence, staged: Sequence[date], run: str) -> int:
    """Register the next version of ``name``: ``staged`` of ``run``, and the other days as they are.  Returns its number."""
    version = current_version(spark, name)
    parts = {d: w for d, w in _partitions(spark, name, version).items() if d not in {_as_date(d) for d in days}}
    parts |= {d: run for d in staged}
    new = f"{name}__v{version + 1}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields if f.name not in (DAY, WRITTEN))
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    spark.sql(f"CREATE TABLE {new} ({columns}, {DAY} date, {WRITTEN} string) USING parquet "
              f"PARTITIONED BY ({DAY}, {WRITTEN}) LOCATION '{root}'")
    each = [f"PARTITION ({DAY} = DATE'{d.isoformat()}', {WRITTEN} = '{w}')" for d, w in sorted(parts.items())]
    for k in range(0, len(each), PER_STATEMENT):
        spark.sql(f"ALTER TABLE {new} ADD IF NOT EXISTS {' '.join(each[k:k + PER_STATEMENT])}")
    return version + 1


def switch(spark: SparkSession, name: str, version: int) -> None:
    """Show ``version`` to readers from now on."""
    columns = ", ".join(c for c in spark.table(f"{name}__v{version}").columns if c != WRITTEN)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('version' = '{version}') AS SELECT {columns} FROM {name}__v{version}")


def replace_days(df: DataFrame, name: str, root: str, days: Sequence, run: str) -> int:
    """Replace exactly ``days`` of the table ``name`` by the rows of ``df`` for those days, all at once.  Returns the version."""
    staged = stage(df, root, days, run)
    version = build(df.sparkSession, name, root, df.schema, days, staged, run)
    switch(df.sparkSession, name, version)
    return version


def vacuum(spark: SparkSession, name: str, root: str, keep: int = 2) -> int:
    """Drop all but the last ``keep`` versions and delete the folders that none of the kept ones names; returns how many."""
    version = current_version(spark, name)
    kept = {(d, w) for v in range(max(1, version - keep + 1), version + 1) for d, w in _partitions(spark, name, v).items()}
    old = version - keep
    while old > 0 and spark.catalog.tableExists(f"{name}__v{old}"):
        spark.sql(f"DROP TABLE {name}__v{old}")
        old -= 1
    fs, folder = _fs(spark, root)
    gone = 0
    for day in fs.listStatus(folder):
        if not day.getPath().getName().startswith(f"{DAY}="):
            continue
        d = date.fromisoformat(day.getPath().getName().split("=", 1)[1])
        for run in fs.listStatus(day.getPath()):
            if (d, run.getPath().getName().split("=", 1)[1]) not in kept:
                fs.delete(run.getPath(), True)
                gone += 1
    return gone
