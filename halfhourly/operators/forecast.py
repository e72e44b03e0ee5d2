"""Seasonal least squares from mergeable normal equations.

A series is fitted by a constant, daily and weekly waves and a trend.  The fit needs only the sums of
products of these regressors with each other and with the value: one aggregation a key, combined
map-side, whose rows can be stored and added up (a later day's sums plus the earlier ones are the sums
of both).  The system of a key is a few numbers and is solved in the task that holds its row;
rows of the series never leave the JVM, and a key with a third of all rows is as parallel as any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfhourly.functions.columns import ts_lit
from halfhourly.operators import seasonal

DAILY, WEEKLY = 2, 1  # waves of each
TERMS = 2 + 2 * (DAILY + WEEKLY)
ORIGIN = "2024-01-01 00:00:00"  # a Monday


def regressors(time: str) -> list[Column]:
    """Constant, trend in weeks, sine and cosine of each wave."""
    minutes = F.timestamp_diff("MINUTE", F.lit(ORIGIN).cast("timestamp_ntz"), F.col(time)).cast("double")
    out = [F.lit(1.0), minutes / 10_080]
    for period, waves in ((1_440, DAILY), (10_080, WEEKLY)):
        for k in range(1, waves + 1):
            angle = F.pmod(minutes, F.lit(float(period))) * (2 * math.pi * k / period)
            out += [F.sin(angle), F.cos(angle)]
    return out


def normal_equations(series: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """(keys, n, products, with_value): the upper triangle of X'X row by row, and X'y; rows without a value are left out."""
    names = [f"x{i}" for i in range(TERMS)]
    rows = series.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("y"), *(c.alias(n) for c, n in zip(regressors(time), names)))
    pairs = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.array(*pairs).alias("products"),
                                   F.array(*(F.sum(F.col(a) * F.col("y")) for a in names)).alias("with_value"))


def add_up(equations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The equations of several stretches of a series, added up."""
    total = lambda c, size: F.array(*(F.sum(F.col(c)[i]) for i in range(size))).alias(c)
    return equations.groupBy(*keys).agg(F.sum("n").alias("n"), total("products", TERMS * (TERMS + 1) // 2), total("with_value", TERMS))


def solve(equations: DataFrame) -> DataFrame:
    """``equations`` with ``coefficients``; the least of all solutions where the data do not decide (fewer rows than terms)."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(TERMS)
        for pdf in it:
            found = []
            for products, with_value in zip(pdf["products"], pdf["with_value"]):
                a = np.zeros((TERMS, TERMS))
                a[upper] = products
                a = a + np.triu(a, 1).T
                found.append(np.linalg.lstsq(a, np.array(with_value, float), rcond=1e-11)[0].tolist())
            yield pdf.drop(columns=["products", "with_value"]).assign(coefficients=found)
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in equations.schema if f.name not in ("products", "with_value"))
    return equations.mapInPandas(run, f"{kept}, coefficients array<double>")


def predict(rows: DataFrame, fitted: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """``rows`` with ``forecast``: NULL for a key without a fit.  ``fitted`` has one row a key."""
    terms = [F.col("coefficients")[i] * x for i, x in enumerate(regressors(time))]
    return rows.join(fitted.select(*keys, "coefficients"), list(keys), "left").withColumn("forecast", sum(terms[1:], terms[0])).drop("coefficients")


def held_out(series: DataFrame, keys: Sequence[str], time: str, value: str, cutoff, first, last, minutes: int = 30) -> DataFrame:
    """Fit on what lies before ``cutoff``; mean absolute errors from there on, where the value of the same slot a week before is
    known too: (keys, n_train, n_test, n_compared, model_mae, week_before_mae, train_slope)."""
    cut = ts_lit(cutoff)
    train = series.filter(F.col(time) < cut)
    fitted = solve(normal_equations(train, keys, time, value))
    paired = seasonal.against_earlier(series, keys, time, value, seasonal.WEEK, minutes, first, last)
    judged = predict(paired.filter(F.col("value").isNotNull()), fitted, keys, time)
    test = F.col(time) >= cut
    both = test & F.col("earlier").isNotNull() & F.col("forecast").isNotNull()
    apart = lambda c: F.avg(F.when(both, F.abs(F.col("value") - F.col(c))))
    return judged.groupBy(*keys).agg(
        F.count_if(~test).cast("bigint").alias("n_train"), F.count_if(test).cast("bigint").alias("n_test"),
        F.count_if(both).cast("bigint").alias("n_compared"), apart("forecast").alias("model_mae"), apart("earlier").alias("week_before_mae"),
        F.avg(F.when(~test, F.col("value") - F.col("forecast"))).alias("train_bias"))
