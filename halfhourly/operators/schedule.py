"""Best use of prices: a store's charging schedule, and the cheapest blocks that do not overlap.

**Charging.** A store of ``levels`` units takes or gives one unit in a half-hour (or rests).  What a stretch of
half-hours is worth, from each level at its start to each level at its end, is a small matrix; two stretches in a row
compose by the (max, +) product, which is associative.  So days are evaluated apart, then composed FAN at a
time up a tree, and the best way is handed down the same tree: a node knows the levels at its ends, chooses those
between its children, and each day finds its own half-hours.  No task sees more than a day's
half-hours or FAN matrices, whatever the length of a region's history.

**Blocks.** Within a horizon (at most two weeks of half-hours a region) the cheapest ``count`` blocks of ``length``
consecutive half-hours that do not overlap, by weighted interval scheduling.

Prices are whole numbers (of a hundredth of a penny, say), so sums are exact and ties real: of equal schedules the one with
the lower level at a seam, seams of longer stretches first; of equal blocks the earliest.  Half-hours without a price are rested.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfhourly.session import checkpoint_dir

FAN = 32
NEVER = -(1 << 60)  # worth of what cannot be; two of them still fit a 64-bit number


def slot_matrix(price: int, levels: int, fee: int) -> np.ndarray:
    """From level i to level j in a half-hour: rest, buy a unit, or sell one for the price less ``fee``."""
    m = np.full((levels + 1, levels + 1), NEVER, np.int64)
    i = np.arange(levels)
    np.fill_diagonal(m, 0)
    m[i, i + 1], m[i + 1, i] = -price, price - fee
    return m


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) product."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NEVER)


def between(matrices: Sequence[np.ndarray], start: int, end: int) -> list[int]:
    """The levels at all seams of a best way through ``matrices`` from level ``start`` to ``end``; lowest of equals."""
    ahead = [np.full(len(matrices[0]), NEVER, np.int64)]
    ahead[0][end] = 0
    for m in reversed(matrices):
        ahead.append(np.maximum((m + ahead[-1][None, :]).max(axis=1), NEVER))
    ahead.reverse()
    way = [start]
    for m, rest in zip(matrices, ahead[1:]):
        way.append(int((m[way[-1]] + rest).argmax()))
    return way


def _square(flat) -> np.ndarray:
    n = int(round(len(flat) ** 0.5))
    return np.asarray(flat, np.int64).reshape(n, n)


_NODE = "key string, index long, worth array<bigint>"


def _up(nodes: DataFrame) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = None
        for flat in pdf.sort_values("index")["worth"]:
            m = _square(flat) if m is None else compose(m, _square(flat))
        return pd.DataFrame({"key": pdf["key"][:1], "index": pdf["index"][:1] // FAN, "worth": [m.ravel().tolist()]})
    return nodes.groupBy("key", F.floor(F.col("index") / FAN)).applyInPandas(run, _NODE)


def _down(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """The levels at the ends of ``nodes``, given those (key, index, start, end) of the nodes above."""
    def run(below: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        below = below.sort_values("index")
        way = between([_square(f) for f in below["worth"]], int(above["start"].iloc[0]), int(above["end"].iloc[0]))
        return pd.DataFrame({"key": below["key"], "index": below["index"], "start": way[:-1], "end": way[1:]})
    return (nodes.withColumn("up", F.floor(F.col("index") / FAN)).groupBy("key", "up")
            .cogroup(ends.withColumnRenamed("index", "up").groupBy("key", "up"))
            .applyInPandas(run, "key string, index long, start int, end int"))


def charging(prices: DataFrame, key: str, time: str, price: str, levels: int = 4, fee: int = 0, first_level: int = 0) -> DataFrame:
    """(key, time, price, action, level): +1 buys a unit, -1 sells one; ``level`` after it.  Starts at ``first_level``, ends anywhere."""
    checkpoint_dir(prices.sparkSession)
    slots = prices.filter(F.col(price).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.date_diff(F.to_date(time), F.lit("0001-01-01").cast("date")).cast("long").alias("index"),
        F.col(time).alias("at"), F.col(price).cast("bigint").alias("price"))

    def day(pdf: pd.DataFrame) -> pd.DataFrame:
        m = None
        for p in pdf.sort_values("at")["price"]:
            own = slot_matrix(int(p), levels, fee)
            m = own if m is None else compose(m, own)
        return pd.DataFrame({"key": pdf["key"][:1], "index": pdf["index"][:1], "worth": [m.ravel().tolist()]})

    rounds = [slots.groupBy("key", "index").applyInPandas(day, _NODE).checkpoint()]
    largest = rounds[0].agg(F.max("index")).first()[0] or 0
    while largest or len(rounds) == 1:
        rounds.append(_up(rounds[-1]).checkpoint())
        largest //= FAN

    worth = F.slice("worth", first_level * (levels + 1) + 1, levels + 1)
    ends = rounds[-1].select("key", "index", F.lit(first_level).alias("start"),
                             (F.array_position(worth, F.array_max(worth)) - 1).cast("int").alias("end"))
    for nodes in rounds[-2::-1]:
        ends = _down(nodes, ends)

    def act(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        way = between([slot_matrix(int(p), levels, fee) for p in pdf["price"]], int(above["start"].iloc[0]), int(above["end"].iloc[0]))
        return pd.DataFrame({"key": pdf["key"], "at": pdf["at"], "price": pdf["price"], "action": np.diff(way), "level": way[1:]})
    done = slots.groupBy("key", "index").cogroup(ends.groupBy("key", "index")).applyInPandas(
        act, "key string, at timestamp_ntz, price bigint, action int, level int")
    return done.select(F.col("key").cast(prices.schema[key].dataType).alias(key), F.col("at").alias(time), F.col("price").alias(price), "action", "level")


def worth(schedule: DataFrame, key: str, price: str, fee: int = 0) -> DataFrame:
    """What a schedule earns, and the levels it stays between."""
    gain = F.when(F.col("action") < 0, F.col(price) - fee).when(F.col("action") > 0, -F.col(price)).otherwise(0)
    return schedule.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("slots"), F.sum(gain).cast("bigint").alias("worth"),
                                     F.min("level").alias("least"), F.max("level").alias("most"))


def best_blocks(prices: DataFrame, key: str, time: str, price: str, length: int, count: int, minutes: int = 30) -> DataFrame:
    """(key, block, start, end, cost) of the cheapest ``count`` non-overlapping blocks of ``length`` consecutive half-hours in
    ``prices`` (a horizon of bounded length); fewer where no more fit.  Blocks are numbered in time order."""
    step = pd.Timedelta(minutes=minutes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        at, cost = list(pdf["at"]), [int(p) for p in pdf["price"]]
        n = len(at)
        whole = [i + length <= n and at[i + length - 1] - at[i] == (length - 1) * step for i in range(n)]
        # (blocks, -cost) from slot i on with at most c more blocks; more blocks first, then cheaper, then earlier
        best = [[(0, 0)] * (n + 1) for _ in range(count + 1)]
        for c in range(1, count + 1):
            for i in range(n - 1, -1, -1):
                best[c][i] = best[c][i + 1]
                if whole[i]:
                    more, saved = best[c - 1][i + length]
                    best[c][i] = max(best[c][i], (more + 1, saved - sum(cost[i:i + length])))
        out, c, i = [], count, 0
        while c and i < n:
            if whole[i]:
                more, saved = best[c - 1][i + length]
                if best[c][i] == (more + 1, saved - sum(cost[i:i + length])):
                    out.append((pdf["key"].iloc[0], len(out) + 1, at[i], at[i + length - 1] + step, sum(cost[i:i + length])))
                    c, i = c - 1, i + length
                    continue
            i += 1
        return pd.DataFrame(out, columns=["key", "block", "start", "end", "cost"])
    slots = prices.filter(F.col(price).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.col(time).alias("at"), F.col(price).cast("bigint").alias("price"))
    return slots.groupBy("key").applyInPandas(run, "key string, block int, start timestamp_ntz, end timestamp_ntz, cost bigint").select(
        F.col("key").cast(prices.schema[key].dataType).alias(key), "block", "start", "end", "cost")
