"""Best-fit packing of token sequences by the linear grouping scheme.

1. Texts become token ids (library tokenizer, end token added) and are cut into pieces of the
   capacity; only longer texts are cut, their first piece takes the remainder.  Pieces of
   the whole capacity are sequences by themselves.
2. **Linear grouping**: the other pieces longer than ``capacity / SMALL`` are put in order of
   length and cut into GROUPS groups of equal cardinality; each length is rounded up to its
   group's longest.  Only the histogram of lengths is needed: at most ``capacity`` rows.
3. **Configurations** of the few sizes: the linear programme over all ways to fill a sequence is
   solved by column generation (a knapsack names the column to enter), rounded down, and
   what is left over (a few pieces a group at most) is packed best-fit decreasing.
4. **Substitution**: the i-th piece of a group takes the i-th slot of its size.  Ranges of slots are a
   table by length (thousands of rows at any input size), so this is one broadcast equi-join.
5. **Best fit of the small pieces** into what the real lengths leave free, longest first: sequences
   with equal free space are alike, so the choice is made on the histogram of free space and
   handed out as ranges of (free space, number), again by equi-join.

Rows never meet the driver: it sees two histograms of at most ``capacity`` bins.  Numbers within
a length or a free space come from salted counts, so one frequent length is as parallel as many.

Defined cases: null or empty text is its end token alone; null and repeated doc_ids and equal texts
are pieces of their own (rows are told apart by a row number given when the pieces are
written); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from halfhourly.llm.common import materialize, rebatch

CAPACITY = 2048
GROUPS, SMALL = 256, 3
GAP = 5e-4  # of the linear programme: its bins are at most this share above the optimum
PER_SALT = 4_000  # rows numbered in one window: a length that most pieces have is spread over as many tasks
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


@lru_cache(2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file, once a worker process: its vocabulary as ranks and its added tokens.
    The ids are the library's that wrote the file (tested), at five times its speed."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    merged = [ranks[bytes(byte[c] for c in "".join(m.split(" ") if isinstance(m, str) else m))] for m in spec["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"{path}: ids do not follow the order of merges")
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


@lru_cache(2)
def library(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def encode(text: str, path: str) -> bytes:
    """The ids of a whole text, little-endian unsigned 32 bits."""
    try:
        ids = encoder(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:  # a run of white space too long for the encoder's split
        ids = np.array(library(path).encode(text, add_special_tokens=False).ids)
    return ids.astype("<u4").tobytes()


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of every row of ``docs`` (doc_id, text), with ``row``, a number that tells rows apart."""
    def run(it):
        for pdf in rebatch(it, "text", 2_000_000):
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = encode(text or "", path) + end.to_bytes(4, "little")
                n, doc_id = len(ids) // 4, None if pd.isna(doc_id) else int(doc_id)
                cuts = list(range(n % capacity, n, capacity)) if n > capacity else []
                cuts = sorted({0, *cuts}) + [n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * a:4 * b]
                    out.append((doc_id, k, a, b - a, zlib.crc32(part), part if with_ids else None))
            got = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            yield got.astype({"doc_id": "Int64"})
    cut = docs.select("doc_id", "text").mapInPandas(run, SCHEMA)
    return (cut if with_ids else cut.drop("ids")).withColumn("row", F.monotonically_increasing_id())


class Plan(NamedTuple):
    large: list[tuple]  # length, first and last number + 1, slot of the first, slots a bin, first bin, place in the bin
    bins: int


def configurations(sizes: np.ndarray, need: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(bins, pieces of each size in a bin) covering ``need``: the linear programme's optimum rounded down, then best fit."""
    n = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)  # the basis: a column a configuration
    inverse = np.diag(1.0 / np.diag(columns)) if n else np.zeros((0, 0))
    levels = np.arange(capacity + 1)[:, None] - sizes[None, :]
    fits = levels >= 0
    levels = np.where(fits, levels, 0)
    for _ in range(50 * n):
        price = inverse.sum(axis=0)  # duals: every column costs one bin
        value, picks = np.zeros(capacity + 1), []
        for _ in range(int(capacity // sizes.min())):
            gain = np.where(fits, value[levels] + price, 0.0)
            pick = gain.argmax(axis=1)
            best = gain[np.arange(capacity + 1), pick]
            picks.append(np.where(best > 1e-12, pick, -1))
            value = best
        if value[capacity] <= 1 + GAP:
            break
        enter, left = np.zeros(n), capacity
        for pick in reversed(picks):
            if pick[left] >= 0:
                enter[pick[left]] += 1
                left -= sizes[pick[left]]
        way, now = inverse @ enter, inverse @ need
        ratio = np.full(n, np.inf)
        ratio[way > 1e-9] = now[way > 1e-9] / way[way > 1e-9]
        out = int(ratio.argmin())
        columns[:, out] = enter
        inverse[out] /= way[out]
        rest = np.arange(n) != out
        inverse[rest] -= np.outer(way[rest], inverse[out])
    times = np.floor(np.maximum(inverse @ need, 0) + 1e-9).astype(int) if n else np.empty(0, int)
    left = need.astype(int).copy()
    done = []
    for t, column in zip(times, columns.T.astype(int)):
        t = min([int(t), *(int(m) // a for m, a in zip(left, column) if a)])  # numerical slips give no slots in excess
        if t > 0:
            done.append((t, column))
            left = left - t * column
    open_: list[list] = []  # free space and contents, best fit decreasing
    for g in np.argsort(-sizes, kind="stable"):
        for _ in range(int(left[g])):
            best = min((b for b in open_ if b[0] >= sizes[g]), key=lambda b: b[0], default=None)
            if best is None:
                open_.append(best := [capacity, np.zeros(n, int)])
            best[0] -= sizes[g]
            best[1][g] += 1
    return done + [(1, b[1]) for b in open_]


def plan_large(lengths: list[tuple[int, int]], capacity: int, groups: int = GROUPS) -> Plan:
    """Slots for the large pieces, from their histogram [(length, count)]."""
    lengths = sorted(lengths, reverse=True)
    total = sum(c for _, c in lengths)
    if not total:
        return Plan([], 0)
    size, count = (np.array(v, np.int64) for v in zip(*lengths))
    ends = np.cumsum(count)
    cuts = np.unique(np.r_[(np.arange(groups) * total) // groups, total])
    top = size[np.searchsorted(ends, cuts[:-1], "right")]  # longest of each group, groups of one size are one
    head = np.r_[True, top[1:] != top[:-1]]
    top, begin = top[head], cuts[:-1][head]
    need = np.diff(np.r_[begin, total])
    ranges, used, first_bin = [], begin.copy(), 0  # over all large pieces in order
    for bins, column in configurations(top, need, capacity):
        place = 0
        for g in np.flatnonzero(column):
            many = bins * int(column[g])
            ranges.append((int(used[g]), int(used[g]) + many, int(column[g]), first_bin, place))
            used[g] += many
            place += int(column[g])
        first_bin += bins
    out, starts = [], ends - count
    for a, b, each, first, place in ranges:
        for k in range(int(np.searchsorted(ends, a, "right")), len(size)):
            if starts[k] >= b:
                break
            lo, hi = max(a, int(starts[k])), min(b, int(ends[k]))
            out.append((int(size[k]), lo - int(starts[k]), hi - int(starts[k]), lo - a, each, first, place))
    return Plan(out, first_bin)


def plan_small(lengths: list[tuple[int, int]], free: list[tuple[int, int]], capacity: int) -> tuple[list[tuple], int]:
    """Best fit, longest first, of [(length, count)] into bins [(free space, count)]: ranges (length, first and last
    number + 1, free space and number of the first bin, offset there); new bins have the free space ``capacity``."""
    state: dict[int, list[list[int]]] = {}  # free now -> [free at first, first number, last number + 1]
    for f, c in sorted(free):
        if f:
            state.setdefault(f, []).append([f, 0, c])
    out, new = [], 0
    for length, count in sorted(lengths, reverse=True):
        at = 0
        while at < count:
            f = min((f for f, held in state.items() if held and f >= length), default=None)
            if f is None:
                each = capacity // length
                many = max((count - at) // each, 1)
                state.setdefault(capacity, []).append([capacity, new, new + many])
                new += many
                continue
            origin, a, b = state[f].pop()
            take = min(count - at, b - a)
            out.append((length, at, at + take, origin, a, capacity - f))
            if take < b - a:
                state[f].append([origin, a + take, b])
            if f > length:
                state.setdefault(f - length, []).append([origin, a, a + take])
            at += take
    return out, new


def numbered(df: DataFrame, by: str, row: str) -> DataFrame:
    """``number`` from 0 within each value of ``by``; ``row`` is unique.  Salted, so a frequent value is no hot task."""
    salts = df.count() // PER_SALT + 1
    salted = df.withColumn("salt", F.pmod(F.xxhash64(row), F.lit(salts)))
    before = Window.partitionBy(by).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy(by, "salt").agg(F.count(F.lit(1)).alias("n")).select(
        by, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    at = F.row_number().over(Window.partitionBy(by, "salt").orderBy(row))
    return salted.withColumn("at", at).join(offsets, [by, "salt"]).withColumn(
        "number", F.col("before") + F.col("at") - 1).drop("salt", "at", "before")


def _histogram(df: DataFrame, column: str) -> list[tuple[int, int]]:
    """At most ``capacity`` rows, whatever the input."""
    return [(int(r[0]), int(r[1])) for r in df.groupBy(column).agg(F.count(F.lit(1))).collect()]


def pack(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``cut`` (row, length and whatever else) with sequence_id and offset."""
    spark = cut.sparkSession
    cut = materialize(cut, "pieces")
    small = max(capacity // SMALL, 1)
    lengths = _histogram(cut, "length")
    plan = plan_large([(n, c) for n, c in lengths if small < n < capacity], capacity, groups)
    short = numbered(cut.filter((F.col("length") < capacity)).select("row", "length"), "length", "row")
    short = materialize(short, "numbered")
    slots = spark.createDataFrame(
        plan.large, "length long, a long, b long, slot long, each long, first long, place long")
    t = F.col("number") - F.col("a") + F.col("slot")
    large = (short.filter(F.col("length") > small)
             .join(F.broadcast(slots), "length").filter((F.col("number") >= F.col("a")) & (F.col("number") < F.col("b")))
             .select("row", "length", (F.col("first") + F.floor(t / F.col("each"))).alias("sequence_id"),
                     (F.col("place") + t % F.col("each")).alias("slot")))
    within = Window.partitionBy("sequence_id").orderBy("slot")
    so_far = F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    large = materialize(large.select("row", "sequence_id", (so_far - F.col("length")).alias("offset"), "length",
                                     F.lead("slot").over(within).isNull().alias("last")), "large")
    bins = large.filter("last").select("sequence_id", (capacity - F.col("offset") - F.col("length")).alias("free"))
    bins = materialize(numbered(bins, "free", "sequence_id"), "bins")
    fills, new = plan_small([(n, c) for n, c in lengths if n <= small and n < capacity], _histogram(bins, "free"), capacity)
    ranges = spark.createDataFrame(fills, "length long, a long, b long, free long, first long, offset long")
    placed = (short.filter(F.col("length") <= small)
              .join(F.broadcast(ranges), "length").filter((F.col("number") >= F.col("a")) & (F.col("number") < F.col("b")))
              .select("row", "free", (F.col("first") + F.col("number") - F.col("a")).alias("number"), "offset"))
    opened = placed.filter(F.col("free") == capacity).select("row", (F.col("number") + plan.bins).alias("sequence_id"), "offset")
    filled = placed.filter(F.col("free") < capacity).join(bins, ["free", "number"]).select("row", "sequence_id", "offset")
    found = large.select("row", "sequence_id", "offset").unionByName(opened).unionByName(filled)
    whole = cut.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": F.col("row") + plan.bins + new, "offset": F.lit(0).cast("long")})
    return cut.join(found, "row").unionByName(whole)
