"""Helpers shared by the operators: table reads, durable intermediate tables,
word and hash primitives used inside Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}  # the folders of local applications


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500):
    """Fewer rows in an Arrow batch for what is written inside the block: rows of whole texts or long arrays.
    (A session of its own would start Python workers of its own.)"""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares (``spark.checkpoint.dir``).  Only a local
    master may go without it; elsewhere a machine-local folder would lose rows."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="hh-llm-"))
    return base


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a durable lineage cut
    that survives lost executors and is computed once however often it is read."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of what is written inside the block go when its write ends, not when the driver happens to collect
    its garbage: a materialized table never asks for them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing is to read any more, neither what is written later nor a result."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if not re.search(r"-[0-9a-f]{32}$", folder):
                raise ValueError(f"{folder} is no materialized table")
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)


def rebatch(it: Iterator[pd.DataFrame], column: str, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into pieces of about ``chars`` characters of ``column``,
    so that what a piece expands to stays bounded whatever the text lengths."""
    for pdf in it:
        if len(pdf) == 0:
            continue
        size = np.fromiter((len(t) if t is not None else 0 for t in pdf[column]), np.int64, len(pdf))
        piece = (np.cumsum(size) - size) // chars
        for k in np.unique(piece):
            yield pdf[piece == k].reset_index(drop=True)


def sorted_groups(it: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict]:
    """The runs of equal ``keys`` of a partition sorted by them, as {column: array}.  A run that
    crosses Arrow batches is put together; far cheaper than a grouped UDF where groups are small."""
    held: pd.DataFrame | None = None
    for pdf in it:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        cols = {c: pdf[c].to_numpy() for c in pdf.columns}
        change = np.zeros(len(pdf) - 1, bool)
        for k in keys:
            change |= cols[k][1:] != cols[k][:-1]
        at = np.flatnonzero(change) + 1
        for a, b in zip(np.r_[0, at[:-1]] if len(at) else [], at, strict=True):
            yield {c: v[a:b] for c, v in cols.items()}
        held = pdf.iloc[at[-1] if len(at) else 0:]
    if held is not None and len(held):
        yield {c: held[c].to_numpy() for c in held.columns}


class WordHashes(dict):
    """Memo word -> 64-bit hash; emptied when it reaches ``limit`` entries."""

    def __init__(self, limit: int = 250_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and odd multipliers), element-wise."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Order-dependent hashes of all k consecutive entries of ``h``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return out


def ascii_lower(text: str) -> str:
    """A-Z to a-z, everything else untouched (``bytes.lower`` is ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def space_words(text: str) -> list[str]:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]``: what the contracts call words."""
    for space in "\n\t\r\x0b\x0c":
        text = text.replace(space, " ")
    return [w for w in text.split(" ") if w]


def ascii_lower_col(c):
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once a row.  A plain projected column
    would be inlined into lambdas by the optimiser and computed again for every element."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"
