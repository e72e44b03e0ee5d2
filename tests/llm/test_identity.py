"""Rows without doc_id and repeated doc_ids in mixing and in the near-duplicate stage; the mixture's copies and slices."""

import collections
import re
import time

import pytest
from pyspark.sql import functions as F

from halfhourly.llm import minhash, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _text(i: int, n: int = 40) -> str:
    return " ".join(f"w{i}x{k}" for k in range(n))


def test_mixture_writes_copies_and_slices(spark):
    rows = [(i, " \n".join(f"a{i}b{k}" for k in range(5 + i % 40)), f"s{min(i % 7, 3)}", None) for i in range(300)]
    rows += [(None, "same words here", "s1", 1)] * 30 + [(7, "same words here", "s1", 1)] * 5 + [(8, None, "s0", 0), (9, "", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    plan = mixing.mix(docs).collect()
    out = mixing.apply(docs).collect()
    words = collections.Counter()
    for r in out:
        words[r.source] += len(WORD.findall(r.text or ""))
        assert (r.copies, r.slice_words > 0) in ((1, False), (0, True))
        assert r.copies or (len(WORD.findall(r.text)) == r.slice_words and r.n_chars == len(r.text))
    for r in plan:
        assert abs(words[r.source] - r.target) <= 1
    want = collections.Counter((r.doc_id, r.source) for r in plan for _ in range(r.copies + (r.slice_words > 0)))
    assert collections.Counter((r.doc_id, r.source) for r in out) == want
    starts = {(d, s): [] for d, _, s, _ in rows}
    for d, t, s, _ in rows:
        starts[d, s].append(t or "")
    assert all(any(t.startswith(r.text or "") for t in starts[r.doc_id, r.source]) for r in out)
    assert sorted(map(repr, mixing.apply(docs.repartition(5)).collect())) == sorted(map(repr, out))


def test_rows_without_id_cost_what_ids_cost(spark):
    base = spark.range(40_000).select("id", F.format_string("w%d and some more words", "id").alias("text"),
                                      F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("source"))
    def took(doc_id):
        start = time.time()
        n = mixing.mix(base.select(doc_id.cast("long").alias("doc_id"), "text", "source")).agg(F.sum("taken")).collect()[0][0]
        return time.time() - start, n
    took(F.col("id"))
    with_ids, without, equal = took(F.col("id")), took(F.lit(None)), took(F.lit(5))
    assert with_ids[1] == without[1] == equal[1]
    assert max(without[0], equal[0]) < 2.5 * with_ids[0] + 3


@pytest.mark.parametrize("several", [False, True])
def test_one_row_of_each_component_stays(spark, several):
    near = _text(1).replace("w1x39", "other")  # 35 of 37 shingles shared
    rows = [(1, _text(1), "a"), (2, near, "b"), (None, near + " x", "c"), (None, _text(2), "d"), (None, _text(2), "e"),
            (None, _text(3), "f"), (4, _text(4), "g"), (4, _text(4), "g"), (4, _text(4), "h"), (5, _text(4) + " y", "i"),
            (None, "", "j"), (None, None, "k"), (None, "", "l"), (6, _text(6), "m")]
    if several:  # one doc_id for two texts: one a copy, one not
        rows += [(7, _text(1), "n"), (7, _text(7), "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("node", F.lit("clash"))
    out = minhash.keep_first(docs)
    assert out.columns == docs.columns
    got = collections.Counter(r.source for r in out.collect())
    assert got["a"] == 1 and not got["b"] and not got["c"]
    assert got["d"] + got["e"] == 1 and got["f"] == 1 and got["m"] == 1
    assert got["g"] + got["h"] == 1 and not got["i"]
    assert got["j"] == got["k"] == got["l"] == 1
    assert not got["n"] and got["o"] == int(several)
    assert sorted(map(repr, minhash.keep_first(docs.repartition(7)).collect())) == sorted(map(repr, out.collect()))
    assert minhash.keep_first(docs.limit(0)).count() == 0
