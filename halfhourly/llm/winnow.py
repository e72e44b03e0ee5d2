"""Benchmark decontamination by winnowing, DataFrame and SQL functions only.

Every text keeps the minimum K-gram hash of each window of W consecutive K-grams
(all of them on ties).  A shared run of K + W - 1 words holds a whole such window on both
sides, so it shares a fingerprint: with K = 6 and W = 5 no common 10-word window is
missed.  Items of fewer than 10 words are shorter than the guarantee; for each
length among them (at most nine) documents also emit every gram of that length.

1. Items with equal words are one class; their fingerprints are joined with the
   documents' (broadcast while there are at most ``BROADCAST_ROWS``; a shuffle join
   beyond, which combines per document first).
2. A hit gives (document, class, offset).  The distinct ones are gathered per
   document and joined back to the texts, where the words of both sides are
   compared along the offset: runs of 10 equal words (or the whole short item)
   are the exact hits; hash collisions end here.

Defined cases: null or empty text: no words, nothing hit; items without words are
no windows; a document shorter than a window is clean unless a short item occurs;
repeated item rows count once by item_id; a null item_id hits words but is neither
counted nor listed; repeated and null doc_ids are judged row by row; an empty
benchmark or document table gives clean documents or no rows; extra columns are
ignored by ``hits`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfhourly.llm.common import let, materialize

K, W = 6, 5
WINDOW = K + W - 1
BROADCAST_ROWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: ``{0}`` is the text column; the separators are ASCII without letters and digits.
_WORDS = (f"filter(split(translate(coalesce({{0}}, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', -1), x -> x <> '')")


def words_sql(column: str = "text") -> str:
    return _WORDS.format(column)


def _grams(k: int) -> str:
    args = ", ".join(f"get(h, i + {j})" for j in range(k))
    return f"if(size(h) >= {k}, transform(sequence(0, size(h) - {k}), i -> xxhash64({k}, {args})), array())"


def _fingerprints(words: str, short: list[int]) -> str:
    """SQL for array<struct<fp, pos>>: the winnowed K-grams and all grams of the ``short`` lengths."""
    least = ", ".join(f"get(g, s + {j})" for j in range(W))
    minima = (f"if(size(g) > {W}, transform(sequence(0, size(g) - {W}), s -> least({least})), "
              f"transform(slice(g, 1, 1), s -> array_min(g)))")
    chosen = " or ".join(f"coalesce(get(m, p - {j}) = v, false)" if j else "coalesce(get(m, p) = v, false)" for j in range(W))
    small = " or ".join(["size(g) <= " + str(W) + " and v = get(m, 0)", chosen])
    picked = let("g", _grams(K), let("m", minima, (
        f"filter(transform(g, (v, p) -> if({small}, named_struct('fp', v, 'pos', p), null)), x -> x is not null)")))
    every = [f"transform({_grams(n)}, (v, p) -> named_struct('fp', v, 'pos', p))" for n in short]
    body = f"concat({', '.join([picked, *every])})" if every else picked
    return let("h", f"transform({words}, x -> xxhash64(x))", body)


def items(benchmark: DataFrame) -> DataFrame:
    """Classes of items with equal words: (class, words, ids), without empty items."""
    own = benchmark.select("item_id", F.expr(words_sql()).alias("words")).filter("size(words) > 0")
    return (own.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
            .select(F.xxhash64("words").alias("class"), "words", "ids"))


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence), item_ids (sorted strings)."""
    return _judged(docs, benchmark).select("doc_id", "n_words", "n_hit", "item_ids")


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``hits`` with the row's text_key."""
    classes = materialize(items(benchmark), "benchmark-classes")
    lengths = classes.select(F.size("words").alias("n")).filter(F.col("n") < WINDOW).distinct().collect()
    short = sorted(r.n for r in lengths)  # at most nine numbers
    one = (f"if(size(words) >= {WINDOW}, {_fingerprints('words', [])}, "
           f"array(named_struct('fp', {let('h', 'transform(words, x -> xxhash64(x))', _whole())}, 'pos', 0)))")
    prints = materialize(classes.select("class", F.inline(F.expr(one))).select("class", "fp", F.col("pos").alias("at")),
                         "benchmark-fingerprints")
    if prints.count() <= BROADCAST_ROWS:
        prints = F.broadcast(prints)
    own = docs.select("doc_id", F.inline(F.expr(_fingerprints(words_sql(), short))))
    found = (own.join(prints, "fp").select("doc_id", "class", (F.col("pos") - F.col("at")).alias("offset")).distinct()
             .join(classes, "class"))
    found = (found.groupBy("doc_id").agg(F.collect_list(F.struct("words", "ids", "offset")).alias("found"))
             .withColumnRenamed("doc_id", "found_id"))
    equal = "transform(c.words, (x, j) -> coalesce(get(ws, j + c.offset) = x, false))"
    starts = (f"if(size(c.words) >= {WINDOW}, filter(sequence(0, size(c.words) - {WINDOW}), "
              f"s -> forall(slice(e, s + 1, {WINDOW}), x -> x)), "
              "if(forall(e, x -> x), array(0), slice(array(0), 1, 0)))")
    at = (f"flatten(transform({starts}, s -> sequence(s + c.offset, s + c.offset + least({WINDOW}, size(c.words)) - 1)))")
    each = f"transform(coalesce(found, slice(array(named_struct('words', array(''), 'ids', array(''), 'offset', 0)), 1, 0)), c -> " \
           f"{let('e', equal, f'named_struct({chr(39)}at{chr(39)}, {at}, {chr(39)}ids{chr(39)}, c.ids)')})"
    result = let("ws", words_sql(), (
        "named_struct('n_words', size(ws), 'found', filter(" + each + ", x -> size(x.at) > 0))"))
    return (docs.select("doc_id", "text").join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
            .select("doc_id", F.xxhash64("text").alias("text_key"), F.expr(result).alias("r"))
            .select("doc_id", "text_key", F.col("r.n_words").cast("long").alias("n_words"),
                    F.expr("cast(size(array_distinct(flatten(r.found.at))) as long)").alias("n_hit"),
                    F.expr("array_sort(array_distinct(flatten(r.found.ids)))").alias("item_ids")))


def _whole() -> str:
    """The gram hash of a whole short item, as ``_grams`` gives it for its length."""
    cases = " ".join(f"when {n} then xxhash64({n}, {', '.join(f'get(h, {j})' for j in range(n))})" for n in range(1, WINDOW))
    return f"case size(h) {cases} end"


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns per document."""
    return hits(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any hit word, columns as they were."""
    dirty = (_judged(docs, benchmark).filter("n_hit > 0")
             .select(F.col("doc_id").alias("__dirty_id"), F.col("text_key").alias("__dirty_key")).distinct())
    return docs.join(dirty, F.col("doc_id").eqNullSafe(F.col("__dirty_id")) & (F.xxhash64("text") == F.col("__dirty_key")), "left_anti")
