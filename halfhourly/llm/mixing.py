"""Mixing sources to target weights by pivotal dependent rounding, DataFrame and SQL
functions only.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating; they share all words,
no target exceeds ``LIMIT`` times its source's words, and the excess is reshared by weight
until none is above.  The level of that water filling is found by iterating one scalar
aggregate over the sources; the rank comes from a range sort and offsets per
partition, so the sources need not fit one task either.

Each document is wanted target / source words times.  Its whole copies are fixed; the
fraction is a copy probability.  Pivotal rounding takes two fractional documents
and moves words from one to the other, in a direction drawn so that neither's
expectation changes, until one probability is 0 or 1; the other goes on.  Words
are conserved by every step, so the source's total stays at its target.

The steps run as a reduction tree: documents are dealt into blocks of about ``BLOCK`` by
hash, a block is folded to at most one fractional document, ``FAN`` residuals meet in
the next level, up to one per source.  That last fraction, one document of a
source at most, is met by the leading part of one further copy (``slice_words``).
A source with a third of all rows is just more blocks.

Everything is drawn from hashes of doc_id, text and a seed, so reruns agree.

Defined cases: null or empty text: size 0, taken 0; null source: a source of its own, last; a source
without words has target 0; no words at all: targets 0; repeated rows (same doc_id) are
separate documents: equal ones are counted, then numbered, so that they spread over the blocks, and share out what
they get in any order; null doc_id is a value like any other; an empty
table gives an empty result; extra columns are ignored by ``mix`` and kept by ``apply``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from halfhourly.llm.common import materialize

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK, FAN = 128, 64
SEED = 20240115
BROADCAST_SOURCES = 20_000
_SIZE = r"cast(coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0) as long)"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words), text_key per document, once over the texts."""
    return docs.select("doc_id", "source", F.expr(_SIZE).alias("size"), F.xxhash64("text").alias("text_key"))


def targets(sized: DataFrame) -> DataFrame:
    """source, rank, documents, source_size, target (double) per source."""
    own = sized.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    part = materialize(own.orderBy(F.asc_nulls_last("source"))
                       .select("*", F.spark_partition_id().alias("p"),
                               F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "sources")
    # as many rows as the sort has partitions
    before = (part.groupBy("p").agg(F.count("*").alias("n"))
              .select("p", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)),
                                      F.lit(0)).alias("before")))
    weight = "case " + " ".join(f"when rank % {len(WEIGHTS)} = {i} then {w}" for i, w in enumerate(WEIGHTS)) + " end"
    ranked = materialize(part.join(before, "p").withColumn("rank", F.col("before") + F.col("at"))
                         .withColumn("weight", F.expr(weight)).select("source", "rank", "documents", "source_size", "weight"),
                         "ranked-sources")
    total = ranked.agg(F.sum("source_size").alias("n")).collect()[0].n or 0
    level, capped = 0.0, -1
    while True:  # every turn caps at least one more source
        full = F.col("source_size") * LIMIT <= F.col("weight") * F.lit(level)
        r = ranked.agg(F.sum(F.when(full, F.col("source_size") * LIMIT)).alias("held"),
                       F.sum(F.when(~full, F.col("weight"))).alias("weights"), F.count_if(full).alias("n")).collect()[0]
        if r.n == capped or not r.weights:
            break
        capped, level = r.n, (total - (r.held or 0)) / r.weights
    cap = (F.col("source_size") * LIMIT).cast("double")
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(float(level))))


#: The state of a fold: the one fractional unit (or null) and the decided ones.
_FOLD = f"""
aggregate(
  units,
  named_struct('cur', cast(null as struct<doc_id: bigint, text_key: bigint, size: bigint, p: double, h: bigint>),
               'out', cast(array() as array<struct<doc_id: bigint, text_key: bigint, size: bigint, up: int>>)),
  (a, b) -> if(a.cur is null, named_struct('cur', b, 'out', a.out),
    element_at(transform(array(named_struct(
        -- words that can move to the current unit and away from it
        'to', least(a.cur.size * (1 - a.cur.p), b.size * b.p),
        'from', least(a.cur.size * a.cur.p, b.size * (1 - b.p)),
        'u', pmod(xxhash64({SEED}, a.cur.h, b.h), 1073741824) / 1073741824D)),
      d -> element_at(transform(array(if(d.u * (d.to + d.from) < d.from, d.to, -d.from)), m ->
        element_at(transform(array(named_struct('pa', a.cur.p + m / a.cur.size, 'pb', b.p - m / b.size)), q ->
          -- the unit whose limit bound the move is decided, exactly
          if(if(m >= 0, a.cur.size * (1 - a.cur.p) <= b.size * b.p, a.cur.size * a.cur.p <= b.size * (1 - b.p)),
             named_struct('cur', named_struct('doc_id', b.doc_id, 'text_key', b.text_key, 'size', b.size, 'p', least(greatest(q.pb, 0D), 1D), 'h', b.h),
                          'out', concat(a.out, array(named_struct('doc_id', a.cur.doc_id, 'text_key', a.cur.text_key, 'size', a.cur.size,
                                                                  'up', if(m >= 0, 1, 0))))),
             named_struct('cur', named_struct('doc_id', a.cur.doc_id, 'text_key', a.cur.text_key, 'size', a.cur.size,
                                              'p', least(greatest(q.pa, 0D), 1D), 'h', a.cur.h),
                          'out', concat(a.out, array(named_struct('doc_id', b.doc_id, 'text_key', b.text_key, 'size', b.size,
                                                                  'up', if(m >= 0, 0, 1))))))), 1)), 1)), 1)))
"""


def pivot(units: DataFrame, blocks: DataFrame) -> DataFrame:
    """Round the fractional ``units`` (rank, doc_id, size, p, and text_key where a doc_id may have several rows); ``blocks``:
    (rank, k) blocks per source.  Returns (rank, doc_id, text_key, size, up, slice_words) for every unit."""
    if "text_key" not in units.columns:
        units = units.withColumn("text_key", F.lit(0).cast("long"))
    equal = ["rank", "doc_id", "text_key", "size", "p"]
    units = (units.groupBy(*equal).agg(F.count("*").alias("n"))
             .select(*equal, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("turn")))
    most = blocks.agg(F.max("k").alias("k")).collect()[0].k or 1
    level = units.join(_small(blocks), "rank").select(
        "rank", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text_key", "size", "turn"), F.col("k")).alias("block"),
        F.struct("doc_id", "text_key", "size", "p",
                 F.xxhash64(F.lit(SEED + 1), "doc_id", "text_key", "size", "turn").alias("h")).alias("unit"))
    decided, turn = None, 0
    while True:
        grouped = level.groupBy("rank", "block").agg(F.collect_list("unit").alias("units"))
        # large documents first: the later, smaller ones then resolve them
        order = grouped.withColumn("units", F.expr(
            "transform(array_sort(transform(units, x -> named_struct('o', -x.size, 'h', x.h, 'd', x.doc_id, 'x', x))), y -> y.x)"))
        done = materialize(order.select("rank", "block", F.expr(_FOLD).alias("f"))
                           .select("rank", "block", "f.cur", "f.out"), f"pivot-{turn}")
        out = done.select("rank", F.inline("out")).select(
            "rank", "doc_id", "text_key", "size", "up", F.lit(0).cast("long").alias("slice_words"))
        decided = out if decided is None else decided.unionByName(out)
        rest = done.filter("cur is not null")
        if most <= 1:
            last = rest.select("rank", "cur.doc_id", "cur.text_key", "cur.size", F.lit(0).alias("up"),
                               F.round(F.col("cur.p") * F.col("cur.size")).cast("long").alias("slice_words"))
            return decided.unionByName(last)
        turn, most = turn + 1, -(-most // FAN)
        level = rest.select("rank", F.floor(F.col("block") / FAN).alias("block"), F.col("cur").alias("unit"))


def _small(per_source: DataFrame) -> DataFrame:
    """A table of one row a source: broadcast while there are few, joined by shuffle beyond."""
    return F.broadcast(per_source) if per_source.count() <= BROADCAST_SOURCES else per_source


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (whole), slice_words, taken, text_key; one row per row of ``docs``."""
    sized = materialize(sizes(docs), "sizes")
    goal = materialize(targets(sized), "targets")
    own = (sized.join(_small(goal), sized.source.eqNullSafe(goal.source))
           .select("doc_id", sized.source, "size", "text_key", "rank", "source_size", "target",
                   F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate")))
    own = own.withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))
    loose = F.col("size") * F.col("p") > 0
    blocks = goal.select("rank", F.greatest(F.lit(1), F.ceil(F.col("documents") / BLOCK)).alias("k"))
    rounded = pivot(own.filter(loose).select("rank", "doc_id", "text_key", "size", "p"), blocks)
    fixed = own.filter(~loose).select("rank", "doc_id", "text_key", "size", F.lit(0).alias("up"),
                                      F.lit(0).cast("long").alias("slice_words"))
    every = rounded.unionByName(fixed)
    facts = goal.select("rank", "source", "source_size", "target",
                        F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
                        .alias("whole"))
    out = every.join(_small(facts), "rank").withColumn("copies", (F.col("whole") + F.col("up")).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", "slice_words",
                      (F.col("copies") * F.col("size") + F.col("slice_words")).alias("taken"), "text_key")


#: The first ``slice_words`` words of a text, with what stands between them.
_SLICE = (r"array_join(slice(regexp_extract_all(text, '[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++', 0), 1, "
          "cast(slice_words as int)), '')")


def apply(docs: DataFrame) -> DataFrame:
    """The mixture itself: a row for every whole copy (``copies`` 1, ``slice_words`` 0), and one for the part of a further
    copy, whose text is its first ``slice_words`` words (``copies`` 0).  So the words of a source's rows come to its target.
    Columns of these names in ``docs`` give way; n_chars follows a cut text if there is one."""
    key = lambda text: F.xxhash64("doc_id", "source", text)
    turn = lambda *by: F.row_number().over(Window.partitionBy("__mix_k").orderBy(*by))
    plan = (mix(docs).withColumn("__mix_k", key("text_key"))
            .withColumn("__mix_turn", turn(F.desc("copies"), F.desc("slice_words")))
            .filter("copies > 0 OR slice_words > 0").select(F.col("__mix_k").alias("__mix_plan"), "__mix_turn", "copies", "slice_words"))
    keep = [c for c in docs.columns if c not in ("copies", "slice_words")]
    columns = [F.col(f"`{c}`") for c in keep]
    own = (docs.select(*columns).withColumn("__mix_text", F.xxhash64("text")).withColumn("__mix_k", key("__mix_text"))
           .withColumn("__mix_mine", turn(F.lit(1))))  # rows of one key are equal in text, any order will do
    # one key only, so that the texts are dealt once for the window and the join
    taken = own.join(plan, (F.col("__mix_k") == F.col("__mix_plan")) & (F.col("__mix_mine") - F.col("__mix_turn") == 0))
    part = F.struct(F.lit(0).cast("long").alias("copies"), F.col("slice_words"))
    whole = F.struct(F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("slice_words"))
    each = F.concat(F.array_repeat(whole, F.col("copies").cast("int")), F.when(F.col("slice_words") > 0, F.array(part)).otherwise(F.array()))
    out = taken.withColumn("__mix_each", each).drop("copies", "slice_words").select(*columns, F.inline("__mix_each"))
    cut = F.col("slice_words") > 0
    out = out.withColumn("text", F.when(cut, F.expr(_SLICE)).otherwise(F.col("text")))
    if "n_chars" in keep:
        out = out.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
