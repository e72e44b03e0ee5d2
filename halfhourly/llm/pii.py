"""Personal data by bootstrapped contextual extraction, DataFrame and SQL functions only.

Base spans come from fixed patterns per kind.  They are the seeds: the two words
before a seed are a lexical pattern, and tokens of identifier shape (a digit or
an at sign) that no base pattern covers are the unknown instances.  Patterns and
instances form a bipartite graph.  A round scores the patterns it has, then admits new ones: instances it trusts are
seeds in turn, also where no base seed ever stood.  Rounds go on until no pattern is added and no confidence rises by TOLERANCE
(they only rise, and DAMPING makes them converge):

* a pattern's confidence for a kind is the mean score of its distinct instances,
  where a seed of the kind counts 1, a seed of another kind 0, an unknown its score;
* an unknown's score is the damped noisy-or of its patterns' confidences.

A pattern is admitted with at least MIN_SEEDS distinct seeds: base spans of the kind, and unknowns of its shape with
a score of MIN_CONFIDENCE.  Unknown tokens under a pattern with MIN_CONFIDENCE whose shape fits the kind become spans of that kind.  The graph holds distinct
(pattern, instance) pairs only; every step is a grouped aggregate or an equi-join on
them, so a pattern with a third of all occurrences is combined before the shuffle.

The patterns are written so that matching is linear: possessive repeats, and a
look-behind (or the end of the last match) where a run of word characters would
be tried from every position.  Their matches are those of the plain patterns.

Defined cases: null or empty text: no spans; empty table: empty result; repeated rows
get the same spans; null doc_id is carried through; offsets are code points, end exclusive;
extra columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfhourly.llm.common import let, materialize

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.6
DAMPING = 0.9
TOLERANCE = 0.01
STEP = 128
CONTEXT = 64  # code points before a span that its context words come from

#: Linear forms of the base patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: What a text must contain for a pattern to be tried at all.
_NEEDS = {"email": "contains(text, '@')", "ip": "text rlike '[0-9][.][0-9]'", "card": "text rlike '[0-9][ -]?[0-9]'",
          "phone": "contains(text, '+')", "token": "text rlike '[0-9@]'"}
_DIGITS = "regexp_replace(m.v, '[^0-9]', '')"
_LUHN = ("aggregate(sequence(1, length({d})), 0, (a, i) -> a + if((length({d}) - i) % 2 = 0, "
         "cast(substring({d}, i, 1) as int), element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), "
         "cast(substring({d}, i, 1) as int) + 1))) % 10 = 0").format(d=_DIGITS)
_VALID = {
    "email": "true",
    "ip": "forall(split(m.v, '[.]'), p -> case when length(ltrim('0', p)) > 3 then false "
          "else cast(concat('0', ltrim('0', p)) as int) <= 255 end)",
    "card": f"case when length({_DIGITS}) between 14 and 19 then {_LUHN} else false end",
    "phone": f"length({_DIGITS}) between 10 and 15",
    "token": "true",
}
#: Shapes a learned instance must have.
_FITS = {"email": "contains(token, '@') and length(token) >= 5",
         "ip": "token rlike '^[0-9a-fA-F]+([.:]+[0-9a-fA-F]+){2,}$'",
         "card": "length(regexp_replace(token, '[^0-9]', '')) between 12 and 19 and token rlike '^[0-9 -]+$'",
         "phone": "length(regexp_replace(token, '[^0-9]', '')) between 7 and 15 and token rlike '^[+0-9().-]+$'"}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(kind: str, pattern: str) -> str:
    """SQL for array<struct<v, s, e, c>>: a kind's valid matches with their offsets.  The pieces between
    the matches give the offsets: start = all earlier pieces and matches, summed in steps of STEP matches
    so that a text of very many matches stays near linear."""
    p = _quoted(pattern)
    add = "0, (a, x) -> a + x"
    before = (f"get(starts, cast(i div {STEP} as int)) + aggregate(slice(lens, cast(i div {STEP} as int) * {STEP} + 1, "
              f"i % {STEP}), {add}) + length(get(gs, i))")
    # a match and the piece before it are two code points at least, so this many reach CONTEXT back
    left = (f"right(concat(array_join(slice(ts, greatest(i + 1 - {CONTEXT // 2}, 1), least(i, {CONTEXT // 2})), ''), "
            f"right(get(gs, i), {CONTEXT})), {CONTEXT})")
    found = let("gs", f"split(text, {p}, -1)", let("lens", "zip_with(ms, slice(gs, 1, size(ms)), (m, g) -> length(m) + length(g))", let(
        "sums", f"transform(sequence(0, cast((size(ms) - 1) div {STEP} as int)), j -> aggregate(slice(lens, j * {STEP} + 1, {STEP}), {add}))",
        let("starts", f"transform(sequence(0, size(sums) - 1), j -> aggregate(slice(sums, 1, j), {add}))",
            let("ts", f"zip_with(ms, slice(gs, 1, size(ms)), (m, g) -> right(concat(right(g, {CONTEXT}), m), {CONTEXT}))",
                f"transform(transform(ms, (m, i) -> named_struct('v', m, 's', {before}, 'c', {left})), "
                "x -> named_struct('v', x.v, 's', x.s, 'e', x.s + length(x.v), 'c', x.c))")))))
    none = "slice(array(named_struct('v', '', 's', 0, 'e', 0, 'c', '')), 1, 0)"
    found = let("ms", f"regexp_extract_all(text, {p}, 0)", f"if(size(ms) = 0, {none}, {found})")
    return (f"if(text is not null and {_NEEDS[kind]}, filter({found}, m -> {_VALID[kind]}), "
            "slice(array(named_struct('v', '', 's', 0, 'e', 0, 'c', '')), 1, 0))")


#: The two words before a match (earlier matches are words too), lower case, digits as 0; '' if there are fewer.
_CTX = ("trim(regexp_replace(regexp_replace(lower(regexp_extract(m.c, '(\\\\S+)\\\\s+(\\\\S+)\\\\s*$', 0)), "
        "'[0-9]+', '0'), '\\\\s+', ' '))")


def base(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_key, spans (start, kind number, end) in order, seeds and unknowns with contexts."""
    kinds = docs.select("doc_id", "text", *[F.expr(_matches(k, p)).alias(k) for k, p in PATTERNS.items()],
                        F.expr(_matches("token", TOKEN)).alias("token"))
    spans = "array_sort(concat(" + ", ".join(
        f"transform({k}, m -> named_struct('s', m.s, 'k', {i}, 'e', m.e))" for i, k in enumerate(KINDS)) + "))"
    seeds = "concat(" + ", ".join(
        f"transform({k}, m -> named_struct('k', {i}, 'token', m.v, 's', m.s, 'e', m.e, 'ctx', {_CTX}))"
        for i, k in enumerate(KINDS)) + ")"
    # spans of a kind are in order and apart, so only the last one that starts before a token's end can cover it:
    # found by halving steps over the array
    steps = "transform(sequence(cast(floor(log2(size({k}) + 1)) as int), 0, -1), j -> cast(shiftleft(1, j) as int))"
    last = ("aggregate(" + steps + ", 0, (a, p) -> if(a + p <= size({k}), if(get({k}, a + p - 1).s < m.e, a + p, a), a))")
    covered = " or ".join(f"(size({k}) > 0 and coalesce(get({k}, {last.format(k=k)} - 1).e > m.s, false))" for k in KINDS)
    unknown = f"filter(token, m -> not ({covered}))"
    # a token's surrounding marks are not part of it
    unknown = (f"filter(transform({unknown}, m -> named_struct('k', -1, 'token', "
               "regexp_extract(m.v, '^[\"\\'(<\\\\[]*+(.*?)[\"\\',;:.!?)>\\\\]]*$', 1), "
               "'s', m.s + length(regexp_extract(m.v, '^[\"\\'(<\\\\[]*+', 0)), 'e', 0, "
               f"'ctx', {_CTX})), u -> length(u.token) >= 5)")
    unknown = f"transform({unknown}, u -> named_struct('k', u.k, 'token', u.token, 's', u.s, 'e', u.s + length(u.token), 'ctx', u.ctx))"
    return kinds.select("doc_id", F.xxhash64("text").alias("text_key"), F.expr(spans).alias("spans"),
                        F.expr(f"filter(concat({seeds}, {unknown}), u -> u.ctx <> '')").alias("near"))


def learn(found: DataFrame) -> DataFrame:
    """(ctx, k, confidence) of the patterns that the bootstrapping trusts."""
    edges = materialize(found.select(F.explode("near").alias("u")).select("u.ctx", "u.k", "u.token").distinct(), "pattern-edges")
    unknown = edges.filter("k < 0")
    base_seeds = materialize(edges.filter("k >= 0").groupBy("ctx", F.col("k").alias("kind"))
                             .agg(F.count("*").alias("seeds")), "pattern-seeds")
    known = F.when(F.col("k") == F.col("kind"), 1.0).when(F.col("k") >= 0, 0.0)
    patterns = admitted = score = None
    while True:
        seeds = base_seeds
        if score is not None:
            sure = score.filter(F.col("score") >= MIN_CONFIDENCE).filter(F.expr(_fits("kind")))
            seeds = seeds.unionByName(unknown.join(sure, "token").groupBy("ctx", "kind").agg(F.count("*").alias("seeds")))
        now = materialize(seeds.groupBy("ctx", "kind").agg(F.sum("seeds").alias("seeds"))
                          .filter(F.col("seeds") >= MIN_SEEDS).select("ctx", "kind"), "pattern-admitted")
        if admitted is None or now.count() > admitted.count():
            graph = materialize(edges.join(now, "ctx"), "pattern-graph")
        rows, before = graph, patterns
        if score is not None:
            rows = rows.join(score, ["token", "kind"], "left")
        of_unknown = F.lit(0.0) if score is None else F.when(F.col("k") < 0, F.col("score"))
        patterns = materialize(rows.groupBy("ctx", "kind").agg(
            F.avg(F.coalesce(known, of_unknown, F.lit(0.0))).alias("confidence")), "pattern-scores")
        if before is not None:
            rise = (patterns.join(before.withColumnRenamed("confidence", "earlier"), ["ctx", "kind"], "left")
                    .filter(F.col("earlier").isNull() | (F.col("confidence") - F.col("earlier") >= TOLERANCE)))
            if rise.isEmpty():
                break
        elif patterns.isEmpty():
            break
        admitted = now
        score = materialize(graph.filter("k < 0").join(patterns, ["ctx", "kind"]).groupBy("token", "kind").agg(
            (DAMPING * (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))))).alias("score")), "pattern-instances")
    return patterns.filter(F.col("confidence") >= MIN_CONFIDENCE).select("ctx", F.col("kind").alias("k"), "confidence")


def _fits(kind: str) -> str:
    """SQL: whether ``token`` has a shape of the kind numbered by the column ``kind``."""
    return "case " + " ".join(f"when {kind} = {i} then {_FITS[k]}" for i, k in enumerate(KINDS)) + " end"


def _all_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, spans (base) and more (learned), the same structs; one row per row of ``docs``."""
    found = materialize(base(docs), "personal-base")
    best = (learn(found).groupBy("ctx").agg(F.max_by("k", F.struct("confidence", -F.col("k"))).alias("k")))
    unknown = (found.select("doc_id", "text_key", F.explode("near").alias("u")).filter("u.k < 0")
               .select("doc_id", "text_key", "u.ctx", "u.token", "u.s", "u.e"))
    more = (unknown.join(best, "ctx").filter(F.expr(_fits("k")))
            .groupBy("doc_id", "text_key")
            .agg(F.collect_set(F.struct("s", "k", "e")).alias("more"))
            .withColumnsRenamed({"doc_id": "d", "text_key": "t"}))
    none = F.expr("slice(array(named_struct('s', 0, 'k', 0, 'e', 0)), 1, 0)")
    return (found.select("doc_id", "text_key", "spans")
            .join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
            .select("doc_id", "text_key", "spans", F.coalesce("more", none).alias("more")))


def _text(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return (f"array_join(transform({spans}, x -> concat(element_at(array({names}), x.k + 1), ':', "
            "cast(x.s as string), ':', cast(x.e as string))), ',')")


def find(docs: DataFrame) -> DataFrame:
    """The digest columns per row: base counts and hash, all spans."""
    counts = [F.expr(f"cast(size(filter(spans, x -> x.k = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return _all_spans(docs).select(
        "doc_id", *counts, F.sha2(F.expr(_text("spans")), 256).alias("base_sha256"),
        F.expr(_text("array_sort(concat(spans, more))")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are replaced once,
    under the first one's kind.  Other columns stay, n_chars too follows the new text if there is one."""
    own = (_all_spans(docs).filter("size(spans) + size(more) > 0")
           .select(F.col("doc_id").alias("__pii_d"), F.col("text_key").alias("__pii_t"),
                   F.array_sort(F.concat("spans", "more")).alias("__pii_spans")).distinct())
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    text = ("aggregate(__pii_spans, named_struct('at', 0, 'out', ''), (a, x) -> if(x.s < a.at, "
            "named_struct('at', greatest(a.at, x.e), 'out', a.out), named_struct('at', x.e, 'out', "
            f"concat(a.out, substring(text, a.at + 1, x.s - a.at), element_at(array({names}), x.k + 1)))), "
            "a -> concat(a.out, substring(text, a.at + 1)))")
    joined = docs.withColumn("__pii_k", F.xxhash64("text")).join(
        own, F.col("doc_id").eqNullSafe(F.col("__pii_d")) & (F.col("__pii_k") == F.col("__pii_t")), "left")
    out = joined.withColumn("text", F.when(F.col("__pii_spans").isNull(), F.col("text")).otherwise(F.expr(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__pii_spans").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
