"""Near-duplicates by HyperMinHash with exact confirmation.

Each document's shingle set is hashed once; the top bits of a hash choose one of
``BUCKETS`` buckets and the register of a bucket keeps, of the bucket's minimum,
the number of leading zeros (6 bits) and the next ``MANTISSA`` bits.  Empty buckets
borrow the register of another by a fixed probe order, so small sets have full
signatures.  ``BANDS`` bands of ``ROWS`` compressed registers are the candidate keys: a
pair at similarity 0.8 misses all 32 with probability (1 - 0.8**4)**32 < 5e-8.

Documents with equal shingle sets are one class first (its smallest doc_id stands
for it), so copies never form pairs.  Inside a band bucket candidates are found in
two steps, so no bucket is expanded into all its pairs:

1. star: every member is compared with the bucket's smallest member;
2. rest: only buckets whose members lie in several components after step 1 stay;
   their members are dealt into blocks, pairs of blocks are compared by
   collision-corrected register similarity, and what reaches the estimate's floor
   comes out as a list of partners for each node of the smaller component.

Every candidate is confirmed on the full shingle sets, recomputed from the texts:
100 * intersection >= 80 * union.  Components come from randomised contraction
(Boegeholz, Brand, Todor: In-database connected component analysis, 2020).

Defined cases: null or empty text, or no words: empty set, linked with nothing;
fewer words than a shingle: the whole sequence is the one shingle; repeated rows
(same doc_id and text): same class; rows that share a doc_id share its links; a null doc_id stands after all others and gets
the class's component; an empty table gives an empty result; extra columns are
ignored by ``components`` and kept by ``keep_first``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfhourly.llm.common import (
    WordHashes, ascii_lower, gram_hashes, materialize, rebatch, sorted_groups, space_words,
)

BUCKETS = 128
BANDS, ROWS = 32, 4
MANTISSA = 10
#: Expected share of unequal minima whose compressed registers agree: the minima must share
#: the zero count (1/3 over all counts) and then MANTISSA bits.
COLLISION = 2.0 ** -MANTISSA / 3
#: Pairs whose estimated similarity lies under threshold - SLACK are not confirmed. The estimate's
#: standard deviation at 0.8 is 0.035, up to 0.05 where buckets are borrowed: 5 deviations or more.
SLACK = 0.25
BLOCK = 2048  # members of a bucket whose registers are compared in one task
BROADCAST_IDS = 2_000_000  # 16 MB of ids
REPEATED_ROWS = 2_000_000  # likewise of repeated ones
VERIFY = 128  # nodes whose full sets are compared in one task, on either side

_SIGNATURE = "doc_id long, n_shingles long, set_key binary, registers binary"


def _probes() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(7))
    return np.stack([rng.permutation(BUCKETS) for _ in range(BUCKETS)])


_PROBES = _probes()
_NONE = np.empty(0, np.int64)


def shingle_set(words: list[str], hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a word sequence."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(hashes.array(words), min(size, len(words))))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The compressed minimum of each bucket of a non-empty sorted hash array."""
    shift = 64 - BUCKETS.bit_length() + 1
    bucket, first = np.unique(shingles >> np.uint64(shift), return_index=True)
    rest = shingles[first] & np.uint64((1 << shift) - 1)  # hashes are sorted, so the first is the minimum
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)  # bit length; ample for the leading bits
    mantissa = np.where(length > MANTISSA, rest >> np.maximum(length - MANTISSA - 1, 0).astype(np.uint64), rest)
    own = ((shift - length).clip(0, 63).astype(np.uint64) << np.uint64(MANTISSA)) | (
        mantissa & np.uint64((1 << MANTISSA) - 1))
    out = np.zeros(BUCKETS, np.uint16)
    full = np.zeros(BUCKETS, bool)
    full[bucket.astype(np.int64)] = True
    out[bucket.astype(np.int64)] = own.astype(np.uint16)
    empty = np.flatnonzero(~full)
    if len(empty):
        probe = _PROBES[empty]
        out[empty] = out[probe[np.arange(len(empty)), full[probe].argmax(axis=1)]]
    return out


def estimate(same: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers, less the expected chance collisions."""
    return np.clip((same - COLLISION) / (1 - COLLISION), 0, 1)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, set size, 128-bit key of the set, registers; null key for empty sets."""
    def run(it):
        hashes = WordHashes()
        for pdf in rebatch(it, "text"):
            rows = []
            for text in pdf["text"]:
                s = shingle_set(space_words(ascii_lower(text or "")), hashes, size)
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), registers(s).tobytes()) if len(s)
                            else (0, None, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "set_key", "registers"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64"))
            yield out
    return docs.select("doc_id", "text").mapInPandas(run, _SIGNATURE)


def _bands(reps: DataFrame) -> DataFrame:
    """(band key, node): the key is the band's registers, exactly, and the band number."""
    def run(it):
        for pdf in it:
            if len(pdf):
                regs = np.frombuffer(b"".join(pdf["registers"]), np.uint16).reshape(len(pdf), BANDS, ROWS)
                keys = np.ascontiguousarray(regs).view(np.int64).reshape(len(pdf) * BANDS)
                yield pd.DataFrame({"band": np.tile(np.arange(BANDS, dtype=np.int8), len(pdf)), "key": keys,
                                    "node": np.repeat(pdf["node"].to_numpy(), BANDS)})
    return reps.select("node", "registers").mapInPandas(run, "band byte, key long, node long")


def _similar(a: DataFrame, floor: float) -> DataFrame:
    """Pairs (u, v) with registers ``ru``, ``rv`` whose corrected estimate reaches the floor."""
    def run(it):
        for pdf in it:
            if len(pdf):
                u = np.frombuffer(b"".join(pdf["ru"]), np.uint16).reshape(-1, BUCKETS)
                v = np.frombuffer(b"".join(pdf["rv"]), np.uint16).reshape(-1, BUCKETS)
                yield pdf.loc[estimate((u == v).mean(axis=1)) >= floor, ["u", "v"]]
    return a.select("u", "v", "ru", "rv").mapInPandas(run, "u long, v long")


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets satisfy 100 * intersection >= percent * union.
    Each side's set is recomputed from its text; a text read for consecutive pairs is hashed once."""
    def run(it):
        hashes = WordHashes()
        held: dict = {}

        def of(node: int, text: str) -> np.ndarray:
            if node not in held:
                if len(held) >= 256:
                    held.clear()
                held[node] = shingle_set(space_words(ascii_lower(text)), hashes, size)
            return held[node]
        for batch in it:
            for pdf in rebatch([batch], "tu", 2_000_000):
                ok = []
                for u, v, tu, tv in zip(pdf["u"], pdf["v"], pdf["tu"], pdf["tv"], strict=True):
                    a, b = of(u, tu), of(v, tv)
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    ok.append(100 * both >= percent * (len(a) + len(b) - both))
                yield pdf.loc[ok, ["u", "v"]]
    t = texts.select("node", "text")
    left = pairs.join(t.withColumnsRenamed({"node": "v", "text": "tv"}), "v")
    return (left.join(t.withColumnsRenamed({"node": "u", "text": "tu"}), "u")
            .select("u", "v", "tu", "tv").mapInPandas(run, "u long, v long"))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the given nodes only, written once for all joins that follow.  While the ids are few
    they filter the scan as a broadcast; beyond BROADCAST_IDS the texts are dealt by doc_id once."""
    ids = materialize(nodes.distinct(), "needed-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    own = docs.select(F.col("doc_id").alias("node"), "text").filter("text IS NOT NULL")
    return materialize(own.join(ids, "node", "left_semi"), "needed-texts")


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); component is the smallest node.

    Randomised contraction: in each round every node joins the neighbour (or itself) with the
    smallest hash of the round, which shrinks the graph by a constant factor whatever its shape.
    Aggregations combine map-side, so a node with very many links costs one buffer a task."""
    edges = links.filter("u <> v").select("u", "v").distinct()
    edges = materialize(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    nodes = edges.select(F.col("u").alias("node")).distinct()
    label = nodes.withColumn("label", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = lambda c, t=turn: F.xxhash64(F.lit(t), F.col(c))
        least = edges.groupBy("u").agg(F.min_by("v", rank("v")).alias("w"), F.min(rank("v")).alias("r"))
        to = materialize(least.select("u", F.when(rank("u") <= F.col("r"), F.col("u")).otherwise(F.col("w")).alias("to")),
                         "contraction")
        label = materialize(label.join(to.withColumnRenamed("u", "label"), "label", "left")
                            .select("node", F.coalesce("to", "label").alias("label")), "labels")
        ends = edges.join(to, "u").select(F.col("to").alias("a"), "v")
        edges = materialize(ends.join(to.withColumnsRenamed({"u": "v", "to": "b"}), "v")
                            .select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct(), "edges")
    smallest = label.groupBy("label").agg(F.min("node").alias("component"))
    return label.join(smallest, "label").select("node", "component")


def _rest(members: DataFrame, component: DataFrame, regs: DataFrame, floor: float) -> tuple[DataFrame, DataFrame]:
    """Candidates of different components inside the buckets that still hold several:
    (u, home, vblock, vs).  u is of the smaller component; its partners come as lists, dealt by
    ``home`` (a node's smallest hub) and block, so a node that is near a large group without
    belonging to it costs one row a block and not one a pair.

    The members of an open bucket are dealt into blocks of about BLOCK; a block meets every
    block of its bucket once, as a pair of blocks in one task."""
    sizes = component.groupBy("component").agg(F.count("*").alias("weight"))
    home = members.groupBy("node").agg(F.min("hub").alias("home"))
    homes = (home.join(home.groupBy("home").agg(F.ceil(F.count("*") / VERIFY).alias("k")), "home")
             .select("node", "home", F.pmod(F.xxhash64("node"), F.col("k")).cast("int").alias("vblock")))
    nodes = materialize(homes.join(component.join(sizes, "component"), "node", "left")
                        .select("node", "home", "vblock", F.coalesce("component", "node").alias("component"),
                                F.coalesce("weight", F.lit(1)).alias("weight")), "nodes")
    own = members.select("band", "key", "node").join(nodes, "node")
    open_ = (own.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                            F.count("*").alias("size"))
             .filter("lo <> hi").select("band", "key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    live = (own.join(open_, ["band", "key"]).join(regs, "node")
            .withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")))
    met = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(F.col("block"), j).alias("i"), F.greatest(F.col("block"), j).alias("j"))))
    dealt = live.withColumn("at", met).drop("blocks")

    def compare(g: dict) -> tuple[np.ndarray, np.ndarray]:
        """Positions (at, to) of the group's candidate pairs."""
        within = g["i"][0] == g["j"][0]
        order = np.lexsort((g["node"], g["component"], g["weight"]))
        comp, block, own = g["component"][order], g["block"][order], g["regs"][order]
        bands = own.reshape(-1, BANDS, ROWS)
        b = int(g["band"][0])
        us, vs = [], []
        last = int((comp == comp[-1]).sum())  # the heaviest component stands at the end
        for r in range(len(comp) - last):
            other = np.arange(r + 1, len(comp))
            other = other[comp[other] != comp[r]]
            if not within:
                other = other[block[other] != block[r]]
            if len(other):
                other = other[estimate((own[other] == own[r]).mean(axis=1)) >= floor]
            if b and len(other):  # a pair that meets in several buckets comes out of its first band only
                other = other[~(bands[other, :b] == bands[r, :b]).all(axis=2).any(axis=1)]
            us.append(np.full(len(other), r))
            vs.append(other)
        return order[np.concatenate(us or [_NONE])], order[np.concatenate(vs or [_NONE])]

    def run(it):
        for g in sorted_groups(it, ["band", "key", "i", "j"]):
            if g["component"].min() == g["component"].max():
                continue
            g["regs"] = np.frombuffer(b"".join(g["registers"]), np.uint16).reshape(-1, BUCKETS)
            at, to = compare(g)
            if not len(at):
                continue
            node, home, vblock = g["node"], g["home"][to], g["vblock"][to]
            order = np.lexsort((vblock, home, at))
            at, to, home, vblock = at[order], to[order], home[order], vblock[order]
            first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (home[1:] != home[:-1]) | (vblock[1:] != vblock[:-1])])
            yield pd.DataFrame({"u": node[at[first]], "home": home[first], "vblock": vblock[first],
                                "vs": pd.Series([x.tolist() for x in np.split(node[to], first[1:])], dtype=object)})
    dealt = dealt.select("band", "key", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "block", "node", "component",
                         "weight", "home", "vblock", "registers")
    found = (dealt.repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
             .mapInPandas(run, "u long, home long, vblock int, vs array<long>"))
    return found, nodes


def _confirm_lists(lists: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (u, v) of the candidate lists, one for each u and component of v: that suffices for components.
    Both sides of a task are bounded: about VERIFY nodes of a home and VERIFY probing nodes."""
    lists = materialize(lists.groupBy("u", "home", "vblock").agg(F.flatten(F.collect_list("vs")).alias("vs")), "lists")
    deals = (lists.groupBy("home", "vblock").agg(F.ceil(F.count("*") / VERIFY).cast("int").alias("deals")))
    left = (lists.join(deals, ["home", "vblock"])
            .join(texts.select(F.col("node").alias("u"), F.col("text").alias("u_text")), "u")
            .withColumn("deal", F.pmod(F.xxhash64("u"), F.col("deals")).cast("int")).drop("deals"))
    right = (nodes.join(deals, ["home", "vblock"])
             .join(texts.select("node", F.col("text").alias("v_text")), "node")
             .select("home", "vblock", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"),
                     "node", "component", "v_text"))

    def run(us: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHashes()
        sets = {n: shingle_set(space_words(ascii_lower(x)), hashes, size)
                for n, x in zip(vs["node"], vs["v_text"], strict=True)}
        comp = dict(zip(vs["node"], vs["component"], strict=True))
        out = []
        for u, text, partners in zip(us["u"], us["u_text"], us["vs"], strict=True):
            a = shingle_set(space_words(ascii_lower(text)), hashes, size)
            met: set = set()
            for v in partners:
                if comp[v] in met:
                    continue
                b = sets[v]
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    met.add(comp[v])
                    out.append((u, v))
        return pd.DataFrame(out, columns=["u", "v"])
    key = ["home", "vblock", "deal"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(run, "u long, v long")


def components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.  Work on classes: ``node`` is
    the smallest doc_id of the documents with equal sets (a class without any doc_id is dropped from
    linking; its rows keep a null component)."""
    floor = percent / 100 - SLACK
    sig = materialize(signatures(docs, size), "signatures")
    reps = materialize(sig.filter("set_key IS NOT NULL").groupBy("set_key")
                       .agg(F.min("doc_id").alias("node"), F.first("registers").alias("registers"))
                       .filter("node IS NOT NULL"), "classes")
    regs = reps.select("node", "registers")
    bands = materialize(_bands(reps), "bands")
    hubs = (bands.groupBy("band", "key").agg(F.min("node").alias("hub"), F.count("*").alias("n"))
            .filter("n > 1").select("band", "key", "hub"))
    members = materialize(bands.join(hubs, ["band", "key"]), "buckets")
    star = members.filter("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    near = _similar(star.join(regs.withColumnsRenamed({"node": "u", "registers": "ru"}), "u")
                    .join(regs.withColumnsRenamed({"node": "v", "registers": "rv"}), "v"), floor)
    near = materialize(near, "pairs-star")
    texts = _texts(docs, near.select(F.explode(F.array("u", "v")).alias("node")))
    links = materialize(_confirm(near, texts, size, percent), "links-star")
    found = materialize(connected(links), "components-star")
    lists, nodes = _rest(members, found, regs, floor)
    lists = materialize(lists, "candidates-rest")
    if not lists.isEmpty():
        met = nodes.join(lists.select("home", "vblock").distinct(), ["home", "vblock"], "left_semi")
        texts = _texts(docs, lists.select(F.col("u").alias("node")).unionByName(met.select("node")))
        links = materialize(links.unionByName(_confirm_lists(lists, nodes, texts, size, percent)), "links")
        found = materialize(connected(links), "components")
    classes = (reps.select("set_key", "node").join(found, "node", "left")
               .select("set_key", F.coalesce("component", "node").alias("class_component")))
    out = sig.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    out = out.withColumn("component_id", F.coalesce("class_component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _nodes(docs: DataFrame) -> DataFrame | None:
    """``docs`` with __near_id where doc_ids are null or repeated; None where each names one row.  Rows of one doc_id and one text
    keep it; rows without doc_id, or whose doc_id has several texts, get a number from both, beyond 2^62."""
    own = F.xxhash64("text")
    repeated = materialize(
        docs.groupBy("doc_id").agg(F.count("*").alias("n"), (F.min(own) != F.max(own)).alias("several"))
        .filter("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("__near_r"), "several"), "repeated-ids")
    n = repeated.count()
    if not n:
        return None
    known = repeated.filter("__near_r IS NOT NULL AND several").select("__near_r")
    known = F.broadcast(known) if n <= REPEATED_ROWS else known
    number = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    return (docs.join(known, F.col("doc_id") == F.col("__near_r"), "left")
            .withColumn("__near_id", F.when(F.col("doc_id").isNull() | F.col("__near_r").isNotNull(), number)
                        .otherwise(F.col("doc_id").cast("long"))).drop("__near_r"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, columns as they were: that with the smallest doc_id.  Rows without doc_id, and rows whose doc_id
    stands for several texts, are documents of their own and stay only where their component has no other; of equal rows
    one stays (of rows that differ in other columns alone, the first by hash).  Rows without words are linked with nothing, so all stay."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = _nodes(docs)
    if own is None:
        drop = components(docs, size, percent).filter("NOT kept").select("doc_id")
        return docs.join(drop, "doc_id", "left_anti").select(*columns)
    texts = materialize(own.select(F.col("__near_id").alias("doc_id"), "text"), "near-texts")
    kept = materialize(components(texts, size, percent).filter("kept").groupBy(F.col("doc_id").alias("__near_k"))
                       .agg(F.when(F.max("n_shingles") > 0, F.count("*")).otherwise(1).alias("__near_n")), "near-kept")
    rows = own.join(kept, F.col("__near_id") == F.col("__near_k"))
    # few rows have an equal one; they are combined before they are dealt
    equal = (rows.filter("__near_n > 1").groupBy("__near_id")
             .agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("__near_row")).select("__near_row.*"))
    return rows.filter("__near_n = 1").select(*columns).unionByName(equal)
