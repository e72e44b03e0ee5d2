"""Operators 11-13 against brute force, the library's own ids and a plain tree, on driver tables and awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from halfhourly.llm import catalog, merkle, packing, runs
from halfhourly.llm.common import space_words, table

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows(spark):
    return [r.asDict() for r in table(spark, SF, "documents").collect()]


AWKWARD = [(1, "a b " * 40), (2, "a b " * 40), (3, ""), (4, None), (5, " ".join(f"w{i % 4999}" for i in range(30_000))), (6, "x " * 5),
           (7, "x " * 6), (8, " \n\t "), (None, "a a a a a a a"), (None, None), (1, "other"), (9, "<|endoftext|> <|endoftext|>x"),
           (10, "あ\U0001f600 é" * 900), (1, "a b " * 40), (11, "1 2 3 4 5 " * 300)]


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame([(d, t, None if k % 4 == 0 else f"l{k % 3}", None if k % 5 == 0 else "s", None if t is None else len(t))
                                for k, (d, t) in enumerate(AWKWARD)], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("row", "length", "tree", "index", "digest", "part", "number", "free", "words", "runs", "block"):
        df = df.withColumn(c, F.lit(c))
    return df


# -- 11 ---------------------------------------------------------------------------------------------------------------

def brute_runs(words):
    """Every stretch that repeats with period q and cannot grow, if no smaller period fits it."""
    found = set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            e = i + q
            if i > s and e - s >= max(6, 4 * q):
                part = words[s:e]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.add((s, e - s, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_sequences():
    rng = random.Random(5)
    for _ in range(600):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, rng.choice([8, 40, 160])), rng.choice([1, 2, 3, 9])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 4))
                w = w[:a] + [w[a + i % p] for i in range(n - a)]
            texts.append(w + w[len(w) // 2:] * rng.choice([0, 0, 2, 5]))
        sizes = np.array([len(t) for t in texts], np.int64)
        got = runs.find_runs(np.array(sum(texts, []), np.int64), sizes).tolist()
        begin = np.cumsum(sizes) - sizes
        assert got == [[b + s, b + s + n, q] for t, b in zip(texts, begin.tolist()) for s, n, q in brute_runs(t)]


def test_grammar_expands_to_the_text_and_repeats_no_pair():
    rng = random.Random(6)
    words = np.array([rng.randrange(4) for _ in range(3000)] * 2, np.int64)
    doc = np.zeros(len(words), np.int64)
    g = runs.re_pair(words, doc)
    width = dict(zip(g.begin.tolist(), (g.end - g.begin).tolist()))
    for r, at in zip(g.rule.tolist(), g.at.tolist()):  # an occurrence spells what the first one spells
        n = int(g.end[r] - g.begin[r])
        assert np.array_equal(words[at:at + n], words[g.begin[r]:g.begin[r] + n])
    assert len(g.start) + len(g.at) == len(words) and width
    ends = np.r_[g.start[1:], len(words)]
    symbols = [tuple(words[a:b]) for a, b in zip(g.start, ends)]
    pairs = list(zip(symbols, symbols[1:]))
    assert all(pairs.count(p) <= 2 for p in set(pairs))  # twice only where the pair overlaps itself or came up in the last round


def runs_row(doc_id, text):
    words = catalog.planted_period(doc_id, space_words(text or ""))
    found = brute_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    keep = [i for i in range(len(words)) if not any(s + q <= i < s + n for s, n, q in found)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(words[i] for i in keep)))


def test_op11_equals_brute_force(spark, rows):
    got = {r.doc_id: tuple(r) for r in catalog.op11_periodic_runs(spark, SF).collect()}
    short = [r for r in rows if len(r["text"] or "") < 8000]
    assert len(got) == len(rows) and len(short) > 150
    assert {d: got[d] for d in (r["doc_id"] for r in short)} == {r["doc_id"]: runs_row(r["doc_id"], r["text"]) for r in short}
    assert sum(r[1] for r in got.values()) > 0


def test_runs_of_awkward_rows(awkward):
    got = runs.collapse(awkward).collect()
    short = [(d, t) for d, t in AWKWARD if len(t or "") < 5000]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((d, [tuple(x) for x in brute_runs(space_words(t or ""))]) for d, t in short), key=key)
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs]) for r in got if r.doc_id != 5), key=key) == want
    assert len(next(r for r in got if r.doc_id == 5).runs) == 1
    assert [r.collapsed for r in got if r.doc_id == 7] == ["x"] and [r.collapsed for r in got if r.doc_id == 6] == ["x x x x x"]
    assert runs.collapse(awkward.limit(0)).collect() == []


# -- 12 ---------------------------------------------------------------------------------------------------------------

def check_packing(found, texts, capacity):
    """Pieces are the library's ids, cut as asked, and lie in their sequences without a gap."""
    library = Tokenizer.from_file(PATH)
    by_doc: dict = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cut = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in cut] == list(range(len(cut))) and sum(r.length for r in cut) == len(ids)
        assert len(cut) == 1 if len(ids) <= capacity else all(r.length == capacity for r in cut[1:])
        for r in cut:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    return check_layout(found, capacity)


def check_layout(found, capacity):
    bins: dict = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_op12_packs_the_library_ids(spark, rows):
    found = catalog.op12_best_fit_packing(spark, SF).collect()
    bins = check_packing(found, [(r["doc_id"], r["text"]) for r in rows], packing.CAPACITY)
    assert bins <= 1.01 * sum(r.length for r in found) / packing.CAPACITY + 1


def test_ids_are_the_library_ids():
    library, rng = Tokenizer.from_file(PATH), random.Random(4)
    parts = ["a", "b", " ", "  ", "\n", "\t", " \n", " ", "　", "\x1c", "\x85", "'s", "'ll", "12", "!", "<|endoftext|>", "é", "漢",
             "\U0001f600", "​", "\r\n"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(packing.encode(text, PATH), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    for text in (" " * 1_000_000, "a" * 300_000, "\n" * 300_000 + "x"):
        assert np.frombuffer(packing.encode(text, PATH), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_packing_of_awkward_rows(awkward):
    found = packing.pack(packing.pieces(awkward, PATH, 64, with_ids=True), 64).collect()
    check_layout(found, 64)
    assert sum(r.length for r in found) == sum(
        len(Tokenizer.from_file(PATH).encode(t or "", add_special_tokens=False).ids) + 1 for _, t in AWKWARD)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found)
    assert packing.pack(packing.pieces(awkward.limit(0), PATH)).collect() == []


@pytest.mark.parametrize("capacity,draw", [
    (100, lambda rng: rng.randint(1, 100)), (100, lambda rng: rng.randint(34, 66)), (100, lambda rng: 51), (100, lambda rng: rng.randint(1, 9)),
    (97, lambda rng: rng.choice([97, 48, 49, 1])), (2048, lambda rng: rng.randint(500, 1100)), (1, lambda rng: 1)])
def test_packing_is_close_to_best_fit(spark, capacity, draw):
    rng = random.Random(capacity)
    sizes = [draw(rng) for _ in range(1500)]
    found = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "row long, length long"), capacity).collect()
    assert sorted(r.length for r in found) == sorted(sizes)
    free: list[int] = []  # best fit decreasing, one by one
    for s in sorted(sizes, reverse=True):
        best = min((f for f in free if f >= s), default=None)
        free.remove(best) if best is not None else None
        free.append((capacity if best is None else best) - s)
    assert check_layout(found, capacity) <= 1.01 * len(free) + 2


# -- 13 ---------------------------------------------------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """The root and each leaf's siblings, level by level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, p in enumerate(place):
            first = p // 8 * 8
            paths[leaf].append((nodes[first:p], nodes[p + 1:first + 8]))
            place[leaf] = p // 8
        nodes = [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain_manifest(rows):
    langs: dict = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        held = sorted(langs[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
        trees[lang] = held, *plain_tree([plain_leaf(r, r["text"]) for r in held])
    root, above = plain_tree([trees[lang][1] for lang in order])
    out = []
    for k, lang in enumerate(order):
        held, subroot, paths = trees[lang]
        for r, path in zip(held, paths):
            path = path + above[k]
            hit = r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            folded = plain_leaf(r, r["text"].encode().lower().decode() if hit else r["text"])
            for left, right in path:
                folded = H(*left, folded, *right)
            out.append((r["doc_id"], plain_leaf(r, r["text"]), subroot, root, H(*(s for a, b in path for s in a + b)), folded, folded == root))
    return sorted(out, key=repr)


def test_op13_equals_a_plain_tree(spark, rows):
    got = sorted((tuple(r) for r in catalog.op13_merkle_manifest(spark, SF).collect()), key=repr)
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2])
def test_rounds_of_any_height(spark, awkward, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    many = spark.range(700).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"),
                                   F.when(F.col("id") % 3 > 0, F.lit("x")).alias("lang"), F.lit("S").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    for df in (many, awkward):
        got = sorted((tuple(r) for r in merkle.manifest(df, merkle.tampered()).collect()), key=repr)
        assert got == plain_manifest([r.asDict() for r in df.collect()])


def test_manifest_of_empty_and_single_tables(awkward):
    assert merkle.manifest(awkward.limit(0), merkle.tampered()).collect() == []
    one = merkle.manifest(awkward.filter("doc_id = 7")).collect()
    assert [(r.leaf == r.subroot == r.root, r.proof_sha256, r.verified) for r in one] == [(True, H(""), True)]


# -- 7: a doc_id with several texts -----------------------------------------------------------------------------------

def test_passages_of_a_doc_id_with_several_texts(spark):
    """Seeds and stretches come from one text of the doc_id, the first by hash."""
    from halfhourly.llm import chaining
    rng = random.Random(9)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    long, short, copy = " ".join(words), " ".join(words[:90]), " ".join(words[150:300])
    df = spark.createDataFrame([(1, long), (1, short), (2, copy), (3, " ".join(words[20:85]))], "doc_id long, text string")
    first = df.filter("doc_id = 1").orderBy(F.xxhash64("text")).first().text
    got = {r.doc_id: r.repeated_words for r in chaining.passages(df).collect()}
    alone = spark.createDataFrame([(1, first), (2, copy), (3, " ".join(words[20:85]))], "doc_id long, text string")
    assert got == {r.doc_id: r.repeated_words for r in chaining.passages(alone).collect()}
    assert got[2] == (150 if first == long else 0) and got[3] >= 55
