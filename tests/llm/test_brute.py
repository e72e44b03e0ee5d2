"""Registered operators against brute force, the library or DuckDB on the small driver tables."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from halfhourly.llm import catalog, chaining, minhash, mixing, quality, quotes, tokens, toxicity
from halfhourly.llm.common import ascii_lower, sorted_groups, space_words

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def test_every_operator_is_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(n) for n in range(1, 14)}
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(catalog.oracle_sql()[name])
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == \
        sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


def test_mixing_totals_and_reruns(spark, duck):
    rows = QUERIES["op2_mix_sources"](spark, SF).collect()
    source = dict(duck.sql("SELECT doc_id, source FROM documents").fetchall())
    total = sum(r.size for r in rows)
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in rows:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size + r.slice_words
        taken[source[r.doc_id]] += r.taken
        size[source[r.doc_id]] += r.size
        target[source[r.doc_id]] = r.target
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(target))}
    share, capped = {}, set()
    while True:  # water filling by brute force
        left = total - sum(3 * size[s] for s in capped)
        open_ = sum(weights[s] for s in target if s not in capped)
        share = {s: 3 * size[s] if s in capped else left * weights[s] / open_ for s in target}
        over = {s for s in target if share[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    for s in target:
        assert abs(target[s] - share[s]) < 1e-6 and abs(taken[s] - target[s]) <= 1
    again = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet").repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def test_pivot_keeps_expectations(spark):
    """Over many blocks of equal units the share taken is the probability, and words are conserved."""
    units = spark.range(4000).selectExpr("0L AS rank", "id AS doc_id", "1L + id % 7 AS size", "0.3D AS p")
    blocks = spark.createDataFrame([(0, 40)], "rank long, k long")
    out = mixing.pivot(units, blocks).collect()
    words = sum(1 + i % 7 for i in range(4000)) * 0.3
    assert len(out) == 4000 and abs(sum(r.up * r.size + r.slice_words for r in out) - words) < 1
    for n in range(1, 8):
        share = np.mean([r.up for r in out if r.size == n])
        assert 0.22 < share < 0.38


def test_near_duplicate_estimates():
    rng = np.random.default_rng(1)
    for n in (5, 40, 300, 4000):
        for _ in range(5):
            both = rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
            extra = rng.integers(0, 1 << 63, max(1, n // 8)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            a = np.unique(both)
            b = np.unique(np.concatenate([both, extra]))
            j = len(a) / len(b)
            e = minhash.estimate((minhash.registers(a) == minhash.registers(b)).mean())
            assert abs(float(e) - j) < 0.2


def test_large_near_group_with_outliers(spark):
    """A chain of near copies and a far relative: components equal brute force."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 500, 120)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.integers(0, 120, int(rng.integers(0, 16))):
            words[at] = f"x{rng.integers(0, 9999)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in
           minhash.components(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()}
    sets = {i: set(zip(t.split(), t.split()[1:])) for i, t in rows}
    label = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                n = len(sets[i] & sets[j])
                if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                    label[i] = label[j] = min(label[i], label[j])
        if all(label[i] == label[label[i]] for i in label):
            break
    assert got == label


def test_token_counts_are_the_librarys(spark, texts):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = QUERIES["op5_token_counts"](spark, SF).collect()
    for r in rows:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 1024)
    rng = np.random.default_rng(2)
    parts = ["'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "\t", "a", "Z", "é", "1", "²", "!", "--", "\U0001f600", " ",
             "the", " don", "<|endoftext|>", "\x1c", "\x85", "中", "́"]
    odd = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(3000)] + ["a" * 3000, " " * 999, "=-" * 700]
    want = [len(e.ids) for e in library.encode_batch(odd, add_special_tokens=False)]
    assert tokens.count_texts(odd, path).tolist() == want


def test_scan_composes_maps():
    rng = np.random.default_rng(3)
    maps = rng.integers(0, 8, (37, 8)).astype(np.uint8)
    state, want = np.arange(8), []
    for m in maps:
        state = m[state]
        want.append(state)
    assert (tokens.scan(maps) == np.array(want)).all()


def test_personal_data_base(spark, texts):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, v):
        digits = re.sub("[^0-9]", "", v)
        if kind == "ip":
            return all(int(x) <= 255 for x in v.split("."))
        if kind == "card":
            return 14 <= len(digits) <= 19 and sum(
                sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15
    for r in QUERIES["op6_personal_data"](spark, SF).collect():
        spans = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(patterns.items())
                       for m in re.finditer(p, texts[r.doc_id]) if good(kind, m[0]))
        line = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in patterns]


def test_bootstrapping_discovers_unseen_identifiers(spark):
    from halfhourly.llm import pii
    rows = [(i, f"please call me at +1 555 200 30{i:02d} soon") for i in range(6)]
    rows += [(50, "please call me at 555-0199, ok"), (51, "we met at 555-0199 main street"), (52, "call me at noon12345")]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == "phone:18:26" and got[51] == "" and got[52] == "" and got[0] == "phone:18:33"


def test_passages_bracketed_by_exact_runs(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    words = {r.doc_id: chaining._WORD.findall(ascii_lower(r.text or "")) for r in docs.select("doc_id", "text").collect()}

    def sharing(length):
        seen = collections.defaultdict(set)
        for i, w in words.items():
            for k in range(len(w) - length + 1):
                seen[tuple(w[k:k + length])].add(i)
        return set().union(*(v for v in seen.values() if len(v) > 1))
    got = {r.doc_id for r in chaining.passages(docs).collect() if r.repeated_words}
    assert sharing(51) <= got <= sharing(chaining.K)


def test_chain_is_best(spark):
    """The Fenwick chain scores what the quadratic recurrence scores."""
    rng = np.random.default_rng(6)
    for _ in range(20):
        x, y = np.sort(rng.integers(0, 60, 25)), rng.integers(0, 60, 25)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]

        def gain(path):
            return sum(chaining.K for _ in path) - sum(
                chaining.GAP * (x[b] + y[b] - x[a] - y[a] - 2 * chaining.K) for a, b in zip(path, path[1:], strict=False))
        best = [0.0] * 25
        for j in range(25):
            best[j] = chaining.K + max([0] + [best[i] + 2 * chaining.GAP * chaining.K - chaining.GAP * (x[j] + y[j] - x[i] - y[i])
                                              for i in range(j) if x[i] < x[j] and y[i] < y[j]])
        assert abs(gain(chaining.chain(x, y)[0].tolist()) - max(best)) < 1e-9


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    score = np.array([r.score for r in rows])
    toxic = np.array([r.toxic == 1 for r in rows])
    rank = score.argsort().argsort() + 1
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.97 and ((score >= 0.5) == toxic).mean() > 0.95
    assert all(r.score >= 0.5 for r in rows if r.offending)


def test_quality_counts(spark, texts):
    for r in QUERIES["op10_quality_rules"](spark, SF).collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        repeat = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat), failed)
        assert r.kept == (not failed and (r.char_distance or 0) <= quality.CHAR_LIMIT and (r.word_distance or 0) <= quality.WORD_LIMIT)


def test_js_distance():
    assert quality.js_distance(np.array([1.0, 0]), np.array([0, 3.0])) == pytest.approx(1)
    assert quality.js_distance(np.array([2.0, 2]), np.array([5.0, 5])) == 0
    assert quality.js_distance(np.zeros(2), np.ones(2)) == 0


def test_quotes_link_and_order(spark):
    rows = [(1, 0, "u", "The cat sat. On a mat!"), (1, 1, "a", "Dogs bark loud. Yes"),
            (1, 2, "u", "On Monday X wrote:\n> The cat\n> sat.\n>> older one\nI agree with that."), (1, 3, "u", "fresh"),
            (1, 5, "a", "> Dogs bark loud.\nno"), (2, 0, "u", "> I agree with that\nWhat?"), (None, None, None, None)]
    out = [(r.conv_id, r.turn, r.text, r.parent_conv, r.parent_turn, r.depth) for r in quotes.link(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
    assert out == [
        (None, None, "", None, None, 0), (1, 0, "The cat sat. On a mat!", None, None, 0), (1, 1, "Dogs bark loud. Yes", 1, 0, 1),
        (1, 2, "I agree with that.", 1, 0, 1), (1, 3, "fresh", 1, 2, 2), (1, 5, "no", 1, 1, 2), (2, 0, "What?", 1, 2, 2)]


def test_space_words_and_groups():
    import pandas as pd
    text = "a b  c\td\x0be\x1cf\n"
    assert space_words(text) == re.findall(r"[^\x20\x09-\x0D]+", text)
    frames = [pd.DataFrame({"k": k, "v": range(len(k))}) for k in ([1, 1, 2], [2], [2, 3, 3])]
    assert [(g["k"][0], len(g["v"])) for g in sorted_groups(iter(frames), ["k"])] == [(1, 2), (2, 3), (3, 2)]


def test_pipeline_stages(spark, texts):
    out = E.queries()["pipeline"](spark, SF).collect()
    assert out and {r.doc_id for r in out} <= set(texts)
    failed = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, SF).collect() if not r.kept}
    dirty = {r.doc_id for r in QUERIES["op8_decontaminate"](spark, SF).collect() if r.contaminated}
    assert not {r.doc_id for r in out} & (failed | dirty)
    assert all(r.copies or r.slice_words for r in out) and not any("@mail" in r.text for r in out)
