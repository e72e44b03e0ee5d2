"""Every operator and stage on awkward tables: nulls in any column, empty and very long texts,
ties, repeated rows, clashing extra columns, empty tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from halfhourly.llm import chaining, minhash, mixing, pii, quality, quotes, tokens, toxicity, warc, winnow
from halfhourly.llm.common import new_path

PROSE = "the quick brown fox jumps over the lazy dog while rain falls on quiet hills and rivers run down to the sea "
LONG = " ".join(f"word{i % 9973}x{i % 7}" for i in range(60_000))
EXTRA = ["node", "key", "k", "u", "v", "size", "rank", "copies", "found", "words", "text_key", "seed", "__pii_k0"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(1, PROSE * 4), (2, PROSE * 4), (3, ""), (4, None), (5, LONG), (6, "one"), (7, "a b"), (8, " \n\t "),
             (None, PROSE * 4), (None, None), (9, "x@y.org 1.2.3.4"), (10, "あ\U0001f600 caf\xe9 " * 30), (2, PROSE * 4)]
    rows = [(i, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in EXTRA:
        df = df.withColumn(c, F.lit(c))
    return df


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, "Rain falls on quiet hills, and rivers run down to the sea"), (2, None), (3, ""), (4, "one"), (None, "a b"),
         (1, "Rain falls on quiet hills, and rivers run down to the sea")], "item_id long, text string").withColumn("doc_id", F.lit(7))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, None, None), (None, 0, 1), (5, 1, 0), (77, 1, 1)],
                                 "doc_id long, quality int, toxic int").withColumn("text", F.lit("no"))


def _operators(docs, benchmark, labels):
    import public_tokenizers
    return {
        "mix": mixing.mix(docs), "near": minhash.components(docs, 2, 80), "quality": quality.score(docs),
        "personal": pii.find(docs), "winnow": winnow.report(docs, benchmark), "passages": chaining.passages(docs),
        "toxicity": toxicity.score(docs, labels), "tokens": tokens.counts(docs, public_tokenizers.path("byte_bpe_50k.json")),
    }


def test_operators_on_awkward_rows(spark, docs, benchmark, labels):
    n = docs.count()
    got = {name: df.collect() for name, df in _operators(docs, benchmark, labels).items()}
    assert {name: len(rows) for name, rows in got.items()} == dict.fromkeys(got, n)
    near = {(r.doc_id, r.n_shingles > 0): (r.component_id, r.kept) for r in got["near"]}
    assert near[1, True] == (1, True) and near[2, True] == (1, False) and near[None, True] == (1, False)
    assert near[4, False] == (4, True) and near[8, False] == (8, True) and near[None, False] == (None, False)
    assert {r.doc_id: r.n_shingles for r in got["near"]}[6] == 1
    by = {r.doc_id: r for r in got["winnow"]}
    assert (by[1].n_items, by[6].n_hit, by[6].n_items, by[7].n_hit, by[7].n_items) == (1, 1, 1, 2, 0)
    assert by[7].contaminated and not by[5].contaminated and by[4].n_words == 0
    assert by[1].n_hit == 4 * 12 and by[1].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert {r.doc_id: r.spans for r in got["personal"]}[9] == "email:0:7,ip:8:15"
    quality_of = {r.doc_id: r for r in got["quality"]}
    assert quality_of[4].n_words == 0 and not quality_of[4].kept and quality_of[5].n_words == 60_000
    assert all(0 <= r.score <= 1 for r in got["toxicity"])
    assert {r.doc_id: r.n_tokens for r in got["tokens"]}[4] == 0
    passages = {r.doc_id: r.repeated_words for r in got["passages"]}
    assert passages[5] == passages[4] == passages[None] == 0
    taken = [r for r in got["mix"] if r.size]
    assert all(r.taken <= 3 * r.size for r in taken) and all(r.taken == 0 for r in got["mix"] if not r.size)


def test_operators_on_empty_tables(spark, docs, benchmark, labels):
    for name, df in _operators(docs.limit(0), benchmark, labels).items():
        assert df.count() == 0, name
    assert winnow.report(docs, benchmark.limit(0)).filter("contaminated").count() == 0
    assert toxicity.score(docs, labels.limit(0)).agg(F.max("score")).collect()[0][0] < 1e-3
    assert quotes.link(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_warc_on_awkward_rows(spark):
    big = "<p>" + "x" * 200
    rows = [(3, "http://a/\r\nX: y", big), (1, None, big), (2, "http://b", None), (4, "", "tiny"), (5, "z", "tiny"),
            (None, "n", big), (1, None, big), (6, "ü", "é" * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("key", F.lit(2))
    out = warc.round_trip(spark, pages).collect()
    kinds = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in out)
    n = len(big)
    assert kinds == [(0, n, "revisit", 1), (1, n, "response", 0), (1, n, "response", 0), (2, 0, "response", 0),
                     (3, n, "revisit", 1), (4, 4, "response", 0), (5, 4, "response", 0), (6, 120, "response", 0)]
    assert {r.payload_digest for r in out if r.payload_bytes == n} == {hashlib.sha256(big.encode()).hexdigest()}
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_warc_is_deterministic_and_commit_repeats(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    names = []
    for k in (1, 5):
        out = new_path(spark, "warc-test")
        manifest = warc.write(pages.repartition(k), out, roll=10_000, shard=100_000)
        warc.commit(manifest, out)  # a second commit changes nothing
        rows = manifest.select("shard", "roll", "records", "bytes", "sha256").orderBy("shard", "roll").collect()
        assert warc.read(manifest, out).count() == pages.count()
        names.append(rows)
    assert names[0] == names[1] and len(names[0]) > 2


def test_stages_keep_columns(spark, docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, "Rain falls on quiet hills, and rivers run down to the sea")], "item_id long, text string") \
        .write.parquet(f"{folder}/benchmark.parquet")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, folder)
            assert out.columns == docs.columns, name
            assert out.count() <= table.count()
        last = corpus_pipeline.STAGES[-1][1](spark, table, folder)
        assert set(last.columns) == set(docs.columns) | {"slice_words"}
        last.count()
    assert corpus_pipeline.near_duplicates(spark, docs, folder).filter("doc_id = 1").count() == 1
    assert corpus_pipeline.near_duplicates(spark, docs, folder).filter("doc_id = 2").count() == 0
    clean = corpus_pipeline.decontaminate(spark, docs, folder)
    assert clean.filter("doc_id IN (1, 2)").count() == 0 and clean.filter("doc_id = 5").count() == 1
    red = corpus_pipeline.personal_data(spark, docs, folder).filter("doc_id = 9").collect()[0]
    assert red.text == "[EMAIL] [IP]" and red.n_chars == 12
