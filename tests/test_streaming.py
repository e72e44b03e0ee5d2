"""Stream == batch: availableNow micro-batches merge to the same hot table as
one batch over the same landed files; quarantined payloads stay out."""

import copy
import os
import time

from halfhourly.operators import lake
from halfhourly.schemas import CARBON_SCHEMA, PRICE_SCHEMA
from halfhourly.sources import payloads
from halfhourly.streaming import ingest
from payload_fixtures import NATIONAL, NATIONAL_NULL_ACTUAL, dumps, prices, regional


def _land(root):
    os.makedirs(os.path.join(root, "national"))
    os.makedirs(os.path.join(root, "regional"))
    os.makedirs(os.path.join(root, "prices", "E-1R-AGILE-24-10-01-C"))
    realised = copy.deepcopy(NATIONAL_NULL_ACTUAL)
    realised["data"][0]["intensity"]["actual"] = 97
    bad = copy.deepcopy(NATIONAL)
    bad["data"][0]["intensity"]["unexpected"] = 1
    docs = [("national", NATIONAL), ("national", NATIONAL_NULL_ACTUAL), ("national", realised),
            ("national", bad), ("regional", regional()), ("regional", regional())]
    for i, (src, d) in enumerate(docs):
        with open(os.path.join(root, src, f"{i:03d}.json"), "w") as f:
            f.write(dumps(d))
        time.sleep(0.02)
    with open(os.path.join(root, "prices", "E-1R-AGILE-24-10-01-C", "p.json"), "w") as f:
        f.write(dumps(prices(4)))


def _rows(spark, path, schema):
    return sorted(tuple(r) for r in lake.read_table(spark, path, schema).collect())


def test_stream_equals_batch(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    _land(land)
    dim = payloads.region_seed(spark)
    s_state, b_state = os.path.join(tmpdir_path, "s_state"), os.path.join(tmpdir_path, "b_state")
    qs = ingest.ingest_stream(spark, land, s_state, os.path.join(tmpdir_path, "ck"),
                              os.path.join(tmpdir_path, "s_quar"), dim=dim, max_files_per_trigger=1)
    for q in qs:
        q.awaitTermination(180)
    written = {table: ingest.ingest_batch(spark, land, b_state, os.path.join(tmpdir_path, "b_quar"), table,
                                          dim=dim)["rows_written"]
               for table in ("carbon_intensity", "agile_price")}
    assert written == {"carbon_intensity": 3 + 2 * 14, "agile_price": 4}
    s_carbon = _rows(spark, os.path.join(s_state, "carbon_intensity"), CARBON_SCHEMA)
    b_carbon = _rows(spark, os.path.join(b_state, "carbon_intensity"), CARBON_SCHEMA)
    strip = lambda rows: [r[:6] for r in rows]  # noqa: E731  (ingested_at differs by design)
    assert strip(s_carbon) == strip(b_carbon)
    assert len(s_carbon) == 2 + 14
    national = [r for r in s_carbon if r[0] == 0]
    assert [r[4] for r in national] == [151, 97]          # second period realised later
    quar = spark.read.parquet(os.path.join(tmpdir_path, "s_quar", "carbon_intensity"))
    assert [r.source for r in quar.collect()] == ["national"]
    assert len(_rows(spark, os.path.join(s_state, "agile_price"), PRICE_SCHEMA)) == 4
    # rerun of the same stream is a no-op (checkpointed, idempotent)
    qs = ingest.ingest_stream(spark, land, s_state, os.path.join(tmpdir_path, "ck"),
                              os.path.join(tmpdir_path, "s_quar"), dim=dim, max_files_per_trigger=1)
    for q in qs:
        q.awaitTermination(180)
    assert _rows(spark, os.path.join(s_state, "carbon_intensity"), CARBON_SCHEMA) == s_carbon


def test_bad_documents_are_set_aside_and_replays_do_not_double(spark, tmpdir_path):
    land, st, qu = (os.path.join(tmpdir_path, x) for x in ("prices/landing", "state", "quar"))
    for code in ("E-1R-AGILE-24-10-01-C", "E-1R-AGILE-24-10-01-Z"):
        os.makedirs(os.path.join(land, "prices", code))
        with open(os.path.join(land, "prices", code, "a.json"), "w") as f:
            f.write(dumps(prices(4)))
    for _ in range(2):
        ingest.ingest_batch(spark, land, st, qu, "agile_price", payloads.region_seed(spark))
    bad = spark.read.parquet(os.path.join(qu, "agile_price")).collect()
    assert [r.violations for r in bad] == [["unknown tariff code"]]
    assert len(_rows(spark, os.path.join(st, "agile_price"), PRICE_SCHEMA)) == 4


def test_batch_with_every_bad_document_finishes(spark, tmpdir_path):
    """Bad documents of each sort beside a good one: the stream goes on, the good rows are stored, nothing is lost."""
    land, st, qu = (os.path.join(tmpdir_path, x) for x in ("landing", "state", "quar"))
    os.makedirs(os.path.join(land, "national"))
    bad = []
    for path, value in [(("from",), "2026-02-31T14:30Z"), (("from",), "2026-05-21T25:61Z"), (("to",), "2027-07-11T15:00"),
                        (("intensity", "forecast"), 99999999999), (("intensity", "forecast"), "x"), (("intensity", "index"), "?")]:
        doc = copy.deepcopy(NATIONAL)
        at = doc["data"][0]
        for k in path[:-1]:
            at = at[k]
        at[path[-1]] = value
        bad.append(doc)
    for i, d in enumerate([NATIONAL, *bad]):
        with open(os.path.join(land, "national", f"{i}.json"), "w") as f:
            f.write(dumps(d))
    for q in ingest.ingest_stream(spark, land, st, os.path.join(tmpdir_path, "ck"), qu, tables=("carbon_intensity",)):
        q.awaitTermination(120)
        assert q.exception() is None
    assert len(_rows(spark, os.path.join(st, "carbon_intensity"), CARBON_SCHEMA)) == 1
    assert spark.read.parquet(os.path.join(qu, "carbon_intensity")).count() == len(bad)


def test_jobs_end_to_end(spark, tmpdir_path):
    """ingest -> build -> archive -> expire -> query, through the job entry points."""
    from halfhourly import jobs
    land = os.path.join(tmpdir_path, "landing")
    _land(land)
    st, ck, qu = (os.path.join(tmpdir_path, d) for d in ("state", "ck", "quar"))
    jobs.main(["ingest", "--landing", land, "--state", st, "--checkpoint", ck, "--quarantine", qu])
    out = jobs.main(["build", "--state", st, "--out", os.path.join(tmpdir_path, "marts"),
                     "--as-of", "2027-07-11T10:00:00"])
    assert out["marts"] == ["mart_best_slots_24h", "mart_generation_mix_long", "mart_half_hourly"]
    arch = jobs.main(["archive", "--state", st, "--lake", os.path.join(tmpdir_path, "lake"),
                      "--as-of", "2027-07-12T02:00:00"])
    assert arch["carbon_intensity/2027-07-11"] == 16 and arch["agile_price/2027-07-11"] == 4
    q = jobs.main(["query", "--lake", os.path.join(tmpdir_path, "lake"),
                   "--sql", "SELECT count(*) AS n FROM carbon_intensity WHERE region_id = ${R}",
                   "--param", "R=0"])
    assert q["rows_shown"] == 1
    monthly = jobs.main(["query", "--lake", os.path.join(tmpdir_path, "lake"), "--as-of", "2027-08-01T00:00:00"])
    assert monthly["rows_shown"] == 1
    gone = jobs.main(["expire", "--state", st, "--as-of", "2027-11-01T00:00:00", "--days", "90"])
    assert gone["carbon_intensity"] == 1


def test_processing_time_trigger(spark, tmpdir_path):
    """The long-running form (processing-time trigger) ingests what lands."""
    land = os.path.join(tmpdir_path, "landing")
    _land(land)
    st = os.path.join(tmpdir_path, "state")
    qs = ingest.ingest_stream(spark, land, st, os.path.join(tmpdir_path, "ck"), os.path.join(tmpdir_path, "q"),
                              tables=("carbon_intensity",), available_now=False, processing_time="1 second")
    try:
        for q in qs:
            q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    assert len(_rows(spark, os.path.join(st, "carbon_intensity"), CARBON_SCHEMA)) == 2 + 14


def test_quarantine_outlives_a_new_checkpoint_folder(spark, tmpdir_path):
    """A new checkpoint numbers its batches from 0 again; what the first query set aside stays."""
    st, qu = (os.path.join(tmpdir_path, x) for x in ("state", "quar"))
    for k in range(2):
        land = os.path.join(tmpdir_path, f"landing{k}")
        os.makedirs(os.path.join(land, "national"))
        with open(os.path.join(land, "national", f"bad{k}.json"), "w") as f:
            f.write("not json")
        for _ in range(2):  # and a restart of either query adds nothing
            for q in ingest.ingest_stream(spark, land, st, os.path.join(tmpdir_path, f"ck{k}"), qu, tables=["carbon_intensity"]):
                q.awaitTermination(180)
                assert q.exception() is None
    kept = spark.read.parquet(os.path.join(qu, "carbon_intensity"))
    assert sorted(r.file.rsplit("/", 1)[1] for r in kept.collect()) == ["bad0.json", "bad1.json"]
