"""Deterministic sharded WARC writer and reader.

1. Payload digests are computed by Spark; of equal payloads of at least ``MIN_REVISIT`` bytes
   the smallest page_id is the response, the others become revisit records.
2. Records are range-sorted by (url, page_id).  The range bounds are quantiles of a hash sample
   of the keys (SAMPLE keys a shard, chosen by the keys alone), so shards hold the same
   records on every run; a page's shard does not depend on partitions or timing.
3. A task writes its shards one after the other as gzip members, one a record, and rolls to
   a new file once ``ROLL`` compressed bytes are reached.  Headers are regenerated: record id,
   block and payload digests, length.  Memory holds one record.
4. Files are written under temporary names of the attempt (``_temporary/<attempt>``).  Their manifest
   is written by Spark, whose commit keeps the rows of one attempt a task, and so decides
   which temporary files count; a second job renames those.  Both steps can be repeated: a lost
   executor costs its unfinished files only, and the rename skips what is in place.
5. The reader goes by the committed manifest, streams each file and checks length, digests and count.

Archives live in any file system that pyarrow opens from a URI (file, hdfs, s3, gs).

Defined cases: null html: empty payload; null url: ``urn:page:<id>``; null page_id: no id header, read
back as null; repeated rows: a record each, and those of the smallest page_id are all responses;
line breaks in urls are percent-encoded; an empty table gives an empty manifest and no files;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfhourly.llm.common import materialize, new_path

MIN_REVISIT = 100
ROLL = 32 << 20      # compressed bytes a file
SHARD = 32 << 20     # payload bytes a shard
BROADCAST_DIGESTS = 100_000  # about 10 MB
SAMPLE = 32          # sampled keys a shard
DATE = "2024-01-15T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6f1d5b62-5b0c-5c0e-9d51-0c1b7f3a2e10")

MANIFEST = "shard int, roll int, temporary string, name string, records long, bytes long, sha256 string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _own(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"),
                        F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("size"))


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, size, refers_to, revisit per page.  Only digests that occur at least twice
    are joined back; while they are few as a broadcast, so the payloads are not shuffled for it."""
    own = _own(pages).withColumn("digest", F.sha2("html", 256))
    twice = (own.filter(F.col("size") >= MIN_REVISIT).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
             .select(F.col("digest").alias("twin"), "first"))
    twice = materialize(twice, "equal-payloads")
    if twice.count() <= BROADCAST_DIGESTS:
        twice = F.broadcast(twice)
    joined = own.join(twice, (F.col("digest") == F.col("twin")) & (F.col("size") >= MIN_REVISIT), "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return joined.select("page_id", "url", "html", "digest", "size", revisit.alias("revisit"),
                         F.when(revisit, F.col("first")).alias("refers_to"))


def _key():
    """The sort key as one string: url, then page_id in its numeric order."""
    return F.expr("concat(coalesce(url, '\uffff'), '\\0', lpad(cast(cast(coalesce(page_id, 0) as decimal(20, 0)) "
                  "+ 9223372036854775808BD as string), 20, '0'))")


def bounds(keyed: DataFrame, shards: int, rows: int) -> list[str]:
    """Shard bounds: at most ``shards`` - 1 quantiles of a sample chosen by the keys' hashes."""
    if shards <= 1:
        return []
    every = max(1, rows // (SAMPLE * shards))
    sample = sorted(r.key for r in keyed.filter(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("key").collect())
    return sorted({sample[len(sample) * i // shards] for i in range(1, shards)} if sample else set())


def _date_id(digest: str, page_id, seq: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{digest}:{page_id}:{seq}')}>"


def _b32(hex_digest: str) -> str:
    return "sha256:" + base64.b32encode(bytes.fromhex(hex_digest)).decode().rstrip("=")


def encode(page_id, url, html: str, digest: str, refers_to, revisit: bool, seq: int) -> bytes:
    """One record as a gzip member."""
    payload = html.encode("utf-8", "surrogatepass")
    block = b"" if revisit else payload
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _date_id(digest, page_id, seq)),
            ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("Content-Type", "text/html; charset=utf-8"),
            ("WARC-Block-Digest", _b32(hashlib.sha256(block).hexdigest())), ("WARC-Payload-Digest", _b32(digest)),
            ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("X-Refers-To-Page", str(refers_to))]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    raw = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(raw) + member.flush()


def write(pages: DataFrame, out: str, roll: int = ROLL, shard: int = SHARD) -> DataFrame:
    """Write the archives under the folder URI ``out``; returns the committed manifest."""
    spark = pages.sparkSession
    made = records(pages).withColumn("key", _key())
    own = _own(pages)
    total = own.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()[0]
    shards = max(1, -(-(total.bytes or 0) // shard))
    cuts = bounds(own.select(_key().alias("key")), shards, total.n)
    where = F.lit(0) if not cuts else F.pandas_udf(
        lambda k, c=tuple(cuts): pd.Series(_search(c, k)), "int")(F.col("key"))
    # twice as many partitions as shards, so that few hash to the same task
    dealt = (made.withColumn("shard", where).repartition(2 * shards, "shard")
             .sortWithinPartitions("shard", "key", "digest", F.col("revisit")))
    fs.FileSystem.from_uri(out)[0].create_dir(f"{fs.FileSystem.from_uri(out)[1]}/_temporary", recursive=True)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(out)
        attempt = f"{base}/_temporary/{uuid.uuid4().hex}"
        store.create_dir(attempt, recursive=True)
        rows, now = [], None

        def close():
            if now:
                now["f"].close()
                rows.append((now["shard"], now["roll"], now["path"], f"{base}/part-{now['shard']:06d}-{now['roll']:04d}.warc.gz",
                             now["n"], now["bytes"], now["sha"].hexdigest()))
        for pdf in it:
            for r in pdf.itertuples(index=False):
                if now is None or now["shard"] != r.shard or now["bytes"] >= roll:
                    close()
                    next_roll = now["roll"] + 1 if now and now["shard"] == r.shard else 0
                    seq = now["seq"] if now and now["shard"] == r.shard else 0
                    path = f"{attempt}/{r.shard}-{next_roll}"
                    now = {"shard": r.shard, "roll": next_roll, "path": path, "f": store.open_output_stream(path, compression=None),
                           "n": 0, "bytes": 0, "seq": seq, "sha": hashlib.sha256()}
                page_id = None if pd.isna(r.page_id) else int(r.page_id)
                refers = None if pd.isna(r.refers_to) else int(r.refers_to)
                member = encode(page_id, r.url, r.html, r.digest, refers, bool(r.revisit), now["seq"])
                now["f"].write(member)
                now["sha"].update(member)
                now["n"] += 1
                now["seq"] += 1
                now["bytes"] += len(member)
        close()
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in MANIFEST.split(", ")])

    manifest = materialize(dealt.select("shard", "page_id", "url", "html", "digest", "refers_to", "revisit")
                           .mapInPandas(run, MANIFEST), "warc-manifest")
    return commit(manifest, out)


def _search(cuts: tuple[str, ...], keys: pd.Series) -> list[int]:
    from bisect import bisect_right
    coded = [c.encode("utf-8") for c in cuts]  # Spark orders strings by their bytes
    return [bisect_right(coded, k.encode("utf-8", "surrogatepass")) for k in keys]


def commit(manifest: DataFrame, out: str) -> DataFrame:
    """Give the manifest's files their names; safe to repeat."""
    def rename(it):
        store = fs.FileSystem.from_uri(out)[0]
        for pdf in it:
            for temporary, name, size in zip(pdf["temporary"], pdf["name"], pdf["bytes"], strict=True):
                there = store.get_file_info(name)
                if there.type != fs.FileType.File or there.size != size:
                    store.move(temporary, name)
            yield pdf
    return materialize(manifest.mapInPandas(rename, MANIFEST), "warc-committed")


def _members(f, piece: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    left = f.read(piece)
    while left:
        out, member = [], zlib.decompressobj(31)
        while not member.eof:
            if not left:
                raise ValueError("an archive ends inside a record")
            out.append(member.decompress(left))
            left = member.unused_data or (b"" if member.eof else f.read(piece))
        yield b"".join(out)
        left = left or f.read(piece)


def decode(raw: bytes) -> tuple:
    """One record as a row of READ; raises if lengths or digests do not hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    field = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(field["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or _b32(hashlib.sha256(block).hexdigest()) != field["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {field.get('WARC-Record-ID')}")
    coded = field["WARC-Payload-Digest"].removeprefix("sha256:")
    digest = base64.b32decode(coded + "=" * (-len(coded) % 8)).hex()
    revisit = field["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha256(block).hexdigest() != digest:
        raise ValueError(f"damaged payload {field['WARC-Record-ID']}")
    page = field.get("X-Page-Id")
    return (None if page is None else int(page), int(field["X-Payload-Length"]), digest, "revisit" if revisit else "response",
            int(field["X-Refers-To-Page"]) if revisit else None, field["WARC-Target-URI"])


def read(manifest: DataFrame, out: str) -> DataFrame:
    """The records of the committed archives, a few thousand at a time."""
    names = [c.split()[0] for c in READ.split(", ")]

    def run(it):
        store = fs.FileSystem.from_uri(out)[0]
        for pdf in it:
            for name, records_ in zip(pdf["name"], pdf["records"], strict=True):
                rows, n = [], 0
                with store.open_input_stream(name, compression=None) as f:
                    for raw in _members(f):
                        rows.append(decode(raw))
                        n += 1
                        if len(rows) == 4096:
                            yield _frame(rows, names)
                            rows = []
                if n != records_:
                    raise ValueError(f"{name} holds {n} records, the manifest says {records_}")
                yield _frame(rows, names)
    files = manifest.count()
    return manifest.repartition(max(1, files), "name").mapInPandas(run, READ)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    out = new_path(spark, "warc")
    if "://" not in out:
        out = ("" if out.startswith("file:") else "file://") + out
    return read(write(pages, out), out)
