"""Deterministic sharded WARC writer and reader.

Writing: records are range-sorted by key into shards whose borders follow
from the data alone, each shard is streamed into gzip members, a file is
rolled when its compressed size passes a limit, headers and digests are
generated anew from the payload.  Tasks write under temporary names; the list
of what each successful task wrote is itself a Spark table, so exactly one
attempt of every task counts.  From it the files are renamed (repeatable: a
file already in place is left) and a manifest is written last.  An archive
without a manifest is not committed; one with it is complete, and the same
input gives the same bytes.

Files are reached through ``pyarrow.fs``, so the folder may be any store that
it can open (file, s3, gs, hdfs).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from .common import text_of
from .shingles import trimmed

DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUCKETS = 4096


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if ":/" in uri else "file://" + uri)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}:{digest}')}>"


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One WARC record: ``response``, or ``revisit`` without payload if
    ``refers`` names the key of the response that holds it."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {record_id(key, digest)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else 'urn:page:' + str(key)}"]
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers, digest)}", f"X-Refers-To-Key: {refers}"]
    head += [f"X-Record-Key: {'' if key is None else key}", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Block-Digest: sha1:{base32_sha1(block)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def info_record(name: str) -> bytes:
    block = b"software: lanegraph\r\nformat: WARC File Format 1.1\r\n"
    head = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id(None, name)}\r\nWARC-Date: {DATE}\r\n"
            f"WARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n")
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """One gzip member; no time stamp, so equal data give equal bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


# ------------------------------------------------------------------ records

def with_originals(pages: DataFrame, key: str, url: str, html: str, min_revisit_bytes: int, scratch: Scratch) -> DataFrame:
    """(key, url, html, sha, n_bytes, refers): ``refers`` is the largest key of
    the rows with an equal payload where that isn't the row's own.

    Keys per digest are pre-aggregated map-side; only digests with two rows or
    more are joined back, and the written side keeps the join splittable.
    """
    p = pages.select(pages[key].cast("long").alias("key"), pages[url].cast("string").alias("url"),
                     text_of(pages, html).alias("html"))
    p = p.withColumns({"sha": F.unhex(F.sha2(F.col("html").cast("binary"), 256)), "n_bytes": F.octet_length("html").cast("long")})
    shared = (p.where(F.col("n_bytes") >= min_revisit_bytes).groupBy("sha")
              .agg(F.max("key").alias("largest"), F.count("*").alias("n")).where("n > 1").select("sha", "largest"))
    shared = scratch.write(shared, "originals")
    own = F.col("largest").isNull() | F.col("key").eqNullSafe(F.col("largest"))
    return p.join(shared, "sha", "left").select("key", "url", "html", "n_bytes", F.when(~own, F.col("largest")).alias("refers"))


def shard_borders(records: DataFrame, shard_bytes: int) -> list[int]:
    """Lower keys of the shards, from exact byte counts per equal-width key
    range; a range that is too full is divided again until it is one key.

    The driver sees at most ``BUCKETS`` rows per division."""
    sizes = records.select("key", F.col("n_bytes") + 600)
    sizes = sizes.toDF("key", "b").where(F.col("key").isNotNull())
    low, high = sizes.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return []
    todo, cells = [(low, high)], []
    while todo:
        lo, hi = todo.pop()
        width = max(1, -(-(hi - lo + 1) // BUCKETS))
        cell = F.floor((F.col("key").cast("decimal(20,0)") - lo) / width).cast("long")
        got = (sizes.where(F.col("key").between(lo, hi)).groupBy(cell.alias("cell")).agg(F.sum("b").alias("b")).collect())
        for r in got:
            a = lo + r["cell"] * width
            if r["b"] > 2 * shard_bytes and width > 1:
                todo.append((a, min(hi, a + width - 1)))
            else:
                cells.append((a, r["b"]))
    borders, room = [], 0
    for a, b in sorted(cells):
        if room < b:
            borders.append(a)
            room = shard_bytes
        room -= b
    return borders


def _shard_of(borders: list[int]):
    """Number of the shard of a key: binary search in a literal array (null: 0)."""
    if not borders:
        return F.lit(0)
    arr = F.from_json(F.lit(str(borders)), "array<long>")
    steps = len(borders).bit_length()
    lo = F.lit(0)
    for s in reversed(range(steps)):
        nxt = lo + F.lit(1 << s)
        lo = F.when((nxt <= F.lit(len(borders))) & (F.get(arr, nxt - 1) <= F.col("key")), nxt).otherwise(lo)
    return F.coalesce(lo, F.lit(0))


# ------------------------------------------------------------------ writer

MANIFEST = "shard int, seq int, tmp string, name string, bytes long, records long, sha256 string"


def _writer(folder: str, roll_bytes: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        fs.create_dir(f"{root}/tmp", recursive=True)
        out = None
        state: dict = {}
        done: list[dict] = []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append({k: state[k] for k in ("shard", "seq", "tmp", "name", "bytes", "records")}
                            | {"sha256": state["hash"].hexdigest()})
                out = None

        def put(data: bytes):
            out.write(data)
            state["hash"].update(data)
            state["bytes"] += len(data)

        try:
            for batch in batches:
                for shard, key, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("shard", "key", "url", "html", "refers")),
                                                         strict=True):
                    if out is None or state["shard"] != shard or state["bytes"] >= roll_bytes:
                        seq = state["seq"] + 1 if state and state["shard"] == shard else 0
                        close()
                        name = f"part-{shard:07d}-{seq:05d}.warc.gz"
                        state = {"shard": shard, "seq": seq, "name": name, "tmp": f"{name}.{uuid.uuid4().hex}", "bytes": 0,
                                 "records": 0, "hash": hashlib.sha256()}
                        out = fs.open_output_stream(f"{root}/tmp/{state['tmp']}", compression=None)
                        put(member(info_record(name), level))
                    payload = html.encode()
                    put(member(record(key, url, payload, base32_sha1(payload), refers), level))
                    state["records"] += 1
            close()
        finally:
            if out is not None:
                out.close()
        cols = {k: [d[k] for d in done] for k in ("shard", "seq", "tmp", "name", "bytes", "records", "sha256")}
        yield pa.RecordBatch.from_arrays([pa.array(cols[k], t) for k, t in (
            ("shard", pa.int32()), ("seq", pa.int32()), ("tmp", pa.string()), ("name", pa.string()), ("bytes", pa.int64()),
            ("records", pa.int64()), ("sha256", pa.string()))], names=list(cols))
    return write


def _committer(folder: str):
    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for batch in batches:
            for r in batch.to_pylist():
                final = fs.get_file_info(f"{root}/{r['name']}")
                if final.type == pafs.FileType.NotFound or final.size != r["bytes"]:
                    fs.move(f"{root}/tmp/{r['tmp']}", f"{root}/{r['name']}")
            yield batch
    return commit


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
               min_revisit_bytes: int = 0, roll_bytes: int = 64 << 20, shard_bytes: int = 32 << 20, level: int = 6,
               scratch: Scratch | None = None) -> DataFrame:
    """Write one record per row of ``pages`` into ``folder``; the manifest table.

    Equal payloads of ``min_revisit_bytes`` or more: the row with the largest
    key is the response, the others revisit it; rows repeating that largest key
    are responses too (a record can't revisit its own key).  Null html is an
    empty payload, a null url becomes ``urn:page:<key>``, null keys go to the
    first shard and count as smaller than any other.  An empty table gives an
    empty manifest.  Other columns of ``pages`` are ignored.
    """
    spark = pages.sparkSession
    scratch = scratch or Scratch(spark, "warc")
    records = with_originals(pages, key, url, html, min_revisit_bytes, scratch)
    narrow = pages.select(pages[key].cast("long").alias("key"), F.octet_length(text_of(pages, html)).alias("n_bytes"))
    borders = shard_borders(narrow, shard_bytes)
    n = max(1, len(borders) + 1)
    # a shard is one range of whole keys and one task: its number is the partition
    placed = (records.withColumn("shard", _shard_of(borders).cast("int")).repartitionById(n, F.col("shard"))
              .sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "url", "html")
              .select("shard", "key", "url", "html", "refers"))
    wrote = scratch.write(placed.mapInArrow(trimmed(_writer(folder, roll_bytes, level)), MANIFEST), "wrote")
    files = wrote.count()
    manifest = wrote.repartition(max(1, min(files, 64))).mapInArrow(_committer(folder), MANIFEST).drop("tmp")
    path = f"{folder}/manifest"
    manifest.write.parquet(path)
    _drop_tmp(spark, folder)
    return spark.read.schema(manifest.schema).parquet(path)


def _drop_tmp(spark: SparkSession, folder: str) -> None:
    """What lost attempts left behind."""
    from ..scratch import remove_path
    remove_path(spark, f"{folder}/tmp")


# ------------------------------------------------------------------ reader

RECORDS = ("record_key long, record_type string, target_uri string, payload_bytes long, payload_digest string, "
           "refers_to long, file string, file_offset long")


def _members(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member, streamed."""
    offset, rest = 0, b""
    while True:
        rest = rest or stream.read(chunk)
        if not rest:
            return
        d, parts, used = zlib.decompressobj(31), [], 0
        while not d.eof:
            if not rest:
                rest = stream.read(chunk)
                if not rest:
                    raise ValueError("archive ends within a member")
            parts.append(d.decompress(rest))
            used += len(rest) - len(d.unused_data)
            rest = d.unused_data
        yield offset, b"".join(parts)
        offset += used


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block; the length must agree."""
    head, _, body = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]}")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(fields["Content-Length"])
    if body[n:] != b"\r\n\r\n":
        raise ValueError("record length does not agree with its header")
    return fields, body[:n]


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        names = [x.split(" ")[0] for x in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        rows: list[tuple] = []

        def flush():
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=names)

        for batch in batches:
            for name in batch.column("name").to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, data in _members(stream):
                        f, block = parse_record(data)
                        if f["WARC-Type"] == "warcinfo":
                            continue
                        if f["WARC-Block-Digest"] != "sha1:" + base32_sha1(block):
                            raise ValueError(f"{name} at {offset}: block digest differs")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rsplit(b"Content-Length: ", 1)[1])
                        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                        if f["WARC-Type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                            raise ValueError(f"{name} at {offset}: payload digest differs")
                        refers = f.get("X-Refers-To-Key")
                        if refers is not None and f["WARC-Refers-To"] != record_id(int(refers), digest):
                            raise ValueError(f"{name} at {offset}: reference differs")
                        key = f["X-Record-Key"]
                        rows.append((int(key) if key else None, f["WARC-Type"], f["WARC-Target-URI"], size, digest,
                                     int(refers) if refers is not None else None, name, offset))
                        if len(rows) >= 4096:
                            yield flush()
                            rows.clear()
        yield flush()
    return read


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a committed archive, one row each; digests are verified."""
    files = spark.read.parquet(f"{folder}/manifest").select("name")
    n = files.count()
    return files.repartition(max(1, n)).mapInArrow(trimmed(_reader(folder)), RECORDS)
