"""WARC archives with a two-level capture index.

Writing: each task writes one archive of single gzip members into the shared folder. Of records with equal
payloads (SHA-1 and length) the one with the largest page_id is a response, the others are revisits that name it;
the groups are found from digests, and only groups of two or more rows are joined back. A task that is run again
writes another file under a new name, and only files named by rows that Spark has committed are ever read.

Index: captures are sorted by key (URL with its host reversed, then page_id) into range slices. A slice becomes
one index file: blocks of ``LINES`` compressed lines, and behind them a sparse directory with the first key and
place of each block. One fence a file (its first and last key, and where its directory is) is all that is kept of
it; there are as many fences as slices, whatever the input, and they are handed to the tasks.

Reading: wanted keys go to the index files whose fences hold them. A task reads a file's directory, binary-searches
it for each key, and range-reads only the blocks found; captures then go to their archives, ``SPAN`` bytes to a
task, and are range-read in order of place. Every payload is decoded and its digest computed again; a revisit takes
length and page from the response that its record names.

A URL, a host or a payload that a third of all rows share is dealt over several slices, archives and tasks.

Defined results: null html is an empty payload; null url has the key ``-``; null page_id comes before all others;
of rows with equal payload and page_id one is the response; records with payloads shorter than ``least`` are never
revisits; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import map_arrow, pieces, store, table
from .slices import running

#: Lines of an index block, bytes of an archive that one task reads, smallest payload that can be revisited.
LINES, SPAN, LEAST = 1000, 32 << 20, 0
#: Bytes between wanted records that are read through instead of skipped.
GAP = 64 << 10
_NO_ID = -(1 << 63)


def url_key(url: Column) -> Column:
    """``https://m.Example.org:80/a?b#c`` becomes ``org,example,m:80)/a?b``; null becomes ``-``."""
    part = lambda i: F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^#]*)", i)
    host = F.array_join(F.reverse(F.split(F.lower(part(1)), r"\.")), ",")
    return F.coalesce(F.concat(host, part(2), F.lit(")"), part(3)), F.lit("-"))


def _record_id(seed: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}>"


def _base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return _member(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n")


def _place(folder: str):
    """(filesystem, path) of a folder URI."""
    return fs.FileSystem.from_uri(folder)


_CAPTURES = "key string, page_id long, digest string, file string, offset long, length long"


def _write(folder: str, date: str):
    schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in pieces(batches, "html"):
            if out is None:
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/{name}", compression=None)
            rows = []
            for r in batch.to_pylist():
                payload, page = (r["html"] or "").encode(), r["page_id"]
                digest = _base32(hashlib.sha1(payload).digest())
                uri = ("".join(c for c in r["url"] or "" if c > " ")) or "about:blank"
                common = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
                common += [("X-Page-ID", str(page))] if page is not None else []
                own, http = _record_id(f"{name}#{at}"), "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if r["response"]:
                    # the largest page_id and the digest name the one response that revisits can refer to
                    own = _record_id(f"{digest}:{len(payload)}:{r['last']}") if r["copies"] > 1 else own
                    block = f"{http}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                    fields = [("WARC-Type", "response"), ("WARC-Record-ID", own)]
                else:
                    block = f"{http}\r\n".encode()
                    fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To", _record_id(f"{digest}:{len(payload)}:{r['last']}")),
                              ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                record = _record([*fields, *common, ("Content-Type", "application/http; msgtype=response")], block)
                out.write(record)
                rows.append({"key": r["key"], "page_id": page, "digest": digest, "file": name, "offset": at, "length": len(record)})
                at += len(record)
            yield pa.RecordBatch.from_pylist(rows, schema)
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) to archives in ``folder``; a stored row per capture: ``key, page_id, digest, file, offset, length``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sha1, size = F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("size")
    page = F.coalesce(F.col("page_id").cast("long"), F.lit(_NO_ID))
    by_page = pages.groupBy(sha1, size, page.alias("last")).agg(F.count(F.lit(1)).alias("ties")).filter(F.col("size") >= least)
    groups = by_page.groupBy("sha1", "size").agg(F.max(F.struct("last", "ties")).alias("top"), F.sum("ties").alias("copies")).filter("copies > 1")
    groups = store(spark, groups.select(F.col("sha1").alias("_sha1"), F.col("size").alias("_size"), "top.last", "top.ties", "copies"), "payloads")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", url_key(F.col("url")).alias("key"), sha1, size, page.alias("_page"))
    rows = rows.join(groups, (F.col("sha1") == F.col("_sha1")) & (F.col("size") == F.col("_size")), "left")
    rows = rows.withColumn("response", F.col("copies").isNull() | (F.col("_page") == F.col("last")))
    if not groups.filter("ties > 1").isEmpty():
        # rows with the payload and the page_id of the response: the first by url is the response
        tied = F.col("response") & (F.coalesce("ties", F.lit(1)) > 1)
        among = running(rows.filter(tied), ["sha1", "size"], ["url"], at=("sum", F.lit(1).cast("long")))
        rows = rows.filter(~tied).unionByName(among.withColumn("response", F.col("at") == 0).drop("at"))
    rows = rows.select("page_id", "url", "html", "key", F.coalesce("copies", F.lit(1)).alias("copies"), "last", "response")
    return store(spark, map_arrow(rows, _write(folder, date), _CAPTURES), "captures")


def _range_read(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)


_FENCE = pa.schema([("index", pa.string()), ("first_key", pa.string()), ("first_page", pa.int64()), ("last_key", pa.string()), ("last_page", pa.int64()),
                    ("offset", pa.int64()), ("length", pa.int64())])


def _index(folder: str, lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        name, out, at, first, last = f"{uuid.uuid4().hex}.cdx.gz", None, 0, None, None
        directory, held = [], []

        def block() -> None:
            nonlocal at, held
            data = _member("\n".join(map(json.dumps, held)).encode())
            out.write(data)
            directory.append([held[0][0], held[0][1], at, len(data)])
            at, held = at + len(data), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                row = [row[0], _NO_ID if row[1] is None else row[1], *row[2:]]
                first, last = first or row[:2], row[:2]
                held.append(row)
                if len(held) == lines:
                    block()
        if out is not None:
            if held:
                block()
            data = _member("\n".join(map(json.dumps, directory)).encode())
            out.write(data)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([name, *first, *last, at, len(data)], _FENCE)], schema=_FENCE)
    return run


def build_index(captures: DataFrame, folder: str, lines: int = LINES) -> list[tuple]:
    """Index files of ``captures`` in ``folder``; returns the fences in key order: (index, first, last, offset, length of its directory)."""
    order = [F.col(c).asc_nulls_first() for c in ("key", "page_id", "file", "offset")]
    rows = captures.select("key", "page_id", "digest", "file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    # one row a slice, so as many as the session has shuffle partitions
    fences = store(captures.sparkSession, map_arrow(rows, _index(folder, lines), "index string, first_key string, first_page long, last_key string, last_page long, offset long, length long"), "fences")
    found = [(f["index"], (f["first_key"], f["first_page"]), (f["last_key"], f["last_page"]), f["offset"], f["length"]) for f in fences.collect()]
    return sorted(found, key=lambda f: (f[1], f[2]))


def _lines(data: bytes) -> list[list]:
    return [json.loads(x) for x in zlib.decompress(data, 31).decode().split("\n")]


def _route(fences: list[tuple]):
    firsts, lasts = [f[1] for f in fences], [f[2] for f in fences]
    schema = pa.schema([("fence", pa.int32()), ("key", pa.string()), ("page_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, *want) for want in zip(*(c.to_pylist() for c in batch.columns))
                    for n in range(bisect_left(lasts, want), bisect_right(firsts, want))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
    return run


def _search(folder: str, fences: list[tuple]):
    schema = pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        fence, file, directory, starts, block, keys, at = None, None, [], [], [], [], None
        for batch in batches:
            found = []
            for n, key, page in zip(*(c.to_pylist() for c in batch.columns)):
                if n != fence:
                    if file is not None:
                        file.close()
                    fence, at = n, None
                    index, _, _, offset, length = fences[n]
                    file = system.open_input_file(f"{root}/{index}")
                    directory = _lines(_range_read(file, offset, length))
                    starts = [(d[0], d[1]) for d in directory]
                want = (key, page)
                # equal keys may begin in the block before the first one that starts with them
                for i in range(max(bisect_left(starts, want) - 1, 0), bisect_right(starts, want)):
                    if i != at:
                        block = _lines(_range_read(file, *directory[i][2:]))
                        keys, at = [(x[0], x[1]) for x in block], i
                    found += [x[1:] for x in block[bisect_left(keys, want):bisect_right(keys, want)]]
            yield pa.RecordBatch.from_arrays([pa.array([None if x[i] == _NO_ID and not i else x[i] for x in found], f.type) for i, f in enumerate(schema)], schema=schema)
        if file is not None:
            file.close()
    return run


def lookup(wanted: DataFrame, folder: str, fences: list[tuple]) -> DataFrame:
    """Captures of the wanted (key, page_id), one row each: ``page_id, digest, file, offset, length``. Absent keys give none."""
    wanted = wanted.select("key", F.coalesce("page_id", F.lit(_NO_ID)).alias("page_id")).distinct()
    routed = map_arrow(wanted, _route(fences), "fence int, key string, page_id long")
    routed = routed.repartition("fence").sortWithinPartitions("fence", "key", "page_id")
    return map_arrow(routed, _search(folder, fences), "page_id long, digest string, file string, offset long, length long")


def _parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one uncompressed record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *fields = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    named = dict(f.split(": ", 1) for f in fields)
    return named, rest[:int(named["Content-Length"])].partition(b"\r\n\r\n")[2]


_RECORD = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("refers", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                     ("record_type", pa.string()), ("html", pa.string())])


def _read(folder: str, gap: int, span: int, bodies: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        name, file, start, data = None, None, 0, b""
        for batch in batches:
            wanted, rows = list(zip(*(c.to_pylist() for c in batch.columns))), []
            for n, (page, digest, path, offset, length) in enumerate(wanted):
                if path != name:
                    if file is not None:
                        file.close()
                    name, file, start, data = path, system.open_input_file(f"{root}/{path}"), 0, b""
                if not start <= offset <= offset + length <= start + len(data):
                    stop = offset + length  # one read for records that lie close together, 4 MB at most beyond the first
                    for _, _, p, o, x in wanted[n + 1:]:
                        if p != path or o > stop + gap or o + x > offset + (4 << 20):
                            break
                        stop = max(stop, o + x)
                    start, data = offset, _range_read(file, offset, stop - offset)
                fields, payload = _parse(zlib.decompress(data[offset - start:offset - start + length], 31))
                response = fields["WARC-Type"] == "response"
                named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if response and _base32(hashlib.sha1(payload).digest()) != named or named != digest:
                    raise ValueError(f"{path} at {offset}: the payload does not have the digest {digest}")
                own = fields.get("X-Page-ID")
                rows.append((None if own is None else int(own), fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), named, len(payload) if response else None,
                             fields["WARC-Type"], payload.decode() if response and bodies else None))
                if len(rows) == 1000:
                    yield _table(rows)
                    rows = []
            yield _table(rows)
        if file is not None:
            file.close()

    def _table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_RECORD)], schema=_RECORD)
    return run


def read_archives(captures: DataFrame, folder: str, span: int = SPAN, bodies: bool = False) -> DataFrame:
    """Records at the given places: ``page_id, payload_bytes, payload_digest, record_type, refers_to`` and, with ``bodies``, ``html``.

    A revisit takes its bytes (and html) from the response that its record names; that must be among ``captures``.
    """
    spark = captures.sparkSession
    part = F.expr(f"offset div {span}").alias("part")
    placed = captures.select("page_id", "digest", "file", "offset", "length", part).repartition("file", "part").sortWithinPartitions("file", "offset").drop("part")
    records = map_arrow(placed, _read(folder, GAP, span, bodies), "page_id long, record_id string, refers string, payload_digest string, payload_bytes long, record_type string, html string")
    records = store(spark, records, "records")
    body = ["html"] if bodies else []
    null = F.lit(None).cast("long").alias("refers_to")
    responses = records.filter("record_type = 'response'")
    first = responses.select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"), "payload_bytes", *body)
    again = records.filter("record_type = 'revisit'").drop("payload_bytes", "html").join(first, "refers", "left")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *body]
    return responses.withColumn("refers_to", null).select(*out).unionByName(again.select(*out))


def new_folder(spark: SparkSession) -> str:
    """A folder for archives in the cluster's shared checkpoint folder, as a URI."""
    shared = ensure_checkpoint_dir(spark)
    if "://" not in shared:
        shared = "file://" + shared.removeprefix("file:")
    return f"{shared}/warc-{uuid.uuid4().hex}"


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), new_folder(spark)
    fences = build_index(write_archives(pages, folder), folder)
    wanted = pages.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    return read_archives(lookup(wanted, folder, fences), folder)


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLE = f"""
with hashed as (select page_id, strlen(coalesce(html, '')) size, sha1(coalesce(html, '')) hex from pages),
groups as (select size, hex, max(page_id) last from hashed group by size, hex)
select page_id::bigint page_id, size::bigint payload_bytes,
  array_to_string(list_transform(range(32), lambda i: '{_ALPHABET}'[1 + ((('0x' || hex[1 + 10 * (i // 8):10 + 10 * (i // 8)])::bigint >> (35 - 5 * (i % 8))) & 31)::integer]), '') payload_digest,
  if(page_id = last, 'response', 'revisit') record_type, if(page_id = last, null, last)::bigint refers_to
from hashed join groups using (size, hex)
"""
