"""WARC archives and their capture index, merged outside memory.

Writing: the payloads' SHA-1 are grouped to find the copies; the record with the largest page id is
the response, the others revisit it without a payload of their own. Every task writes gzip members,
one a record, into files of its own name in a folder that all executors see; the table of files that
it returns, not the folder, says which files count, so that a repeated task leaves no double records.

Reading: each task walks through its files member by member, checks length and SHA-1 of every
payload, and emits the captures as sorted runs of at most ``RUN`` entries. Index: keys taken at a
fixed stride from all runs give the range borders; runs are cut there, the slices of a range meet in
one task, and a loser tree merges them by URL key and timestamp. Ranges hold about ``RANGE`` captures
whatever the URLs, since the order is total (URL key, timestamp, page id, file, offset): a URL with a
third of all captures spreads over many. Totals of ranges number the captures from end to end.

Defined cases: a null page has an empty payload; a null URL is empty; null ids are smaller than all
others and revisit a known one, and copies that all have null ids are all responses; rows that share
the largest id of their payload are all responses; payloads below ``least`` bytes are never revisits;
without a date column a record is dated by its id, in seconds after ``FIRST_DAY``; URL keys of over
``KEY_CHARS`` characters end in their SHA-1; control characters of a URL are percent-encoded; texts of any length are written whole; an empty table
gives no files and an empty index; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import cut, lookup

FILE_BYTES = 256 << 20  # a task begins another file beyond
RUN = 1 << 16  # captures sorted at once by a task
CHUNK = 1024  # captures in a row of a run
STRIDE = 64  # a border candidate for so many captures of a run
RANGE = 100_000  # captures merged by a task
KEY_CHARS = 1024
BROADCAST = 200_000  # repeated payloads whose table is broadcast
READ_BYTES = 1 << 17
FIRST_DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = (
    "struct<urlkey:string,timestamp:string,page_id:bigint,file:string,offset:bigint,length:bigint,url:string,"
    "record_type:string,payload_digest:string,payload_bytes:bigint,refers_to:bigint>"
)
FIELDS = [f.split(":")[0] for f in CAPTURE[len("struct<") : -1].split(",")]
ORDER = ["urlkey", "timestamp", "page_id", "file", "offset"]


def record_types(pages: DataFrame, least: int = 0, date: str | None = None, broadcast_rows: int = BROADCAST) -> DataFrame:
    """(page_id, url, html, seconds, digest, keeper): time of the capture, SHA-1 of each payload in
    hex, and for payloads of several rows the largest page id among them."""
    html = F.coalesce("html", F.lit(""))
    by_id = F.lit(int(FIRST_DAY.timestamp())) + F.coalesce("page_id", F.lit(0)) % 10**10
    seconds = by_id if date is None else F.coalesce(F.unix_timestamp(date), by_id)
    hashed = pages.select("page_id", "url", html.alias("html"), seconds.alias("seconds"), F.sha1(html.cast("binary")).alias("digest"))
    counts = hashed.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keeper"))
    copies = cut(counts.filter("n > 1"))
    if copies.count() <= broadcast_rows:
        return hashed.join(F.broadcast(copies.select("digest", "keeper")), "digest", "left").select(*hashed.columns, "keeper")
    return lookup(hashed, copies.select("digest", "keeper"), ["digest"], copies.select("digest", "n"), hashed.count())


def _field(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}')}>"


def record(page_id: int | None, url: str, date: datetime, payload: bytes, digest: str, keeper: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit of page ``keeper`` without."""
    code = base64.b32encode(bytes.fromhex(digest)).decode()
    revisit = keeper is not None and keeper != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {date.strftime('%Y-%m-%dT%H:%M:%SZ')}", f"WARC-Target-URI: {_field(url)}", f"WARC-Payload-Digest: sha1:{code}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(keeper, digest)}", f"Refers-To-Page-ID: {keeper}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info() -> bytes:
    block = b"software: venuelens\r\nformat: WARC File Format 1.1\r\n"
    head = [VERSION, "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {FIRST_DAY.strftime('%Y-%m-%dT%H:%M:%SZ')}",
            "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder, by its URI (file, hdfs, s3, gs and the like)."""
    return fs.FileSystem.from_uri(folder if ":/" in folder else os.path.abspath(folder))


def write_archives(
    pages: DataFrame, folder: str, least: int = 0, date: str | None = None, file_bytes: int = FILE_BYTES, level: int = 6, broadcast_rows: int = BROADCAST
) -> DataFrame:
    """Write one record a row of ``pages`` into ``folder`` (a URI that all executors reach);
    (file, records, bytes) of the files. ``date`` names a timestamp column."""
    where, root = opened(folder)
    where.create_dir(root, recursive=True)
    rows = record_types(pages, least, date, broadcast_rows)
    names = ["file", "records", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = opened(folder)
        name, out, count = None, None, 0

        def closed():
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count]), pa.array([size])], names=names)

        for batch in batches:
            ids, urls, times, digests, keepers = (batch.column(c).to_pylist() for c in ("page_id", "url", "seconds", "digest", "keeper"))
            payloads = batch.column("html").cast(pa.binary())
            for page_id, url, html, seconds, digest, keeper in zip(ids, urls, payloads, times, digests, keepers, strict=True):
                if out is None:
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = where.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(_member(_info(), level))
                when = datetime.fromtimestamp(seconds, timezone.utc)
                out.write(_member(record(page_id, url or "", when, html.as_py(), digest, keeper), level))
                count += 1
                if out.tell() >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return cut(rows.mapInArrow(run, "file string, records long, bytes long"))


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of the gzip members of a file, one after the other."""
    raw, start = b"", 0
    while raw or (raw := stream.read(READ_BYTES)):
        z, parts, used = zlib.decompressobj(31), [], 0
        while True:
            parts.append(z.decompress(raw))
            used += len(raw)
            if z.eof:
                break
            raw = stream.read(READ_BYTES)
            if not raw:
                raise EOFError("archive ends inside a record")
        raw = z.unused_data
        used -= len(raw)
        yield start, used, b"".join(parts)
        start += used


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record length does not fit its block")
    return fields, rest[:size]


def url_key(url: str) -> str:
    """Host labels from the right, then path and query: captures of a site stand together."""
    m = re.match(r"(?i)(?:[a-z][a-z0-9+.\-]*:)?//(?:[^@/?#]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url)
    key = f"{','.join(reversed(m[1].lower().split('.')))}){m[2] or '/'}" if m else url
    return key if len(key) <= KEY_CHARS else key[: KEY_CHARS - 41] + "#" + hashlib.sha1(key.encode()).hexdigest()


def capture(fields: dict[str, str], block: bytes, file: str, offset: int, length: int) -> tuple:
    """The index entry of a response or revisit, in the order of ``FIELDS``; a payload that is not
    what its record says raises."""
    head, _, payload = block.partition(b"\r\n\r\n")
    declared = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response":
        if len(payload) != declared or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged payload in {file} at {offset}")
    url = fields.get("warc-target-uri", "")
    number = {k: int(fields[k]) if k in fields else None for k in ("page-id", "refers-to-page-id")}
    stamp = re.sub(r"\D", "", fields["warc-date"])
    return (url_key(url), stamp, number["page-id"], file, offset, length, url, fields["warc-type"], digest, declared, number["refers-to-page-id"])


def _key(c: tuple) -> tuple:
    return (c[0], c[1], -(2**63) if c[2] is None else c[2], c[3], c[4])


def _entries(captures: list[tuple]) -> pa.StructArray:
    kinds = [pa.int64() if k in ("page_id", "offset", "length", "payload_bytes", "refers_to") else pa.string() for k in FIELDS]
    columns = zip(*captures, strict=True) if captures else [[] for _ in FIELDS]
    return pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=FIELDS)


def capture_runs(files: DataFrame, folder: str, run_size: int = RUN) -> DataFrame:
    """(run, chunk, entries): the captures of the archives in ``files`` as runs, each sorted and
    laid out in rows of at most ``CHUNK`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = opened(folder)

        def sorted_run(captures: list[tuple]) -> Iterator[pa.RecordBatch]:
            captures.sort(key=_key)
            name = uuid.uuid4().hex
            for at in range(0, len(captures), CHUNK):
                part = _entries(captures[at : at + CHUNK])
                column = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at // CHUNK]), column], names=["run", "chunk", "entries"])

        waiting: list[tuple] = []
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with where.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for offset, length, data in members(stream):
                        fields, block = parsed(data)
                        if fields["warc-type"] in ("response", "revisit"):
                            waiting.append(capture(fields, block, file, offset, length))
                        if len(waiting) >= run_size:
                            yield from sorted_run(waiting)
                            waiting = []
        if waiting:
            yield from sorted_run(waiting)

    n = max(files.count(), 1)  # a task a file
    return cut(files.select("file").repartition(n).mapInArrow(run, f"run string, chunk long, entries array<{CAPTURE}>"))


class LoserTree:
    """Merge of sorted runs: each inner node holds the loser of its match, the winner goes on to the
    root, and the next entry of the winner's run only replays the matches on its own path."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.head = [next(r, None) for r in runs]
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or (x is not None and x <= y)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        a, b = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.head[self.winner] is not None:
            at = self.winner
            yield self.head[at]
            self.head[at] = next(self.runs[at], None)
            node = (at + self.k) // 2
            while node >= 1:
                if not self._beats(at, self.losers[node]):
                    at, self.losers[node] = self.losers[node], at
                node //= 2
            self.winner = at


def borders(runs: DataFrame, size: int, stride: int = STRIDE) -> list[tuple]:
    """Keys that cut all captures into ranges of about ``size``, from every ``stride``-th entry of
    the runs; one key a range comes to the driver."""
    total = runs.agg(F.sum(F.size("entries"))).first()[0] or 0
    n = -(-total // size)
    if n <= 1:
        return []
    picked = runs.select("run", F.posexplode("entries").alias("at", "e")).filter(F.col("at") % stride == 0)
    keys = picked.select(F.struct(*[F.col(f"e.{c}").alias(c) for c in ORDER]).alias("key")).repartitionByRange(n, "key")
    least = keys.groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).collect()
    return sorted(_key(tuple(r.key)) for r in least)[1:]


def merged_index(runs: DataFrame, size: int = RANGE, stride: int = STRIDE) -> DataFrame:
    """All captures in global order: range, place (in the range) and the fields of the capture.
    Partitions follow each other in the order of the ranges."""
    spark = runs.sparkSession
    cuts = borders(runs, size, stride)
    shared = spark.sparkContext.broadcast(cuts)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, parts = [], []
            for run, chunk, entries in zip(batch.column("run").to_pylist(), batch.column("chunk").to_pylist(), batch.column("entries"), strict=True):
                entries = entries.values
                keys = [_key(t) for t in zip(*[entries.field(c).to_pylist() for c in ORDER], strict=True)]
                at, number = 0, bisect_right(shared.value, keys[0])  # a border begins its range
                while at < len(keys):
                    stop = bisect_left(keys, shared.value[number]) if number < len(shared.value) else len(keys)
                    if stop > at:
                        out.append((number, run, chunk))
                        parts.append(entries.slice(at, stop - at))
                    at, number = stop, number + 1
            if out:
                offsets = [0]
                for p in parts:
                    offsets.append(offsets[-1] + len(p))
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(parts))
                yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in zip(*out, strict=True)], column], names=["range", "run", "chunk", "entries"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []

        def merged() -> Iterator[pa.RecordBatch]:
            runs: dict[str, list[int]] = {}
            begin = 0
            for run, entries in held:
                runs.setdefault(run, []).append((begin, len(entries)))
                begin += len(entries)
            together = pa.concat_arrays([e for _, e in held])
            keys = [_key(t) for t in zip(*[together.field(c).to_pylist() for c in ORDER], strict=True)]

            def walk(pieces):
                for at, n in pieces:
                    for i in range(at, at + n):
                        yield keys[i], i

            order = [i for _, i in LoserTree([walk(p) for p in runs.values()])]
            for at in range(0, len(order), 8192):
                part = together.take(pa.array(order[at : at + 8192]))
                columns = [pa.array([number] * len(part), pa.int64()), pa.array(range(at, at + len(part)), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + part.flatten(), names=["range", "place", *FIELDS])

        for batch in batches:
            for this, run, entries in zip(batch.column("range").to_pylist(), batch.column("run").to_pylist(), batch.column("entries"), strict=True):
                if this != number and held:
                    yield from merged()
                    held = []
                number = this
                held.append((run, entries.values))
        if held:
            yield from merged()

    sliced = runs.mapInArrow(slices, f"range long, run string, chunk long, entries array<{CAPTURE}>")
    dealt = sliced.repartitionByRange(len(cuts) + 1, "range").sortWithinPartitions("range", "run", "chunk")
    flat = CAPTURE[len("struct<") : -1].replace(":", " ").replace(",", ", ")
    return cut(dealt.mapInArrow(merge, f"range long, place long, {flat}"))


def histories(index: DataFrame) -> DataFrame:
    """The merged captures with their position in the whole index and their number among the
    captures of their URL key (both from 0); a URL key that goes on in the next ranges is counted on
    from the totals of the ranges before."""
    ranges = index.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min_by("urlkey", "place").alias("first"))
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranges = cut(ranges)  # a row a range, of about RANGE captures each
    first = ranges.select(F.col("first").alias("urlkey")).distinct()
    parts = index.join(F.broadcast(first), "urlkey", "left_semi").groupBy("urlkey", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("urlkey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("carried", F.sum("n").over(earlier)).filter("carried is not null").drop("n")
    here = Window.partitionBy("range", "urlkey").orderBy("place")
    out = index.withColumn("number", F.row_number().over(here).cast("long") - 1)
    out = out.join(F.broadcast(ranges.select("range", "before")), "range").join(F.broadcast(parts), ["urlkey", "range"], "left")
    return out.select(
        (F.col("before") + F.col("place")).alias("position"), (F.col("number") + F.coalesce("carried", F.lit(0))).alias("capture"), *FIELDS
    )


def removed(folder: str) -> None:
    """Delete a folder of archives that ``write_archives`` made."""
    where, root = opened(folder)
    where.delete_dir(root)


def archived_pages(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write ``pages`` to archives in ``folder``, read them back and merge their index: one row per
    capture in index order."""
    files = write_archives(pages, folder, least)
    return merged_index(capture_runs(files, folder))


def fresh_folder(spark: SparkSession) -> str:
    """A folder for archives under the shared folder of ``spark.checkpoint.dir``."""
    from venuelens.session import ensure_checkpoint_dir

    return os.path.join(ensure_checkpoint_dir(spark), "venuelens", "warc", uuid.uuid4().hex)
