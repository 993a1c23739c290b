"""WARC archives of captures, and their index merged from sorted runs.

Method: every task writes its captures to archives of bounded size, one gzip
member a record. The captures of an archive, sorted by URL key, time and id,
are one run, a file beside it. Runs are merged by a loser tree: while there are
more than ``FAN_IN``, groups of them become longer runs; the last merge is done
range by range of the key, each range by one task that finds its place in every
run by bisection. The merged parts are in global order, so all captures of a
URL stand together by time, and a URL with many captures may span parts.

Of equal payloads (SHA-1) of at least ``min_bytes``, the capture with the
smallest id is written as a response; others are revisit records that refer to
it. Which payloads repeat is counted first; that table is broadcast if it was
counted to be small and joined by shuffle, hot payloads apart, otherwise.

Archives and runs are written below the folder that all machines share. Names
are unique to the attempt and only those of finished tasks are used, so a
repeated task does no harm. Nothing is held but one record, and one line of
each run.

Defined results: null html is an empty payload; a null id is written as "null",
comes before all numbers and never is the smallest id; equal rows of the
smallest id are all responses. A null time is 0, a null URL an empty key.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches, checkpoint_dir, join_hot, saved
from textgauge.session import fits

#: Compressed bytes after which an archive is closed.
ARCHIVE_BYTES = 32 << 20
FAN_IN = 64
#: Repeated payloads: about 100 bytes a row, so at most 10 MB are broadcast.
BROADCAST_ROWS = 100_000
BASE_32_HEX, BASE_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RUN = "run string, captures long"
INDEX = "url_key string, captured long, id string, archive string, offset long, length long"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1: each 5 hexadecimal digits are 4 of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), BASE_32_HEX, BASE_32)


def url_key(url: str | None) -> str:
    """Host parts in reverse, then path and sorted query; the same for spellings of one URL."""
    text = (url or "").strip()
    try:
        split = urlsplit(text)
        host, port = (split.hostname or "").removeprefix("www."), split.port
    except ValueError:
        return quote(text, safe="/:?=&%,;@+!*'()~$#")
    if not host:
        return quote(text, safe="/:?=&%,;@+!*'()~$#")
    place = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    query = "&".join(sorted(filter(None, split.query.split("&"))))
    key = f"{place}){split.path.rstrip('/') or '/'}" + (f"?{query}" if query else "")
    return quote(key, safe="/:?=&%,;@+!*'()~$")


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def record(kind: str, page: str, url: str, when: int, payload: bytes, digest: str, refers: str | None) -> bytes:
    """A response, or a revisit without the payload; its HTTP head states the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    fields = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Target-URI: {quote(url or '', safe=_URI)}",
        f"WARC-Date: {_date(when)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URI = "/:?=&%,;@+!*'()~$#[]"


def _date(seconds: int) -> str:
    from datetime import datetime, timedelta

    return (datetime(1970, 1, 1) + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def _line_key(line: bytes) -> tuple[bytes, int, int]:
    key, when, page, _ = line.split(b"\t", 3)
    return key, int(when), -1 if page == b"null" else int(page)


class LoserTree:
    """The smallest of k sorted streams of (key, line), by one match per level.

    Inner nodes hold the loser of their match, ``winner`` the overall winner.
    """

    def __init__(self, streams: list[Iterator[tuple]]):
        self.streams, self.size = streams, max(1, len(streams))
        self.heads = [next(s, None) for s in streams] or [None]
        self.losers = [0] * self.size
        self.winner = self._play(1) if self.size > 1 else 0

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (b, a) if self._before(b, a) else (a, b)
        self.losers[node] = lost
        return won

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x[0], a) < (y[0], b))

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[self.winner]) is not None:
            yield head
            run = self.winner
            self.heads[run] = next(self.streams[run], None)
            node = (run + self.size) // 2
            while node >= 1:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def _lines(source, start: int = 0) -> Iterator[bytes]:
    """Lines of an open file from an offset that begins one."""
    source.seek(start)
    rest = b""
    while chunk := source.read(1 << 16):
        parts = (rest + chunk).split(b"\n")
        rest = parts.pop()
        yield from parts


def _first_not_below(source, key: tuple) -> int:
    """Offset of the first line whose key is ``key`` or more."""
    low, high = 0, source.size()  # the line that begins at or after low is wanted
    while low < high:
        middle = (low + high) // 2
        at = _next_line(source, middle)
        line = next(_lines(source, at), None) if at < source.size() else None
        if line is not None and _line_key(line) < key:
            low = middle + 1
        else:
            high = middle
    return _next_line(source, low)


def _next_line(source, offset: int) -> int:
    """Begin of the first line at or after ``offset``."""
    if offset == 0:
        return 0
    source.seek(offset - 1)
    at = offset - 1
    while chunk := source.read(1 << 12):
        found = chunk.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(chunk)
    return at


def merged(folder: str, runs: list[str], low: tuple | None = None, high: tuple | None = None) -> Iterator[bytes]:
    """Lines of all runs in order, from ``low`` and before ``high``."""
    store, base = _store(folder)

    def stream(name: str) -> Iterator[tuple]:
        with store.open_input_file(f"{base}/{name}") as source:
            for line in _lines(source, _first_not_below(source, low) if low else 0):
                key = _line_key(line)
                if high is not None and key >= high:
                    return
                yield key, line

    return (line for _, line in LoserTree([stream(r) for r in runs]))


def write(pages: DataFrame, folder: str, id_col: str, url_col: str, html_col: str, time_col: str, min_bytes: int = 0) -> DataFrame:
    """Write archives and runs below ``folder``; returns (run, captures), one row a run."""
    bounded_batches(pages.sparkSession, 200)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(url_col, F.lit("")).alias("url"),
        F.coalesce(F.col(time_col).cast("long"), F.lit(0)).alias("when"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    ).withColumn("digest", sha1_base32(F.col("html")))
    sized = rows.where(F.octet_length("html") >= min_bytes)
    repeated = saved(sized.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1"))
    joined = rows.join(F.broadcast(repeated), "digest", "left") if fits(repeated, BROADCAST_ROWS) else join_hot(rows, repeated, ["digest"], "n")
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base)
        name, out, size, lines = "", None, 0, []

        def close() -> pa.RecordBatch:
            out.close()
            lines.sort(key=_line_key)
            with store.open_output_stream(f"{base}/{name}.run") as run:
                for k in range(0, len(lines), 1000):
                    run.write(b"".join(x + b"\n" for x in lines[k : k + 1000]))
            return pa.RecordBatch.from_arrays([pa.array([f"{name}.run"]), pa.array([len(lines)], pa.int64())], names=["run", "captures"])

        for batch in batches:
            for page, url, when, html, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, size, lines = uuid.uuid4().hex, 0, []
                    out = store.open_output_stream(f"{base}/{name}.warc.gz", compression=None)
                own = "null" if page is None else str(page)
                kind = "response" if first is None else "revisit"
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                packed = packer.compress(record(kind, own, url, when, html.encode("utf-8", "surrogatepass"), digest, None if first is None else str(first))) + packer.flush()
                out.write(packed)
                lines.append(f"{url_key(url)}\t{when}\t{own}\t{name}.warc.gz\t{size}\t{len(packed)}".encode())
                size += len(packed)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return saved(joined.select("id", "url", "when", "html", "digest", refers.alias("refers")).mapInArrow(written, RUN))


def read(runs: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives: id, type, payload size and digest, the id referred to, place."""
    schema = "archive string, offset long, id long, record_type string, payload_bytes long, payload_digest string, refers_to long"

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for run in batch.column("run").to_pylist():
                name = run.removesuffix(".run") + ".warc.gz"
                with store.open_input_file(f"{base}/{name}") as source:
                    rows = []
                    for offset, data in _members(source):
                        rows.append((name, offset, *_parsed(data)))
                        if len(rows) == 1000:
                            yield _batch(rows, schema_of)
                            rows = []
                    if rows:
                        yield _batch(rows, schema_of)

    schema_of = pa.schema(
        [("archive", pa.string()), ("offset", pa.int64()), ("id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    )
    return _spread(runs.select("run")).mapInArrow(archived, schema)


def _spread(runs: DataFrame) -> DataFrame:
    return runs.repartition(max(1, min(runs.count(), 10 * runs.sparkSession.sparkContext.defaultParallelism)))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _members(source) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member, one at a time."""
    offset, unpacker, parts, rest = 0, zlib.decompressobj(31), [], b""
    while rest or (rest := source.read(1 << 18)):
        parts.append(unpacker.decompress(rest))
        if unpacker.eof:
            after = unpacker.unused_data
            yield offset, b"".join(parts)
            offset = source.tell() - len(after)
            unpacker, parts, rest = zlib.decompressobj(31), [], after
        else:
            rest = b""


def _parsed(data: bytes) -> tuple:
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def number(name: str) -> int | None:
        text = fields.get(name, "<urn:page:null>")[10:-1]
        return None if text == "null" else int(text)

    return number("WARC-Record-ID"), kind, size, digest, number("WARC-Refers-To")


def merged_index(runs: DataFrame, folder: str, ranges: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """The captures in global order of URL key, time and id; one partition a range."""
    spark = runs.sparkSession
    runs = saved(_merge_groups(runs, folder, fan_in)) if runs.count() > fan_in else runs
    while (count := runs.count()) > fan_in:
        runs = saved(_merge_groups(runs, folder, fan_in))
    names = sorted(r["run"] for r in runs.collect())  # at most fan_in
    ranges = ranges or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), count and runs.agg(F.sum("captures")).first()[0]))
    bounds = _bounds(runs, folder, ranges)
    parts = spark.createDataFrame([(k,) for k in range(len(bounds) + 1)], "part int").repartitionByRange(len(bounds) + 1, "part")

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("part").to_pylist():
                low, high = (bounds[part - 1] if part else None), (bounds[part] if part < len(bounds) else None)
                rows = []
                for line in merged(folder, names, low, high):
                    key, when, page, archive, offset, length = line.decode().split("\t")
                    rows.append((key, int(when), page, archive, int(offset), int(length)))
                    if len(rows) == 5000:
                        yield _batch(rows, index_of)
                        rows = []
                if rows:
                    yield _batch(rows, index_of)

    index_of = pa.schema([("url_key", pa.string()), ("captured", pa.int64()), ("id", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
    return parts.mapInArrow(ordered, INDEX)


def _merge_groups(runs: DataFrame, folder: str, fan_in: int) -> DataFrame:
    """Longer runs, each of about ``fan_in`` runs."""
    groups = -(-runs.count() // fan_in)

    def grown(table: pa.Table) -> pa.Table:
        store, base = _store(folder)
        name = f"{uuid.uuid4().hex}.run"
        with store.open_output_stream(f"{base}/{name}") as out:
            for line in merged(folder, sorted(table.column("run").to_pylist())):
                out.write(line + b"\n")
        return pa.table({"run": [name], "captures": pa.array([sum(table.column("captures").to_pylist())], pa.int64())})

    return runs.withColumn("_group", F.pmod(F.xxhash64("run"), F.lit(groups))).groupBy("_group").applyInArrow(lambda _, t: grown(t), RUN)


def _bounds(runs: DataFrame, folder: str, ranges: int) -> list[tuple]:
    """Keys that cut the captures into about equal ranges; at most one fewer than ``ranges``."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for run in batch.column("run").to_pylist():
                with store.open_input_file(f"{base}/{run}") as source:
                    keys = [_line_key(line) for k, line in enumerate(_lines(source)) if k % 64 == 0]
                yield pa.RecordBatch.from_arrays([pa.array([k[0].decode() for k in keys]), *[pa.array([k[j] for k in keys], pa.int64()) for j in (1, 2)]], names=["key", "time", "id"])

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                break
        for _ in batches:
            pass

    kind = "key string, time long, id long"
    cut = runs.select("run").mapInArrow(sampled, kind).repartitionByRange(ranges, "key", "time", "id").sortWithinPartitions("key", "time", "id")
    found = sorted((r["key"].encode(), r["time"], r["id"]) for r in cut.mapInArrow(firsts, kind).collect())  # one a range
    return found[1:]


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str = "captured", min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write, read back and index: the records read, with URL key and time from the merged index."""
    folder = folder or f"{checkpoint_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    runs = write(pages, folder, id_col, url_col, html_col, time_col, min_bytes)
    index = merged_index(runs, folder).select("archive", "offset", "url_key", "captured")
    return read(runs, folder).join(index, ["archive", "offset"]).drop("archive", "offset")


