r"""WARC archives: writing with revisits, and reading by boundary-chain verification.

Writing is a text job: a record is one row and ``\r\n\r\n`` is the line separator, so Spark's own
commit protocol makes the files. Of pages with equal payloads (by SHA-256) of at least
``least_bytes``, those with the smallest id are responses, the others revisits, which keep the
HTTP header with the length of the payload and name the response's record.

Reading does not trust the magic ``WARC/1.1``, as a payload may hold it. Tasks read byte ranges
of all files. Each emits a candidate for every place in its range where a record header parses,
with the place of the record that would follow. Inside a range the candidates are chained to the
first place beyond it; pointer jumping over these exits, doubling each round, then finds in which
places the chain that starts at each file's first byte enters the ranges. Only records on that
chain are read; a candidate inside a payload is on none. A chain that ends before its file does
is an error.

Ranges are read with Arrow's file systems, by the URI of the archive folder; that folder must be
one that all executors reach (a shared path, S3, GCS, ABFS or HDFS).

Null html is an empty payload. A null page id is written without one, never the smallest, and
reads back as null; its record id is a random one. Repeated rows are records of their own, repeated
ids give equal record ids. Empty tables make no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.scratch import scratch_folder, stored

#: Fixed values of the format.
MAGIC, END = b"WARC/1.1\r\n", "\r\n\r\n"
#: Bytes of a range, and of those read behind it at first; a longer header is read on to its end.
RANGE, BEHIND = 8 << 20, 64 << 10
#: Tasks that ranges are dealt to at most; more ranges share tasks.
MOST_TASKS = 1 << 14


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits, five of them at a time."""
    digits = [F.lpad(F.lower(F.conv(F.substring(hex_digest, i, 5), 16, 32)), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*digits), "0123456789abcdefghijklmnopqrstuv", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_response(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id, url, html`` with ``refers_to``, null for responses."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("same", F.sha2("html", 256))
    slim = rows.filter(F.octet_length("html") >= least_bytes).groupBy("same")
    first = slim.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    joined = rows.join(stored(first, "payloads"), "same", "left")
    later = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return joined.select("page_id", "url", "html", F.when(later, F.col("first")).alias("refers_to"))


def record(page_id: Column, url: Column, html: Column, refers_to: Column, date: str) -> Column:
    size = F.octet_length(html).cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    block = F.concat(http, F.when(refers_to.isNull(), html).otherwise(""))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    id_of = lambda x: F.concat(F.lit("<urn:page:"), x.cast("string"), F.lit(">"))
    return F.concat(
        F.lit(MAGIC.decode()),
        line("WARC-Type", F.when(refers_to.isNull(), "response").otherwise("revisit")),
        line("WARC-Record-ID", F.coalesce(id_of(page_id), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(url, r"[\r\n]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.sha1(html)))),
        line("WARC-Profile", F.when(refers_to.isNotNull(), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", id_of(refers_to)),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str | None = None) -> None:
    """One record per row; as many files as there are tasks. ``date``: the records' time, now if not given."""
    rows = with_response(pages, least_bytes)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    made = record(F.col("page_id"), F.col("url"), F.col("html"), F.col("refers_to"), date)
    rows.select(made.alias("value")).write.option("lineSep", END).text(folder)


class Source:
    """Byte ranges of files that a URI names."""

    def __init__(self) -> None:
        self.open: tuple | None = None

    def read(self, path: str, start: int, stop: int) -> bytes:
        from pyarrow import fs

        if not self.open or self.open[0] != path:
            uri = re.sub(r"^file:/(?!/)", "file:///", path)
            system, name = fs.FileSystem.from_uri(uri)
            self.open = (path, system.open_input_file(name))
        return self.open[1].read_at(max(stop - start, 0), start)


FIELD = re.compile(rb"([!-9;-~]+):[ \t]*([^\r\n]*)\r\n")


#: A header of which not all bytes have been read.
UNREAD = object()


def header_at(data: bytes, at: int):
    """Fields of a record header that begins at a place, lower-case names, and where it ends.

    None where there is none, ``UNREAD`` where the bytes end before the header does.
    """
    if not data.startswith(MAGIC, at):
        return None
    fields, at = {}, at + len(MAGIC)
    while hit := FIELD.match(data, at):
        fields[hit[1].lower()] = hit[2]
        at = hit.end()
    if not data.startswith(b"\r\n", at):
        return None if data.find(b"\r\n", at) >= 0 else UNREAD
    size = fields.get(b"content-length", b"")
    if not size.isdigit() or len(size) > 18 or b"warc-type" not in fields:
        return None
    return fields, at + 2


class Window:
    """The bytes of a file from one place on, read further where a header goes on behind them."""

    def __init__(self, source: Source, path: str, start: int, stop: int, length: int) -> None:
        self.source, self.path, self.start, self.length = source, path, start, length
        self.data = source.read(path, start, min(stop + BEHIND, length))

    def header(self, at: int):
        while (found := header_at(self.data, at)) is UNREAD:
            end = self.start + len(self.data)
            if end >= self.length:
                return None
            self.data += self.source.read(self.path, end, min(end + max(len(self.data), BEHIND), self.length))
        return found

    def bytes(self, at: int, size: int) -> bytes:
        part = self.data[at : at + size]
        return part if len(part) == size else self.source.read(self.path, self.start + at, self.start + at + size)


def ranges_of(spark: SparkSession, folder: str, size: int) -> tuple[DataFrame, int]:
    """``path, length, part, start, stop``: byte ranges of the files of a folder; and how many tasks to deal them to."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length").filter("length > 0")
    parts = files.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))))
    start = F.col("part") * size
    ranges = parts.withColumns({"start": start, "stop": F.least(start + size, F.col("length"))})
    many = files.agg(F.sum(F.ceil(F.col("length") / size))).first()[0]
    return ranges, min(max(many or 1, 1), MOST_TASKS)


CHAIN = "path string, length long, part long, stop long, start long, next long"


def candidates(ranges: DataFrame) -> DataFrame:
    """``path, length, part, stop, start, next``: every place where a header parses, and its successor.

    No record ends beyond its file, so places whose successor does are none.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = Source()
        for batch in batches:
            for x in batch.to_pylist():
                window = Window(source, x["path"], x["start"], x["stop"], x["length"])
                found, at = [], window.data.find(MAGIC)
                while 0 <= at < x["stop"] - x["start"]:
                    if header := window.header(at):
                        following = x["start"] + header[1] + int(header[0][b"content-length"]) + len(END)
                        if following <= x["length"]:
                            found.append((x["start"] + at, following))
                    at = window.data.find(MAGIC, at + 1)
                columns = [[x[c]] * len(found) for c in ("path", "length", "part", "stop")] + [[f[i] for f in found] for i in (0, 1)]
                kinds = [pa.string(), *[pa.int64()] * 5]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "length", "part", "stop", "start", "next"])

    return ranges.mapInArrow(scan, CHAIN)


def chained(rows: list[tuple[int, int]], stop: int) -> dict[int, int]:
    """For each candidate of a range, the first place of its chain that is beyond the range.

    -1 where the chain meets a place that is no candidate. Successors lie behind, so one pass from
    the back is enough.
    """
    out: dict[int, int] = {}
    for start, following in sorted(rows, reverse=True):
        out[start] = following if following >= stop else out.get(following, -1)
    return out


def entries(found: DataFrame) -> DataFrame:
    """``path, start``: where the chain of each file enters its ranges, by pointer jumping."""

    def leave(table: pa.Table) -> pa.Table:
        x = table.select(["start", "next"]).to_pydict()
        out = chained(list(zip(x["start"], x["next"])), table["stop"][0].as_py())
        n = len(out)
        return pa.table([pa.array([table["path"][0].as_py()] * n), pa.array([table["length"][0].as_py()] * n), pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.int64())], names=["path", "length", "start", "exit"])

    exits = stored(found.groupBy("path", "part").applyInArrow(leave, "path string, length long, start long, exit long"), "exits")
    # only where a file begins and where some chain enters a range: a few places of each range
    landed = exits.select("path", F.col("exit").alias("start")).distinct()
    entered = exits.filter("start > 0").join(landed.hint("merge"), ["path", "start"], "left_semi")
    jumps = stored_exits = stored(exits.filter("start = 0").unionByName(entered.select(exits.columns)), "jumps")
    reached = stored(jumps.filter("start = 0").select("path", "start"), "reached")
    while True:
        over = jumps.select("path", "start", "exit")
        ahead = reached.join(over, ["path", "start"]).select("path", F.col("exit").alias("start"))
        more = ahead.join(stored_exits.select("path", "start"), ["path", "start"]).join(reached, ["path", "start"], "left_anti").distinct()
        more = stored(more, "reached")
        if more.isEmpty():
            break
        reached = stored(reached.unionByName(more), "reached")
        twice = over.select("path", F.col("start").alias("exit"), F.col("exit").alias("then"))
        jumps = stored(over.join(twice, ["path", "exit"]).select("path", "start", F.col("then").alias("exit")), "jumps")
    last = reached.join(stored_exits, ["path", "start"]).groupBy("path", "length").agg(F.max("exit").alias("end"), F.min("exit").alias("least"))
    broken = last.filter("end <> length OR least < 0").limit(5).collect()
    if broken:
        raise ValueError(f"no chain of records to the end of: {[x['path'] for x in broken]}")
    return reached


RECORDS = "path string, start long, record_type string, page_id long, refers_to long, payload_digest string, payload_bytes long, payload binary"


def read_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE) -> DataFrame:
    """Every record: its place, type, ids, digest, the length of the full payload, and its payload.

    The payload of a revisit is null. A response whose payload does not have its digest is an error.
    """
    ranges, tasks = ranges_of(spark, folder, range_bytes)
    # a given number of partitions is not merged, however small the rows that name the ranges are
    found = stored(candidates(ranges.repartition(tasks, "path", "part")), "candidates")
    # A file without any record at its first byte has no chain; it may not pass unseen.
    whole = ranges.filter("part = 0").select("path").join(found.filter("start = 0").select("path"), "path", "left_anti").limit(1)
    if not whole.isEmpty():
        raise ValueError(f"no record at the start of {whole.first()['path']}")
    reached = entries(found).withColumn("part", F.floor(F.col("start") / range_bytes))
    begins = reached.groupBy("path", "part").agg(F.min("start").alias("entry"))
    todo = ranges.join(begins.hint("merge"), ["path", "part"]).repartition(tasks, "path", "part")

    def number(value: bytes | None) -> int | None:
        hit = re.fullmatch(rb"<urn:page:(-?\d+)>", value or b"")
        return int(hit[1]) if hit else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = Source()
        for batch in batches:
            for x in batch.to_pylist():
                at, stop, out = x["entry"], x["stop"], []
                window, origin = Window(source, x["path"], at, stop, x["length"]), at
                while at < stop:
                    fields, body = window.header(at - origin)
                    size = int(fields[b"content-length"])
                    block = window.bytes(body, size)
                    http, _, payload = block.partition(END.encode())
                    length = int(re.search(rb"(?i)^content-length: *(\d+)", http, re.M)[1])
                    kind, digest = fields[b"warc-type"].decode(), fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload without its digest at {at} of {x['path']}")
                    ids = (number(fields.get(b"warc-record-id")), number(fields.get(b"warc-refers-to")))
                    out.append((x["path"], at, kind, *ids, digest, length, payload if kind == "response" else None))
                    at = origin + body + size + len(END)
                yield _records(out)

    return todo.mapInArrow(read, RECORDS)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.record_batch([pa.array(c, kinds[k.split()[1]]) for c, k in zip(columns, RECORDS.split(", "))], names=names)


def op2_warc(spark, sf_dir):
    folder = scratch_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
