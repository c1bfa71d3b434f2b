"""Web archives: writing records, reading them back, and an index merged from sorted runs.

``write_archives`` writes a record per page. Of pages with equal payloads of at least ``SMALLEST_REVISIT`` bytes the one
with the smallest page id is the response; the others are revisits that name it and hold no payload. Payloads
cross the network once; a payload that many pages share is spread over ``SALTS`` parts.

``read_archives`` parses records by their declared lengths. Files are read as a stream of records, so a task holds one
record at a time; a payload that happens to contain the record separator is put together again. Payloads are UTF-8.

``merged_index`` is an external merge: every archive gives a run of captures sorted by URL key and time; the key space
is cut into ranges of similar size (on key, time, page and place, so one address with very many captures is cut too);
each range merges its parts of the runs through a loser tree. The result is written with its global rank.

A null payload is empty, a null address or page id is left out of the record and read back as null; line breaks in addresses
are percent-encoded. Missing page ids come last: they are revisits of a page with an id, if there is one. Repeated
rows with the smallest id are responses all. An empty table gives an empty index. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltide.session import stage, staging_path

SMALLEST_REVISIT = 100
SALTS = 16
RECORDS_PER_FILE = 20_000
VERSION, BREAK = "WARC/1.1\r\n", "\r\n"
SEPARATOR = BREAK * 2 + VERSION
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_CAPTURE = 1_700_000_000

ENTRY = (
    "url_key string, captured string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, archive string, place long, length long"
)
NAMES = [field.split()[0] for field in ENTRY.split(", ")]
ORDER = ("url_key", "captured", "page_id", "archive", "place")


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a missing value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(BREAK)), F.lit(""))


def _record_id(page_id: Column, digest: Column) -> Column:
    hashed = F.md5(F.concat_ws("/", page_id.cast("string"), digest).cast("binary"))
    spelled = F.regexp_replace(hashed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), spelled, F.lit(">"))


def classified(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest, record type and, for revisits, the page they refer to."""
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)}
    )
    shared = stage(
        own.filter(F.col("payload_bytes") >= SMALLEST_REVISIT)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null")
        .select("payload_digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")),
        "shared-payloads",
    )
    salted = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return salted.join(shared, ["payload_digest", "salt"], "left").select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first")).alias("refers_to"),
    )


def record(page: DataFrame) -> Column:
    """The record of a classified page, without the separator behind it."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(BREAK * 2),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    address = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    captured = F.date_format(
        F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    return F.concat(
        F.lit(VERSION),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _header("WARC-Date", captured),
        _header("WARC-Target-URI", address),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), F.col("payload_digest")))),
        _header("X-Page-ID", F.col("page_id")),
        _header("X-Refers-To-Page-ID", F.col("refers_to")),
        _header("X-Payload-Length", F.col("payload_bytes")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)),
        F.lit(BREAK),
        block,
    )


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> str:
    """Write gzipped archives below ``path``; the text sink writes the two line breaks behind every record."""
    written = classified(pages)
    written.select(record(written).alias("value")).write.options(
        lineSep=BREAK * 2, compression="gzip", maxRecordsPerFile=records_per_file
    ).text(path)
    return path


def url_key(url: str | None) -> str:
    """Host labels from the top down, then path and query: the order in which captures of a site lie together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url.strip().lower()
    host = re.sub(r"^www\d*\.", "", host)
    shown = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{shown}){parts.path or '/'}{query}".lower()


def parse(fields: str, block: bytes) -> dict:
    """An index entry (without its place) of one record."""
    headers = dict(line.split(": ", 1) for line in fields.split(BREAK) if ": " in line)
    number = lambda name: int(headers[name]) if name in headers else None
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = number("X-Payload-Length")
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"record {headers['WARC-Record-ID']} does not hold the payload it declares")
    address = headers.get("WARC-Target-URI")
    return {
        "url_key": url_key(address),
        "captured": headers["WARC-Date"],
        "page_id": number("X-Page-ID"),
        "url": address,
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload_bytes": size,
        "payload_digest": digest,
    }


class Records:
    """Puts the records of one archive together from the texts between separators."""

    def __init__(self, archive: str):
        self.archive, self.place, self.open = archive, 0, ""

    def add(self, text: str) -> dict | None:
        if self.open:
            text = self.open + SEPARATOR + text
        elif not self.place:
            text = text.removeprefix(VERSION)
        fields, found, rest = text.partition(BREAK * 2)
        length = int(re.search(r"(?:^|\r\n)Content-Length: (\d+)", fields)[1])
        block = rest.encode()
        if not found or len(block) < length:  # the payload holds a separator; its other part follows
            self.open = text
            return None
        if block[length:].strip(b"\r\n"):
            raise ValueError(f"{self.archive}: a record is longer than it declares")
        whole = len(VERSION) + len(fields.encode()) + 4 + length
        entry = parse(fields, block[:length]) | {"archive": self.archive, "place": self.place, "length": whole}
        self.place, self.open = self.place + whole + 4, ""
        return entry


def sort_key(entry: dict) -> tuple:
    page = entry["page_id"]
    return entry["url_key"], entry["captured"], page is not None, page or 0, entry["archive"], entry["place"]


def _batch(entries: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(entries, schema=_SCHEMA)


_KINDS = {"string": pa.string(), "long": pa.int64()}
_SCHEMA = pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in ENTRY.split(", "))])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all records; those of one archive form a sorted run, and a run stays in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, entries = None, []
        for batch in batches:
            for archive, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if records is None or records.archive != archive:
                    if records is not None:
                        yield _batch(sorted(entries, key=sort_key))
                    records, entries = Records(archive), []
                if entry := records.add(text.as_py()):
                    entries.append(entry)
        if records is not None:
            if records.open:
                raise ValueError(f"{records.archive}: the last record is cut off")
            yield _batch(sorted(entries, key=sort_key))

    lines = spark.read.option("lineSep", SEPARATOR).text(path)
    return lines.select(F.col("_metadata.file_name"), "value").mapInArrow(run, ENTRY)


class LoserTree:
    """Merges sorted lists: inner nodes hold the loser of their game, so the next entry costs one path of games."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(run) for run in runs]
        self.heads = [next(run, None) for run in self.runs]
        self.k = max(1, len(runs))
        self.losers = [-1] * self.k
        self.winner = self._play(1) if len(runs) > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        first, second = self.heads[a], self.heads[b]
        return first is not None and (second is None or first <= second)

    def _play(self, node: int) -> int:
        """The winner below a node; leaves are the nodes from k on."""
        if node >= self.k:
            return node - self.k
        left, right = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (left, right) if self._beats(left, right) else (right, left)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator[tuple]:
        while self.heads and (entry := self.heads[self.winner]) is not None:
            yield entry
            run = self.winner
            self.heads[run] = next(self.runs[run], None)
            node = (run + self.k) // 2
            while node:
                if self._beats(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merged_index(entries: DataFrame, ranges: int | None = None) -> DataFrame:
    """All entries in one order, with ``rank`` from 0: captures of an address lie together in the order of time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[list[tuple]]] = {}
        for batch in batches:
            for entry in batch.to_pylist():
                item = (sort_key(entry), entry)
                parts = runs.setdefault(entry["archive"], [])
                if parts and parts[-1][-1][0] <= item[0]:
                    parts[-1].append(item)
                else:  # the part of a run that another task has sent
                    parts.append([item])
        flat = [[(key, n, k) for k, (key, _) in enumerate(part)] for n, part in enumerate(sum(runs.values(), []))]
        held = sum(runs.values(), [])
        merged = [held[n][k][1] for _, n, k in LoserTree(flat)]
        part = TaskContext.get().partitionId()
        for at in range(0, len(merged), 10_000):
            rows = [e | {"part": part, "at": at + k} for k, e in enumerate(merged[at : at + 10_000])]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([*_SCHEMA, ("part", pa.int32()), ("at", pa.int64())])
    runs = stage(entries, "capture-runs")
    keys = [F.col(c) for c in ORDER]
    spread = runs.repartitionByRange(ranges, *keys) if ranges else runs.repartitionByRange(*keys)
    merged = stage(spread.mapInArrow(run, f"{ENTRY}, part int, at long"), "capture-index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = merged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return merged.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("at")).drop("start", "at")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder, read them back, merge the index."""
    spark = pages.sparkSession
    path = write_archives(pages, staging_path(spark, "archives"))
    return merged_index(read_archives(spark, path))
