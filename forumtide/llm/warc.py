"""WARC archives with revisit records, and a merged capture index.

Writing: one record per page through Spark's text writer, whose line separator is the two
line ends that close a WARC record; archives are gzip files. Of equal payloads of
``REVISIT_BYTES`` or more, the smallest page_id is stored and the others refer to it.

Reading: archives are read by Spark as chunks between version lines, in order, and chunks are
joined until the record's Content-Length is met, so a payload may hold anything. One record
is in memory at a time, whatever the size of an archive. Digests are checked.

Index: every task leaves its captures as a locally sorted run. Ranges of (URL key, time, id)
are dealt out, and each range merges the runs that reach it with a tournament of losers. Read
in partition order the result is one globally ordered capture history.

Defined results: a null html is an empty payload; a null url gets a ``urn:page`` target. Rows
with equal page_id and payload are all responses if theirs is the smallest id. A null page_id
never is the one referred to; if all ids of a payload are null, all are responses. An empty
table gives an empty archive and no rows. Input columns other than page_id, url and html are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumtide.session import materialize, scratch_path

REVISIT_BYTES = 100
VERSION = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
EPOCH = "2024-01-01 00:00:00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE_SCHEMA = (
    "url_key string, captured_at string, page_id bigint, payload_bytes bigint, "
    "payload_digest string, record_type string, refers_to bigint, record_id string, "
    "target_uri string, archive string, record_offset bigint"
)


def url_key(url: Column) -> Column:
    """Sort-friendly form: reversed host, a bracket, then path and query in lower case."""
    parts = r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\d*\.)?([^/?#:]*)(?::\d*)?([^#]*)"
    lower = F.lower(url)
    host = F.regexp_extract(lower, parts, 1)
    rest = F.regexp_extract(lower, parts, 2)
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(host == "", lower).otherwise(
        F.concat(reversed_host, F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))
    )


def _capture_time(page_id: Column) -> Column:
    """The pages carry no capture time; ids stand for seconds since ``EPOCH``."""
    seconds = F.coalesce(F.pmod(page_id, F.lit(1 << 31)), F.lit(0)).cast("int")
    at = F.expr(f"timestamp_ntz'{EPOCH}'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _record_id(page_id: Column, digest: Column) -> Column:
    hashed = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("none")), digest))
    return F.regexp_replace(hashed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _target(url: Column, page_id: Column) -> Column:
    """The url on one header line: control characters become percent escapes."""
    named = F.coalesce(
        url, F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))
    )
    for code in (9, 10, 13):
        named = F.replace(named, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return named


def _header(name: str, value: Column) -> Column:
    """One header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def decided(pages: DataFrame) -> DataFrame:
    """Pages with digest, record type and the page referred to.

    Only payloads seen more than once are looked up: a reduced, stored table.
    """
    payload = F.coalesce("html", F.lit(""))
    records = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
    )
    repeated = (
        records.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("_ft_digest"))
        .agg(
            F.min("page_id").alias("_ft_first"),
            F.min_by("url", F.col("page_id")).alias("_ft_url"),
            F.count(F.lit(1)).alias("_ft_n"),
        )
        .where((F.col("_ft_n") > 1) & F.col("_ft_first").isNotNull()).drop("_ft_n")
    )
    repeated = materialize(repeated, "repeated-payloads")
    revisit = F.col("_ft_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_ft_first"))
    joined = records.join(
        repeated,
        (F.col("payload_digest") == F.col("_ft_digest"))
        & (F.col("payload_bytes") >= REVISIT_BYTES),
        "left",
    )
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_ft_first")).alias("refers_to"),
        F.when(revisit, F.col("_ft_url")).alias("_ft_url"),
    )


def record_text(pages: DataFrame) -> DataFrame:
    """One column ``value``: the record without the two line ends that close it."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    stored = F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    first_time = F.when(revisit, _capture_time(F.col("refers_to")))
    first_url = F.when(revisit, _target(F.col("_ft_url"), F.col("refers_to")))
    first_id = F.when(revisit, _record_id(F.col("refers_to"), F.col("payload_digest")))
    return pages.select(F.concat(
        F.lit(VERSION),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _header("WARC-Date", _capture_time(F.col("page_id"))),
        _header("WARC-Target-URI", _target(F.col("url"), F.col("page_id"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Page-ID", F.col("page_id")),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("WARC-Refers-To", first_id),
        _header("WARC-Refers-To-Target-URI", first_url),
        _header("WARC-Refers-To-Date", first_time),
        _header("WARC-Refers-To-Page-ID", F.col("refers_to")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length(http) + stored),
        F.lit("\r\n"), http,
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    ).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    record_text(decided(pages)).write.option("lineSep", RECORD_END).option(
        "compression", "gzip"
    ).text(path)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {
        name.strip().lower(): value.strip()
        for name, found, value in (line.partition(":") for line in lines) if found
    }


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _capture(head: bytes, block: bytes, archive: str, at: int) -> tuple:
    """A record's row; the digest of a stored payload is computed again and compared."""
    fields = _fields(head)
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    size = int(_fields(http).get("content-length", len(payload)))
    if fields["warc-type"] == "response":
        found = hashlib.sha256(payload).hexdigest()
        if found != digest or len(payload) != size:
            raise ValueError(f"{archive}: damaged payload at byte {at}")
    return (
        _number(fields.get("warc-page-id")), size, digest, fields["warc-type"],
        _number(fields.get("warc-refers-to-page-id")), fields.get("warc-record-id"),
        fields.get("warc-target-uri"), fields.get("warc-date"), archive, at,
    )


class _Joiner:
    """Puts the chunks of one archive back together by Content-Length."""

    def __init__(self, archive: str):
        self.archive = archive
        self.at = 0  # byte offset of the open record
        self.parts: list[bytes] = []
        self.size = 0
        self.wanted: int | None = None
        self.begun = False

    def feed(self, chunk: bytes) -> tuple | None:
        if not self.begun:
            self.begun = True
            if not chunk:
                return None  # before the first version line
            raise ValueError(f"{self.archive}: does not begin with a record")
        if self.parts:
            chunk = VERSION.encode() + chunk
        self.parts.append(chunk)
        self.size += len(chunk)
        if self.wanted is None:
            head, found, _ = b"".join(self.parts).partition(b"\r\n\r\n")
            if not found:
                return None
            self.head = head
            self.wanted = len(head) + 4 + int(_fields(head)["content-length"]) + len(RECORD_END)
        if self.size < self.wanted:
            return None
        if self.size > self.wanted:
            raise ValueError(f"{self.archive}: record at byte {self.at} has a wrong length")
        whole, at = b"".join(self.parts), self.at
        block = whole[len(self.head) + 4:-len(RECORD_END)]
        row = _capture(self.head, block, self.archive, at)
        self.at += len(VERSION) + self.size
        self.parts, self.size, self.wanted = [], 0, None
        return row

    def close(self) -> None:
        if self.parts:
            raise ValueError(f"{self.archive}: ends within the record at byte {self.at}")


_READ = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
    ("target_uri", pa.string()), ("captured_at", pa.string()), ("archive", pa.string()),
    ("record_offset", pa.int64()),
])
_READ_DDL = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, record_id string, target_uri string, captured_at string, "
    "archive string, record_offset bigint"
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    joiner = None
    for batch in batches:
        rows = []
        for archive, chunk in zip(batch.column(0), batch.column(1)):
            name = archive.as_py()
            if joiner is None or joiner.archive != name:
                if joiner is not None:
                    joiner.close()
                joiner = _Joiner(name)
            row = joiner.feed(chunk.as_py())
            if row is not None:
                rows.append(row)
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _READ.types)]
            yield pa.RecordBatch.from_arrays(columns, schema=_READ)
    if joiner is not None:
        joiner.close()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Captures of gzip archives. A gzip file is read front to back by one task."""
    chunks = spark.read.option("lineSep", VERSION).option("pathGlobFilter", "*.gz").text(path)
    located = chunks.select(
        F.col("_metadata.file_path").alias("archive"), F.col("value").cast("binary")
    )
    return located.mapInArrow(_parse, _READ_DDL)


def write_runs(captures: DataFrame, path: str) -> None:
    """Each task's captures, sorted by URL key, time and id, as one run."""
    keyed = captures.withColumn("url_key", F.coalesce(url_key(F.col("target_uri")), F.lit("")))
    columns = [field.split()[0] for field in CAPTURE_SCHEMA.split(", ")]
    keyed.select(*columns).sortWithinPartitions("url_key", "captured_at", "page_id").write.parquet(
        path
    )


def merge_runs(runs: Sequence[Iterator], key: Callable) -> Iterator:
    """K-way merge with a tree of losers: one comparison per level for every item.

    Inner node i holds the loser of the match played there; the overall winner is replayed
    along its path only. Ties go to the earlier run.
    """
    k = len(runs)
    heads: list[tuple | None] = []
    for run in runs:
        item = next(run, None)
        heads.append(None if item is None else (key(item), item))

    def beats(a: int, b: int) -> bool:
        one, two = heads[a], heads[b]
        if one is None or two is None:
            return two is None and (one is not None or a < b)
        return one[0] < two[0] or (one[0] == two[0] and a < b)

    losers = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    winner = winners[1] if k > 1 else 0
    while k and heads[winner] is not None:
        yield heads[winner][1]
        item = next(runs[winner], None)
        heads[winner] = None if item is None else (key(item), item)
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2


def _merge_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive run by run; a step down in the order begins the next run."""
    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held)
    ids = rows["page_id"].to_pylist()
    keys = list(zip(
        rows["url_key"].to_pylist(), rows["captured_at"].to_pylist(),
        [(i is not None, i or 0) for i in ids],
    ))
    starts = [0] + [i for i in range(1, len(keys)) if keys[i] < keys[i - 1]] + [len(keys)]
    runs = [iter(range(a, b)) for a, b in zip(starts, starts[1:])]
    order = pa.array(merge_runs(runs, keys.__getitem__), pa.int64())
    yield from rows.take(order).combine_chunks().to_batches()


def merged_index(spark: SparkSession, path: str) -> DataFrame:
    """The capture history over all runs, globally ordered by URL key, time and id.

    Ranges are cut by the whole key, so a URL with most of the captures spans many of them.
    """
    runs = spark.read.schema(CAPTURE_SCHEMA).parquet(path)
    ranges = runs.repartitionByRange("url_key", "captured_at", "page_id")
    return ranges.mapInArrow(_merge_partition, CAPTURE_SCHEMA)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back, merge their index."""
    spark = pages.sparkSession
    archives, runs = scratch_path(spark, "warc"), scratch_path(spark, "runs")
    write_archives(pages, archives)
    write_runs(read_archives(spark, archives), runs)
    return merged_index(spark, runs)
