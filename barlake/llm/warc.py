"""WARC archives of page captures, and their index merged from sorted runs.

Writing: captures with equal payloads become one response and revisits of it. Each task writes one
archive, sorted by url key and time: a sorted capture run. Reading: archives are parsed into index
entries, which are dealt out in ranges of url key and time; each range merges its slices of all runs
with a loser tree, so the histories of all urls come out in one global order.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, ship
from barlake.llm.url_filter import with_parts

# The base32 alphabet, the line end of the format, the end of a record.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LINE = "\r\n"
END = "\r\n\r\n"

INDEX = (
    "run string, url_key string, captured timestamp, capture_id bigint, payload_bytes bigint,"
    " payload_digest string, record_type string, refers_to bigint, offset bigint"
)


def base32(hex_text: Column) -> Column:
    """Base32 of a hex text whose length is a multiple of 5 (no padding), 20 bits at a time."""
    bits = F.transform(
        F.sequence(F.lit(0), (F.length(hex_text) / 5).cast("int") - 1),
        lambda i: F.conv(F.substr(hex_text, (i * 5 + 1).cast("int"), F.lit(5)), 16, 10).cast("int"),
    )
    letters = F.transform(bits, lambda b: F.concat(*(
        F.substr(F.lit(BASE32), F.shiftright(b, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)
    )))
    return F.array_join(letters, "")


def with_url_key(frame: DataFrame) -> DataFrame:
    """Adds the sort key of ``url``: host labels from the right, then path and query. Empty if there is
    no host."""
    parts = with_parts(frame, "url", "_")
    turned = F.concat(F.array_join(F.reverse(F.split(F.col("_host"), r"\.")), ","), F.lit(")"))
    key = F.coalesce(F.concat(turned, F.substr("_key", F.length("_host") + 1)), F.lit(""))
    return parts.withColumn("url_key", key).select(*frame.columns, "url_key")


def with_records(captures: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Digest, size and record type of ``captures(capture_id, captured, url, payload)``.

    Of captures with equal payloads (same SHA-1) of at least ``min_bytes`` bytes, the one with the
    largest id is the response; others revisit it and leave their payload out. A null payload is empty,
    and null ids count as smallest. Rows that repeat the largest id are all responses.
    Payload groups are combined before they are shuffled, and the join has one row per payload on one
    side, so a payload that a third of all captures share can be split on the other.
    """
    payload = F.coalesce(F.col("payload"), F.lit(""))
    sized = captures.withColumn("payload", payload).withColumns({
        "payload_bytes": F.octet_length(payload).cast("bigint"), "_sha": F.sha1(payload),
    })
    first = sized.groupBy("_sha").agg(F.max("capture_id").alias("_first"))
    typed = with_url_key(sized.join(first, "_sha"))
    again = (F.col("payload_bytes") >= min_bytes) & ~F.col("capture_id").eqNullSafe(F.col("_first"))
    return typed.select(
        "capture_id", "captured", "url", "url_key", "payload_bytes",
        base32(F.col("_sha")).alias("payload_digest"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_first")).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def _record() -> tuple[Column, Column]:
    """A record as text, without the four bytes that end it, and its block, to be named ``_http``."""
    def name(number: str) -> Column:
        return F.concat(F.lit("<urn:capture:"), F.coalesce(F.col(number).cast("string"), F.lit("none")), F.lit(">"))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END), F.coalesce(F.col("payload"), F.lit("")),
    )
    lines = F.concat_ws(
        LINE,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), name("capture_id")),
        F.concat(F.lit("WARC-Date: "), F.date_format(
            F.to_utc_timestamp("captured", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
        )),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Refers-To: "), F.when(F.col("record_type") == "revisit", name("refers_to"))),
        F.when(F.col("record_type") == "revisit", F.lit(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("_http").cast("string")),
    )
    return F.concat(lines, F.lit(END), F.col("_http")), http


def write_archives(captures: DataFrame, path: str, min_bytes: int = 0, compression: str = "gzip") -> None:
    """Write ``captures(capture_id, captured, url, payload)`` as WARC files, one sorted run per task.

    A record ends with two line ends, which the text writer puts behind each row.
    """
    record, http = _record()
    rows = with_records(captures, min_bytes).sortWithinPartitions("url_key", "captured", "capture_id")
    rows = rows.withColumn("_http", http).select(record.alias("value"))
    rows.write.option("compression", compression).option("lineSep", END).text(path)


class _Stream:
    """Bytes of an archive, inflated piece by piece; what has been read is let go."""

    def __init__(self, content: memoryview, piece: int = 1 << 20):
        self.source, self.at, self.piece = content, 0, piece
        self.inflate = zlib.decompressobj(31) if bytes(content[:2]) == b"\x1f\x8b" else None
        self.buffer, self.offset = bytearray(), 0

    def _more(self) -> bool:
        if self.at >= len(self.source):
            return False
        part = self.source[self.at:self.at + self.piece]
        self.at += len(part)
        if self.inflate is None:
            self.buffer += part
            return True
        while len(part):
            self.buffer += self.inflate.decompress(part)
            part = self.inflate.unused_data
            if self.inflate.eof:  # the next gzip member, if any
                self.inflate = zlib.decompressobj(31)
        return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError(f"archive ends within a record at byte {self.offset}")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.offset += n
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``; None at the end of the archive."""
        start = 0
        while (found := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark))
            if not self._more():
                if self.buffer.strip():
                    raise ValueError(f"archive ends within a header at byte {self.offset}")
                return None
        return self.take(found + len(mark))


def _number(urn: str | None) -> int | None:
    digits = re.fullmatch(r"<urn:capture:(-?\d+)>", urn or "")
    return int(digits[1]) if digits else None


def parse_archive(content: bytes) -> Iterator[dict]:
    """Records of an archive, with their payloads (None for revisits). Broken digests raise."""
    stream = _Stream(memoryview(content))
    while True:
        offset = stream.offset
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        fields = dict(
            line.split(": ", 1) for line in head.decode("utf-8", "replace").strip().split("\r\n")[1:]
        )
        block = stream.take(int(fields["Content-Length"]))
        stream.take(len(END))
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit:
            if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"payload differs from its digest at byte {offset}")
        yield {
            "url": fields.get("WARC-Target-URI"), "date": fields.get("WARC-Date"),
            "capture_id": _number(fields["WARC-Record-ID"]), "payload_bytes": size,
            "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": _number(fields.get("WARC-Refers-To")), "offset": offset,
            "payload": None if revisit else payload,
        }


_PARSED = (
    "run string, url string, date string, capture_id bigint, payload_bytes bigint, payload_digest string,"
    " record_type string, refers_to bigint, offset bigint"
)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("run", pa.string()), ("url", pa.string()), ("date", pa.string()), ("capture_id", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("offset", pa.int64()),
    ])
    for batch in batches:
        for i in range(batch.num_rows):
            run, rows = batch.column(0)[i].as_py(), []
            for record in parse_archive(batch.column(1)[i].as_buffer()):
                del record["payload"]
                rows.append({"run": run} | record)
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives below ``path``, in the order of each archive. One archive is read
    by one task and has to fit it; archives are as large as the partitions they were written from."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    parsed = files.mapInArrow(_index_rows, _PARSED)
    return with_url_key(parsed).select(
        "run", "url_key", F.to_timestamp("date").alias("captured"),
        "capture_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "offset",
    )


class LoserTree:
    """Merge of sorted sequences: each inner node keeps the loser of its match, the top the winner.

    Taking the smallest key replays one path from a leaf to the top. Equal keys leave in the order of
    the sequences.
    """

    def __init__(self, runs: Sequence[Sequence]):
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.tree = [-1] * max(self.k, 1)
        for run in range(self.k):
            self._replay(run)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run ``a`` comes before run ``b``; finished runs come last."""
        done_a, done_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if done_a or done_b:
            return done_b and (not done_a or a < b)
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return (x, a) < (y, b)

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:  # while the tree is filled: wait for the opponent
                self.tree[node] = winner
                return
            if self._beats(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """``(run, place in it)`` in merged order."""
        while self.k:
            run = self.tree[0]
            place = self.at[run]
            if place >= len(self.runs[run]):
                return
            self.at[run] = place + 1
            yield run, place
            self._replay(run)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of a range. They arrive one after the other, each sorted."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    table = table.combine_chunks()
    # None sorts first, as in the range partitioning.
    keys = list(zip(*(
        [(v is not None, v) for v in column.to_pylist()] for column in (
            table["url_key"], table["captured"].cast(pa.int64()), table["capture_id"]
        )
    )))
    names, starts = table["run"].to_pylist(), []
    for i, name in enumerate(names):
        if i == 0 or name != names[i - 1]:
            starts.append(i)
    ends = [*starts[1:], len(names)]
    order = [starts[run] + place for run, place in LoserTree([keys[a:b] for a, b in zip(starts, ends)])]
    for i in range(0, len(order), 8192):
        yield from table.take(pa.array(order[i:i + 8192])).to_batches()


def merged_index(index: DataFrame, scratch: Scratch) -> DataFrame:
    """All capture histories in the order of url key, time and id, over partitions in order.

    The index is stored once, since range partitioning samples it. Ranges are cut within a url's
    captures too, so a url with a third of all captures takes a third of the tasks. A task holds the
    index entries of its range (some 200 bytes each), not their payloads.
    """
    runs = scratch.save(index, "index")
    ranges = runs.repartitionByRange("url_key", "captured", "capture_id", "run", "offset")
    return ranges.sortWithinPartitions("run", "url_key", "captured", "capture_id").mapInArrow(_merge, INDEX)


def archive_and_index(captures: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``captures(capture_id, captured, url, payload)`` to archives in the shared folder, read
    them back, and return their merged index. Other columns are ignored; an empty table gives no rows."""
    spark = captures.sparkSession
    scratch = Scratch(spark, "warc")
    write_archives(captures.select("capture_id", "captured", "url", "payload"), scratch.path("archives"), min_bytes)
    return merged_index(read_index(spark, scratch.path("archives")), scratch)
