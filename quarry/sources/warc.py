"""S1-S3 WARC/WET scan, F1 record-type predicate, P1-P3 extraction.

The scan is a Python Data Source (``warc``): a file is a partition (gzip
members cannot be split), read as a stream - inflated member by member, parsed
record by record and handed on in Arrow batches of a few MB - so a task needs
memory for one record and one batch whatever the file's size.  A filter on
``warc_type`` is pushed into the scan: records of other types are skipped
without being kept.
"""

from __future__ import annotations

import io
import json
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull

from quarry.functions import text as T
from quarry.functions.html import decode_bytes, html_to_text, strip_http_header

RECORD_SCHEMA = ("path string, record_no int, warc_type string, target_uri string, "
                 "warc_date string, content binary")
_COLUMNS = ["path", "record_no", "warc_type", "target_uri", "warc_date", "content"]
_BATCH_BYTES, _BATCH_ROWS = 8 << 20, 4096
_CHUNK = 1 << 16
_MAX_HEADER = 1 << 20  # a record header that does not end by then is damage, not a header


class _Bytes:
    """Forward reader over a raw stream: plain, or gzip of any number of members."""

    def __init__(self, raw):
        self._raw, self._buffer, self._member, self._end = raw, bytearray(), None, False
        first = raw.read(_CHUNK)
        self._rest = first
        self._gzip = first[:2] == b"\x1f\x8b"

    def _more(self) -> bool:
        """One more chunk into the buffer; False at the end."""
        if self._end:
            return False
        chunk, self._rest = self._rest or self._raw.read(_CHUNK), b""
        if not chunk:
            self._end = True
            return False
        if not self._gzip:
            self._buffer += chunk
            return True
        if self._member is None or self._member.eof:
            self._member = zlib.decompressobj(16 + zlib.MAX_WBITS)
        self._buffer += self._member.decompress(chunk, 1 << 22)  # at most 4 MB at a time
        self._rest = self._member.unused_data if self._member.eof else self._member.unconsumed_tail
        return True

    def until(self, mark: bytes, most: int) -> bytes | None:
        """Bytes up to and with ``mark``; None when it does not come within ``most`` bytes."""
        seen = 0
        while True:
            at = self._buffer.find(mark, max(0, seen - len(mark)))
            if at >= 0:
                return self.take(at + len(mark))
            seen = len(self._buffer)
            if seen > most or not self._more():
                return None

    def seek(self, mark: bytes) -> bool:
        """Go to the next ``mark``; False when there is none."""
        while True:
            at = self._buffer.find(mark)
            if at >= 0:
                del self._buffer[:at]
                return True
            del self._buffer[:max(0, len(self._buffer) - len(mark) + 1)]
            if not self._more():
                return False

    def take(self, n: int) -> bytes:
        while len(self._buffer) < n and self._more():
            pass
        out = bytes(self._buffer[:n])
        del self._buffer[:n]
        return out

    def skip(self, n: int) -> None:
        while n > 0:
            if not self._buffer and not self._more():
                return
            got = min(n, len(self._buffer))
            del self._buffer[:got]
            n -= got


def stream_records(raw, types: set[str] | None = None):
    """Yield (record_no, warc_type, target_uri, date, content) of a WARC stream.

    ``types``: only records of these types; others are read over.  A file that
    breaks off or is damaged gives the records before the damage.
    """
    try:
        data, no = _Bytes(raw), 0
        while data.seek(b"WARC/"):
            header = data.until(b"\r\n\r\n", _MAX_HEADER)
            if header is None:
                return
            fields = {}
            for line in header.split(b"\r\n")[1:]:
                k, _, v = line.partition(b":")
                fields[k.strip().lower()] = v.strip().decode("latin-1")
            try:
                length = max(0, int(fields.get(b"content-length", "0")))
            except ValueError:
                length = 0
            kind = fields.get(b"warc-type", "")
            if types is not None and kind not in types:
                data.skip(length)
            else:
                yield no, kind, fields.get(b"warc-target-uri") or None, fields.get(b"warc-date") or None, data.take(length)
            no += 1
    except (OSError, EOFError, zlib.error):
        return


def _batches(path: str, records):
    rows, size = [], 0
    kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _COLUMNS)

    for record in records:
        rows.append((path, *record))
        size += len(record[-1])
        if size >= _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def _open(path: str):
    """Input stream of a file on any file system that pyarrow knows."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem().open_input_stream(path, compression=None)
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner, compression=None)


class WarcReader(DataSourceReader):
    def __init__(self, files: list[str], types: set[str] | None):
        self.files, self.types = files, types

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("warc_type",):
                wanted = {f.value}
            elif isinstance(f, In) and f.attribute == ("warc_type",):
                wanted = set(f.value)
            elif isinstance(f, IsNotNull) and f.attribute == ("warc_type",):
                continue  # a record's type is a string, "" where the header has none
            else:
                yield f  # stays with Spark
                continue
            self.types = wanted if self.types is None else self.types & wanted

    def partitions(self):
        return [InputPartition(f) for f in self.files]

    def read(self, partition):
        with _open(partition.value) as raw:
            yield from _batches(partition.value, stream_records(raw, self.types))


class WarcSource(DataSource):
    """``spark.read.format("warc")``: options ``files`` (JSON list of paths) and ``types`` (JSON list, optional)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return RECORD_SCHEMA

    def reader(self, schema):
        types = self.options.get("types")
        return WarcReader(json.loads(self.options["files"]), set(json.loads(types)) if types else None)


def records_from_files(files: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Parse a (path, content) DataFrame of WARC files into records."""
    wanted = set(types) if types else None

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                if content.is_valid:
                    yield from _batches(path, stream_records(io.BytesIO(content.as_buffer()), wanted))

    return files.select("path", "content").mapInArrow(run, RECORD_SCHEMA)


#: File systems that the tasks open themselves; others are read by Spark's ``binaryFile`` (a file in memory).
_STREAMED = ("file", "hdfs", "s3", "s3a", "gs")


def read_warc(spark: SparkSession, path: str, types: list[str] | None = None) -> DataFrame:
    """S1-S3 scan: path may be a file, folder or glob (``.warc``/``.warc.gz``/``.wet``).

    ``types`` keeps records of these types only; a filter on ``warc_type`` has
    the same effect when ``spark.sql.python.filterPushdown.enabled`` is on
    (:func:`quarry.session.get_spark` turns it on).
    """
    source = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true").load(path)
    files = [r["path"] for r in source.select("path").orderBy("path").collect()]  # names only: contents are pruned
    if any(f.split(":", 1)[0] not in _STREAMED for f in files):
        return records_from_files(source.select("path", "content"), types)
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc").option("files", json.dumps([f.replace("s3a:", "s3:", 1) for f in files]))
    return (reader.option("types", json.dumps(sorted(types))) if types else reader).load()


def response_texts(records: DataFrame) -> DataFrame:
    """Response records -> strip HTTP header -> skip empty -> decode -> HTML text."""
    r = records.filter(F.col("warc_type") == "response")
    body = strip_http_header("content")
    r = r.withColumn("body", body).filter(F.length("body") > 0)
    header = F.substring_index(F.decode(F.substring("content", 1, 8192), "ISO-8859-1"), "\r\n\r\n", 1)
    return r.withColumn("html", decode_bytes("body", header)).withColumn("text", html_to_text("html"))


def conversion_texts(records: DataFrame) -> DataFrame:
    """Conversion records decoded as UTF-8 with replacement characters."""
    r = records.filter(F.col("warc_type") == "conversion")
    return r.withColumn("text", F.make_valid_utf8(F.col("content").cast("string")))


def is_long(text: str, min_words: int = 100):
    """S3: more than ``min_words`` whitespace words."""
    return F.size(T.split_whitespace(text)) > min_words


def long_texts(texts: DataFrame, min_words: int = 100) -> DataFrame:
    """S3: the texts of more than ``min_words`` words."""
    return texts.filter(is_long("text", min_words))


def pages_as_warc(pages: DataFrame) -> DataFrame:
    """Render (page_id, url, html) rows as WARC response files: (path, content).

    Used to exercise the parser on data derived from the shared tables.
    """
    payload = F.concat(F.lit(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"),
                       F.encode("html", "UTF-8"))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.col("url"),
                    F.lit("\r\nWARC-Date: 2024-12-01T00:00:00Z\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    info = F.lit(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\ninfo\r\n\r\n")
    content = F.concat(info, F.encode(head, "UTF-8"), payload, F.lit(b"\r\n\r\n"))
    return pages.select(F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".warc")).alias("path"),
                        content.alias("content"))
