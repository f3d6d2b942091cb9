"""Web archives (WARC, one gzip member a record) with a two-level capture index.

Tasks write archives of bounded size into a folder that all can reach, and give a row
per record. Index: the keys (reversed host, path, page) in one global order, cut into
compressed blocks; the directory has the first and last key of each block. A lookup
finds blocks by binary search in the directory, captures by binary search in a block,
and reads each record by its byte range.

Files are reached through pyarrow's file systems (local paths, S3, GCS, HDFS)."""

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import functions as F

from meterspan.llm.text import small_batches
from meterspan.session import scratch_folder, written

#: Payloads from this size on are stored once; further copies are revisits.
SHARED = 1000
ARCHIVE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
#: Lines in a block, at least; the directory has at most DIRECTORY blocks, so it can be sent to every task.
LINES = 500
DIRECTORY = 100_000


def _plain(key):
    """``key`` without the signs that part lines and columns of a block."""
    return key.replace("%", "%25").replace("\t", "%09").replace("\n", "%0A")


def surt(url):
    """Sort key of a URL: host labels reversed, lower case, then port, path and query.
    What cannot be parsed is its own key; null is the empty key. Tab, newline and the
    percent sign are escaped in every key."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", f":{parts.port}" if parts.port else ""
    except ValueError:
        return _plain(url)
    if not host:
        return _plain(url)
    query = f"?{parts.query}" if parts.query else ""
    return _plain(f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}")


def _store(folder):
    return pafs.FileSystem.from_uri(folder)


def _record(page, url, body, kind, refers, digest):
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        f"WARC/1.1\r\nWARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{coded}",
        f"X-Payload-Length: {len(body)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers}>",
        ]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if kind == "response":
        block += body
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 3, mtime=0)


def parse(data):
    """Headers (lower-case names) and HTTP payload of one record as stored."""
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _writer(folder):
    def run(batches):
        store, root = _store(folder)
        out = name = None
        size = 0
        for batch in batches:
            keys, files, starts, lengths = [], [], [], []
            for page, url, html, kind, refers, digest in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or size >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    # A task that runs again writes another file; only rows that were committed name one.
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = _record(page, url, (html or "").encode(), kind, refers, digest)
                out.write(data)
                keys.append(surt(url))
                files.append(name)
                starts.append(size)
                lengths.append(len(data))
                size += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), batch.column(0), pa.array(files, pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                ["key", "page_id", "file", "start", "length"],
            )
        if out is not None:
            out.close()

    return run


_CAPTURE = "key string, page_id long, file string, start long, length long"


def write_archives(pages, folder):
    """Write a record for each row of ``pages`` (page_id, url, html) and return the
    captures: key, page_id, file, start, length.

    Of rows with equal html of ``SHARED`` bytes or more, those with the largest page_id
    are responses and the others revisits of it; smaller ones are all responses. A null
    html is an empty payload; null page_ids are smaller than any other."""
    small_batches(pages.sparkSession)
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"))
    large = F.octet_length("html") >= SHARED
    copies = rows.where(large).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    copies = written(copies.where("n > 1").select("digest", "first"), "archive-copies")
    known = rows.join(copies, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    ready = known.select("page_id", "url", "html", kind.alias("kind"), F.when(again, F.col("first")).alias("refers"), "digest")
    spark = pages.sparkSession
    home = spark._jvm.org.apache.hadoop.fs.Path(folder)
    home.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(home)
    return written(ready.mapInArrow(_writer(folder), _CAPTURE), "captures")


def _line(key, page, file, start, length):
    return f"{key}\t{'' if page is None else page}\t{file}\t{start}\t{length}"


def _blocks(size):
    def run(batches):
        lines, first, last = [], None, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                first, last = row[0] if not lines else first, row[0]
                lines.append(_line(*row))
                if len(lines) == size:
                    yield _packed(first, last, lines)
                    lines = []
        if lines:
            yield _packed(first, last, lines)

    return run


def _packed(first, last, lines):
    data = zlib.compress("\n".join(lines).encode(), 6)
    return pa.RecordBatch.from_arrays([pa.array([first]), pa.array([last]), pa.array([len(lines)], pa.int64()), pa.array([data])], ["first", "last", "lines", "data"])


def build_index(captures):
    """The blocks: first and last key, lines, data (compressed lines in key order)."""
    rows = captures.count()
    size = max(LINES, -(-2 * rows // DIRECTORY))
    order = ["key", "page_id", "file", "start"]
    ranged = captures.repartitionByRange(max(1, min(-(-rows // (20 * size)), 10_000)), *order).sortWithinPartitions(*order)
    blocks = ranged.select("key", "page_id", "file", "start", "length").mapInArrow(_blocks(size), "first string, last string, lines long, data binary")
    return written(blocks, "capture-index")


def directory(index):
    """The sparse directory, in key order: at most ``DIRECTORY`` first and last keys."""
    return sorted(tuple(r) for r in index.select("first", "last").collect())


def _route(entries):
    firsts, lasts = [e[0] for e in entries], [e[1] for e in entries]

    def run(batches):
        for batch in batches:
            keys, found = [], []
            for key in batch.column(0).to_pylist():
                # Blocks that may hold the key: from the first that ends at or after it.
                at = bisect.bisect_left(lasts, key)
                while at < len(firsts) and firsts[at] <= key:
                    if not found or keys[-1] != key or found[-1] != entries[at]:
                        keys.append(key)
                        found.append(entries[at])
                    at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([e[0] for e in found], pa.string()), pa.array([e[1] for e in found], pa.string())], ["key", "first", "last"]
            )

    return run


def _probe(batches):
    for batch in batches:
        out = []
        for keys, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = [x.split("\t") for x in zlib.decompress(data).decode().split("\n")]
            own = [x[0] for x in lines]
            for key in keys:
                at = bisect.bisect_left(own, key)
                while at < len(own) and own[at] == key:
                    out.append(lines[at])
                    at += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in out], pa.string()),
                pa.array([int(x[1]) if x[1] else None for x in out], pa.int64()),
                pa.array([x[2] for x in out], pa.string()),
                pa.array([int(x[3]) for x in out], pa.int64()),
                pa.array([int(x[4]) for x in out], pa.int64()),
            ],
            ["key", "page_id", "file", "start", "length"],
        )


def lookup(keys, index):
    """Captures of the distinct keys in ``keys`` (key). A key that fills many blocks is
    looked up in each of them. Keys that the index lacks give no row."""
    routed = keys.select("key").distinct().mapInArrow(_route(directory(index)), "key string, first string, last string")
    asked = written(routed.distinct().groupBy("first", "last").agg(F.collect_list("key").alias("keys")), "lookups")
    return asked.join(index, ["first", "last"]).select("keys", "data").mapInArrow(_probe, _CAPTURE)


def _reader(folder):
    def run(batches):
        store, root = _store(folder)
        name = handle = None
        for batch in batches:
            out = []
            for key, page, file, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    if handle is not None:
                        handle.close()
                    name, handle = file, store.open_input_file(f"{root}/{file}")
                handle.seek(start)
                fields, body = parse(handle.read(length))
                coded = fields["warc-payload-digest"].partition(":")[2]
                refers = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
                digest = base64.b32decode(coded).hex()
                if fields["warc-type"] == "response" and hashlib.sha1(body).hexdigest() != digest:
                    raise ValueError(f"payload of {file} at {start} does not match its digest")
                out.append((page, fields.get("warc-target-uri"), int(fields["x-payload-length"]), digest, fields["warc-type"], int(refers) if refers else None, body))
            cols = list(zip(*out)) or [()] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.large_binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
            )

    return run


def read_records(captures, folder):
    """The records of the captures, each by its byte range: page_id, url, payload_bytes,
    payload_digest (SHA-1, hex), record_type, refers_to, payload (empty for revisits).
    Captures are read in file order within a task; a payload that does not match its
    digest fails the job."""
    ordered = captures.select("key", "page_id", "file", "start", "length").sortWithinPartitions("file", "start")
    out = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return ordered.mapInArrow(_reader(folder), out)


def archived(pages, folder=None):
    """Write ``pages`` to archives, index them, look every URL up and read it back."""
    spark = pages.sparkSession
    folder = folder or scratch_folder(spark, "archives")
    captures = write_archives(pages, folder)
    index = build_index(captures)
    found = lookup(captures.select("key"), index)
    return read_records(found, folder)
