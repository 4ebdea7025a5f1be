"""WARC archives with a two-level capture index.

Records are gzip members of their own in numbered archives. The index sorts captures by reversed-host
URL key and holds them in compressed blocks; a sparse directory has the first key and the place of
each block. A lookup binary-searches the directory, reads one range of the index (more while a key
goes on into the next block), and then one range of an archive.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import zlib
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import join_checked, materialize, new_path

#: Payloads from this size on are stored once; captures of an index block; archives and index parts of a run.
LEAST, BLOCK_LINES, DATE = 100, 1000, "2024-01-01T00:00:00Z"
#: Blocks of an index: beyond BLOCK_LINES times as many captures blocks get longer, so that the directory fits in memory.
MOST_BLOCKS = 200_000
RECORD = "page_id long, url string, file string, offset long, length long, record_type string, refers_to long"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the path in it: local paths and URIs alike."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        path = re.sub(r"^file:/+", "file:///", path)
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def url_key(url: str | None) -> str:
    """Host reversed by labels and lower-cased, port and path: ``http://a.b.c/x?q`` is ``c,b,a)/x?q``."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text if "://" in text else "//" + text)
        host, port = parts.hostname or "", parts.port
    except ValueError:  # no URL: it stands for itself, under no host
        return ")" + text
    host = ",".join(reversed(re.sub(r"^www\d*\.", "", host).split(".")))
    return f"{host}{f':{port}' if port not in (None, 80, 443) else ''}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def target(url: str | None) -> str:
    """A URL as a header holds it: on one line."""
    return re.sub(r"[\r\n]+", " ", url or "")


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None, date: str = DATE) -> bytes:
    """A WARC/1.1 record as a gzip member. A revisit has no payload but names the record that has it."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page)}", f"WARC-Date: {date}", f"WARC-Target-URI: {target(url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}", f"WARC-Refers-To-Target-URI: {target(refers_url)}"]
        payload = b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    body = "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"
    return gzip.compress(body, 5, mtime=0)


def parse(member: bytes) -> dict:
    """Headers and payload of one decompressed record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or not lines[0].startswith("WARC/"):
        raise ValueError("a WARC record is cut off")
    number = lambda x: None if x in (None, "<urn:page:>") else int(x[len("<urn:page:") : -1])
    return {"page_id": number(headers["WARC-Record-ID"]), "type": headers["WARC-Type"], "url": headers["WARC-Target-URI"], "digest": headers["WARC-Payload-Digest"].partition(":")[2], "refers_to": number(headers.get("WARC-Refers-To")), "payload": block.partition(b"\r\n\r\n")[2]}


def members(stream, chunk: int = 1 << 20):
    """(offset, length, decompressed) of each gzip member of a file, holding one at a time."""
    at, pending = 0, b""
    while True:
        unzip, parts, used = zlib.decompressobj(31), [], 0
        while not unzip.eof:
            if not pending:
                pending = stream.read(chunk)
                if not pending:
                    if used:
                        raise ValueError("an archive is cut off")
                    return
            parts.append(unzip.decompress(pending))
            used += len(pending) - len(unzip.unused_data)
            pending = unzip.unused_data
        yield at, used, b"".join(parts)
        at += used


def _write(root: str):
    def run(batches):
        import uuid

        store, base = opened(root)
        store.create_dir(base, recursive=True)
        # a name of its own for each attempt: what a lost attempt left is in no capture list, so it is never read
        name, out, at = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                rows = []
                for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    page, url, html, digest, refers, refers_url = r
                    out = out or store.open_output_stream(f"{base}/{name}", compression=None)
                    data = record(page, url, (html or "").encode(), digest, refers, refers_url)
                    out.write(data)
                    rows.append((page, url, name, at, len(data), "response" if refers is None else "revisit", refers))
                    at += len(data)
                cols = list(zip(*rows, strict=True)) or [[]] * 7
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["page_id", "url", "file", "offset", "length", "record_type", "refers_to"])
        finally:
            if out:
                out.close()

    return run


@dataclass
class Archive:
    """root: the folder of archives and index; captures: one row a record; directory: one row an index block."""

    root: str
    captures: DataFrame
    directory: DataFrame


def _blocks(root: str, lines: int):
    def run(batches):
        import uuid

        store, base = opened(root)
        store.create_dir(base, recursive=True)
        name, out, at, held = f"index-{uuid.uuid4().hex}.gz", None, 0, []

        def close_block():
            nonlocal out, at
            out = out or store.open_output_stream(f"{base}/{name}", compression=None)
            data = gzip.compress("".join(json.dumps(x, ensure_ascii=False) + "\n" for x in held).encode(), 6, mtime=0)
            out.write(data)
            row = (held[0][0], held[-1][0], name, at, len(data), len(held))
            at += len(data)
            held.clear()
            return row

        def rows_out(rows):
            cols = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["first", "last", "file", "offset", "length", "lines"])

        try:
            for batch in batches:
                rows = []
                for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    held.append(x)
                    if len(held) == lines:
                        rows.append(close_block())
                if rows:
                    yield rows_out(rows)
            if held:
                yield rows_out([close_block()])
        finally:
            if out:
                out.close()

    return run


def _keys(batches):
    for batch in batches:
        at = batch.schema.get_field_index("url")
        yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(at).to_pylist()], pa.string()), *(batch.column(batch.schema.get_field_index(n)) for n in ("page_id", "file", "offset", "length"))], names=["key", "page_id", "file", "offset", "length"])


def write(pages: DataFrame, root: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST, lines: int = BLOCK_LINES, most_blocks: int = MOST_BLOCKS) -> Archive:
    """Write one record a page and the capture index of all records.

    A null html is an empty payload, a null url an empty target. Of records with equal payloads of at
    least ``least`` bytes the one with the smallest id is the response (rows without an id are responses
    of their own), others revisit it. Rows that repeat an id and payload are all responses if their id
    is the smallest. Empty tables make an empty archive.
    """
    spark = pages.sparkSession
    root = root or new_path(spark, "warc")
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    src = src.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    big = F.octet_length(F.coalesce("html", F.lit(""))) >= least
    twice = src.where(big & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("m"), F.count("*").alias("c")).where("c > 1")
    twice = materialize(twice.select(F.col("digest").alias("d"), F.col("m.page_id").alias("first_id"), F.col("m.url").alias("first_url")), "twice")
    joined = join_checked(src, twice, F.col("digest") == F.col("d"), "left")
    again = F.col("first_id") != F.col("page_id")
    rows = joined.select("page_id", "url", "html", "digest", F.when(again, F.col("first_id")).alias("refers_to"), F.when(again, F.col("first_url")).alias("refers_url"))
    captures = materialize(rows.mapInArrow(_write(f"{root}/archives"), RECORD), "captures")
    lines = max(lines, -(-captures.count() // most_blocks))
    keyed = captures.mapInArrow(_keys, "key string, page_id long, file string, offset long, length long")
    ordered = keyed.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    directory = materialize(ordered.mapInArrow(_blocks(f"{root}/index", lines), "first string, last string, file string, offset long, length long, lines long"), "directory")
    return Archive(root, captures, directory)


def _read(root: str):
    def run(batches):
        store, base = opened(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for _, _, data in members(stream):
                        r = parse(data)
                        own = r["type"] == "response"
                        digest = hashlib.sha256(r["payload"]).hexdigest() if own else r["digest"]
                        if digest != r["digest"]:
                            raise ValueError(f"page {r['page_id']}: the payload does not match its digest")
                        rows.append((r["page_id"], len(r["payload"]) if own else None, digest, r["type"], r["refers_to"]))
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return run


def read_back(archive: Archive) -> DataFrame:
    """One row a record, from the archives alone; a revisit takes its payload's size from the record that it refers to."""
    files = archive.captures.select("file").distinct()
    n = max(1, files.count())
    rows = files.repartition(min(n, 10_000), "file").mapInArrow(_read(f"{archive.root}/archives"), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    rows = materialize(rows, "records")
    named = rows.where("record_type = 'revisit'").select("refers_to", "payload_digest").distinct()
    full = rows.where("record_type = 'response' and page_id is not null").select(F.col("page_id").alias("r"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"))
    named = materialize(named.join(full, (F.col("refers_to") == F.col("r")) & (F.col("payload_digest") == F.col("d"))).select("r", "d", "b").distinct(), "named")
    out = join_checked(rows, named, (F.col("refers_to") == F.col("r")) & (F.col("payload_digest") == F.col("d")), "left")
    return out.select("page_id", F.coalesce("payload_bytes", "b").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


class Index:
    """Lookups of single URLs: the sparse directory in memory, blocks and records by range reads."""

    def __init__(self, root: str, directory: list[tuple]):
        self.root, self.rows = root, sorted(directory)
        self.firsts = [r[0] for r in self.rows]
        self.last: tuple | None = None

    def block(self, row: tuple) -> list[list]:
        """The captures of one block, by one range read; the latest block is kept."""
        if self.last is None or self.last[0] != row:
            store, base = opened(f"{self.root}/index")
            with store.open_input_file(f"{base}/{row[2]}") as f:
                text = gzip.decompress(f.read_at(row[4], row[3])).decode()
            self.last = (row, [json.loads(x) for x in text.split("\n")[:-1]])
        return self.last[1]

    def captures(self, url: str | None) -> list[tuple]:
        """(page_id, archive, offset, length) of each capture of a URL, in the order of page_id."""
        key, out = url_key(url), []
        at = max(0, bisect.bisect_left(self.firsts, key) - 1)  # the key may begin in the block before
        while at < len(self.rows) and self.rows[at][0] <= key:
            if self.rows[at][1] >= key:
                lines = self.block(self.rows[at])
                i = bisect.bisect_left(lines, key, key=lambda x: x[0])
                while i < len(lines) and lines[i][0] == key:
                    out.append(tuple(lines[i][1:]))
                    i += 1
            at += 1
        return out

    def fetch(self, capture: tuple) -> dict:
        """The record of a capture, by one range read."""
        _, name, offset, length = capture
        store, base = opened(f"{self.root}/archives")
        with store.open_input_file(f"{base}/{name}") as f:
            return parse(gzip.decompress(f.read_at(length, offset)))


def open_index(archive: Archive) -> Index:
    """An index for lookups; its directory has at most about MOST_BLOCKS rows."""
    return Index(archive.root, [tuple(r) for r in archive.directory.collect()])


def _find(index: Index):
    def run(batches):
        for batch in batches:
            rows = []
            # in the order of keys a block that serves several queries is read once
            for _, page, url in sorted(zip(map(url_key, batch.column(1).to_pylist()), batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), key=lambda q: (q[0], q[1] is None, q[1] or 0)):
                for c in index.captures(url):
                    r = index.fetch(c)
                    rows.append((page, *c, r["page_id"] == c[0] and r["url"] == target(url)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["query_id", "page_id", "file", "offset", "length", "matched"])

    return run


def lookup(archive: Archive, queries: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(query_id, page_id, file, offset, length, matched): all captures of each query's URL, through the index.

    The directory goes to every task. ``matched``: the record at that range of the archive is that page's,
    and its URL is the query's and not just one of the same key.
    """
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"))
    return asked.mapInArrow(_find(open_index(archive)), "query_id long, page_id long, file string, offset long, length long, matched boolean")


def captured(pages: DataFrame, every: int = 20) -> DataFrame:
    """Archive ``pages``, read the archives back, and look up the URLs of every id divisible by ``every``.

    One row a page: page_id, payload_bytes, payload_digest, record_type, refers_to, url_captures (captures
    of just this URL that the index finds and whose records are where it says; null for other pages; where
    rows of one id have several URLs, the most). A null URL is an empty one. Pages without an id are
    archived and have no captures to count; repeated rows are captures of their own.
    """
    archive = write(pages)
    rows = read_back(archive)
    asked = materialize(pages.where(F.col("page_id") % every == 0).select("page_id", "url").distinct(), "asked")
    # each URL is looked up once, however many pages have it
    urls = materialize(asked.select("url").distinct().select(F.monotonically_increasing_id().alias("query_id"), "url"), "urls")
    found = lookup(archive, urls, "query_id").where("matched").groupBy("query_id").agg(F.countDistinct("page_id").alias("url_captures"))
    found = urls.join(materialize(found, "found"), "query_id").select(F.col("url").alias("__url"), "url_captures")
    found = asked.join(found, F.col("url").eqNullSafe(F.col("__url"))).groupBy(F.col("page_id").alias("query_id")).agg(F.max("url_captures").alias("url_captures"))
    found = materialize(found, "found")
    return join_checked(rows, found, F.col("page_id") == F.col("query_id"), "left").drop("query_id")
