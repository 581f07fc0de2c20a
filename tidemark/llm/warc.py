"""WARC archives: writing transactions, reading records, and assembling one nested row per capture.

A capture is a response (or a revisit of an earlier equal payload) with the request and metadata records whose
``WARC-Concurrent-To`` names it, or which it names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.llm.components import components
from tidemark.llm.tables import stored
from tidemark.llm.words import slices

REVISIT_BYTES = 100
#: Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_READ_BYTES = 1 << 20
#: Packed bytes given to a member at a time: what is behind its end is copied, once for each member.
_FEED_BYTES = 1 << 13
_WAIT_BYTES = 1 << 26
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _line_safe(value: str) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", value)


def _record(kind: str, record_id: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", _DATE), *fields, ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def _transaction(name: str, page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, first_url: str | None) -> bytes:
    """A page's request, response or revisit, and metadata record, each a gzip member."""
    ids = [f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{name}:{k}')}" for k in range(3)]
    target = [("WARC-Target-URI", _line_safe(url))] if url is not None else []
    joined = [("WARC-Concurrent-To", f"<{ids[1]}>")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    of = [*target, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    notes = {"page-id": page, "refers-to-page-id": first}
    if first is None:
        response = _record("response", ids[1], of, http + payload)
    else:
        of += [("WARC-Profile", _PROFILE), ("WARC-Refers-To-Date", _DATE)]
        of += [("WARC-Refers-To-Target-URI", _line_safe(first_url))] if first_url is not None else []
        response = _record("revisit", ids[1], of, http)
    asked = f"GET {_line_safe(url or '')} HTTP/1.1\r\n\r\n".encode()
    said = "".join(f"{k}: {v}\r\n" for k, v in notes.items() if v is not None).encode()
    return b"".join(
        [
            _record("request", ids[0], [*target, *joined, ("Content-Type", "application/http; msgtype=request")], asked),
            response,
            _record("metadata", ids[2], [*target, *joined, ("Content-Type", "application/warc-fields")], said),
        ]
    )


def write(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Write a transaction per page; returns the written table of archive ``address`` and ``pages``.

    Of pages with equal payloads (UTF-8 of ``html``) of ``least`` bytes or more, that with the smallest id is a response
    and the others revisit it; rows that repeat that id are responses too. Null html is an empty payload, a null id is
    behind all others, a null url leaves its fields out; blanks and control characters of an url are percent-encoded.
    """
    base = files.folder(pages.sparkSession, "warc")
    text = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page"), F.col(f"`{url}`").alias("url"), text.alias("html"), F.sha2(text, 256).alias("digest")
    )
    alike = rows.where(F.octet_length("html") >= least).groupBy("digest")
    origin = F.min(F.when(F.col("page").isNotNull(), F.struct(F.col("page").alias("first"), F.col("url").alias("first_url")))).alias("o")
    firsts = alike.agg(F.count("*").alias("n"), origin).where("n > 1 AND o IS NOT NULL").select("digest", "o.*")
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    planned = rows.join(firsts, "digest", "left").select(
        "page", "url", "html", "digest", F.when(again, F.col("first")).alias("first"), F.when(again, F.col("first_url")).alias("first_url")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        address, out, n = None, None, 0
        for batch in batches:
            for part in slices(batch, "html"):
                if out is None:
                    address, out = files.created(base, ".warc.gz")
                for page, link, text, digest, first, first_url in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    out.write(_transaction(f"{address}:{n}", page, link, text.encode(), digest, first, first_url))
                    n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"address": [address], "pages": pa.array([n], pa.int64())})

    return stored(planned.mapInArrow(task, "address string, pages long"), "warc-manifest")


class _Stream:
    """Bytes of an archive in order, plain or in gzip members, holding no more than the record at hand."""

    def __init__(self, address: str) -> None:
        self._in = files.opened(address)
        self._held = bytearray()
        self._raw, self._fed, self._rest = memoryview(self._in.read(_READ_BYTES)), 0, b""
        self._packed = self._raw[:2] == b"\x1f\x8b"
        self._unpack = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self._fed == len(self._raw) and not self._rest:
            self._raw, self._fed = memoryview(self._in.read(_READ_BYTES)), 0
            if not len(self._raw):
                return False
        if not self._packed:
            self._held += self._raw
            self._fed = len(self._raw)
            return True
        fed = self._rest
        if not fed:
            fed = self._raw[self._fed : self._fed + _FEED_BYTES]
            self._fed += len(fed)
        self._held += self._unpack.decompress(fed, _WAIT_BYTES)
        self._rest = self._unpack.unconsumed_tail
        if self._unpack.eof:
            self._rest, self._unpack = self._unpack.unused_data, zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the file."""
        seen = 0
        while (at := self._held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self._held)
            if not self._more():
                if self._held.strip():
                    raise ValueError("archive ends inside a record")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self._held) < n:
            if not self._more():
                raise ValueError("archive ends inside a record")
        out = bytes(self._held[:n])
        del self._held[:n]
        return out


def _fields(lines: bytes) -> list[tuple[str, str]]:
    text = lines.decode("utf-8", "replace").replace("\r\n ", " ").replace("\r\n\t", " ")
    return [(k.strip().lower(), v.strip()) for line in text.split("\r\n") for k, colon, v in (line.partition(":"),) if colon]


def records(address: str) -> Iterator[dict]:
    """The records of an archive; digests and lengths are of the whole payload, for a revisit as its headers have them."""
    stream = _Stream(address)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = _fields(head)
        named = dict(fields)
        if "content-length" not in named:
            raise ValueError(f"a record without content-length: {address}")
        block = stream.take(int(named["content-length"]))
        stream.take(4)
        kind, row = named.get("warc-type", ""), {}
        if named.get("content-type", "").startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
            if kind == "response":
                row = {"payload": payload, "payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest()}
            elif kind == "revisit":
                row = {"payload_bytes": int(dict(_fields(http)).get("content-length", 0)), "payload_digest": named.get("warc-payload-digest", "").partition(":")[2] or None}
            row |= {"first_line": http.partition(b"\r\n")[0].decode("utf-8", "replace")}
        elif named.get("content-type", "") == "application/warc-fields":
            row = {"notes": _fields(block)}
        else:
            row = {"payload": block, "payload_bytes": len(block), "payload_digest": hashlib.sha256(block).hexdigest()}
        together = [v.strip("<>") for k, v in fields if k == "warc-concurrent-to"]
        yield {"type": kind, "record_id": named.get("warc-record-id", "").strip("<>"), "concurrent_to": together, "uri": named.get("warc-target-uri"), "date": named.get("warc-date"), "fields": fields} | row


_SCHEMA = (
    "type string, record_id string, concurrent_to array<string>, uri string, date string, fields map<string, string>, payload binary, "
    "payload_bytes long, payload_digest string, first_line string, notes map<string, string>"
)
_STRINGS = pa.map_(pa.string(), pa.string())
_ARROW = pa.schema(
    {"type": pa.string(), "record_id": pa.string(), "concurrent_to": pa.list_(pa.string()), "uri": pa.string(), "date": pa.string(), "fields": _STRINGS,
     "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "first_line": pa.string(), "notes": _STRINGS}
)


def read(archives: DataFrame) -> DataFrame:
    """Every record of the archives in ``address``; an archive is one task, of which one batch of records is held.

    Field names are lower-case; of repeated fields the last counts, but ``concurrent_to`` has all. Raises ValueError on
    an archive that ends inside a record.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column("address").to_pylist():
                held, size = [], 0
                for record in records(address):
                    record["fields"] = list(dict(record["fields"]).items())
                    record["notes"] = list(dict(record["notes"]).items()) if "notes" in record else None
                    held.append(record)
                    size += len(record.get("payload") or b"") + 1000
                    if size > _READ_BYTES * 4:
                        yield pa.RecordBatch.from_pylist(held, _ARROW)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, _ARROW)

    return archives.select("address").repartition(max(1, archives.count())).mapInArrow(task, _SCHEMA)


def _capture_ids(names: DataFrame, responses: DataFrame, rest: DataFrame) -> DataFrame:
    """``record_id, capture_id`` of requests and metadata; ``names`` are (record_id, named) of all records."""
    back = names.select(F.col("named").alias("record_id"), F.col("record_id").alias("named"))
    links = names.join(rest, "record_id", "left_semi").unionByName(back.join(rest, "record_id", "left_semi")).distinct()
    known = responses.select(F.col("record_id").alias("named"))
    direct = stored(links.join(known, "named").groupBy("record_id").agg(F.min("named").alias("capture_id")), "direct-captures")
    alone = stored(rest.join(direct, "record_id", "left_anti"), "records-without-response")
    if alone.isEmpty():
        return direct
    through = direct.select(F.col("record_id").alias("named"), F.col("capture_id").alias("__there"))
    steps = links.join(alone, "record_id", "left_semi").join(through, "named", "left")
    tied = components(steps.select(F.col("record_id").alias("a"), F.coalesce("__there", "named").alias("b")))
    is_response, is_rest = (x.select(F.col("record_id").alias("node"), F.lit(True).alias(n)) for x, n in ((responses, "__response"), (rest, "__rest")))
    roots = (
        tied.join(is_response, "node", "left").join(is_rest, "node", "left").groupBy("component")
        .agg(F.min(F.when(F.col("__response"), F.col("node"))).alias("response"), F.min(F.when(F.col("__rest").isNull(), F.col("node"))).alias("missing"))
    )
    found = tied.join(roots, "component").select(F.col("node").alias("record_id"), F.coalesce("response", "missing", "component").alias("capture_id"))
    others = alone.join(found, "record_id", "left").select("record_id", F.coalesce("capture_id", "record_id").alias("capture_id"))
    return direct.unionByName(others)


def captures(all_records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, request, metadata``, and the numbers ``requests, metadata_records``.

    Requests and metadata follow any identifier they name to a response, or the response that names them, the smallest
    identifier if there are several; those that have none so follow chains of requests and metadata that name each other,
    in either direction. Of several requests or metadata records that of the smallest identifier is in the row, and their
    number beside it. Records that repeat a response's identifier are captures of their own; requests and metadata that
    lead to no response make a row without one, together if they name each other or the same absent record.
    """
    is_response = F.col("type").isin("response", "revisit", "resource")
    kept = ("type", "record_id", "concurrent_to", "uri", "date", "first_line")
    wanted = all_records.where(is_response | F.col("type").isin("request", "metadata"))
    named = stored(wanted.select(*kept, F.when(~is_response, F.map_entries("notes")).alias("notes")), "records")
    ids = [named.where(x).select("record_id").distinct() for x in (is_response, ~is_response)]
    names = named.select("record_id", F.explode("concurrent_to").alias("named"))
    keyed = named.where(~is_response).join(_capture_ids(names, *ids), "record_id")
    one = {"request": F.struct("record_id", "uri", "date", "first_line"), "metadata": F.struct("record_id", "uri", "date", "notes")}
    aggregates = [F.min(F.when(F.col("type") == k, s)).alias(k) for k, s in one.items()]
    aggregates += [F.count(F.when(F.col("type") == k, 1)).alias(f"{k}s") for k in one]
    companions = keyed.groupBy("capture_id").agg(*aggregates).withColumnRenamed("metadatas", "metadata_records")
    whole_record = ("record_id", "type", "uri", "date", "fields", "first_line", "payload", "payload_bytes", "payload_digest")
    whole = all_records.where(is_response).select(F.col("record_id").alias("capture_id"), F.struct(*whole_record).alias("response"))
    joined = whole.join(companions, "capture_id", "full")
    return joined.select("capture_id", "response", "request", "metadata", "requests", "metadata_records")
