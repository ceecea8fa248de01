"""WARC archives: writing with payload deduplication, reading, and assembling captures.

Every page becomes a request, a response (or a revisit of an equal payload) and a metadata
record, each a gzip member of its own. The response and the metadata name the request in
WARC-Concurrent-To; reading joins the records of a capture through these identifiers.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filesystem, join_groups, shared_path, stored

DEDUP_BYTES = 1000
FILE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, n_records long, n_bytes long"
RECORD = ("record_id string, type string, target_uri string, date string, "
          "concurrent_to array<string>, refers_to string, payload_digest string, "
          "payload_length long, payload binary, fields array<struct<name:string,value:string>>")


def payload_table(pages: DataFrame) -> DataFrame:
    """page_id, payload_digest (hex SHA-1) and payload_bytes of every page."""
    raw = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.sha1(raw).alias("payload_digest"),
                        F.octet_length(raw).cast("long").alias("payload_bytes"))


def revisits(payloads: DataFrame, least: int = DEDUP_BYTES) -> DataFrame:
    """(page_id, payload_digest, owner) of the pages whose payload of at least ``least`` bytes is
    stored with another page: the one with the largest page_id. NULL ids never own."""
    big = payloads.where(F.col("payload_bytes") >= least)
    groups = big.groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id")
                                               .alias("owner")).where("n > 1")
    hits = join_groups(big, stored(groups, "warc-groups"), "payload_digest", "n")
    return hits.where("owner is not null and not (page_id <=> owner)").select(
        "page_id", "payload_digest", "owner").distinct()


def response_id(page_id: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'response/{page_id}/{digest}')}>"


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def _record(kind: str, rid: str, date: str, extra: list[tuple[str, str]], content_type: str,
            block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", date), *extra,
            ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(text.encode() + block + b"\r\n\r\n") + z.flush()


def capture_records(page_id: int | None, url: str | None, payload: bytes, owner: int | None,
                    date: str) -> Iterator[bytes]:
    """The three compressed records of a page; ``owner`` is the page it revisits, if any."""
    digest = hashlib.sha1(payload)
    hexed = digest.hexdigest()
    labelled = "sha1:" + base64.b32encode(digest.digest()).decode()
    target = [] if url is None else [("WARC-Target-URI", _clean(url))]
    request = f"<urn:uuid:{uuid.uuid4()}>"
    concurrent = [("WARC-Concurrent-To", request)]
    yield _record("request", request, date, target, "application/http; msgtype=request",
                  f"GET {_clean(url or '/')} HTTP/1.1\r\n\r\n".encode())
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    facts = [*target, *concurrent, ("WARC-Payload-Digest", labelled)]
    if owner is None:
        rid = response_id(page_id, hexed) if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
        yield _record("response", rid, date, facts, "application/http; msgtype=response",
                      head + payload)
    else:
        yield _record("revisit", f"<urn:uuid:{uuid.uuid4()}>", date, [
            *facts, ("WARC-Profile", PROFILE), ("WARC-Refers-To", response_id(owner, hexed))],
            "application/http; msgtype=response", head)
    fields = "" if page_id is None else f"page-id: {page_id}\r\n"
    yield _record("metadata", f"<urn:uuid:{uuid.uuid4()}>", date, [*target, *concurrent],
                  "application/warc-fields", fields.encode())


def write_archives(pages: DataFrame, folder: str | None = None, least: int = DEDUP_BYTES,
                   date: str = "2020-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records of every page; returns the manifest (path, n_records, n_bytes).

    ``pages`` needs page_id, url and html; other columns are ignored, whatever their names. NULL
    html is an empty payload, NULL url leaves out the target, NULL page_id the id. Of equal
    payloads of at least ``least`` bytes the largest page_id is written as response; repeated rows
    of that page_id are responses too. Files have about ``file_bytes``; their names are new for
    each attempt, and only those of finished tasks are in the manifest.
    """
    spark = pages.sparkSession
    root = folder or shared_path(spark, "warc")
    known = stored(payload_table(pages), "warc-payloads")
    again = stored(revisits(known, least), "warc-revisits").select(
        F.col("page_id").alias("__page"), F.col("payload_digest").alias("__digest"), "owner")
    raw = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), raw.alias("payload"))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("__page")) & (
        F.sha1("payload") == F.col("__digest")), "left").select(
        "page_id", "url", "payload", "owner")

    def write(batches):
        fs, base = filesystem(root)
        fs.create_dir(base, recursive=True)
        stream, path, n, size = None, "", 0, 0

        def done():
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [n],
                                               "n_bytes": [size]})

        for b in batches:
            for page_id, url, payload, owner in zip(*[c.to_pylist() for c in b.columns],
                                                    strict=True):
                if stream is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, n, size = f"{root}/{name}", 0, 0
                    stream = fs.open_output_stream(f"{base}/{name}", compression=None)
                for record in capture_records(page_id, url, payload, owner, date):
                    stream.write(record)
                    n, size = n + 1, size + len(record)
                if size >= file_bytes:
                    yield done()
                    stream = None
        if stream is not None:
            yield done()

    return stored(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def members(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, decompressed one by one."""
    z, parts, data = zlib.decompressobj(31), [], b""
    while True:
        if not data:
            data = stream.read(step)
            if not data:
                break
        parts.append(z.decompress(data))
        data = z.unused_data
        if z.eof:
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends inside a record")


def parse_record(raw: bytes) -> dict:
    """One record's headers and content as a row of ``read_records``."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    named: dict[str, list[str]] = {}
    for line in lines[1:]:
        k, _, v = line.partition(":")
        named.setdefault(k.strip().lower(), []).append(v.strip())
    one = lambda k: named.get(k, [None])[0]
    block = rest[:int(one("content-length") or 0)]
    kind, payload, length, fields = one("warc-type"), None, None, []
    if kind in ("response", "revisit"):
        http, _, body = block.partition(b"\r\n\r\n")
        sizes = [x.split(b":")[1] for x in http.split(b"\r\n")
                 if x.lower().startswith(b"content-length:")]
        length = int(sizes[0]) if sizes else len(body)
        payload = body if kind == "response" else None
    elif kind == "metadata":
        for line in block.decode("utf-8").split("\r\n"):
            k, colon, v = line.partition(":")
            if colon:
                fields.append({"name": k.strip(), "value": v.strip()})
    digest = one("warc-payload-digest")
    if digest and digest.startswith("sha1:"):
        digest = base64.b32decode(digest[5:]).hex()
    return {"record_id": one("warc-record-id"), "type": kind, "target_uri": one("warc-target-uri"),
            "date": one("warc-date"), "concurrent_to": named.get("warc-concurrent-to", []),
            "refers_to": one("warc-refers-to"), "payload_digest": digest,
            "payload_length": length, "payload": payload, "fields": fields}


def read_records(manifest: DataFrame, batch_bytes: int = 4 << 20) -> DataFrame:
    """The records of the archives named in the manifest, one row each (see RECORD). Files are
    dealt over the tasks; each is read as a stream."""
    schema = pa.schema([
        ("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()),
        ("date", pa.string()), ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()), ("payload_digest", pa.string()),
        ("payload_length", pa.int64()), ("payload", pa.binary()),
        ("fields", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())])))])

    def read(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, p = filesystem(path)
                held, size = [], 0
                with fs.open_input_stream(p, compression=None) as stream:
                    for raw in members(stream):
                        held.append(parse_record(raw))
                        size += len(raw)
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInArrow(read, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: request and response, structs of the records' other columns (NULL
    where a capture lacks one), and metadata, an array of such structs by record_id, joined through
    WARC-Concurrent-To. Two requests, or two responses, of one capture raise an error: which of
    them belongs to it cannot be told.

    A record belongs to the record that it names, or to the one that that names in turn (metadata
    that name a response that names its request); records that name none start a capture.
    ``records`` may have any columns besides record_id, type and concurrent_to; keep payloads out
    unless they are needed, as the rows are shuffled. Revisits are responses here.
    """
    own = F.get("concurrent_to", F.lit(0))
    rows = records.withColumn("__names", own)
    named = rows.where("__names is not null").select(
        F.col("record_id").alias("__rid"), F.col("__names").alias("__next"))
    # records come out of a few manifest rows, from which Spark would take them for small
    rows = rows.join(named.hint("merge"), F.col("__names") == F.col("__rid"), "left")
    key = F.coalesce("__next", "__names", "record_id")
    cols = [c for c in records.columns if c != "concurrent_to"]
    def of(*kinds: str) -> Column:
        return F.when(F.col("type").isin(*kinds), F.struct(*cols))

    def one(what: str, *kinds: str) -> Column:
        return F.when(F.count(of(*kinds)) > 1, F.raise_error(F.concat(
            F.lit(f"two {what}s in the capture of "), F.min("record_id")))).otherwise(
            F.min(of(*kinds)))

    # a capture's own records: as many as its archive's writer gave it
    return rows.groupBy(key.alias("capture_id")).agg(
        one("request", "request").alias("request"),
        one("response", "response", "revisit").alias("response"),
        F.sort_array(F.collect_list(of("metadata"))).alias("metadata"))


def resolved(found: DataFrame) -> DataFrame:
    """Captures with page_id and refers_to, the page_id of the response that a revisit names.

    Responses that many revisits name are joined by broadcast (see ``join_groups``).
    """
    page = F.get(F.filter(F.flatten("metadata.fields"), lambda f: f["name"] == "page-id"),
                 F.lit(0))["value"].cast("long")
    rows = stored(found.withColumn("page_id", page), "warc-captures")
    again = rows.where("response.type = 'revisit'").withColumn("names", F.col("response.refers_to"))
    owners = (again.groupBy("names").agg(F.count("*").alias("__n")).join(
        rows.where("response.type = 'response'").groupBy(F.col("response.record_id").alias("__r"))
        .agg(F.max("page_id").alias("refers_to")), F.col("names") == F.col("__r"), "left")
        .drop("__r"))
    linked = join_groups(again, stored(owners, "warc-owners"), "names", "__n").drop("names", "__n")
    rest = rows.where("not (response.type <=> 'revisit')").withColumn(
        "refers_to", F.lit(None).cast("long"))
    return linked.unionByName(rest)
