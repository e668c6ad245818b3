"""Legacy ARC archives and their conversion to WARC.

An ARC file begins with a version record whose lines name the fields of the header
line that precedes each document; a header ends with the declared length of what
follows. Records are read by these lengths alone, so a payload may hold anything.
From each, the equivalent WARC record is synthesised: identifier, date, type and
digests. Records with equal payloads become revisits of one response.

Files are written by Spark's text sink, a record a line, and read as whole files,
each of a bounded number of records. Contents are never grouped or shuffled by
payload: which record revisits which is decided on digests.
"""

import gzip
import hashlib
import re
from base64 import b32encode
from urllib.parse import quote
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.llm.store import SALTS, folder, small_batches, written

RECORDS_A_FILE = 1000
LARGE = 1 << 18  # bytes of a payload beyond which its record has a file of its own; a file's others make 256 MB at most
CAPTURED = "20240101000000"  # the pages table holds no time of capture
ADDRESS = "0.0.0.0"

# The field lines of the two ARC versions, and names of the WARC format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"


def sha1(data) -> str:
    return b32encode(hashlib.sha1(data).digest()).decode()


def version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 ledgerflow\n{ARC_FIELDS[version]}\n\n".encode()
    fields = {"URL": f"filedesc://{name}", "Content-type": "text/plain"}
    return arc_header(fields, len(body), version) + body


def arc_header(fields: dict[str, str], length: int, version: int) -> bytes:
    known = {"IP-address": ADDRESS, "Archive-date": CAPTURED, "Archive-length": str(length)} | fields
    return (" ".join(known.get(name, "-") for name in ARC_FIELDS[version].split()) + "\n").encode()


def http_message(page_id, payload: bytes) -> bytes:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    lines += [] if page_id is None else [f"{PAGE_HEADER}: {page_id}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + payload


def _arc_lines(records_a_file: int):
    """ARC records without their final line end; each file begins with a version record."""
    def run(batches):
        part, n, version = TaskContext.get().partitionId(), 0, 1
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if n % records_a_file == 0:
                    version = 1 + (part + n // records_a_file) % 2
                    # The text sink ends this record's blank line.
                    out.append(version_block(f"{part}-{n // records_a_file}.arc", version)[:-1])
                n += 1
                message = http_message(page_id, (html or "").encode())
                url = quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else f"urn:page:{page_id}"
                out.append(arc_header({"URL": url, "Content-type": "text/html", "Result-code": "200"}, len(message), version) + message)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
    return run


def _text_files(records: DataFrame, path: str, records_a_file: int) -> None:
    lines = records.select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", records_a_file + 1).text(path)


def write_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", records_a_file: int = RECORDS_A_FILE) -> str:
    """The folder of ARC files of both versions that hold one HTTP response for each page.

    A null html is empty; a page without url is named by its id; url characters that
    end a header field are percent-encoded. A file holds ``records_a_file`` pages of up to
    LARGE bytes, or one larger page.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col))
    path, large = folder(pages.sparkSession, "arc"), F.coalesce(F.octet_length(html_col), F.lit(0)) > LARGE
    for name, some, records in (("small", ~large, records_a_file), ("large", large, 1)):
        _text_files(rows.where(some).mapInArrow(_arc_lines(records), "value binary"), f"{path}/{name}", records)
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def _plain(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def parse_arc(data: bytes):
    """Header fields and content of each record after the version record.

    Only the first record of a file is a version record, whatever later urls look like.
    A length that reaches beyond the file is cut there, and the fields say so.
    """
    at, names, first = 0, ARC_FIELDS[1].split(), True
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].decode("utf-8", "replace").strip("\r")
        at = end + 1
        if not line:
            continue
        values = line.split(" ")
        length = int(values[-1]) if values[-1].isdigit() else -1
        if length < 0:
            raise ValueError(f"no ARC header line: {line[:80]!r}")
        body, at = data[at:at + length], at + length
        version, first = first and line.startswith("filedesc:"), False
        if version:
            said = body.decode("utf-8", "replace").split("\n")
            names = said[1].split() if len(said) > 1 and said[1].strip() else ARC_FIELDS[int(said[0][:1] or 1)].split()
            continue
        fields = dict(zip(names, values, strict=False)) | {"Archive-length": values[-1]}
        if len(body) < length:
            fields["truncated"] = "length"
        yield fields, body


def warc_date(date: str) -> str:
    """An ISO time from ARC's up to 14 digits, missing ones at their least."""
    d = re.sub(r"\D", "", date)[:14]
    d += "19700101000000"[len(d):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """The HTTP head with its blank line, and the payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode() if found else None


def record_id(path: str, number: int, digest: str) -> str:
    return f"urn:uuid:{uuid5(NAMESPACE_URL, f'{path.rsplit("/", 1)[-1]}#{number}#{digest}')}"


INDEX = ("path", "number", "page_id", "record_id", "url", "date", "payload_digest", "payload_bytes")


def _index(batches):
    """What is known of each ARC record but its content."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            rows: list = [[] for _ in INDEX]
            for number, (fields, block) in enumerate(parse_arc(_plain(content))):
                head, payload = split_http(block)
                digest = sha1(payload)
                page = http_field(head, PAGE_HEADER)
                values = (path, number, None if page is None else int(page), record_id(path, number, digest), fields["URL"], warc_date(fields["Archive-date"]), digest, len(payload))
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=list(INDEX))


def warc_record(kind: str, headers: dict[str, str | None], block: bytes) -> bytes:
    """A record up to the last line end but one; the text sink writes that."""
    lines = [WARC_VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items() if v is not None), f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r"


def _warc_lines(records_a_file: int):
    def run(batches):
        n = 0
        for batch in batches:
            for path, content, refers in zip(*(batch.column(k).to_pylist() for k in ("path", "content", "refers")), strict=True):
                original, out = {r["number"]: r for r in refers or ()}, []
                for number, (fields, block) in enumerate(parse_arc(_plain(content))):
                    head, payload = split_http(block)
                    digest = sha1(payload)
                    if n % records_a_file == 0:
                        info = b"software: ledgerflow\r\nformat: WARC File Format 1.1\r\n"
                        out.append(warc_record("warcinfo", {"WARC-Record-ID": f"<{record_id(path, -1 - n, '')}>", "WARC-Date": warc_date(fields["Archive-date"]), "Content-Type": "application/warc-fields"}, info))
                    n += 1
                    to = original.get(number)
                    kind = "revisit" if to else "response" if head else "resource"
                    kept = head if to else block
                    out.append(warc_record(kind, {
                        "WARC-Record-ID": f"<{record_id(path, number, digest)}>", "WARC-Date": warc_date(fields["Archive-date"]), "WARC-Target-URI": fields["URL"],
                        "WARC-IP-Address": fields.get("IP-address"), "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{sha1(kept)}",
                        "WARC-Profile": REVISIT_PROFILE if to else None, "WARC-Refers-To": f"<{to['record_id']}>" if to else None,
                        "WARC-Refers-To-Target-URI": to["url"] if to else None, "WARC-Refers-To-Date": to["date"] if to else None, "WARC-Truncated": fields.get("truncated"),
                        "Content-Type": "application/http; msgtype=response" if head else fields.get("Content-type"),
                    }, kept))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
    return run


def convert(spark: SparkSession, arc: str, least_bytes: int = 0, records_a_file: int = RECORDS_A_FILE) -> str:
    """The folder of WARC files for a folder of ARC files.

    Of the records with equal payloads of at least ``least_bytes``, the one with the
    largest page id is the response, null ids last, and the others revisit it; all
    smaller ones are responses. The records of an ARC file that holds a payload of over LARGE
    bytes get a WARC file each.
    """
    index = written(_files(spark, arc).mapInArrow(_index, "path string, number long, page_id long, record_id string, url string, date string, payload_digest string, payload_bytes long"), "index")
    same = ["payload_digest", "payload_bytes"]
    best = F.max(F.struct("page_id", "record_id", "url", "date")).alias("best")
    groups = index.where(F.col("payload_bytes") >= least_bytes).groupBy(*same).agg(best, F.count(F.lit(1)).alias("n")).where("n > 1")
    spread = groups.drop("n").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = index.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    revisits = salted.join(spread, [*same, "salt"]).where(F.col("record_id") != F.col("best.record_id"))
    # At most a file's records for each file.
    refers = revisits.groupBy("path").agg(F.collect_list(F.struct("number", "best.record_id", "best.url", "best.date")).alias("refers"))
    facts = index.groupBy("path").agg((F.max("payload_bytes") > LARGE).alias("large"))
    facts = written(facts.join(refers, "path", "left"), "files")
    path = folder(spark, "warc")
    for name, some, records in (("small", ~F.col("large"), records_a_file), ("large", F.col("large"), 1)):
        own = facts.where(some)
        if name == "small" or not own.isEmpty():
            found = _files(spark, arc).join(own, "path").mapInArrow(_warc_lines(records), "value binary")
            _text_files(found, f"{path}/{name}", records)
    return path


def parse_warc(data: bytes):
    """Headers, by lower-case name, and block of each record."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError("a WARC record without end of headers")
        lines = data[at:end].decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        if not lines[0].startswith("WARC/") or "content-length" not in headers:
            raise ValueError(f"no WARC record: {lines[0][:80]!r}")
        start = end + 4
        stop = start + int(headers["content-length"])
        yield headers, data[start:stop]
        at = stop + 4


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to_id string, url string, date string"


def _records(batches):
    for batch in batches:
        for content in batch.column("content").to_pylist():
            rows: list = [[] for _ in RECORD.split(", ")]
            for headers, block in parse_warc(_plain(content)):
                kind = headers["warc-type"]
                if kind == "warcinfo":
                    continue
                head, payload = split_http(block)
                page = http_field(head, PAGE_HEADER)
                digest, size = headers["warc-payload-digest"].partition(":")[2], len(payload)
                if kind == "revisit":
                    size = int(http_field(head, "Content-Length") or 0)
                elif sha1(payload) != digest:
                    raise ValueError(f"digest of {headers['warc-record-id']} doesn't match")
                values = (None if page is None else int(page), size, digest, kind, headers["warc-record-id"].strip("<>"), headers.get("warc-refers-to", "").strip("<>") or None,
                          headers.get("warc-target-uri"), headers.get("warc-date"))
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            kinds = [pa.int64() if f.endswith("long") else pa.string() for f in RECORD.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=[f.split()[0] for f in RECORD.split(", ")])


def read_warc(spark: SparkSession, warc: str) -> DataFrame:
    """One row for each record of the WARC files, responses' digests verified, with
    ``refers_to``, the page id of the record that a revisit names."""
    records = written(_files(spark, warc).mapInArrow(_records, RECORD), "records")
    named = records.where("record_type = 'revisit'").select("refers_to_id").distinct()
    pages = records.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    pages = pages.join(named, "refers_to_id").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = records.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    return salted.join(pages, ["refers_to_id", "salt"], "left").drop("salt", "refers_to_id")
