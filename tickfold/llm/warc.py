"""WARC archives: write, index first, read back by byte ranges (operator 1).

Writing tasks append one gzip member per record to archives in the shared
folder and return the index: archive, offset, length, URL, digest of each
record.  Readers take any selection of index rows, sorted by archive and
offset, join ranges that lie close into one read, and parse the members.

Archives are written and read through pyarrow's file systems (file, s3, gs,
hdfs URIs), as Spark has no sink for them; tables go through Spark.  An archive
is named by its task attempt, so what a lost or repeated attempt left behind is
in no index.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from datetime import UTC, datetime
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import new_path, stored

#: Payloads below this size are never revisits.
LEAST_REVISIT = 100
#: An archive is closed at this size; ranges at most GAP apart are read at once, up to READ.
ARCHIVE = 256 << 20
GAP = 64 << 10
READ = 8 << 20
#: Bytes of archives that a reading task gets, about.
TASK = 64 << 20

INDEX = ("page_id bigint, url string, digest string, type string, refers_to bigint, "
         "archive string, offset bigint, length bigint")
RECORD = ("page_id bigint, url string, record_type string, payload_digest string, "
          "refers_to bigint, payload string")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str, place: str) -> bytes:
    """One WARC/1.1 record; a revisit leaves its payload out.

    ``place`` names the archive and offset, so that no two records share an id;
    pages are told apart by fields of our own.
    """
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>",
            f"WARC-Date: {date}", f"Page-ID: {_text(page_id)}",
            f"WARC-Payload-Digest: sha256:{digest}", f"Content-Length: {len(body)}"]
    if url is not None:  # one line, whatever the URL holds
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To-Date: {date}", f"Page-Refers-To: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _text(x) -> str:
    return "" if x is None else str(x)


def parse(raw: bytes) -> tuple:
    """The columns of RECORD, of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[:int(field["Content-Length"])]
    if rest[len(body):] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut off")

    def page(name):
        found = field.get(name)
        return int(found) if found else None

    url = field.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    digest = field["WARC-Payload-Digest"].removeprefix("sha256:")
    if field["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError("a payload doesn't have its digest")
    return (page("Page-ID"), url, field["WARC-Type"], digest, page("Page-Refers-To"),
            body.decode() if field["WARC-Type"] == "response" else None)


def first_pages(pages: DataFrame) -> DataFrame:
    """(digest, first_id) of payloads that several pages have."""
    sizes = pages.groupBy("digest").agg(F.min("page_id").alias("first_id"),
                                        F.count(F.lit(1)).alias("n"))
    return sizes.filter("n > 1 AND first_id IS NOT NULL").select("digest", "first_id")


def write(pages: DataFrame, folder: str | None = None, date: str | None = None) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and return the stored index.

    ``date`` is the WARC-Date of all records, the time of the call if not given.

    A null html is an empty payload, a null url leaves its line out; a null
    page_id is kept and never a revisit's target.  Rows that repeat a page_id
    and its payload are archived each, as responses if the id is the smallest.
    An empty table gives an empty index; other columns are left out.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    folder = folder or new_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                         payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    large = pages.filter(F.octet_length("html") >= LEAST_REVISIT).select("page_id", "digest")
    firsts = stored(first_pages(large), "warc-first-pages")
    # Small enough by its true size, firsts is sent along; else both sides are sorted.
    marked = pages.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.octet_length("html") >= LEAST_REVISIT,
               F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))).alias("refers_to"))
    schema = _schema(INDEX)

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
            else (fs.LocalFileSystem(), folder)
        files.create_dir(root, recursive=True)
        out, name, at = None, None, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None or at >= ARCHIVE:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                raw = record(row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"],
                             date, f"{name}/{at}")
                member = gzip.compress(raw, 4, mtime=0)
                out.write(member)
                kind = "response" if row["refers_to"] is None else "revisit"
                rows.append((row["page_id"], row["url"], row["digest"], kind, row["refers_to"],
                             name, at, len(member)))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                    schema=schema)
        if out is not None:
            out.close()

    index = stored(marked.mapInArrow(run, INDEX), "warc-index")
    return index.withColumn("archive", F.concat(F.lit(folder + "/"), F.col("archive")))


def ranges(rows: list[tuple[int, int]]):
    """Stretches of ``rows`` (offset, length; sorted) that one read fetches."""
    begin = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i][0] - sum(rows[i - 1]) > GAP \
                or sum(rows[i]) - rows[begin][0] > READ:
            yield rows[begin:i]
            begin = i


def read(index: DataFrame) -> DataFrame:
    """The records of the given index rows; see RECORD.

    Tasks are cut by the bytes of the records, not of the index; an empty index
    gives no rows, a row given twice is read twice.
    """
    schema = _schema(RECORD)

    def run(batches):
        files, opened, at_end = None, None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True)
            for archive, group in groupby(rows, key=lambda r: r[0]):
                if archive != at_end:
                    if opened is not None:
                        opened.close()
                    files, path = fs.FileSystem.from_uri(archive) if "://" in archive \
                        or archive.startswith("file:") else (fs.LocalFileSystem(), archive)
                    opened, at_end = files.open_input_file(path), archive
                for part in ranges([r[1:] for r in group]):
                    start = part[0][0]
                    opened.seek(start)
                    raw = opened.read(sum(part[-1]) - start)
                    found = [parse(zlib.decompress(raw[o - start:o - start + n], 31)) for o, n in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)],
                        schema=schema)
        if opened is not None:
            opened.close()

    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).head()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, 1 + size // TASK)
    ordered = (index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset")
               .sortWithinPartitions("archive", "offset"))
    return ordered.mapInArrow(run, RECORD)


def with_payloads(records: DataFrame) -> DataFrame:
    """``records`` with payload_bytes, for revisits that of the response they name."""
    sized = records.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).drop("payload")
    sized = stored(sized, "warc-records")
    originals = (sized.filter("record_type = 'response'").groupBy(F.col("page_id").alias("target"),
                 F.col("payload_digest").alias("target_digest"))
                 .agg(F.max("payload_bytes").alias("target_bytes")))
    revisits = sized.filter("record_type = 'revisit'").join(
        originals, (F.col("refers_to") == F.col("target"))
        & (F.col("payload_digest") == F.col("target_digest")), "left")
    return sized.filter("record_type = 'response'").unionByName(
        revisits.withColumn("payload_bytes", F.col("target_bytes")).select(*sized.columns))
