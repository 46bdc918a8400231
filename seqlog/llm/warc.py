"""WARC archives without repeated payloads: revisit records in place of copies.

Writing. The headers of all records (id, URL, payload digests and length, no payload) are shuffled by
digest and reduced to the original of each payload: the record with the largest id. A record of equal
payload and smaller id becomes a revisit, which keeps the digest and names the original; its payload
is neither shuffled nor written again. All others become responses. Every record gets fresh WARC and
HTTP headers. Spark's text writer puts them into archives of about `archive_bytes`, with the blank lines
that end a WARC record between them, so a lost executor's archives are written again.

Reading. Archives are framed by the Content-Length of their records, whatever their payloads hold, and
every payload is hashed anew and compared with its digest. `resolve` shuffles the headers by digest and
joins each revisit to the response it names.

Equal means equal SHA-1 and equal SHA-256. A payload that very many records share makes a hot digest:
originals are found by an aggregation that combines before its shuffle, and the joins take digests
with more than HOT records apart. There are at most rows / HOT of these, so they are broadcast.

A null payload is an empty one. A null id is smaller than any other. Records that share payload and
largest id, repeated rows among them, are all responses, and revisits name their common id. A null URL
leaves the header out; line ends in a URL are written as %0D and %0A. Payloads shorter than `least_bytes`
are never revisited. Very long payloads make long records: an archive has one record at least, and must
fit in a task's memory when it is read. An empty table gives archives without records and reads back
empty. Only the three named columns are read, so no other column's name can clash.
"""

import base64
import gzip
import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlog.llm.common import arrow_rows, drop_written, frugal, shuffles_removed, table, written
from seqlog.plans.staging import scratch_path

VERSION, END = "WARC/1.1", "\r\n"
#: Size of an archive, and records of one digest beyond which it is joined apart.
ARCHIVE_BYTES, HOT = 16 << 20, 100_000
# Header names; the last two are our own, as the format has no place for a row's id.
TYPE, RECORD, DATE, URL = "WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI"
DIGEST, REFERS, LENGTH = "WARC-Payload-Digest", "WARC-Refers-To", "Content-Length"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE, ORIGINAL = "Page-ID", "Original-Page-ID"
RECORDS = (
    "page_id long, url string, record_id string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to_record string, original long, payload binary"
)


def base32(hexadecimal: Column) -> Column:
    """40 hexadecimal digits as 32 of base 32, upper case: ten at a time make eight."""
    parts = [
        F.lpad(F.conv(F.substring(hexadecimal, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)
    ]
    return F.translate(
        F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def join_hot(rows: DataFrame, side: DataFrame, on: list[str], records: str) -> DataFrame:
    """Inner join with a side of one row per key whose column `records` counts the key's rows.

    Keys with more than HOT rows are broadcast: there are at most rows / HOT. The others are shuffled.
    """
    hot = side.where(F.col(records) > HOT)
    cold = rows.join(side.where(F.col(records) <= HOT), on)
    return cold.unionByName(rows.join(F.broadcast(hot), on))


def record_id(page: Column, url: Column, digest: Column) -> Column:
    """A UUID drawn from the record's content, so that a task that runs again names it alike."""
    empty = F.lit("")
    drawn = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), empty), F.coalesce(url, empty), digest))
    parts = [F.substring(drawn, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def _head(kind: str, date: str, *lines: Column) -> Column:
    return F.concat(F.lit(f"{VERSION}{END}{TYPE}: {kind}{END}{DATE}: {date}{END}"), *lines)


def _http(length: Column) -> Column:
    return F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}{LENGTH}: "),
        length.cast("string"),
        F.lit(END + END),
    )


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: datetime | None = None,
    compression: str = "gzip",
) -> None:
    """Write a record per row into archives in `folder`, which must be new."""
    spark = pages.sparkSession
    stamp = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumns(
        {
            "url": F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
            "bytes": F.octet_length("payload").cast("long"),
            "sha1": F.sha1("payload"),
            "sha256": F.sha2("payload", 256),
        }
    )
    headers, headers_path = written(rows.drop("payload"), "warc-headers")
    digest = ["sha1", "sha256"]
    # Nulls order before all ids, so the largest struct is the record with the largest id.
    originals = (
        headers.where(F.col("bytes") >= least_bytes)
        .groupBy(*digest)
        .agg(F.max(F.struct("page", "url")).alias("of"), F.count("*").alias("records"))
        .where("records > 1")
        .select(*digest, F.col("of.page").alias("original"), F.col("of.url").alias("original_url"), "records")
    )
    originals, originals_path = written(originals, "warc-originals")
    copies = join_hot(headers, originals, digest, "records").where(
        "page < original OR (page IS NULL AND original IS NOT NULL)"
    )
    revisits, revisits_path = written(copies, "warc-revisits")
    own = record_id(F.col("page"), F.col("url"), F.col("sha1"))
    named = F.concat(F.lit("sha1:"), base32(F.col("sha1")))
    fields = [_line(RECORD, own), _line(URL, F.col("url")), _line(DIGEST, named), _line(PAGE, F.col("page"))]
    http = _http(F.col("bytes"))
    revisit = F.concat(
        _head("revisit", stamp, *fields),
        _line("WARC-Profile", F.lit(PROFILE)),
        _line(REFERS, record_id(F.col("original"), F.col("original_url"), F.col("sha1"))),
        _line("WARC-Refers-To-Target-URI", F.col("original_url")),
        _line(ORIGINAL, F.col("original")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line(LENGTH, F.octet_length(http)),
        F.lit(END),
        http,
    )
    response = F.concat(
        _head("response", stamp, *fields),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line(LENGTH, F.octet_length(http) + F.col("bytes")),
        F.lit(END),
        http,
        F.col("payload"),
    )
    # Responses: no revisit has their id and payload. The id spreads a hot payload's rows; a hot id too is
    # one row repeated, which stays a response, so it meets no revisit and may be split like any skewed key.
    gone = revisits.select(F.coalesce("page", F.lit(-1)).alias("_page"), F.col("page").isNull().alias("_null"), *digest)
    keyed = rows.withColumns({"_page": F.coalesce("page", F.lit(-1)), "_null": F.col("page").isNull()})
    kept = keyed.join(gone.distinct(), ["_page", "_null", *digest], "left_anti")
    total = headers.agg(F.sum(F.col("bytes") + 600)).first()[0] or 0
    archives = -(-total // archive_bytes) or 1
    records = kept.select(response.alias("record_text")).union(revisits.select(revisit.alias("record_text")))
    with shuffles_removed(spark):
        # In turn, so that repeated rows are spread as well; Spark sorts first, so a task that runs again deals alike.
        dealt = records.repartition(archives)
        dealt.write.option("lineSep", END + END).option("compression", compression).text(folder)
    drop_written(spark, headers_path, originals_path, revisits_path)


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive."""
    if archive[:2] == b"\x1f\x8b":
        archive = gzip.decompress(archive)
    at, line = 0, END.encode()
    while at < len(archive):
        end = archive.index(line + line, at)
        first, *lines = archive[at:end].decode("utf-8").split(END)
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}: {first[:40]!r}")
        named = (field.partition(":") for field in lines)
        fields = {name.strip().lower(): value.strip() for name, _, value in named}
        begin = end + 2 * len(line)
        at = begin + int(fields[LENGTH.lower()])
        if archive[at : at + 4] != line + line:
            raise ValueError(f"the record at byte {end} does not end where its {LENGTH} says")
        yield fields, archive[begin:at]
        at += 4


def _record(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    number = lambda name: int(fields[name.lower()]) if name.lower() in fields else None
    named = fields.get(DIGEST.lower(), "").removeprefix("sha1:") or None
    row = {
        "page_id": number(PAGE), "url": fields.get(URL.lower()), "record_id": fields.get(RECORD.lower()),
        "record_type": fields[TYPE.lower()], "payload_digest": named, "payload_bytes": None,
        "refers_to_record": fields.get(REFERS.lower()), "original": number(ORIGINAL), "payload": None,
    }
    if row["record_type"] == "response":
        blank = (END + END).encode()
        is_http = fields.get("content-type", "").startswith("application/http")
        payload = block[block.index(blank) + len(blank) :] if is_http else block
        held = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if named not in (None, held):
            raise ValueError(f"record {row['record_id']} has a payload of digest {held}, not {named}")
        row |= {"payload_digest": held, "payload_bytes": len(payload), "payload": payload if payloads else None}
    return row


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in `folder`, plain or gzip; see `resolve` for revisits.

    Only responses have a payload, and a digest that was compared. Other types are rows, too.
    """
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in RECORDS.split(","))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in parsed(content.as_py()):
                    rows.append(_record(fields, block, payloads))
                    held += len(block) if payloads else 0
                    if held > 4 << 20 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(frugal(read), RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest and refers_to of every record.

    Revisits are joined by digest to the response they name, and take its length. A revisit whose
    original is missing fails the job.
    """
    columns = ["page_id", "url", "record_type", "payload_bytes", "payload_digest"]
    responses = records.where("record_type = 'response'")
    revisits = records.where("record_type = 'revisit'")
    named = revisits.groupBy("payload_digest", "refers_to_record").agg(F.count("*").alias("records"))
    # Responses that share id and payload share a record id, too: one of them stands for all.
    originals = responses.groupBy("payload_digest", F.col("record_id").alias("refers_to_record")).agg(
        F.max("payload_bytes").alias("length"), F.max("page_id").alias("found")
    )
    side = named.join(originals, ["payload_digest", "refers_to_record"], "left").withColumn(
        "length",
        F.when(F.col("length").isNotNull(), F.col("length")).otherwise(
            F.raise_error(F.concat(F.lit("no response for the revisit of "), "refers_to_record")).cast("long")
        ),
    )
    joined = join_hot(revisits.drop("payload_bytes"), side, ["payload_digest", "refers_to_record"], "records")
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        joined.withColumn("payload_bytes", F.col("length")).select(*columns, F.col("found").alias("refers_to"))
    )


def op12_warc(spark, sf_dir) -> DataFrame:
    folder = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    with arrow_rows(spark, 1):
        records, _ = written(read_archives(spark, folder, payloads=False).drop("payload"), "warc-records")
    drop_written(spark, folder)
    return resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
parts AS (
  SELECT page_id, payload, [('0x' || substr(h, 10 * k + 1, 10))::BIGINT FOR k IN range(0, 4)] AS p,
         max(page_id) OVER (PARTITION BY payload) AS original
  FROM payloads)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((p[i // 8 + 1] >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)
                        FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM parts
"""
