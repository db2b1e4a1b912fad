"""WARC archives written and read by way of an index.

The index comes first: file, offset, length, URL and digest of every record are written before
an archive is. Each record is a gzip member of its own, as the format has it, compressed where
its page is read, so only compressed bytes move. Archives are files of bounded size. Reading
starts from index rows: selected records are sorted by offset, near ones are joined into one
byte range, and ranges are read by tasks.

Of pages with equal payloads of at least ``MIN_REVISIT`` bytes, the one with the largest id
is stored; the others are revisits that refer to it.

Archives are files in a store that Arrow can open by URI, as is the shared scratch folder. A
file is written under a name of the attempt and then renamed, so a lost task leaves none.

Defined cases: a null html is an empty payload; a null url is ``about:blank``, line breaks in
one become blanks; pages repeated with the same id, url and html give the same record each
time, and all rows with the largest id are responses; a null id ranks below every other;
an empty table gives an index without rows and no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved
from ledgerlens.session import scratch_dir

MIN_REVISIT = 1000
#: Aimed-at bytes of one archive file.
ARCHIVE_BYTES = 32 << 20
#: Byte ranges are joined across gaps up to this and never grow past the second.
GAP_BYTES, RANGE_BYTES = 64 << 10, 4 << 20
DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the format.
CRLF = "\r\n"
END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STATUS = "HTTP/1.1 200 OK" + CRLF


def roles(pages: DataFrame) -> DataFrame:
    """The pages with digest, size, record ids and whether they are stored or refer."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id",
        F.coalesce(F.regexp_replace("url", "[\r\n]", " "), F.lit("about:blank")).alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html.cast("binary")).alias("digest"),
    )
    large = F.col("payload_bytes") >= MIN_REVISIT
    # Light rows: one per payload that occurs more than once, combined before the shuffle.
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "url"))
    light = rows.select("page_id", "url", "payload_bytes", "digest").where(large)
    shared = light.groupBy("digest").agg(F.count("*").alias("n"), best.alias("stored")).where("n > 1")
    # Written, so that its true size is known where the join is planned.
    shared = saved(shared.select(F.col("digest").alias("shared_digest"), "stored"), "warc-shared")
    rows = rows.join(shared, large & (F.col("digest") == F.col("shared_digest")), "left")
    revisit = F.col("stored").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("stored.page_id"))
    return rows.select(
        "page_id",
        "url",
        "payload_bytes",
        "digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        record_id(F.col("page_id"), F.col("url"), F.col("digest")).alias("record_id"),
        F.when(revisit, record_id(F.col("stored.page_id"), F.col("stored.url"), F.col("digest"))).alias("refers_to_id"),
        F.when(revisit, F.lit(None)).otherwise(F.col("html")).alias("html"),
    )


def record_id(page_id: Column, url: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("-")), url, digest))
    cuts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def record(date: str = DATE) -> Column:
    """A whole record but for the blank lines at its end."""
    response = F.col("record_type") == "response"
    http = F.concat(
        F.lit(STATUS + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
        F.coalesce("html", F.lit("")),
    )

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(CRLF))

    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {date}{CRLF}"),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.coalesce(line("Page-Id", F.col("page_id").cast("string")), F.lit("")),
        F.when(response, F.lit("")).otherwise(
            F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.col("refers_to_id")))
        ),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(http).cast("string")),
        F.lit(CRLF),
    )
    return F.concat(head, http)


def _compressed(records: pd.Series) -> pd.Series:
    # No time and no name in the member: equal records give equal bytes.
    return pd.Series([gzip.compress((r + END).encode(), 6, mtime=0) for r in records], dtype=object)


FILES = "shard int, uri string, bytes long"
ORDER = ("page_id", "record_id")


def write(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """``path/records``: every record, compressed; ``path/index``: a row per record;
    ``path/archives``: one file per shard; ``path/files``: their URIs."""
    spark = pages.sparkSession
    member = F.pandas_udf(_compressed, "binary")(record())
    roles(pages).withColumn("member", member).drop("html").write.parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records").withColumn("length", F.octet_length("member").cast("long"))
    total = records.agg(F.sum("length")).first()[0] or 0
    shards = 1 + int(total) // archive_bytes
    records = records.withColumn("shard", F.pmod(F.xxhash64("record_id"), F.lit(shards)).cast("int"))
    # A total order of different records; equal ones may change places unnoticed.
    before = Window.partitionBy("shard").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    index = records.drop("member").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    index.write.parquet(f"{path}/index")
    dealt = records.select("shard", *ORDER, "member").repartition(shards, "shard")
    ordered = dealt.sortWithinPartitions("shard", *ORDER).select("shard", "member")
    folder = f"{path}/archives"

    def store(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, out, shard = [], None, None

        def finish() -> None:
            size = out.tell()
            out.close()
            files.move(temporary, name)
            done.append((shard, f"{folder}/{shard:08}.warc.gz", size))

        for frame in frames:
            for own, member in zip(frame["shard"], frame["member"], strict=True):
                if own != shard:
                    if out:
                        finish()
                    shard = own
                    files, name = _store(f"{folder}/{shard:08}.warc.gz")
                    files.create_dir(name.rpartition("/")[0], recursive=True)
                    temporary = f"{name}.{uuid.uuid4().hex}"
                    out = files.open_output_stream(temporary)
                out.write(member)
        if out:
            finish()
        yield pd.DataFrame(done, columns=["shard", "uri", "bytes"])

    ordered.mapInPandas(store, FILES).write.parquet(f"{path}/files")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def byte_ranges(selected: DataFrame) -> DataFrame:
    """Selected index rows as few byte ranges: ``shard``, ``start``, ``past`` and the
    records in each, none of more than RANGE_BYTES plus its last record."""
    stretch = F.floor(F.col("offset") / RANGE_BYTES)
    rows = selected.select("shard", "offset", "length", stretch.alias("stretch"))
    near = Window.partitionBy("shard", "stretch").orderBy("offset")
    end = F.max(F.col("offset") + F.col("length")).over(near.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("offset") - end > GAP_BYTES, F.lit(False)).cast("int")
    rows = rows.withColumn("apart", apart).withColumn("piece", F.sum("apart").over(near))
    return rows.groupBy("shard", "stretch", "piece").agg(
        F.min("offset").alias("start"),
        F.max(F.col("offset") + F.col("length")).alias("past"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"),
    )


def _store(uri: str):
    """The file system of a URI and the name in it."""
    from pyarrow.fs import FileSystem

    # Hadoop writes file:/x where a URI has file:///x.
    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


@lru_cache(maxsize=16)
def _open(uri: str):
    files, name = _store(uri)
    return files.open_input_file(name)


PARSED = (
    "record_id string, record_type string, page_id string, url string, refers_to_id string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def parse(raw: bytes, with_payload: bool) -> tuple:
    """One record's fields from its gzip member; its own digest is checked."""
    raw = gzip.decompress(raw)
    head, _, rest = raw.partition(END.encode())
    lines = head.decode().split(CRLF)
    fields = dict(line.split(": ", 1) for line in lines[1:])
    if lines[0] != "WARC/1.1" or not raw.endswith(END.encode()):
        raise ValueError(f"no record at the indexed place: {raw[:60]!r}")
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(END.encode())[2]
    kind, digest, size = fields["WARC-Type"], None, None
    if kind == "response":
        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
        if fields["WARC-Payload-Digest"] != "sha1:" + digest:
            raise ValueError(f"digest of {fields['WARC-Record-ID']} differs")
    return (
        fields["WARC-Record-ID"],
        kind,
        fields.get("Page-Id"),
        fields["WARC-Target-URI"],
        fields.get("WARC-Refers-To"),
        size,
        digest,
        payload if with_payload and kind == "response" else None,
    )


def read(spark: SparkSession, path: str, selected: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of selected index rows, read from the archives by byte ranges."""
    names = [field.split()[0] for field in PARSED.split(", ")]

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri, start, past, records in zip(
                frame["uri"], frame["start"], frame["past"], frame["records"], strict=True
            ):
                data = _open(uri).read_at(past - start, start)
                cuts = [(r["offset"] - start, r["length"]) for r in records]
                yield pd.DataFrame([parse(data[a : a + n], with_payload) for a, n in cuts], columns=names)

    if selected.isEmpty():
        return spark.createDataFrame([], PARSED)
    files = spark.read.parquet(f"{path}/files").select("shard", "uri")
    ranges = byte_ranges(selected).join(files, "shard")
    return ranges.select("uri", "start", "past", "records").mapInPandas(fetch, PARSED)


def resolve(records: DataFrame) -> DataFrame:
    """Each record with size and digest of its full payload: revisits take them, and the
    page they refer to, from the response."""
    light = records.drop("payload")
    stored = light.where("record_type = 'response'").select(
        F.col("record_id").alias("stored_id"),
        F.col("page_id").alias("stored_page"),
        F.col("payload_bytes").alias("stored_bytes"),
        F.col("payload_digest").alias("stored_digest"),
    )
    # Only responses that something refers to; repeated pages give one record id twice.
    joined = light.join(stored.dropDuplicates(["stored_id"]), F.col("refers_to_id") == F.col("stored_id"), "left")
    return joined.select(
        "page_id",
        F.coalesce("payload_bytes", "stored_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "stored_digest").alias("payload_digest"),
        "record_type",
        F.col("stored_page").alias("refers_to"),
        "url",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every page to archives in the shared folder and read all of them back."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    found = resolve(read(spark, path, read_index(spark, path)))
    return found.withColumn("page_id", F.col("page_id").cast(kind)).withColumn(
        "refers_to", F.col("refers_to").cast(kind)
    )
