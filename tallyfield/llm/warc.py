"""WARC archives with a two-level capture index."""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.llm.common import require
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin, scratch_path

#: Index lines of one compressed block at least, and blocks of one directory at most.
BLOCK_LINES = 3000
DIRECTORY_BLOCKS = 50_000
#: Fixed date of all records: archives of the same pages are the same bytes.
DATE = "2024-01-01T00:00:00Z"
LEVEL = 3
NULL_ID = "null"

CAPTURE = "key string, url string, page_id long, record_type string, file string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def open_store(uri: str):
    """(file system, path) for a folder that all executors share, by its URI; a plain path is local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def surt(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then the path; lowered host, no scheme, www, port or fragment."""
    if not url:
        return ")"
    try:
        parts = urlsplit(url if "://" in url else f"//{url}")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return f"){url}"
    path = parts.path or "/"
    return ",".join(reversed(host.split("."))) + ")" + path + (f"?{parts.query}" if parts.query else "")


def _header_value(text: str) -> str:
    return re.sub(r"[\r\n]+", " ", text)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member with one record; a revisit leaves its payload out but keeps size and digest."""
    revisit = refers_to is not None
    name = NULL_ID if page_id is None else str(page_id)
    body = b"" if revisit else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {_header_value(url)}" if url is not None else "",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        *(
            [
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                f"WARC-Refers-To: <urn:page:{refers_to}>",
            ]
            if revisit
            else []
        ),
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    head = "\r\n".join(x for x in lines if x).encode()
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(head + b"\r\n\r\n" + body + b"\r\n\r\n") + squeeze.flush()


def parse_record(member: bytes) -> dict:
    """Fields of one gzip member; a payload that does not match its digest raises."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    body = rest[:size]
    if len(body) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("WARC record is cut short")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and sha1_base32(body) != digest:
        raise ValueError(f"payload digest differs in {fields['WARC-Record-ID']}")

    def number(name: str) -> int | None:
        value = fields[name].removeprefix("<urn:page:").removesuffix(">")
        return None if value == NULL_ID else int(value)

    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("WARC-Refers-To") if kind == "revisit" else None,
        "payload": body if kind == "response" else None,
    }


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write one archive per task and return its captures (see ``CAPTURE``).

    Payloads are the texts in UTF-8, null as empty. Of records with equal payloads of at least
    ``least_bytes`` bytes the smallest page id is the response, the others are revisits that refer to
    it. Rows that repeat the smallest id are responses too, as are rows of equal payloads that all
    lack an id. A task writes a file name of its own and reports it with its rows, so a file left by
    a lost or repeated attempt is never read.
    """
    require(pages, id_col, url_col, payload_col)
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    sizes = rows.filter(F.octet_length("html") >= least_bytes).groupBy("digest")
    firsts = sizes.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = pin(firsts.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"), "repeated")
    # Only payloads that occur twice are joined: broadcast within measured limits, salted beyond.
    known = keyed_join(rows, repeated, ["digest"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    # Ids travel as text: pandas would turn longs with a null among them into doubles.
    known = known.select(F.col("page_id").cast("string"), "url", "html", refers.cast("string").alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        name = f"{path}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out, offset = None, 0
        for batch in batches:
            found = []
            for page_id, url, html, refers_to in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"]):
                out = out or store.open_output_stream(name, compression=None)
                page_id, refers_to = (None if x is None else int(x) for x in (page_id, refers_to))
                payload = html.encode()
                member = make_record(page_id, url, payload, sha1_base32(payload), refers_to)
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                found.append((surt(url), url, page_id, kind, name, offset, len(member)))
                offset += len(member)
            yield pd.DataFrame(found, columns=[x.split()[0] for x in CAPTURE.split(", ")]).astype({"page_id": "Int64"})
        if out:
            out.close()

    return pin(known.mapInPandas(write, CAPTURE), "captures")


def _squeeze(lines: list[str]) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress("\n".join(lines).encode())


def _lines(block: bytes) -> list[list]:
    import json

    import zstandard

    return [json.loads(x) for x in zstandard.ZstdDecompressor().decompress(block).decode().split("\n")]


def build_index(captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, directory) of captures sorted by key.

    ``blocks`` has (block, first_key, n, body): a run of sorted index lines, compressed. The sparse
    directory holds the first key of each block; lines per block grow with the table, so that it never
    has many more than ``DIRECTORY_BLOCKS`` rows and can be held by every task. Equal keys may span
    blocks.
    """
    import json

    per_block = max(BLOCK_LINES, -(-captures.count() // DIRECTORY_BLOCKS))
    # The place in an archive breaks ties, so one hot host or URL is spread over ranges as well.
    ordered = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    ordered = ordered.withColumn("page_id", F.col("page_id").cast("string"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, count = TaskContext.get().partitionId(), [], 0

        def block(lines: list[tuple]) -> pd.DataFrame:
            body = _squeeze([json.dumps(list(x)) for x in lines])
            return pd.DataFrame(
                {"block": [(part << 32) + count], "first_key": [lines[0][0]], "n": [len(lines)], "body": [body]}
            )

        for batch in batches:
            ids = [None if x is None else int(x) for x in batch["page_id"]]
            held += zip(batch["key"], batch["file"], map(int, batch["offset"]), map(int, batch["length"]), ids, batch["record_type"])
            while len(held) >= per_block:
                yield block(held[:per_block])
                held, count = held[per_block:], count + 1
        if held:
            yield block(held)

    blocks = pin(ordered.mapInPandas(pack, "block long, first_key string, n int, body binary"), "index")
    return blocks, blocks.select("block", "first_key", "n")


ENTRY = "key string, file string, offset long, length long, page_id long, record_type string"


def index_entries(blocks: DataFrame) -> DataFrame:
    """All index lines of some blocks."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for body in batch["body"]:
                yield pd.DataFrame(_lines(body), columns=[x.split()[0] for x in ENTRY.split(", ")]).astype(
                    {"page_id": "Int64"}
                )

    return blocks.mapInPandas(unpack, ENTRY)


def read_captures(entries: DataFrame, with_payload: bool = False) -> DataFrame:
    """Range-read and check the record behind each index entry (see ``RECORD``)."""
    # By stretches of a file, in order of place: neighbours are read in one go, and a file can be shared by tasks.
    stretch = F.floor(F.col("offset") / (8 << 20))
    placed = entries.repartition("file", stretch).sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, source = None, None
        for batch in batches:
            found = []
            for file, offset, length in zip(batch["file"], batch["offset"], batch["length"]):
                if file != name:
                    if source:
                        source.close()
                    store, path = open_store(file)
                    name, source = file, store.open_input_file(path)
                record = parse_record(source.read_at(int(length), int(offset)))
                if not with_payload:
                    record["payload"] = None
                found.append(record)
            yield pd.DataFrame(found, columns=[x.split()[0] for x in RECORD.split(", ")]).astype(
                {"page_id": "Int64", "refers_to": "Int64"}
            )
        if source:
            source.close()

    return placed.mapInPandas(read, RECORD)


def _key_column(url: Column) -> Column:
    return F.pandas_udf(lambda urls: urls.map(surt), T.StringType())(url)


def find_entries(keys: DataFrame, blocks: DataFrame, directory: DataFrame) -> DataFrame:
    """The index lines (see ``ENTRY``) of every distinct value of ``keys.key``, each line once.

    The directory (bounded, see ``build_index``) is binary-searched for the blocks that can hold a
    key, those blocks alone are read, and each is binary-searched again. A block is unpacked once and
    its keys stream past it, so no list of keys is gathered.
    """
    found = sorted((r.first_key, r.block) for r in directory.select("first_key", "block").collect())
    held = keys.sparkSession.sparkContext.broadcast(([k for k, _ in found], [b for _, b in found]))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def places(keys: pd.Series) -> pd.Series:
        first, block = held.value
        return pd.Series([block[max(bisect.bisect_left(first, k) - 1, 0) : bisect.bisect_right(first, k)] for k in keys])

    wanted = keys.select("key").distinct().select(F.explode(places("key")).alias("block"), "key")
    bodies = blocks.select("block", "body").join(wanted.select("block").distinct(), "block", "left_semi")
    # A block's body comes before its keys: null sorts first.
    both = wanted.withColumn("body", F.lit(None).cast("binary")).unionByName(
        bodies.withColumn("key", F.lit(None).cast("string"))
    )
    placed = both.repartition("block").sortWithinPartitions("block", "key")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, lines, first = None, [], []
        for batch in batches:
            out = []
            for block, key, body in zip(batch["block"], batch["key"], batch["body"]):
                if key is None:
                    kept, lines = block, _lines(body)
                    first = [x[0] for x in lines]
                elif block != kept:
                    raise ValueError(f"index block {block} is missing")
                else:
                    out += lines[bisect.bisect_left(first, key) : bisect.bisect_right(first, key)]
            yield pd.DataFrame(out, columns=[x.split()[0] for x in ENTRY.split(", ")]).astype({"page_id": "Int64"})

    return placed.mapInPandas(search, ENTRY)


def lookup(queries: DataFrame, blocks: DataFrame, directory: DataFrame, url_col: str = "url") -> DataFrame:
    """(url, page_id, file, offset, length, record_type) of every capture of each asked URL, by ``find_entries``."""
    asked = queries.select(F.col(url_col).alias("url")).distinct().withColumn("key", _key_column(F.col("url")))
    entries = find_entries(asked, blocks, directory)
    return asked.join(entries, "key").select("url", "page_id", "file", "offset", "length", "record_type")


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write archives and their index, then look every page's URL up in it and read its records back.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to. An empty table
    gives no rows.
    """
    blocks, directory = build_index(write_archives(pages, None, id_col, url_col, payload_col))
    asked = pages.select(F.col(url_col).alias("url")).distinct()
    found = read_captures(find_entries(asked.select(_key_column(F.col("url")).alias("key")), blocks, directory))
    return found.select(F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
