"""Web archives: WARC records in ZIP packages, written and read back by range.

A package is a ZIP file of stored members: ``archive/data.warc.gz`` (one gzip member for each record, so that every
record can be read alone) and ``indexes/index.cdxj`` (a line for each record with its offset and length).

Writing. Digests and sizes are columns. Of records with equal payloads of at least ``SHARED`` bytes one is the
response, found by a minimum for each digest (no group is gathered), and the others are revisits without payload.
A payload is sent once for each digest, and the packages are rolled at ``PACKAGE`` bytes. A task's packages count only
if its rows in the manifest are committed, so a repeated task leaves no trace.

Reading. The directory (central and ZIP64) names the members, the index gives the places of the records, and these
are dealt out as ranges of about ``RANGE`` bytes, whichever package they are in. A reader seeks to its range and inflates record by
record; nothing is extracted and no package is read whole. A member that no index covers is scanned for its records
instead. Files are opened through Arrow's file systems, by the address of the shared folder.

Defined results: null html is empty; a null page id has no header, is null again when read, and comes last when the response is chosen; of equal
rows one is the response; null and hostile URLs are left out or percent-encoded; an empty table gives no package and no rows; a
record or package that cannot be read raises, with its place; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.zip_archives import BadArchive, Member, data_at, members, read_at
from tidemark.session import scratch

#: Payloads from this size on are written once.
SHARED = 100
#: Bytes after which a package is closed, and bytes of records read at once.
PACKAGE, RANGE = 64 << 20, 4 << 20
#: Index lines held at once; a range is made of neighbours among them.
LINES = 50_000
WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STAMP = "2024-01-01T00:00:00Z"
MANIFEST = "package string, n_records long, n_bytes long"
RECORD = (
    "package string, at long, record_id string, record_type string, page_id long, url string, payload_bytes long, "
    "payload_digest string, header_digest string, refers_to_id string, payload binary"
)


# --- which records there are ------------------------------------------------


def _identity(digest: str | Column, page: str | Column, url: str | Column, row: str | Column) -> Column:
    """A record's id, from what makes it unique."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in (digest, page, row, url)]
    h = F.md5(F.concat_ws(":", *parts))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cuts))


def plan(pages: DataFrame) -> DataFrame:
    """One record for each page: (record_id, record_type, page_id, url, payload_bytes, payload_digest, refers_to_id, payload)."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    size = F.octet_length("payload").cast("long")
    narrow = pages.select(
        "page_id", "url", F.sha2("payload", 256).alias("payload_digest"), size.alias("payload_bytes"),
        F.when(size < SHARED, F.col("payload")).alias("small"), F.monotonically_increasing_id().alias("row"),
    )
    rows = written(narrow, "page-digests")
    least = F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "url", "row")).alias("first")
    first = rows.where(F.col("payload_bytes") >= SHARED).groupBy("payload_digest").agg(least)
    # A key of its own on both sides: each gets a shuffle right below the join, and AQE splits a hot digest.
    key = F.concat(F.lit("sha256:"), F.col("payload_digest"))
    kept = first.select(key.alias("_key"), F.col("first.row").alias("kept"), _identity("payload_digest", "first.page_id", "first.url", "first.row").alias("kept_id"))
    revisits = (F.col("payload_bytes") >= SHARED) & (F.col("row") != F.col("kept"))
    placed = rows.withColumn("_key", key).join(kept, "_key", "left").select(
        _identity("payload_digest", "page_id", "url", "row").alias("record_id"),
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        "page_id", "url", "payload_bytes", "payload_digest", F.when(revisits, F.col("kept_id")).alias("refers_to_id"), "small",
    )
    placed = written(placed, "page-records")
    # One payload for each digest; a map task already sends each of its own once.
    payloads = pages.where(F.octet_length("payload") >= SHARED).select(F.sha2("payload", 256).alias("payload_digest"), "payload")
    payloads = payloads.groupBy("payload_digest").agg(F.first("payload").alias("payload"))
    alone = F.col("small").isNull() & (F.col("record_type") == "response")
    large = placed.where(alone).join(payloads, "payload_digest").select(*[c for c in placed.columns if c != "small"], "payload")
    return large.unionByName(placed.where(~alone).withColumnRenamed("small", "payload"))


# --- writing ----------------------------------------------------------------


def opened(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(address)


def header_text(value: str) -> str:
    """A header value on one line: white space and control characters become percent codes."""
    return "".join(quote(c) if c <= " " or "\x7f" <= c <= "\x9f" else c for c in value)


def record_bytes(row) -> bytes:
    """One WARC record with an HTTP response; a revisit has its headers only."""
    body = row.payload if row.record_type == "response" else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {row.record_type}", f"WARC-Record-ID: <{row.record_id}>", f"WARC-Date: {STAMP}"]
    lines += [f"WARC-Target-URI: {header_text(row.url)}"] if isinstance(row.url, str) else []
    lines += [f"WARC-Page-ID: {int(row.page_id)}"] if not pd.isna(row.page_id) else []
    lines += [f"WARC-Payload-Digest: sha256:{row.payload_digest}"]
    if row.record_type == "revisit":
        lines += [f"WARC-Refers-To: <{row.refers_to_id}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}", "", ""]
    return "\r\n".join(lines).encode() + http + body + b"\r\n\r\n"


def index_key(url: str | None) -> str:
    """Host from the top domain down, then the path: neighbours of a site stand together."""
    try:
        parts = urlsplit(url or "")
        return f"{','.join(reversed((parts.hostname or '-').split('.')))}){parts.path or '/'}"
    except ValueError:
        return "-)/"


class Package:
    """A package being written: records as they come, the index when it is closed."""

    def __init__(self, address: str, level: int):
        self.address, self.level, self.lines, self.at = address, level, [], 0
        fs, path = opened(address)
        self.file = fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(WARC), "w", force_zip64=True)

    def add(self, row) -> None:
        squeeze = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        data = squeeze.compress(record_bytes(row)) + squeeze.flush()
        self.member.write(data)
        url = header_text(row.url) if isinstance(row.url, str) else None
        entry = {"url": url, "digest": f"sha256:{row.payload_digest}", "offset": str(self.at), "length": str(len(data)), "filename": posixpath.basename(WARC)}
        self.lines.append(f"{header_text(index_key(url))} {STAMP} {json.dumps(entry)}")
        self.at += len(data)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(INDEX, "".join(f"{line}\n" for line in sorted(self.lines)))
        self.zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "created": STAMP}))
        self.zip.close()
        self.file.close()
        return self.address, len(self.lines), self.at


def write(records: DataFrame, folder: str, size: int = PACKAGE, level: int = 4) -> DataFrame:
    """Packages below ``folder`` and their manifest. Names are new for every attempt of a task."""
    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        package = None
        for frame in frames:
            done = []
            for row in frame.itertuples(index=False):
                if package is None:
                    package = Package(f"{folder}/{uuid.uuid4().hex}.wacz", level)
                package.add(row)
                if package.at >= size:
                    done.append(package.close())
                    package = None
            if done:
                yield pd.DataFrame(done, columns=["package", "n_records", "n_bytes"])
        if package is not None:
            yield pd.DataFrame([package.close()], columns=["package", "n_records", "n_bytes"])

    return written(records.mapInPandas(pack, MANIFEST), "manifest")


# --- reading ----------------------------------------------------------------


def index_entries(file, member: Member) -> Iterator[tuple[str, int, int]]:
    """(file name, offset, length) of each line of an index, plain or gzipped, a piece at a time."""
    squeezed = zlib.decompressobj(31) if member.name.endswith(".gz") else None
    rest, at, left = b"", data_at(file, member), member.size
    while left:
        piece = read_at(file, at, min(left, 1 << 20))
        at, left = at + len(piece), left - len(piece)
        while squeezed and piece:
            rest += squeezed.decompress(piece)
            piece = squeezed.unused_data
            if squeezed.eof:
                squeezed = zlib.decompressobj(31)
        *lines, rest = (rest + piece).split(b"\n")
        for line in lines if left else [*lines, rest]:
            if line.strip() and not line.startswith(b"!"):
                entry = json.loads(line[line.index(b"{") :])
                yield entry["filename"], int(entry["offset"]), int(entry["length"])


def scanned(file, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of each gzip member of a stored member without an index."""
    squeezed, at, begun, piece = zlib.decompressobj(31), 0, 0, b""
    while at < size or piece:
        if not piece:
            piece = read_at(file, start + at, min(size - at, 1 << 18))
            at += len(piece)
        squeezed.decompress(piece)
        piece = squeezed.unused_data
        if squeezed.eof:
            yield begun, at - len(piece) - begun
            begun, squeezed = at - len(piece), zlib.decompressobj(31)
    if begun != size:
        raise BadArchive("the last record is cut off")


def runs(places: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Records in order of their place, cut where a gap begins or ``RANGE`` bytes are full."""
    run: list[tuple[int, int]] = []
    for at, length in sorted(places):
        if run and (run[-1][0] + run[-1][1] != at or at + length - run[0][0] > RANGE):
            yield run
            run = []
        run.append((at, length))
    if run:
        yield run


def located(file, size: int) -> Iterator[list[tuple[int, int]]]:
    """Ranges of records, as absolute places, of one package."""
    found = members(file, size)
    warcs = {m.name.rsplit("/", 1)[-1]: m for m in found if m.name.startswith("archive/") and m.name.endswith(".warc.gz")}
    starts = {name: data_at(file, m) for name, m in warcs.items()}
    covered, held = set(), []
    for index in (m for m in found if m.name.startswith("indexes/") and m.name.removesuffix(".gz").endswith((".cdxj", ".cdx")) and m.size):
        for name, at, length in index_entries(file, index):
            if name not in warcs or at + length > warcs[name].size:
                raise BadArchive(f"the index names {name} at {at}, which is not there")
            covered.add(name)
            held.append((starts[name] + at, length))
            if len(held) >= LINES:
                yield from runs(held)
                held = []
    yield from runs(held)
    for name in sorted(warcs.keys() - covered):
        held = []
        for at, length in scanned(file, starts[name], warcs[name].size):
            held.append((starts[name] + at, length))
            if len(held) >= LINES:
                yield from runs(held)
                held = []
        yield from runs(held)


def ranges(packages: DataFrame) -> DataFrame:
    """(package, starts, lengths): what a reader takes at once, dealt out over all tasks."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for address in frame["package"]:
                fs, path = opened(address)
                with fs.open_input_file(path) as file:
                    try:
                        for run in located(file, file.size()):
                            starts, lengths = map(list, zip(*run))
                            yield pd.DataFrame({"package": [address], "starts": [starts], "lengths": [lengths]})
                    except (BadArchive, ValueError, KeyError, zlib.error) as bad:
                        raise BadArchive(f"{address}: {bad}") from bad

    # Numbers of their own: rows are few and short here, and AQE would join partitions that stand for much reading.
    n = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = packages.select("package").repartition(n, "package")
    found = found.mapInPandas(build, "package string, starts array<long>, lengths array<long>")
    return found.repartition(n, "package", F.col("starts")[0])


def headers(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip(" \t") for k, _, v in (line.decode("utf-8", "replace").partition(":") for line in lines)}


def parsed(data: bytes) -> dict:
    """The parts of one inflated record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not mark or not version.startswith(b"WARC/"):
        raise BadArchive("no WARC header")
    found = headers(lines)
    block = rest[: int(found["content-length"])]
    if len(block) != int(found["content-length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise BadArchive("the block's length is not the header's")
    payload = block
    if found.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    page = found.get("warc-page-id")
    return {
        "record_id": found["warc-record-id"].strip("<>"), "record_type": found["warc-type"], "page_id": None if page is None else int(page),
        "url": found.get("warc-target-uri"), "header_digest": found.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "refers_to_id": found["warc-refers-to"].strip("<>") if "warc-refers-to" in found else None, "payload": payload,
    }


def inflated(data: bytes) -> bytes:
    """One gzip member, whole."""
    squeezed = zlib.decompressobj(31)
    out = squeezed.decompress(data)
    if not squeezed.eof or squeezed.unused_data:
        raise BadArchive("not one whole gzip member")
    return out


def read_record(address: str, at: int, length: int) -> dict:
    """One record by its place, with one ranged read."""
    fs, path = opened(address)
    with fs.open_input_file(path) as file:
        return parsed(inflated(read_at(file, at, length)))


def read(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the packages. A revisit has no size, digest or payload of its own; see ``resolved``.

    A response whose bytes do not have the digest of its header raises.
    """

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for frame in frames:
            for package, starts, lengths in zip(frame["package"], frame["starts"], frame["lengths"]):
                fs, path = opened(package)
                out = []
                with fs.open_input_file(path) as file:
                    data = read_at(file, starts[0], starts[-1] + lengths[-1] - starts[0])
                for at, length in zip(starts, lengths):
                    try:
                        r = parsed(inflated(data[at - starts[0] : at - starts[0] + length]))
                        if r["record_type"] == "response":
                            r |= {"payload_bytes": len(r["payload"]), "payload_digest": hashlib.sha256(r["payload"]).hexdigest()}
                            if r["header_digest"] not in (None, r["payload_digest"]):
                                raise BadArchive("the payload does not have the header's digest")
                        if r["record_type"] != "response" or not payloads:
                            r["payload"] = None
                    except (KeyError, ValueError, zlib.error) as bad:
                        raise BadArchive(f"{package} at {at}: {bad!r}") from bad
                    out.append(r | {"package": package, "at": at})
                rows = pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "payload_bytes": "Int64"})
                yield rows.astype(object).where(rows.notna(), None).astype({"at": "int64", "page_id": "Int64", "payload_bytes": "Int64"})

    return ranges(packages).mapInPandas(build, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Every record with the size and digest of its full payload; a revisit takes them from the response it refers to."""
    responses = records.where("record_type = 'response'")
    own = responses.select("page_id", "record_type", "url", "payload_bytes", "payload_digest", F.lit(None).cast("long").alias("refers_to"))
    revisits = records.where("record_type = 'revisit'").select("page_id", "record_type", "url", "header_digest", F.col("refers_to_id").alias("record_id"))
    origin = responses.select("record_id", F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    right = F.col("payload_digest") == F.col("header_digest")
    checked = F.when(right, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a revisit's response is missing or has another digest")))
    found = revisits.join(origin, "record_id", "left").withColumn("payload_digest", checked)
    return own.unionByName(found.select(own.columns))


def op11_warc(pages: DataFrame) -> DataFrame:
    manifest = write(plan(pages), scratch(pages.sparkSession, "packages"))
    found = resolved(written(read(manifest, payloads=False).drop("payload"), "records"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    r AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS least FROM p)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= {SHARED} AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= {SHARED} AND page_id <> least THEN least END AS refers_to FROM r"""
