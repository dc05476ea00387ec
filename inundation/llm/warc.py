"""WARC archives: writing them, and a normaliser for archives that are one gzip stream.

``write_monolithic`` writes a file per partition, whose records all lie in one gzip member, as naive crawlers leave it: nothing in
it can be read without inflating all before it.  ``normalise`` inflates each such file once, as a stream, and rewrites every record
as a gzip member of its own, next to a sidecar index of offsets.  ``read_records`` fetches records by that index.  Records with equal
payloads of ``LEAST_REVISIT`` bytes or more are stored once: that of the smallest id is the response, the others revisit it.

Files go to a folder that driver and executors share, by a temporary name first, so that a task that runs again replaces its own
file and nobody sees half a file.  Task memory holds one record at a time and a buffer.

Defined cases: a null payload is empty; a null id sorts after all others and gives a record without an id; rows that repeat with the
same id are records of their own, and the response of equal ones is the first in id, then in address.  Columns besides the named
ones are ignored.  An empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads that are shorter are always stored; the gzip framing of zlib; the version line of a record.
LEAST_REVISIT = 100
GZIP = 31
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 1
BUFFER = 1 << 20
#: Records that share a response's id are dealt over so many parts while they are matched to it.
SALTS = 64
#: Parts over which the revisits of one response are spread when they are put to it.
REVISIT_SALTS = 16
#: Bytes of payloads in a batch of records that were read.
BATCH_BYTES = 8 << 20


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _write(fs: pa.fs.FileSystem, path: str, fill: Callable) -> None:
    """Writes under a name of this attempt, then moves the file to its place."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(part, compression=None, buffer_size=BUFFER) as out:
        fill(out)
    fs.move(part, path)


def with_revisits(pages: DataFrame, id_col: str, payload_col: str, uri_col: str) -> DataFrame:
    """``id``, ``uri``, ``payload``, ``digest`` and ``refers_to``, the id of the response that a revisit stands for."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(uri_col).cast("string"), F.lit("")).alias("uri"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long = rows.where(F.octet_length("payload") >= LEAST_REVISIT)
    # Equal payloads combine before the shuffle; the smallest of all ids, nulls last.
    least = long.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("uri"))).alias("first"), F.count("*").alias("n"))
    # Only digests found twice are of interest.  They are spread, so that no digest's rows meet in one task.
    first = least.where("n > 1").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "uri"), F.lit(SALTS)).cast("int"))
    here = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("uri"))
    revisit = F.col("first").isNotNull() & (here != F.col("first"))
    return salted.join(first, ["digest", "salt"], "left").select(
        "id", "uri", "payload", "digest", F.when(revisit, F.col("first")["id"]).alias("refers_to"), revisit.alias("is_revisit")
    )


def record_bytes(record_id: str, ident: int | None, uri: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    head = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        f"WARC-Record-ID: <urn:uuid:{record_id}>".encode(),
        b"WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A").encode(),
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
        # What a revisit leaves out, so that its payload's size is known without the response.
        f"X-Payload-Length: {len(payload)}".encode(),
    ]
    if ident is not None:
        head.append(f"X-Page-ID: {ident}".encode())
    if revisit:
        head.append(f"WARC-Profile: {REVISIT_PROFILE}".encode())
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}".encode())
    body = b"" if revisit else payload
    head += [b"Content-Type: application/octet-stream", f"Content-Length: {len(body)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def _record_id(*parts) -> str:
    return str(uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16], version=5))


def write_monolithic(records: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """A file per partition that has rows, in one gzip member; returns ``archive`` and ``n_records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        archive, n = f"part-{TaskContext.get().partitionId():06d}.warc.gz", 0

        def rows() -> Iterator[dict]:
            for b in batches:
                for i in range(len(b)):
                    yield {k: c[i].as_py() for k, c in zip(b.schema.names, b.columns, strict=True)}

        todo = rows()
        first = next(todo, None)

        def fill(out) -> None:
            nonlocal n
            pack, row = zlib.compressobj(level, zlib.DEFLATED, GZIP), first
            while row is not None:
                ident = _record_id(archive, n)
                out.write(pack.compress(record_bytes(ident, row["id"], row["uri"], row["payload"], row["digest"], row["refers_to"], row["is_revisit"])))
                n += 1
                row = next(todo, None)
            out.write(pack.flush())

        if first is not None:
            _write(fs, f"{base}/{archive}", fill)
            yield pa.RecordBatch.from_pydict({"archive": [archive], "n_records": [n]})

    return records.select("id", "uri", "payload", "digest", "refers_to", "is_revisit").mapInArrow(run, "archive string, n_records long")


def read_stream(source) -> Iterator[bytes]:
    """The inflated bytes of a gzip file of any number of members, a buffer at a time."""
    unpack = zlib.decompressobj(GZIP)
    while raw := source.read(BUFFER):
        while raw:
            if unpack.eof:
                unpack = zlib.decompressobj(GZIP)
            part = unpack.decompress(raw, 4 * BUFFER)
            if part:
                yield part
            raw = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
    if tail := unpack.flush():
        yield tail


def split_records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records as their header and all of their bytes; ends within a record are an error."""
    held = bytearray()

    def more() -> bool:
        part = next(parts, None)
        held.extend(part or b"")
        return part is not None

    while True:
        while (at := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held:
                    raise ValueError("The archive ends within a record's header")
                return
        lines = bytes(held[:at]).split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"Not a WARC record: {lines[0][:40]!r}")
        head = {k.strip().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines[1:])}
        end = at + 4 + int(head["Content-Length"]) + 4
        while len(held) < end:
            if not more():
                raise ValueError("The archive ends within a record")
        yield head, bytes(held[:end])
        del held[:end]


def normalise(archives: DataFrame, folder: str, into: str, level: int = LEVEL) -> DataFrame:
    """Rewrites the named archives of ``folder`` record by record; returns the index that it also writes beside each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, base), (to, target) = _filesystem(folder), _filesystem(into)
        for b in batches:
            for archive in b.column("archive").to_pylist():
                index: dict[str, list] = {"archive": [], "record_id": [], "offset": [], "length": []}

                def fill(out, archive=archive, index=index) -> None:
                    at = 0
                    with fs.open_input_stream(f"{base}/{archive}", compression=None) as source:
                        for head, record in split_records(read_stream(source)):
                            pack = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                            member = pack.compress(record) + pack.flush()
                            out.write(member)
                            for k, v in zip(index, (archive, head["WARC-Record-ID"], at, len(member)), strict=True):
                                index[k].append(v)
                            at += len(member)

                _write(to, f"{target}/{archive}", fill)
                lines = (json.dumps({k: index[k][i] for k in index}) + "\n" for i in range(len(index["archive"])))
                _write(to, f"{target}/{archive}.idx", lambda out, lines=lines: [out.write(x.encode()) for x in lines])
                yield pa.RecordBatch.from_pydict(index, schema=pa.schema({"archive": pa.string(), "record_id": pa.string(), "offset": pa.int64(), "length": pa.int64()}))

    fs, target = _filesystem(into)
    fs.create_dir(target, recursive=True)
    # A file per task at most; names and counts only are dealt out.
    n = max(1, archives.count())
    return archives.select("archive").repartition(n, "archive").mapInArrow(run, "archive string, record_id string, offset long, length long")


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The indexed records, each read at its offset: header fields, the digest of what was stored and, if wanted, the payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        opened, name = None, None
        out: dict[str, list] = {k: [] for k in _READ.names}
        held = 0
        try:
            for b in batches:
                for archive, at, size in zip(*(b.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                    if archive != name:
                        if opened is not None:
                            opened.close()
                        opened, name = fs.open_input_file(f"{base}/{archive}"), archive
                    opened.seek(at)
                    raw = opened.read(size)
                    (head, record), *rest = split_records(read_stream(io.BytesIO(raw)))
                    if rest:
                        raise ValueError(f"{archive} holds more than one record at {at}")
                    body = record[record.find(b"\r\n\r\n") + 4 : -4]
                    kind, named = head["WARC-Type"], head["WARC-Payload-Digest"].partition(":")[2]
                    number = lambda k, head=head: int(head[k]) if k in head else None
                    stored = kind == "response"
                    found = hashlib.sha256(body).hexdigest() if stored else named
                    values = (
                        number("X-Page-ID"), head["WARC-Target-URI"], kind, number("X-Refers-To-Page-ID"),
                        len(body) if stored else number("X-Payload-Length"), found, body if stored and payloads else None, found == named,
                    )
                    for k, v in zip(out, values, strict=True):
                        out[k].append(v)
                    held += len(values[6] or b"")
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict(out, schema=_READ)
                        out, held = {k: [] for k in _READ.names}, 0
                yield pa.RecordBatch.from_pydict(out, schema=_READ)
                out, held = {k: [] for k in _READ.names}, 0
        finally:
            if opened is not None:
                opened.close()

    return index.mapInArrow(run, _READ_SQL)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records as they were read, revisits with the size and digest of the response that is stored for them.

    A revisit is intact if a response with its digest is stored under the id that it refers to, whole and of the size that the
    revisit gives; without such a response its size and digest are null.  Only ids, digests and sizes are shuffled, and revisits of one response are spread over
    ``REVISIT_SALTS`` parts.
    """
    slim = records.select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "intact")
    asked = slim.where("record_type = 'revisit'").select("refers_to", "payload_digest").distinct()
    held = slim.where("record_type = 'response'").groupBy(F.col("page_id").alias("found_id"), F.col("payload_digest").alias("found_digest"))
    held = held.agg(F.max("payload_bytes").alias("found_bytes"), F.max("intact").alias("found_intact"))
    match = F.col("refers_to").eqNullSafe(F.col("found_id")) & (F.col("payload_digest") == F.col("found_digest"))
    found = asked.join(held, match).select("found_id", "found_digest", "found_bytes", "found_intact")
    # Digests travel as bytes, half as long as their digits.
    salts = F.explode(F.sequence(F.lit(0), F.lit(REVISIT_SALTS - 1)))
    found = found.withColumn("found_digest", F.unhex("found_digest")).withColumn("found_salt", salts)
    salted = records.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(REVISIT_SALTS)).cast("int")).withColumn("digest", F.unhex("payload_digest"))
    revisits, others = salted.where("record_type = 'revisit'"), records.where("record_type <> 'revisit'")
    on = (F.col("salt") == F.col("found_salt")) & F.col("refers_to").eqNullSafe(F.col("found_id")) & (F.col("digest") == F.col("found_digest"))
    intact = F.coalesce(F.col("found_intact") & (F.col("found_bytes") == F.col("payload_bytes")), F.lit(False))
    proven = revisits.join(found, on, "left").withColumns({"intact": intact, "payload_bytes": F.col("found_bytes"), "payload_digest": F.lower(F.hex("found_digest"))})
    return others.unionByName(proven.select(*records.columns))


_READ = pa.schema(
    {"page_id": pa.int64(), "uri": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(),
     "payload_digest": pa.string(), "payload": pa.binary(), "intact": pa.bool_()}
)
_READ_SQL = "page_id long, uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, intact boolean"


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar indexes of a folder."""
    return spark.read.schema("archive string, record_id string, offset long, length long").option("pathGlobFilter", "*.idx").json(folder)
