"""CSV inside zip archives.

Archives are read as a stream: Spark's text reader hands their bytes on in
pieces between line-feed bytes, the pieces of an archive are sorted into one
task, and there the first member whose name contains a pattern is inflated
piece by piece. No archive and no member is ever whole in memory. The lines
are stored on shared storage with their quote notes, as those of plain files
(:mod:`civitas.sources.records`), and parsed from there by many tasks.

Archives are staged in runs. A run's lines count once the run is in the
listing of what is complete, so a run that broke off half-way leaves nothing
behind that is read, and the next one stages only what the listing lacks.
A zip stream cannot be split: one archive is inflated by one task.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.session import scratch_path
from civitas.sources.csv import parse_named
from civitas.sources.records import NOTED, note_lines, records_of

CHUNK = 1 << 20     # bytes inflated at once
ROWS = 1 << 14      # lines handed on together at most
BETWEEN = "\0"      # between archive and member in a line's source path
LISTED = "path string, length long, modificationTime timestamp, member_like string, run string"


class MemberNotFound(RuntimeError):
    pass


class Stream:
    """Bytes of an archive, pulled in as they are needed."""

    def __init__(self, pieces: Iterator[bytes], name: str):
        self.pieces, self.buffer, self.name = pieces, b"", name

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.buffer += piece
        return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        if len(self.buffer) < n:
            raise ValueError(f"{self.name} ends too early")
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out

    def starts_with(self, mark: bytes) -> bool:
        while len(self.buffer) < len(mark) and self.more():
            pass
        return self.buffer.startswith(mark)


def member_bytes(stream: Stream, method: int, size: int | None) -> Iterator[bytes]:
    """The member at the stream's place, in chunks; ``size``: its stored bytes, None if only its end tells."""
    if method == 0 and size is not None:
        while size:
            n = min(size, CHUNK)
            yield stream.take(n)
            size -= n
    elif method == 8:
        inflate = zlib.decompressobj(-zlib.MAX_WBITS)
        while not inflate.eof:
            if not stream.buffer and not stream.more():
                raise ValueError(f"{stream.name} ends too early")
            chunk = inflate.decompress(stream.buffer, CHUNK)
            stream.buffer = inflate.unconsumed_tail or inflate.unused_data
            yield chunk
    else:
        raise ValueError(f"{stream.name}: members of method {method} without a size are not read")


def first_member(pieces: Iterator[bytes], member_like: str, archive: str) -> Iterator[str | bytes]:
    """The name of the first member that contains ``member_like``, then its bytes in chunks, its checksum compared."""
    stream = Stream(pieces, archive)
    while stream.starts_with(b"PK\x03\x04"):
        _, _, flags, method, _, _, crc, size, plain, n_name, n_extra = struct.unpack("<IHHHHHIIIHH", stream.take(30))
        name = stream.take(n_name).decode("utf-8" if flags & 0x800 else "cp437")
        extra = stream.take(n_extra)
        while len(extra) >= 4:                          # sizes of 4 GB and more stand in a block of their own
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1 and size == 0xFFFFFFFF:
                size = struct.unpack("<Q", extra[4 + 8 * (plain == 0xFFFFFFFF):][:8])[0]
            extra = extra[4 + n:]
        if flags & 1:
            raise ValueError(f"{archive}: {name} is encrypted")
        late = bool(flags & 8)                          # sizes and checksum follow the member
        wanted, found = member_like in name, 0
        if wanted:
            yield name
        for chunk in member_bytes(stream, method, None if late else size):
            if wanted:
                found = zlib.crc32(chunk, found)
                yield chunk
        if wanted:
            if late:
                crc = struct.unpack("<I", stream.take(8)[4:] if stream.starts_with(b"PK\x07\x08") else stream.take(4))[0]
            if found != crc:
                raise ValueError(f"{archive}: {name} is damaged")
            return
        if late:                                        # to the next header, past a record of 12 to 24 bytes
            stream.take(4 if stream.starts_with(b"PK\x07\x08") else 0)
            stream.take(12)
            if not any(stream.starts_with(m) for m in (b"PK\x03\x04", b"PK\x01\x02")):
                stream.take(8)
    raise MemberNotFound(f"{member_like!r} not found in {archive}")


def pieces_by_archive(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """Each archive of the sorted (path, piece) rows with its bytes; what the caller does not read is passed over."""
    def rows():
        for b in batches:
            at, paths = 0, b.column(0).to_pylist()
            while at < len(paths):
                end = at + 1
                while end < len(paths) and paths[end] == paths[at]:
                    end += 1
                yield paths[at], b.column(1).slice(at, end - at)
                at = end

    source = rows()
    held = next(source, None)

    def pieces(path):
        nonlocal held
        while held is not None and held[0] == path:
            part = held[1].to_pylist()
            held = next(source, None)
            yield b"\n".join(part) + b"\n"

    while held is not None:
        mine = pieces(held[0])
        yield held[0], mine
        for _ in mine:
            pass


def member_lines(batches: Iterator[pa.RecordBatch], member_like: str) -> Iterator[pa.RecordBatch]:
    """(path and member, start, line) rows of the archives' members."""
    for path, pieces in pieces_by_archive(batches):
        chunks = first_member(pieces, member_like, path)
        source, tail = path + BETWEEN + next(chunks), []

        def batch(lines, source=source):
            return pa.RecordBatch.from_arrays([pa.array([source] * len(lines)), pa.array([0] * len(lines), pa.int64()),
                                               pa.array(lines, pa.binary()).cast(pa.string())], names=["path", "start", "line"])

        for chunk in chunks:
            first, *rest = chunk.split(b"\n")
            tail.append(first)
            if rest:
                lines = [b"".join(tail), *rest[:-1]]
                tail = [rest[-1]]
                for i in range(0, len(lines), ROWS):
                    yield batch(lines[i:i + ROWS])
        if last := b"".join(tail):
            yield batch([last])


def stage_members(spark: SparkSession, path: str, member_like: str, stage: str, glob: str = "*.zip") -> DataFrame:
    """The noted lines of every archive under ``path``, staged in ``stage`` where they are not yet.

    An archive is known by path, length and time of change. One without a
    matching member, cut off or damaged fails the run: nothing of it counts.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length", "modificationTime")
    complete = _complete(spark, stage).filter(F.col("member_like") == member_like)
    todo = listing.join(complete, ["path", "length", "modificationTime"], "left_anti")
    todo = todo.collect()                               # the driver lists input files anyway
    if todo:
        run = uuid.uuid4().hex
        names = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in todo]
        bytes_of = spark.read.option("lineSep", "\n").text(names).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("piece"))
        streams = bytes_of.repartition("path").sortWithinPartitions("path", "start", "at").select("path", "piece")
        streams.mapInArrow(lambda batches: note_lines(member_lines(batches, member_like)), NOTED).write.option("compression", "zstd").parquet(f"{stage}/lines/{run}")
        spark.createDataFrame([(*r, member_like, run) for r in todo], LISTED).coalesce(1).write.mode("append").parquet(f"{stage}/complete")
    complete = _complete(spark, stage).filter(F.col("member_like") == member_like)
    runs = [r["run"] for r in complete.join(listing, ["path", "length", "modificationTime"], "left_semi").select("run").distinct().collect()]
    if not runs:
        return spark.createDataFrame([], NOTED)
    return spark.read.schema(NOTED).parquet(*[f"{stage}/lines/{r}" for r in sorted(runs)])


def _complete(spark: SparkSession, stage: str) -> DataFrame:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{stage}/complete")
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(LISTED).parquet(f"{stage}/complete")
    return spark.createDataFrame([], LISTED)


def read_zip_member_csv(spark: SparkSession, path: str, member_like: str, wanted: Mapping[str, str],
                        stage: str | None = None, glob: str = "*.zip") -> DataFrame:
    """``source_path, member, line_no`` and the wanted columns of every archive under ``path``.

    Columns are matched by header name, text cast to the given types; a
    missing column reads as NULL, and so do the missing markers of
    :func:`civitas.sources.csv.parse_named`. ``stage``: a folder on shared
    storage that keeps staged lines from run to run (a fresh one by default).
    """
    noted = stage_members(spark, path, member_like, stage or scratch_path(spark, "zip-members"), glob)
    rows = parse_named(records_of(noted), wanted, positions=True)
    place = F.split("source_path", BETWEEN)
    return rows.select(place[0].alias("source_path"), place[1].alias("member"), "line_no", *[F.col(f"`{n}`") for n in wanted])
