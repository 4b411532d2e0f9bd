"""Media columns: texts stored as lossless 8-bit images in archives, read back by byte ranges."""

from __future__ import annotations

import struct
import time
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import shared_dir, text_or_empty

#: Samples in an image row; payloads are padded to a multiple of it.
WIDTH = 64

#: An archive is closed and the next one begun when it has so many bytes.
ARCHIVE_BYTES = 128 << 20

_PNG = b"\x89PNG\r\n\x1a\n"
_LOCAL = struct.Struct("<4sHHHHHIIIHH")  # a zip member's local header


def payload_of(text: str) -> tuple[bytes, int]:
    """The text's UTF-8 bytes, filled up with 0 to a positive multiple of WIDTH, and how many there were."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + bytes(max(1, -(-len(raw) // WIDTH)) * WIDTH - len(raw)), len(raw)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes, n_bytes: int) -> bytes:
    """An 8-bit grey PNG of WIDTH columns with a payload byte for each sample; a private chunk holds ``n_bytes``."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    rows = np.zeros((len(samples), WIDTH + 1), np.uint8)  # each row begins with its filter type, 0
    rows[:, 1:] = samples
    return b"".join(
        (
            _PNG,
            _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)),
            _chunk(b"nbYt", struct.pack(">Q", n_bytes)),
            _chunk(b"IDAT", zlib.compress(rows, 1)),
            _chunk(b"IEND", b""),
        )
    )


def decode_png(media: bytes) -> tuple[bytes, int]:
    """The payload and n_bytes of what ``encode_png`` made; ValueError for anything else."""
    if not media.startswith(_PNG):
        raise ValueError("not a PNG")
    at, chunks = len(_PNG), {}
    while at < len(media):
        (size,) = struct.unpack_from(">I", media, at)
        kind, data = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(media[at + 4 : at + 8 + size]):
            raise ValueError(f"chunk {kind!r} is damaged")
        chunks[kind] = data
        at += 12 + size
    width, height = struct.unpack_from(">II", chunks[b"IHDR"])
    rows = np.frombuffer(zlib.decompress(chunks[b"IDAT"]), np.uint8).reshape(height, width + 1)
    return rows[:, 1:].tobytes(), struct.unpack(">Q", chunks[b"nbYt"])[0]


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _publish(store: fs.FileSystem, draft: str, final: str) -> None:
    """Rename, so that readers see whole archives only; a repeated attempt of a task writes the same name again."""
    try:
        store.move(draft, final)
    except OSError:  # some stores don't rename over an earlier attempt's file
        if store.get_file_info(final).type != fs.FileType.File:
            raise
        store.delete_file(draft)


def write_archives(docs: DataFrame, path: str) -> int:
    """Store each row's whole text as a PNG in zip archives under ``path``; returns the number of members.

    Every task writes its partition to archives of its own, named after the
    partition, so a task that is repeated after a lost executor replaces its
    files. A null text is empty; a null doc_id and repeated rows get members
    like others; no rows, no members.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _opened(path)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}"
        part, members, archive, draft = 0, 0, None, ""
        stream = None

        def close() -> None:
            archive.close()
            stream.close()
            _publish(store, draft, f"{folder}/{name}-{part:04d}.zip")

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if archive is None:
                    draft = f"{folder}/.{name}-{part:04d}-{task.taskAttemptId()}.draft"
                    stream = store.open_output_stream(draft)
                    archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                archive.writestr(
                    zipfile.ZipInfo(f"{members:08d}/{'null' if doc is None else doc}.png"),
                    encode_png(*payload_of(text.as_py() or "")),
                )
                members += 1
                if stream.tell() >= ARCHIVE_BYTES:
                    close()
                    archive, part = None, part + 1
        if archive is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([members], pa.int64())], ["members"])

    store, folder = _opened(path)
    store.create_dir(folder, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "members long").agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]


class MemberReader:
    """Reads the members of one archive by their offsets; each is tried again on its own."""

    def __init__(self, open_archive: Callable[[], object], attempts: int = 3, pause: float = 0.1):
        self.open_archive, self.attempts, self.pause = open_archive, attempts, pause
        self.source = open_archive()

    def directory(self) -> list[zipfile.ZipInfo]:
        with zipfile.ZipFile(self.source) as archive:
            found = sorted(archive.infolist(), key=lambda m: m.header_offset)
        self.source = self.open_archive()  # ZipFile may close what it is given
        return found

    def _read(self, member: zipfile.ZipInfo) -> bytes:
        self.source.seek(member.header_offset)
        head = _LOCAL.unpack(self.source.read(_LOCAL.size))
        if head[0] != b"PK\x03\x04":
            raise ValueError("no member begins at this offset")
        self.source.seek(member.header_offset + _LOCAL.size + head[9] + head[10])
        data = self.source.read(member.compress_size)
        if len(data) != member.compress_size or zlib.crc32(data) != member.CRC:
            raise ValueError("the member's bytes don't match its checksum")
        return data

    def read(self, member: zipfile.ZipInfo) -> tuple[bytes | None, int, str | None]:
        """(bytes, attempts, None), or (None, attempts, what failed last)."""
        error = None
        for attempt in range(1, self.attempts + 1):
            try:
                return self._read(member), attempt, None
            except (OSError, ValueError, struct.error) as e:
                error = f"{type(e).__name__}: {e}"
                time.sleep(self.pause * attempt)
                try:
                    self.source = self.open_archive()
                except OSError as e2:
                    error = f"{type(e2).__name__}: {e2}"
        return None, self.attempts, error


class ByteRange(InputPartition):
    """The members of an archive that begin in [start, stop)."""

    def __init__(self, archive: str, start: int, stop: int):
        self.archive, self.start, self.stop = archive, start, stop


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.range_bytes = int(options.get("range_bytes", 16 << 20))
        self.batch_bytes = int(options.get("batch_bytes", 4 << 20))
        self.attempts = int(options.get("attempts", 3))
        self.strict = options.get("on_error", "row") == "raise"

    def partitions(self) -> list[ByteRange]:
        store, folder = _opened(self.path)
        found = store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        return [
            ByteRange(f.path, at, at + self.range_bytes)
            for f in sorted(found, key=lambda f: f.path)
            if f.type == fs.FileType.File and f.extension == "zip" and not f.base_name.startswith(".")
            for at in range(0, f.size, self.range_bytes)
        ] or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        store, _ = _opened(self.path)
        reader = MemberReader(lambda: store.open_input_file(partition.archive), self.attempts)
        rows, size = [], 0
        for member in reader.directory():
            if partition.start <= member.header_offset < partition.stop:
                media, attempts, error = reader.read(member)
                if error and self.strict:
                    raise OSError(f"{partition.archive}, offset {member.header_offset}: {error}")
                rows.append((partition.archive, member.filename, member.header_offset, media, attempts, error))
                size += len(media or b"")
                if size >= self.batch_bytes:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int32(), pa.string()]
        names = ["archive", "member", "offset", "media", "attempts", "error"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class MediaArchives(DataSource):
    """``spark.read.format("media_archives").load(folder)``: a row for each member of the zip archives in a folder.

    Options: range_bytes (a partition covers so much of one archive), batch_bytes
    (payload in an Arrow batch), attempts (for each member) and on_error ("row":
    a member that can't be read has null media and its error; "raise").
    The members must be stored, not deflated.
    """

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return "archive string, member string, offset long, media binary, attempts int, error string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").options(**options).load(path)


def features(samples: bytes) -> str:
    """Mean, deviation, entropy of the 8-bit samples, mean step along a row, and share of zeros."""
    values = np.frombuffer(samples, np.uint8)
    counts = np.bincount(values, minlength=256)
    share = counts[counts > 0] / len(values)
    levels = np.arange(256)
    mean = float(counts @ levels) / len(values)
    deviation = max(0.0, float(counts @ (levels * levels)) / len(values) - mean * mean) ** 0.5
    steps = np.abs(np.diff(values.reshape(-1, WIDTH).astype(np.int16), axis=1)).sum() / (len(values) // WIDTH * (WIDTH - 1))
    return (
        f"mean={mean:.4f};std={deviation:.4f};entropy={float(-(share * np.log2(share)).sum()):.4f};"
        f"step={float(steps):.4f};zero={counts[0] / len(values):.4f}"
    )


def media_features(members: DataFrame) -> DataFrame:
    """Decode the column media and describe it; rows whose media is null (not readable) get null features.

    Returns doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the
    last 64 payload bytes), media_bytes, media_sha256, feature. Equal texts
    have equal values in all but doc_id.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for batch in batches:
            rows = []
            for member, media in zip(batch.column(0).to_pylist(), batch.column(1)):
                name = member.rpartition("/")[2].removesuffix(".png")
                doc, media = None if name == "null" else int(name), media.as_py()
                if media is None:
                    rows.append((doc, *[None] * 7))
                    continue
                payload, n_bytes = decode_png(media)
                rows.append(
                    (doc, n_bytes, len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), sha256(media).hexdigest(), features(payload))
                )
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return members.select("member", "media").mapInArrow(
        run,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
        "media_bytes long, media_sha256 string, feature string",
    )


def store_and_describe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the texts of ``docs`` to archives, read them back through the data source and describe them.

    ``path`` is a folder that the whole cluster reaches, by default a new one in
    the shared folder. Other columns than doc_id and text are not read.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "media")
    write_archives(docs, path)
    return media_features(read_archives(spark, path, on_error="raise"))
