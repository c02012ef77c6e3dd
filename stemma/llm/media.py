"""Media columns: archives of media members, read by a custom data source over byte ranges.

An archive is a file of members, each with a header (sizes, checksum) and its identifier as text before its payload, and a footer with
the members' offsets. ``write_archives`` fills a directory of them; archives are closed at ``ARCHIVE_BYTES``, so a
footer stays small. The data source lists the directory once, plans one partition for each ``range_bytes`` of an
archive, and a partition reads the members that begin in its range. Payloads leave in Arrow batches of at most
``BATCH_BYTES`` (or one member), read by one handle for the range. A member whose read or checksum fails is retried on its
own, from its offset, by a fresh handle; members before it are not read again. What fails every time raises, or with ``on_error=report`` becomes a row with ``error``.

Files are named by partition and written under a temporary name first, so a repeated task after a lost executor
replaces its files with equal ones. Paths go through ``pyarrow.fs``, so any store it knows will do.
"""

from __future__ import annotations

import hashlib
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stemma.llm.cluster import shared_path

#: Samples in a row of the image; payloads are padded to whole rows.
WIDTH = 64
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 16 << 20
BATCH_BYTES = 8 << 20
TRIES = 4
_MEMBER = struct.Struct("<8s?7xQQQI4x")  # mark, has identifier, its bytes, unpadded bytes, media bytes, CRC-32 of the media
_FOOTER = struct.Struct("<QQ8s")  # where the offsets begin, their number, mark
_MARK, _END = b"STEMMAM2", b"STEMMAE2"
_PNG = b"\x89PNG\r\n\x1a\n"


# ---------- the stored form: an 8-bit grey PNG ----------


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def padded(text: bytes) -> bytes:
    """Zero bytes up to a positive multiple of WIDTH."""
    return text + bytes(-len(text) % WIDTH if text else WIDTH)


def encode_image(payload: bytes) -> bytes:
    """The payload's bytes as grey samples, losslessly; equal payloads give equal files."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each line begins with its filter number, 0
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def decode_image(media: bytes) -> bytes:
    """The samples of an image that ``encode_image`` made; a damaged chunk raises ValueError."""
    if media[:8] != _PNG:
        raise ValueError("no PNG")
    at, data, size = 8, b"", (0, 0)
    while at < len(media):
        (n,), kind = struct.unpack_from(">I", media, at), media[at + 4 : at + 8]
        body = media[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", media, at + 8 + n)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"damaged chunk {kind!r}")
        if kind == b"IHDR":
            size = struct.unpack_from(">II", body)
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(size[1], size[0] + 1)
    return lines[:, 1:].tobytes()


def features(samples: bytes) -> str:
    """Size, mean, deviation and entropy of the samples, and the share of rows that repeat the row before."""
    x = np.frombuffer(samples, np.uint8)
    counts = np.bincount(x, minlength=256)
    p, levels = counts / len(x), np.arange(256)
    mean = float((p * levels).sum())
    deviation = float(np.sqrt(max(0.0, (p * levels * levels).sum() - mean * mean)))
    some = p[p > 0]
    rows = x.reshape(-1, WIDTH)
    same = float((rows[1:] == rows[:-1]).all(axis=1).mean()) if len(rows) > 1 else 0.0
    return f"grey8 {WIDTH}x{len(rows)} mean={mean:.4f} dev={deviation:.4f} entropy={float(-(some * np.log2(some)).sum()):.4f} same={same:.4f}"


# ---------- archives ----------


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Archive:
    """One open archive."""

    def __init__(self, fs: pafs.FileSystem, path: str) -> None:
        self.fs, self.path, self.temp = fs, path, f"{path}.tmp-{uuid.uuid4().hex}"
        self.out, self.at, self.offsets = fs.open_output_stream(self.temp), 0, []

    def add(self, key: str | None, n_bytes: int, media: bytes) -> int:
        self.offsets.append(self.at)
        name = (key or "").encode()
        self.out.write(_MEMBER.pack(_MARK, key is not None, len(name), n_bytes, len(media), zlib.crc32(media)) + name)
        self.out.write(media)
        self.at += _MEMBER.size + len(name) + len(media)
        return self.offsets[-1]

    def close(self) -> None:
        self.out.write(struct.pack(f"<{len(self.offsets)}Q", *self.offsets) + _FOOTER.pack(self.at, len(self.offsets), _END))
        self.out.close()
        if self.fs.get_file_info(self.path).type == pafs.FileType.File:  # an earlier attempt's, with the same content
            self.fs.delete_file(self.path)
        self.fs.move(self.temp, self.path)


def write_archives(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Store each row's text as a media member in archives below ``path``; returns the number of members.

    Null texts count as empty. Rows are stored as often as they occur; null identifiers stay null, others are kept as text,
    whatever their type.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _store(path)
        fs.create_dir(root, recursive=True)
        part, seq, total, archive = TaskContext.get().partitionId(), 0, 0, None
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                if archive is None:
                    archive, seq = _Archive(fs, f"{root}/part-{part:06d}-{seq:05d}.pack"), seq + 1
                raw = text.as_py() or b""
                archive.add(key, len(raw), encode_image(padded(raw)))
                total += 1
                if archive.at >= archive_bytes:
                    archive.close()
                    archive = None
        if archive is not None:
            archive.close()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["members"])

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return rows.mapInArrow(put, "members bigint").agg(F.sum("members")).first()[0] or 0


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, stop: int) -> None:
        self.path, self.start, self.stop = path, start, stop


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.tries = int(options.get("tries", TRIES))
        self.report = options.get("on_error", "fail") == "report"

    def partitions(self) -> list[ByteRange]:
        fs, root = _store(self.path)
        files = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted((f.path, f.size) for f in files if f.type == pafs.FileType.File and f.path.endswith(".pack"))
        return [ByteRange(p, at, min(size, at + self.range_bytes)) for p, size in files for at in range(0, size, self.range_bytes)] or [ByteRange("", 0, 0)]

    @staticmethod
    def _parsed(raw: bytes, at: int, path: str) -> tuple[str | None, int, bytes]:
        mark, has, named, n_bytes, size, crc = _MEMBER.unpack_from(raw)
        media = raw[_MEMBER.size + named :]
        if mark != _MARK or size != len(media) or crc != zlib.crc32(media):
            raise OSError(f"damaged member at {at} of {path}")
        return raw[_MEMBER.size : _MEMBER.size + named].decode() if has else None, n_bytes, media

    def _member(self, fs: pafs.FileSystem, path: str, at: int, stop: int, handle: pa.NativeFile | None = None) -> tuple[str | None, int, bytes]:
        """The member at an offset, by the range's handle or one of its own."""
        if handle is not None:
            return self._parsed(handle.read_at(stop - at, at), at, path)
        with fs.open_input_file(path) as f:
            return self._parsed(f.read_at(stop - at, at), at, path)

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = _store(self.path)
        with fs.open_input_file(partition.path) as f:
            size = f.size()
            begin, n, mark = _FOOTER.unpack(f.read_at(_FOOTER.size, size - _FOOTER.size))
            if mark != _END:
                raise OSError(f"{partition.path} has no footer")
            offsets = struct.unpack(f"<{n}Q", f.read_at(8 * n, begin))
            rows, held = [], 0
            for at, stop in pairwise((*offsets, begin)):
                if not partition.start <= at < partition.stop:
                    continue
                for left in reversed(range(self.tries)):
                    try:
                        row = (*self._member(fs, partition.path, at, stop, f if left == self.tries - 1 else None), at, partition.path, None)
                        break
                    except (OSError, ValueError, struct.error) as e:
                        if left:
                            time.sleep(0.05 * (self.tries - left))
                        elif self.report:
                            row = (None, None, None, at, partition.path, str(e))
                        else:
                            raise
                rows.append(row)
                held += len(row[2] or b"")
                if held >= BATCH_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
            if rows:
                yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ArchiveSource.NAMES)


class ArchiveSource(DataSource):
    """``spark.read.format("stemma_archive").load(directory)``; options: range_bytes, tries, on_error (fail, report)."""

    NAMES = ["doc_id", "n_bytes", "media", "offset", "archive", "error"]

    @classmethod
    def name(cls) -> str:
        return "stemma_archive"

    def schema(self) -> str:
        return "doc_id string, n_bytes bigint, media binary, offset bigint, archive string, error string"

    def reader(self, schema: object) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, path: str, **options: object) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("stemma_archive").options(**{k: str(v) for k, v in options.items()}).load(path)


def describe(members: DataFrame) -> DataFrame:
    """Digests and features of members as read: one row for each. Members that could not be read have nulls."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for media in b.column(2):
                stored = media.as_py()
                if stored is None:
                    rows.append((None,) * 6)
                    continue
                samples = decode_image(stored)
                rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), features(samples)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], _DESCRIBED)

    schema = "doc_id string, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return members.select("doc_id", "n_bytes", "media").mapInArrow(of, schema)


_DESCRIBED = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def media_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as a media member, read the archives back through the data source and describe each member.

    One row per input row, identifiers in their own type; null texts count as empty (64 zero samples). An empty input gives an empty result. The
    archives stay in the shared folder, which the result still reads.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "archives")
    write_archives(docs, path, id_col, text_col)
    made = describe(read_archives(spark, path))
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)).withColumnRenamed("doc_id", id_col)
