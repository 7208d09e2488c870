"""A mirror of a run's folder by byte tails: a streaming source and sink of Spark.

The source's offset is the number of bytes of each ``.jsonl`` file that were seen (size and time of change
of any other file). A batch is dealt into pieces of ``PIECE`` bytes, which begin and end at line breaks, so tasks read
one large file side by side. The sink writes each piece as a file of its own, named by the place of its
first byte, in a folder with the log's name: parts in order of their names are the log, and no line is cut in two.
Bytes behind the last line break are a part by themselves; when the line is finished, the part that
begins at the same byte takes its place. So a part is written whole or not at all, a repeated batch writes the same
parts again, and a new stream goes on where the target ends, with or without a checkpoint. A target that
has more than the source is left alone. Other files are copied whole where size or time differ.

Edge cases: an empty file has no part; a file that isn't there any more is passed over; process files, hidden
files and checksums aren't mirrored; a line of any length is read whole by one task.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import absolute

SCHEMA = "file string, start long, data binary"
#: Bytes of a log that a task reads at a time, and bytes looked through at a time for a line break.
PIECE, LOOK = 16 << 20, 1 << 16
#: Pieces of a task, if together they have no more bytes than one may have.
MOST_PIECES = 32
#: What isn't mirrored.
PASSED = re.compile(r"(^|/)(\.|_temporary(/|$))|\.(pid|crc|lock)$")


def listed(uri: str) -> dict[str, tuple[int, int]]:
    """(bytes, time of change) of every file below ``uri``, by its path from there."""
    files, root = FileSystem.from_uri(uri)
    infos = files.get_file_info(FileSelector(root, recursive=True, allow_not_found=True))
    found = {i.path[len(root.rstrip("/")) + 1 :]: (i.size, i.mtime_ns or 0) for i in infos if i.type == FileType.File}
    return {name: stamp for name, stamp in found.items() if not PASSED.search(name)}


def mirrored(uri: str) -> dict[str, tuple[int, int]]:
    """As ``listed``, of a mirror: the parts of a log count as one file, up to the first byte that is lacking.

    A batch that was broken off may have left later parts behind a gap; they don't count, and are written again.
    """
    out: dict[str, tuple[int, int]] = {}
    parts: dict[str, list[tuple[int, int, int]]] = {}
    for name, (size, changed) in listed(uri).items():
        log, _, part = name.rpartition("/")
        if log.endswith(".jsonl") and part.isdigit():
            parts.setdefault(log, []).append((int(part), size, changed))
        else:
            out[name] = (size, changed)
    for log, own in parts.items():
        upto = 0
        for start, size, _ in sorted(own):
            if start > upto:
                break
            upto = max(upto, start + size)
        out[log] = (upto, max(c for *_, c in own))
    return out


@dataclass
class Piece:
    """Bytes ``first`` to ``upto`` of a log of which ``end`` are there; ``whole`` for another file."""

    file: str
    first: int = 0
    upto: int = 0
    end: int = 0
    whole: bool = False


@dataclass
class Pieces(InputPartition):
    """What one task reads, piece by piece."""

    pieces: list[Piece]


def packed(pieces: list[tuple[int, Piece]], most: int) -> list[Pieces]:
    """Pieces with their bytes, in their order, as tasks of at most ``most`` bytes or one piece."""
    out: list[Pieces] = []
    room = 0
    for size, piece in pieces:
        if not out or size > room or len(out[-1].pieces) == MOST_PIECES:
            out.append(Pieces([]))
            room = most
        out[-1].pieces.append(piece)
        room -= size
    return out


class TailReader(DataSourceStreamReader):
    def __init__(self, options):
        self.source, self.target, self.piece = options["path"], options["target"], int(options.get("piece", PIECE))

    def initialOffset(self) -> dict:
        there, here = mirrored(self.target), listed(self.source)
        # Another file is in the mirror if what is there is as large, and no older.
        same = lambda f: f in there and there[f][0] == here[f][0] and there[f][1] >= here[f][1]
        return {f: there[f][0] if f.endswith(".jsonl") else list(here[f]) for f in here if f in there and (f.endswith(".jsonl") or same(f))}

    def latestOffset(self) -> dict:
        there = mirrored(self.target)
        return {f: max(size, there.get(f, (0, 0))[0]) if f.endswith(".jsonl") else [size, changed] for f, (size, changed) in listed(self.source).items()}

    def partitions(self, start: dict, end: dict) -> list[Pieces]:
        """What the target lacks, which is the truth also where another stream, or a broken batch, went on from ``start``."""
        out, there = [], mirrored(self.target)
        for f, upto in end.items():
            if not f.endswith(".jsonl"):
                out += [(upto[0], Piece(f, whole=True))] if start.get(f) != upto else []
                continue
            first = there.get(f, (0, 0))[0]
            cuts = [first, *range((first // self.piece + 1) * self.piece, upto, self.piece), upto] if first < upto else []
            out += [(b - a, Piece(f, a, b, upto)) for a, b in zip(cuts, cuts[1:])]
        return packed(out, self.piece)

    def read(self, partition: Pieces) -> Iterator[tuple]:
        files, root = FileSystem.from_uri(self.source)
        for piece in partition.pieces:
            yield from self.bytes_of(files, root, piece)

    def bytes_of(self, files: FileSystem, root: str, piece: Piece) -> Iterator[tuple]:
        path = f"{root.rstrip('/')}/{piece.file}"
        if files.get_file_info(path).type != FileType.File:
            return
        with files.open_input_file(path) as f:
            if piece.whole:
                yield piece.file, -1, f.read()
                return
            if (end := piece.end) > f.size():
                return  # it was cut short since it was listed
            # The line that the first piece's first byte is in begins before it, unless a line break is just there.
            begin, upto = line_start(f, piece.first, end), end if piece.upto >= end else line_start(f, piece.upto, end)
            if begin >= upto:
                return
            data = f.read_at(upto - begin, begin)
            lines = data.rfind(b"\n") + 1 if upto == end else len(data)
            if lines:
                yield piece.file, begin, data[:lines]
            if lines < len(data):
                yield piece.file, begin + lines, data[lines:]


def line_start(f, at: int, end: int) -> int:
    """The place of the first byte of the line that byte ``at`` is in."""
    at = min(at, end)
    while at > 0:
        first = max(at - LOOK, 0)
        if (found := f.read_at(at - first, first).rfind(b"\n")) >= 0:
            return first + found + 1
        at = first
    return 0


@dataclass
class Copied(WriterCommitMessage):
    parts: int


class PartWriter(DataSourceStreamWriter):
    def __init__(self, options):
        self.target = options["path"]

    def write(self, rows: Iterator) -> Copied:
        files, root = FileSystem.from_uri(self.target)
        n = 0
        for n, (file, start, data) in enumerate(rows, 1):
            place = f"{root.rstrip('/')}/{file}"
            if start < 0:
                put(files, place, bytes(data))
                continue
            put(files, f"{place}/{start:020d}", bytes(data))
            # Parts that a broken batch, or an unfinished line, left within these bytes.
            for info in files.get_file_info(FileSelector(place)):
                if info.base_name.isdigit() and start < int(info.base_name) < start + len(data):
                    files.delete_file(info.path)
        return Copied(n)

    def commit(self, messages, batchId) -> None:
        """Each part came into its place when it was whole."""

    abort = commit


def put(files: FileSystem, place: str, data: bytes) -> None:
    folder, _, name = place.rpartition("/")
    files.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(data)
    replaced(files, part, place)


def replaced(files: FileSystem, part: str, place: str) -> None:
    """Moves ``part`` to ``place``, instead of a file that is there."""
    if files.type_name != "local" and files.get_file_info(place).type == FileType.File:
        files.delete_file(place)  # stores whose renaming replaces nothing
    files.move(part, place)


class ByteTail(DataSource):
    """``spark.readStream.format("byte_tail")`` with ``path`` and ``target``; the same options for both sides."""

    @classmethod
    def name(cls) -> str:
        return "byte_tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


class ByteParts(DataSource):
    """``writeStream.format("byte_parts")`` with ``path``."""

    @classmethod
    def name(cls) -> str:
        return "byte_parts"

    def schema(self) -> str:
        return SCHEMA

    def streamWriter(self, schema, overwrite) -> PartWriter:
        return PartWriter(self.options)


def mirror(spark: SparkSession, source: str, target: str, checkpoint: str, seconds: int | None = None, piece: int = PIECE) -> StreamingQuery:
    """Mirrors a folder, every so many seconds; without ``seconds`` it copies what is there and ends."""
    for kind in (ByteTail, ByteParts):
        spark.dataSource.register(kind)
    source, target = absolute(spark, source), absolute(spark, target)
    rows = spark.readStream.format("byte_tail").options(path=source, target=target, piece=str(piece)).load()
    writer = rows.writeStream.format("byte_parts").options(path=target, checkpointLocation=checkpoint)
    return writer.trigger(**({"processingTime": f"{seconds} seconds"} if seconds else {"availableNow": True})).start()


def restored(spark: SparkSession, target: str, local: str) -> DataFrame:
    """Copies what only the mirror has back to ``local``, logs as single files; (file, bytes) of what was copied.

    Files that are there already are left alone, whatever is in them. Each file is one task's work.
    """
    remote, back = absolute(spark, target), absolute(spark, local)
    parts: dict[str, list[str]] = {}
    for name in sorted(listed(remote)):
        log, _, part = name.rpartition("/")
        parts.setdefault(log if log.endswith(".jsonl") and part.isdigit() else name, []).append(name)
    there = listed(back)
    lacking = [(f, names) for f, names in parts.items() if f not in there]
    rows = spark.createDataFrame(lacking, "file string, parts array<string>")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (files, root), (own, home) = FileSystem.from_uri(remote), FileSystem.from_uri(back)
        for batch in batches:
            for file, names in zip(*(c.to_pylist() for c in batch.columns)):
                place, n = f"{home.rstrip('/')}/{file}", 0
                own.create_dir(place.rpartition("/")[0], recursive=True)
                part = f"{place}.{uuid.uuid4().hex}.lock"
                with own.open_output_stream(part) as out:
                    for name in names:
                        with files.open_input_stream(f"{root.rstrip('/')}/{name}") as f:
                            while data := f.read(PIECE):
                                n += out.write(data)
                own.move(part, place)
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([n], pa.int64())], ["file", "bytes"])

    return rows.repartition(max(1, min(len(lacking), 4 * spark.sparkContext.defaultParallelism)), "file").mapInArrow(copy, "file string, bytes long")


def verified(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(file, source_lines, target_lines, same) of every log on either side."""
    lines = lambda path, name, to: spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(path).groupBy(F.regexp_extract("_metadata.file_path", r"([^/]+\.jsonl)(?:/[0-9]+)?$", 1).alias("file")).agg(F.count("*").alias(to))
    both = lines(source, "*.jsonl", "source_lines").join(lines(target, "[0-9]*", "target_lines"), "file", "full_outer")
    return both.withColumn("same", F.col("source_lines").eqNullSafe(F.col("target_lines")))
