"""Archives of many zstd frames, read by many tasks: frames are listed from their headers, and ranges of them are streams of their own.

A frame can be decompressed alone, with any window, and where it ends follows from its block headers, without decompressing.
Files are listed by tasks; each range of frames is another task's, which holds one window and one line at a time, so files
of any size are read. A range that begins within a line leaves that to the one before it, which reads on into later frames.
Files must lie in a folder that all executors share, as they are read by place.
"""

from __future__ import annotations

import io
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusloom.functions.shared import stored
from corpusloom.functions.shipping import ship
from corpusloom.sources.sink import local

#: Fixed values of the format: the magic numbers, and bytes of dictionary ids and content sizes by flag.
MAGIC, SKIPPABLE = 0xFD2FB528, 0x184D2A5
DICTIONARY, CONTENT = (0, 1, 2, 4), (0, 2, 4, 8)
RANGE_BYTES = 32 << 20
#: Lines that are handed on at once.
LINES = 2048


def frames(f, size: int) -> list[tuple[int, int]]:
    """(start, end) of each frame with content, from the start of a file up to ``size``; one that is broken or cut is an error."""
    out, at = [], 0

    def number(place: int, n: int) -> int:
        f.seek(place)
        return int.from_bytes(f.read(n), "little")

    while at < size:
        magic = number(at, 4)
        if magic >> 4 == SKIPPABLE:
            end = at + 8 + number(at + 4, 4)
        elif magic != MAGIC:
            raise ValueError(f"no frame begins at byte {at}")
        else:
            flags = number(at + 4, 1)
            single, last, held = flags >> 5 & 1, 0, 0
            end = at + 5 + (not single) + DICTIONARY[flags & 3] + (CONTENT[flags >> 6] or single)
            while not last and end < size:
                block = number(end, 3)
                last, kind, held = block & 1, block >> 1 & 3, held | block >> 3
                end += 3 + (1 if kind == 1 else block >> 3)
            end += 4 * (flags >> 2 & 1)
        if end > size:
            raise ValueError(f"the frame at byte {at} is cut")
        if magic >> 4 != SKIPPABLE and held:
            out.append((at, end))
        at = end
    return out


class Section(io.RawIOBase):
    """Bytes ``start`` to ``end`` of a file."""

    def __init__(self, f, start: int, end: int):
        self.f, self.at, self.end = f, start, end

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        self.f.seek(self.at)
        got = self.f.read(min(len(into), self.end - self.at))
        into[: len(got)] = got
        self.at += len(got)
        return len(got)


def lines_of(path: str, start: int, end: int, before: int) -> Iterator[str]:
    """The lines that begin in the frames from ``start`` up to ``end``, and in full; ``before`` is where the frame in front begins."""
    import zstandard

    size = os.path.getsize(path)
    with open(path, "rb") as f:
        opened = lambda a, b: io.BufferedReader(zstandard.ZstdDecompressor(max_window_size=2**31).stream_reader(Section(f, a, b), read_across_frames=True, closefd=False), 1 << 20)
        ending = b"\n"
        if before < start:  # does the frame in front end a line? only then does one begin here
            with opened(before, start) as last:
                while got := last.read(1 << 20):
                    ending = got[-1:]
        part = opened(start, end)
        if ending != b"\n":
            part.readline()
        line = b""
        for line in part:
            if line.endswith(b"\n"):
                yield line[:-1].decode("utf-8", "replace")
        if line and not line.endswith(b"\n"):
            rest = opened(end, size).readline() if end < size else b""
            yield (line + rest).removesuffix(b"\n").decode("utf-8", "replace")


def _table(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source, place, start, end, before): ranges of whole frames of each file, about ``range_bytes`` or one frame long, and where the last frame in front of each begins."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                made: list[list[int]] = []
                file = local(name)
                with open(file, "rb") as f:
                    last = 0
                    for start, end in frames(f, os.path.getsize(file)):
                        if made and made[-1][1] - made[-1][0] < range_bytes:
                            made[-1][1] = end
                        else:
                            made.append([start, end, last if made else start])
                        last = start
                numbers = {n: pa.array([m[i] for m in made], pa.int64()) for i, n in enumerate(("start", "end", "before"))}
                yield _table({"source": pa.array([name] * len(made), pa.string()), "place": pa.array(range(len(made)), pa.int64()), **numbers})

    return spark.read.format("binaryFile").load(path).select("path").mapInArrow(run, "source string, place long, start long, end long, before long")


def frame_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source, ord, value): the lines of zstd archives, in file order within a source, a task for each range of frames."""
    found = stored(ranges(spark, path, range_bytes), "frames")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                first, held = r["place"] << 36, []
                for line in lines_of(local(r["source"]), r["start"], r["end"], r["before"]):
                    held.append(line)
                    if len(held) == LINES:
                        yield _lines(r["source"], first, held)
                        first, held = first + len(held), []
                yield _lines(r["source"], first, held)

    return found.repartition(max(1, found.count())).mapInArrow(run, "source string, ord long, value string")


def _lines(name: str, first: int, lines: list[str]) -> pa.RecordBatch:
    return _table({"source": pa.array([name] * len(lines), pa.string()), "ord": pa.array(range(first, first + len(lines)), pa.int64()), "value": pa.array(lines, pa.string())})
