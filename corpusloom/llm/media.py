"""Media columns: bytes kept in ISO base media files, and what their boxes say about them.

:func:`write_track` lays a payload down losslessly as one video track of raw 8-bit grey pictures of
``unit`` bytes, several pictures to a chunk, every ``key_every``-th marked as a sync sample.

:func:`probe` walks the nested boxes of any file and decodes the sample tables: sizes (stsz, stz2),
chunks (stsc, stco, co64), times (stts), sync samples (stss), and the runs of fragments (tfhd, tfdt,
trun, with the defaults of trex). It gives codec, duration and the byte range of every keyframe of
the first video track (of the first track if there is no video), lists all tracks, and touches no
payload byte. :func:`read_track` follows the same tables to fetch the samples. Counts are held
against the file's size before anything is made of them, so a hostile file costs no more memory
than an honest one.

Column forms: :func:`with_media` (text to a media column) and :func:`with_probe` (media column to
codec, time scale, duration, samples, keyframe ranges, payload or why it can't be read). Rows are
handled one by one inside Arrow batches cut into slices of bounded bytes.

Defined cases: null or empty text is one unit of zero bytes; equal texts give equal files; a null or
broken file has null fields and a reason in ``problem``; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .workers import tidied

UNIT, KEY_EVERY, PER_CHUNK, TIMESCALE, TICKS = 64, 16, 64, 600, 20
#: Boxes that hold nothing but boxes.
CONTAINERS = frozenset((b"moov", b"trak", b"mdia", b"minf", b"dinf", b"stbl", b"edts", b"mvex", b"moof", b"traf", b"udta"))
#: Containers in containers beyond this depth hold no tables.
DEEPEST = 16
#: Bytes of input handled at once in a task, beside a single row.
SLICE_BYTES = 16 << 20
MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def padded(data: bytes, unit: int = UNIT) -> bytes:
    """``data`` and zero bytes up to a positive multiple of ``unit``."""
    return data + bytes(-len(data) % unit if data else unit)


# ---- writing ---------------------------------------------------------------------------------


def box(kind: bytes, *parts: bytes) -> bytes:
    n = 8 + sum(map(len, parts))
    return b"".join((struct.pack(">I4s", n, kind), *parts)) if n < 1 << 32 else b"".join((struct.pack(">I4sQ", 1, kind, n + 8), *parts))


def full_box(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def be32(values) -> bytes:
    return np.asarray(values, dtype=">u4").tobytes()


def write_track(payload: bytes, unit: int = UNIT, key_every: int = KEY_EVERY, per_chunk: int = PER_CHUNK) -> bytes:
    """An ISO media file whose single track holds ``payload`` (a positive multiple of ``unit``) as raw pictures."""
    n, rest = divmod(len(payload), unit)
    if rest or not n:
        raise ValueError("the payload isn't a positive multiple of the unit")
    duration, chunks = n * TICKS, -(-n // per_chunk)
    side = int(unit**0.5)
    width, height = (side, side) if side * side == unit else (unit, 1)
    entry = struct.pack(">6xH16xHHIIIH32shh", 1, width, height, 72 << 16, 72 << 16, 0, 1, b"\x08raw grey".ljust(32, b"\0"), 40, -1)
    runs = [(1, per_chunk, 1)] if n % per_chunk == 0 else [(chunks, n % per_chunk, 1)] if chunks == 1 else [(1, per_chunk, 1), (chunks, n % per_chunk, 1)]
    head = box(b"ftyp", b"qt  ", struct.pack(">I", 0x200), b"qt  isom")

    def moov(first: int) -> bytes:
        offsets = first + np.arange(chunks, dtype=np.int64) * (per_chunk * unit)
        wide = first + len(payload) >= 1 << 32
        table = full_box(b"co64", struct.pack(">I", chunks), offsets.astype(">u8").tobytes()) if wide else full_box(b"stco", struct.pack(">I", chunks), be32(offsets))
        stbl = box(
            b"stbl",
            full_box(b"stsd", struct.pack(">I", 1), box(b"raw ", entry)),
            full_box(b"stts", struct.pack(">III", 1, n, TICKS)),
            full_box(b"stss", struct.pack(">I", -(-n // key_every)), be32(np.arange(0, n, key_every) + 1)),
            full_box(b"stsc", struct.pack(">I", len(runs)), be32(runs)),
            full_box(b"stsz", struct.pack(">II", unit, n)),
            table,
        )
        dinf = box(b"dinf", full_box(b"dref", struct.pack(">I", 1), full_box(b"url ", flags=1)))
        minf = box(b"minf", full_box(b"vmhd", bytes(8), flags=1), dinf, stbl)
        mdhd = full_box(b"mdhd", struct.pack(">QQIQHH", 0, 0, TIMESCALE, duration, 0x55C4, 0), version=1)
        mdia = box(b"mdia", mdhd, full_box(b"hdlr", bytes(4), b"vide", bytes(12), b"raw\0"), minf)
        tkhd = full_box(b"tkhd", struct.pack(">QQIIQ8xhhhH", 0, 0, 1, 0, duration, 0, 0, 0, 0), MATRIX, struct.pack(">II", width << 16, height << 16), version=1, flags=3)
        mvhd = full_box(b"mvhd", struct.pack(">QQIQiH10x", 0, 0, TIMESCALE, duration, 0x10000, 0x100), MATRIX, bytes(24), struct.pack(">I", 2), version=1)
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    mdat_head = 8 if len(payload) + 8 < 1 << 32 else 16
    before = len(head) + mdat_head
    first = before + len(moov(0))
    if first + len(payload) >= 1 << 32:
        first = before + len(moov(1 << 32))
    return b"".join((head, moov(first), box(b"mdat", payload)))


# ---- reading ---------------------------------------------------------------------------------


class Broken(ValueError):
    """The boxes or tables of a file contradict each other."""


def boxes(data: memoryview, at: int, end: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(kind, start of the box, start and end of its contents) of each box between ``at`` and ``end``."""
    while at < end:
        if end - at < 8:
            raise Broken("a box header is cut off")
        n, kind = struct.unpack_from(">I4s", data, at)
        start = at + 8
        if n == 1:
            if end - at < 16:
                raise Broken("a box header is cut off")
            n, start = struct.unpack_from(">Q", data, start)[0], start + 8
        elif n == 0:
            n = end - at
        if n < start - at or at + n > end:
            raise Broken(f"box {kind!r} reaches beyond what holds it")
        yield kind, at, start, at + n
        at += n


def walk(data: memoryview) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    """(path of kinds, start of the box, start and end of its contents) of every box, parents first; iterative, so depth is no matter."""
    todo = [((), boxes(data, 0, len(data)))]
    while todo:
        path, level = todo[-1]
        found = next(level, None)
        if found is None:
            todo.pop()
            continue
        kind, at, start, stop = found
        yield (*path, kind), at, start, stop
        if kind in CONTAINERS and len(path) < DEEPEST:
            todo.append(((*path, kind), boxes(data, start, stop)))


def _table(data: memoryview, start: int, end: int, skip: int, width: int, kind: str = ">u4") -> np.ndarray:
    n = struct.unpack_from(">I", data, start + skip)[0]
    at, size = start + skip + 4, n * width * np.dtype(kind).itemsize
    if at + size > end:
        raise Broken("a table is longer than its box")
    return np.frombuffer(data[at : at + size], dtype=kind).astype(np.int64).reshape(n, width)


def tracks(data: memoryview) -> list[dict]:
    """Per track: id, handler, codec, timescale, duration, and numpy arrays offset, size, time and sync, one entry a sample."""
    found: list[dict] = []
    defaults: dict[int, tuple[int, int, int]] = {}
    fragments: list[dict] = []
    moof = 0
    for path, at, start, end in walk(data):
        kind = path[-1]
        if path[0] == b"moof":
            if kind == b"moof":
                moof = at
                fragments.append({"moof": moof, "first": True})
            elif kind == b"traf":
                fragments.append({"moof": moof, "first": fragments[-1].pop("first", False), "runs": []})
            elif kind == b"tfhd":
                fragments[-1]["tfhd"] = _track_head(data, start, end)
            elif kind == b"tfdt":
                fragments[-1]["time"] = struct.unpack_from(">Q" if data[start] else ">I", data, start + 4)[0]
            elif kind == b"trun" and "runs" in fragments[-1]:
                fragments[-1]["runs"].append((start, end))
            continue
        if kind == b"trex":
            track, _, *rest = struct.unpack_from(">5I", data, start + 4)
            defaults[track] = tuple(rest)
        if kind == b"trak":
            found.append({})
        if b"trak" not in path or path[0] != b"moov" or not found:
            continue
        t = found[-1]
        if kind == b"tkhd":
            t["id"] = struct.unpack_from(">I", data, start + (20 if data[start] else 12))[0]
        elif kind == b"mdhd":
            t["timescale"], t["duration"] = struct.unpack_from(">IQ" if data[start] else ">II", data, start + (20 if data[start] else 12))
        elif kind == b"hdlr":
            t["handler"] = bytes(data[start + 8 : start + 12]).decode("latin-1")
        elif kind == b"stsd":
            t["codec"] = next((k.decode("latin-1") for k, *_ in boxes(data, start + 8, end)), None)
        elif kind == b"stts":
            t["stts"] = _table(data, start, end, 4, 2)
        elif kind == b"stss":
            t["stss"] = _table(data, start, end, 4, 1)[:, 0] - 1
        elif kind == b"stsc":
            t["stsc"] = _table(data, start, end, 4, 3)
        elif kind == b"stco":
            t["chunks"] = _table(data, start, end, 4, 1)[:, 0]
        elif kind == b"co64":
            t["chunks"] = _table(data, start, end, 4, 1, ">u8")[:, 0]
        elif kind == b"stsz":
            same, n = struct.unpack_from(">II", data, start + 4)
            if same * n > len(data):
                raise Broken("the samples are larger than the file")
            t["size"] = np.full(n, same, np.int64) if same else _table(data, start, end, 8, 1)[:, 0]
        elif kind == b"stz2":
            bits, n = data[start + 7], struct.unpack_from(">I", data, start + 8)[0]
            raw = np.frombuffer(data[start + 12 : end], np.uint8)
            t["size"] = (np.stack((raw >> 4, raw & 15), 1).ravel() if bits == 4 else raw if bits == 8 else raw[: len(raw) // 2 * 2].view(">u2"))[:n].astype(np.int64)
    for t in found:
        _place(t, len(data))
    _add_fragments(data, found, defaults, [f for f in fragments if f.get("runs")])
    return found


def _track_head(data: memoryview, start: int, end: int) -> dict:
    """What a fragment says of its track: id, base (of offsets), and default duration, size and flags of samples."""
    flags, track = struct.unpack_from(">II", data, start)
    out, at = {"id": track, "whole": flags & 0x20000}, start + 8
    for bit, name, kind in ((0x1, "base", ">Q"), (0x2, None, ">I"), (0x8, "duration", ">I"), (0x10, "size", ">I"), (0x20, "flags", ">I")):
        if flags & bit:
            if at + struct.calcsize(kind) > end:
                raise Broken("a fragment's head is cut off")
            if name:
                out[name] = struct.unpack_from(kind, data, at)[0]
            at += struct.calcsize(kind)
    return out


def _add_fragments(data: memoryview, found: list[dict], defaults: dict[int, tuple[int, int, int]], fragments: list[dict]) -> None:
    """Append the samples of fragments to their tracks."""
    by_id = {t.get("id"): t for t in found}
    ended = 0
    for f in fragments:
        head = f.get("tfhd")
        t = by_id.get(head["id"]) if head else None
        if t is None:
            raise Broken("a fragment's track doesn't exist")
        duration, size, flags = (head.get(k, v) for k, v in zip(("duration", "size", "flags"), defaults.get(head["id"], (0, 0, 0)), strict=True))
        at = base = head.get("base", f["moof"] if head["whole"] or f["first"] else ended)
        parts = t.setdefault("parts", [])
        time = f.get("time", parts[-1][4] if parts else int(t["end"]))
        for start, end in f["runs"]:
            said, n = struct.unpack_from(">II", data, start)
            fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if said & bit]
            p = start + 8
            if said & 0x1:
                at, p = base + struct.unpack_from(">i", data, p)[0], p + 4
            first = None
            if said & 0x4:
                first, p = struct.unpack_from(">I", data, p)[0], p + 4
            if p + 4 * n * len(fields) > end or not said & 0x200 and size * n > len(data) or not fields and not size and n > len(data):
                raise Broken("a fragment's run is longer than its box or the file")
            table = np.frombuffer(data[p : p + 4 * n * len(fields)], ">u4").astype(np.int64).reshape(n, len(fields))
            column = lambda bit, default: table[:, fields.index(bit)] if bit in fields else np.full(n, default, np.int64)  # noqa: B023, E731
            sizes, steps, marks = column(0x200, size), column(0x100, duration), column(0x400, flags)
            if first is not None and n:
                marks = marks.copy()
                marks[0] = first
            ends = np.cumsum(sizes)
            offset = at + ends - sizes
            if n and (at < 0 or offset[-1] + sizes[-1] > len(data)):
                raise Broken("a sample lies outside the file")
            times = time + np.cumsum(steps) - steps
            at, time = at + (int(ends[-1]) if n else 0), time + int(steps.sum())
            parts.append((offset, sizes, times, np.flatnonzero((marks & 0x10000) == 0), time))
        ended = at
    for t in found:
        if parts := t.pop("parts", None):
            before = np.cumsum([len(t["size"]), *(len(x[1]) for x in parts)])
            t["sync"] = np.concatenate([t["sync"], *(x[3] + b for x, b in zip(parts, before))])
            for k, name in enumerate(("offset", "size", "time")):
                t[name] = np.concatenate([t[name], *(x[k] for x in parts)])
            t["end"] = max(t["end"], *(x[4] for x in parts))
        t["duration"] = t.get("duration") or int(t.pop("end"))
        t.pop("end", None)


def _place(t: dict, end: int) -> None:
    size, chunks, runs = t.get("size"), t.get("chunks"), t.pop("stsc", None)
    if size is None or chunks is None or runs is None:
        raise Broken("a track lacks a sample table")
    n = len(size)
    if n:
        if not len(runs) or runs[0, 0] != 1 or (np.diff(runs[:, 0]) <= 0).any() or runs[-1, 0] > len(chunks):
            raise Broken("the chunk runs are out of order")
        in_chunk = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0] - 1, len(chunks))))
        if in_chunk.sum() != n:
            raise Broken("chunks and samples differ in number")
        first = np.cumsum(in_chunk) - in_chunk
        ends = np.cumsum(size)
        starts = ends - size
        nonempty = in_chunk > 0
        base = np.repeat(chunks[nonempty] - starts[first[nonempty]], in_chunk[nonempty])
        t["offset"] = base + starts
        if (t["offset"] < 0).any() or (t["offset"] + size > end).any():
            raise Broken("a sample lies outside the file")
    else:
        t["offset"] = np.zeros(0, np.int64)
    stts = t.pop("stts", np.zeros((0, 2), np.int64))
    # no more steps than samples, whatever the table says
    counts = np.minimum(stts[:, 0], n)
    counts = np.clip(counts, 0, np.maximum(0, n - (np.cumsum(counts) - counts)))
    steps = np.repeat(stts[:, 1], counts)
    t["time"], t["end"] = np.cumsum(steps) - steps, steps.sum()
    t["sync"] = t.pop("stss", np.arange(n))
    if len(t["sync"]) and (t["sync"].min() < 0 or t["sync"].max() >= n):
        raise Broken("a sync sample doesn't exist")


def probe(data: bytes) -> dict:
    """Codec, timescale, duration, n_samples and keyframes (time, offset, size) of the first video track, or else of the first track; all tracks in short."""
    found = tracks(memoryview(data))
    if not found:
        raise Broken("no track")
    t = next((t for t in found if t.get("handler") == "vide"), found[0])
    k = t["sync"]
    times = t["time"][k] if len(t["time"]) == len(t["size"]) else np.zeros(len(k), np.int64)
    listed = [{"handler": x.get("handler"), "codec": x.get("codec"), "timescale": x.get("timescale"), "duration": x.get("duration"), "n_samples": len(x["size"]), "n_keyframes": len(x["sync"])} for x in found]
    return {"codec": t.get("codec"), "timescale": t.get("timescale"), "duration": t.get("duration"), "n_samples": len(t["size"]), "keyframes": (times, t["offset"][k], t["size"][k]), "tracks": listed, "track": t}


def read_track(data: bytes, track: dict) -> bytes:
    """All samples of a track in order; neighbours are fetched in one piece."""
    offset, size = track["offset"], track["size"]
    if not len(size):
        return b""
    cut = np.flatnonzero(offset[1:] != offset[:-1] + size[:-1]) + 1
    first, last = np.append(0, cut), np.append(cut, len(size)) - 1
    return b"".join(data[a:b] for a, b in zip(offset[first].tolist(), (offset[last] + size[last]).tolist(), strict=True))


# ---- columns ---------------------------------------------------------------------------------


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about SLICE_BYTES in ``column`` each."""
    per_row = max(1, batch.column(column).nbytes // max(1, batch.num_rows))
    step = max(1, SLICE_BYTES // per_row)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def with_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (of the text in UTF-8) and ``media``, the text's bytes as a media file."""
    ship(docs.sparkSession)

    @tidied
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                texts = [b"" if x is None else x for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array([write_track(padded(x)) for x in texts], pa.binary())], ["doc_id", "n_bytes", "media"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(write, f"doc_id {kind}, n_bytes long, media binary")


KEYFRAMES = "array<struct<time: bigint, offset: bigint, size: bigint>>"
TRACKS = "array<struct<handler: string, codec: string, timescale: bigint, duration: bigint, n_samples: bigint, n_keyframes: bigint>>"


def with_probe(media: DataFrame, media_col: str = "media", payload: bool = False) -> DataFrame:
    """Adds codec, timescale, duration, n_samples, keyframes, problem and tracks; with ``payload`` also the bytes of all samples.

    Columns of those names that are there already are replaced.
    """
    ship(media.sparkSession)
    fields = ["codec", "timescale", "duration", "n_samples", "keyframes", "problem", "tracks"] + ["payload"] * payload
    keep = [c for c in media.columns if c not in fields]
    numbers = lambda *names: [(n, pa.int64()) for n in names]
    listed = pa.list_(pa.struct([("handler", pa.string()), ("codec", pa.string()), *numbers("timescale", "duration", "n_samples", "n_keyframes")]))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct(numbers("time", "offset", "size"))), pa.string(), listed, pa.binary()]

    @tidied
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, keep.index(media_col)):
                out: list[list] = [[] for _ in range(8)]
                for data in batch.column(keep.index(media_col)).to_pylist():
                    try:
                        if data is None:
                            raise Broken("null")
                        p = probe(data)
                        row = [p["codec"], p["timescale"], p["duration"], p["n_samples"], p["keyframes"], None, p["tracks"], read_track(data, p["track"]) if payload else None]
                    except (ValueError, struct.error, IndexError, OverflowError, MemoryError) as e:
                        row = [None, None, None, None, None, str(e) or type(e).__name__, None, None]
                    for k, v in zip(out, row, strict=True):
                        k.append(v)
                sizes = [-1 if k is None else len(k[0]) for k in out[4]]
                ends = np.cumsum([0, *(max(0, n) for n in sizes)])
                flat = [np.concatenate([k[i] for k in out[4] if k is not None] or [np.zeros(0, np.int64)]) for i in range(3)]
                ranges = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], ["time", "offset", "size"])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ranges, mask=pa.array([n < 0 for n in sizes]))
                made = [lists if i == 4 else pa.array(x, kinds[i]) for i, x in enumerate(out[: len(fields)])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*keep, *fields])

    types = ["string", "bigint", "bigint", "bigint", KEYFRAMES, "string", TRACKS, "binary"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema if f.name in keep), *(f"{n} {t}" for n, t in zip(fields, types))])
    return media.select(*keep).mapInArrow(read, schema)
