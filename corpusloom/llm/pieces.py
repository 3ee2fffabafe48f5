"""Offset-preserving SentencePiece encoding and decoding.

The text is normalised here: at each place the longest prefix that the model's compiled character
map knows is replaced (else one character is copied), white space is escaped and trimmed as the
model asks, and for every byte of the result the source byte it came from is recorded. The
library then only segments: it gets a copy of the model whose own normaliser is switched off.
Byte lengths of the pieces give their place in the normalised text, and the alignment projects
that to byte spans of the original text.

Where no piece of a byte-fallback BPE vocabulary has a character in front of an escaped space, and
around characters that occur in no longer piece, no merge can cross. The text is cut there and the
segments' ids are kept in a bounded table, which gives the same ids with far less work.

Defined cases: null or empty text has no piece but the end id; a model with user-defined symbols is
refused; repeated rows are encoded alike; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .workers import tidied

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
#: Segments whose ids a worker remembers.
REMEMBERED = 200_000


class CharacterMap:
    """The compiled map: a double-array trie of byte strings and the strings they turn into."""

    def __init__(self, blob: bytes):
        self.entries: dict[str, str] = {}
        if blob:
            n = struct.unpack_from("<I", blob)[0]
            self._read(np.frombuffer(blob, "<u4", n // 4, 4).tolist(), blob[4 + n :])
        self.longest: dict[str, list[int]] = {}
        for key in self.entries:
            self.longest.setdefault(key[0], []).append(len(key))
        for k, lengths in self.longest.items():
            self.longest[k] = sorted(set(lengths), reverse=True)
        self.starts = re.compile("[" + re.escape("".join(sorted(self.longest))) + "]") if self.longest else None

    def _read(self, units: list[int], strings: bytes) -> None:
        todo = [(0, b"")]
        while todo:
            node, key = todo.pop()
            base = node ^ ((units[node] >> 10) << ((units[node] & 512) >> 6))
            if key and units[node] & 256:
                at = units[base] & 0x7FFFFFFF
                self.entries[key.decode("utf-8")] = strings[at : strings.index(b"\0", at)].decode("utf-8")
            for byte in range(1, 256):
                child = base ^ byte
                if child < len(units) and units[child] & 0x800000FF == byte:
                    todo.append((child, key + bytes((byte,))))

    def pieces(self, text: str) -> Iterator[tuple[str, str]]:
        """(source, result): stretches that stay as they are, and the longest known prefix at any other place."""
        if self.starts is None:
            if text:
                yield text, text
            return
        at = same = 0
        while m := self.starts.search(text, at):
            at = m.start()
            n = next((n for n in self.longest[text[at]] if text[at : at + n] in self.entries), 0)
            if not n:
                at += 1
                continue
            if at > same:
                yield text[same:at], text[same:at]
            yield text[at : at + n], self.entries[text[at : at + n]]
            at = same = at + n
        if same < len(text):
            yield text[same:], text[same:]


class Normaliser:
    def __init__(self, spec, suffix: bool):
        self.map, self.suffix = CharacterMap(spec.precompiled_charsmap), suffix
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the source byte it came from."""
        if not text:
            return "", np.zeros(1, np.int64)
        chars, origin = [], []
        if self.map.starts is None and not self.trim:
            raw = text
            source = np.arange(len(text.encode()) + 1)
        else:
            at = 0
            for piece, result in self.map.pieces(text):
                n, m = len(piece.encode()), len(result.encode())
                chars.append(result)
                origin.append(np.arange(at, at + n) if piece == result else np.full(m, at))
                at += n
            raw, source = "".join(chars), np.concatenate([*origin, [at]])
        data = np.frombuffer(raw.encode(), np.uint8)
        space = data == 32
        if self.trim:
            keep = ~(space & np.append(True, space[:-1]))
            if not keep.any():
                return "", np.zeros(1, np.int64)
            # a run keeps its first space; the end of the text keeps none
            end = len(data)
            while end and space[end - 1]:
                end -= 1
            keep[end:] = False
            source = np.append(source[:-1][keep], source[end])
            data, space = data[keep], space[keep]
            raw = data.tobytes().decode()
        mark = SPACE if self.escape else " "
        width = len(mark.encode())
        if self.escape:
            raw = raw.replace(" ", SPACE)
            source = np.repeat(source, np.append(np.where(space, width, 1), 1))
        if self.prefix:
            if self.suffix:
                raw, source = raw + mark, np.append(source, np.full(width, source[-1]))
            else:
                raw, source = mark + raw, np.append(np.full(width, source[0]), source)
        return raw, source


class Encoder:
    """Encodes as the library does, with spans of original bytes."""

    def __init__(self, path: str, end_id: bool = True):
        import sentencepiece as sp
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if any(p.type == USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined symbols aren't supported")
        self.whole = sp.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.normalise = Normaliser(model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix)
        self.end = [self.whole.eos_id()] if end_id else []
        pieces = [(p.piece, p.type) for p in model.pieces]
        self.names = [p for p, _ in pieces]
        self.width = np.array([1 if t == BYTE else 0 if t == CONTROL else len(p.encode()) for p, t in pieces])
        self.digits = [str(i) for i in range(len(pieces))]
        spec = model.normalizer_spec
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.segmenter = sp.SentencePieceProcessor(model_proto=model.SerializeToString())
        longer = [p for p, t in pieces if t == NORMAL and len(p) > 1]
        inside = any(SPACE in p.lstrip(SPACE) for p in longer)
        self.segments = None
        if model.trainer_spec.model_type == BPE and model.trainer_spec.byte_fallback and not inside:
            soft = re.escape("".join(sorted({c for p in longer for c in p} - {SPACE})))
            self.segments = re.compile(f"{SPACE}+[{soft}]*|[{soft}]+|[^{soft}{SPACE}]", re.DOTALL)
        self.known: dict[str, tuple[int, ...]] = {}

    def ids_of(self, normal: str) -> list[int]:
        if self.segments is None:
            return self.segmenter.encode(normal, num_threads=1)
        found = self.segments.findall(normal)
        known = self.known
        missing = [s for s in dict.fromkeys(found) if s not in known]
        if missing:
            if len(known) + len(missing) > REMEMBERED:
                known.clear()
                missing = list(dict.fromkeys(found))
            known.update(zip(missing, map(tuple, self.segmenter.encode(missing, num_threads=1)), strict=True))
        return list(chain.from_iterable(map(known.__getitem__, found)))

    def encode(self, text: str | None) -> tuple[list[int], np.ndarray, np.ndarray]:
        """ids, and the first and last-plus-one original byte of each; the end id spans nothing at the end."""
        normal, source = self.normalise(text or "")
        ids = self.ids_of(normal)
        bounds = np.cumsum(np.append(0, self.width[ids])) if ids else np.zeros(1, np.int64)
        if bounds[-1] != len(source) - 1:  # unknown pieces cover what the piece's own name doesn't tell
            bounds = self._surfaces(normal, ids)
        spans = source[bounds]
        begin, end = spans[:-1], spans[1:]
        if self.end:
            ids = [*ids, *self.end]
            begin, end = np.append(begin, source[-1]), np.append(end, source[-1])
        return ids, begin, end

    def _surfaces(self, normal: str, ids: list[int]) -> np.ndarray:
        pieces = self.segmenter.encode(normal, return_type="proto").pieces
        if [p.id for p in pieces] != ids:
            raise ValueError("the segmenter disagrees with itself")
        return np.cumsum([0, *(len(p.surface.encode()) for p in pieces)])

    def decode(self, ids: list[int]) -> str:
        return self.whole.decode(ids)

    def digests(self, ids: list[int], begins: np.ndarray | list = (), ends: np.ndarray | list = ()) -> tuple[int, str, str, str]:
        """Number of ids, SHA-256 of their decimals, of the text they decode to, and of the spans (little-endian 64-bit begins, then ends)."""
        digits = self.digits
        spans = hashlib.sha256(np.asarray(begins, "<i8").tobytes() + np.asarray(ends, "<i8").tobytes()).hexdigest()
        return len(ids), hashlib.sha256(" ".join([digits[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest(), spans


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and model."""
    return Encoder(path)


LISTS = "ids array<int>, begins array<long>, ends array<long>"


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), derive: tuple[str, list[pa.DataType], Callable] | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, then ids, begins and ends (byte spans of the original text) of every piece.

    ``derive`` = (schema, types, function of encoder, ids, begins, ends) puts what it makes of these in their place,
    for callers who need no more than that. The model file must be at ``model_path`` on every executor.
    """
    ship(docs.sparkSession)
    schema, types, make = derive or (LISTS, [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())], lambda _, *lists: lists)
    names = ["doc_id", *keep, *(s.split()[0] for s in schema.split(", "))]

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = [make(coder, *coder.encode(t)) for t in part.column(part.num_columns - 1).to_pylist()]
                made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(run, f"{kept}, {schema}")


DIGESTS = ("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string", [pa.int64(), pa.string(), pa.string(), pa.string()], lambda coder, *lists: coder.digests(*lists))
