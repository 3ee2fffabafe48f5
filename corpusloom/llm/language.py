"""Language identification by prediction by partial matching.

For every language a tree of byte contexts of order 0 to ``order`` is counted on a bounded sample
of labelled documents and then frozen. Coding a byte starts in the longest context: if the byte was
seen there it costs -log2(c / (n + d)), for count c, n bytes and d different ones after that
context; if not, the escape costs -log2(d / (n + d)) and coding goes on one order shorter. Contexts
never seen cost nothing to leave; below order 0 every byte value costs 8 bits. The sum over a
document is its exact code length under the language's frozen statistics. The shortest wins.

The trees of all languages share one table a context length: n-gram to a vector of costs, one for
each language. A batch of documents is coded with a few array look-ups an order, and only bytes not
coded yet go on to the next order.

The score is the posterior of the language under equal priors, with the evidence of a document
weighed as that of ``evidence`` of its bytes at most, so long documents don't all score 1.

Texts are lower-cased before training and coding. Label, source and id are never read for a
prediction. Defined cases: null text or text without a letter is ``und`` with score 0, as is
every text if nothing could be learned; ties go to the smallest label; repeated rows are judged
alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import ship
from .workers import tidied

ORDER = 4
#: Bound of the training sample: documents of a language, and bytes of a language (whole documents, passing over those that do not fit; if none fits, the head of the shortest).
SAMPLE_DOCS, SAMPLE_BYTES = 256, 400_000
#: All languages are learned. Of more than this many each has less of the sample, so that the whole keeps its bound, but LEAST_DOCS at least.
SAMPLE_LANGUAGES, LEAST_DOCS = 256, 8
EVIDENCE = 64
#: Bytes that are coded at once.
STRETCH = 1 << 18
LETTER = regex.compile(r"\p{L}")
#: Separates documents and stands for the context before their first byte; as long as the longest context.
PAD = b"\n" * ORDER
MIX = np.uint64(0x9E3779B97F4A7C15)


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """For each position, the ``length`` bytes that end there as one number (the first ones reach before the start: zeros)."""
    out = np.zeros(len(data), np.uint64)
    for back in range(length):
        out[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return out


class Lookup:
    """Numbers to rows of a table, by open addressing in arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.shift = np.uint64(64 - self.bits)
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        mask = (1 << self.bits) - 1
        self.probes = 1
        for row, (key, at) in enumerate(zip(keys.tolist(), ((keys * MIX) >> self.shift).tolist())):
            n = 1
            while self.rows[at] >= 0:
                at, n = (at + 1) & mask, n + 1
            self.keys[at], self.rows[at] = key, row
            self.probes = max(self.probes, n)
        self.mask = np.int64(mask)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it has none."""
        at = ((keys * MIX) >> self.shift).astype(np.int64)
        row = self.rows[at]
        hit = (self.keys[at] == keys) & (row >= 0)
        out = np.where(hit, row, -1)
        left = np.flatnonzero(~hit & (row >= 0))
        for _ in range(self.probes - 1):
            if not len(left):
                break
            at_left = (at[left] + 1) & self.mask
            at[left] = at_left
            row = self.rows[at_left]
            hit = (self.keys[at_left] == keys[left]) & (row >= 0)
            out[left[hit]] = row[hit]
            left = left[~hit & (row >= 0)]
        return out


class Model:
    """Frozen context trees of several languages."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = ORDER):
        self.languages = sorted(samples)
        self.order = order
        self.seen: list[Lookup] = []
        self.costs: list[np.ndarray] = []
        self.contexts: list[Lookup] = []
        self.escapes: list[np.ndarray] = []
        joined = {lang: np.frombuffer(PAD + PAD.join(docs) + PAD, np.uint8) for lang, docs in samples.items()}
        for k in range(order + 1):
            counts = {lang: np.unique(grams(data, k + 1)[ORDER:], return_counts=True) for lang, data in joined.items()}
            keys = np.unique(np.concatenate([c[0] for c in counts.values()])) if counts else np.zeros(0, np.uint64)
            parents = np.unique(keys >> np.uint64(8))
            cost, escape = np.full((len(keys), len(self.languages)), -1, np.float32), np.zeros((len(parents), len(self.languages)), np.float32)
            for i, lang in enumerate(self.languages):
                own, n = counts[lang]
                up, inverse, different = np.unique(own >> np.uint64(8), return_inverse=True, return_counts=True)
                total = np.bincount(inverse, weights=n, minlength=len(up))
                cost[np.searchsorted(keys, own), i] = -np.log2(n / (total + different)[inverse])
                escape[np.searchsorted(parents, up), i] = -np.log2(different / (total + different))
            self.seen.append(Lookup(keys))
            self.costs.append(cost)
            self.contexts.append(Lookup(parents))
            self.escapes.append(escape)
        self._compile()

    def _compile(self) -> None:
        """Fill the cost of a gram in languages that never saw it: escape there, then the cost one order shorter."""
        for k in range(self.order + 1):
            keys = self.seen[k].keys[self.seen[k].rows >= 0]
            rows = self.seen[k].rows[self.seen[k].rows >= 0]
            cost = self.costs[k][rows]
            escape = self.escapes[k][self.contexts[k].find(keys >> np.uint64(8))]
            if k:
                shorter = self._below(keys & np.uint64((1 << 8 * k) - 1), k - 1)
            else:
                shorter = np.full_like(cost, 8)
            self.costs[k][rows] = np.where(cost < 0, escape + shorter, cost)

    def _below(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Costs of grams of ``k`` + 1 bytes under all languages."""
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        left, now = np.arange(len(keys)), keys
        while len(left):
            row = self.seen[k].find(now)
            hit = row >= 0
            out[left[hit]] += self.costs[k][row[hit]]
            left, now = left[~hit], now[~hit]
            parent = self.contexts[k].find(now >> np.uint64(8))
            known = parent >= 0
            out[left[known]] += self.escapes[k][parent[known]]
            if k == 0:
                out[left] += 8
                break
            k, now = k - 1, now & np.uint64((1 << 8 * k) - 1)
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        piece, size, first = [], 0, 0
        for i, text in enumerate([*texts, None]):
            if text is None or size > STRETCH:
                if piece:
                    out[first : first + len(piece)] = self._code(piece)
                piece, size, first = [], 0, i
            if text is not None:
                piece.append(text)
                size += len(text)
        return out

    def _code(self, texts: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(t) + ORDER for t in texts])
        data = np.frombuffer(b"".join(PAD + t for t in texts), np.uint8)
        total, step = np.zeros((len(texts), len(self.languages))), STRETCH
        owner_ends = ends
        for at in range(0, len(data), step):
            lo = max(0, at - ORDER)
            keys = grams(data[lo : at + step], self.order + 1)[at - lo :]
            bits = self._below(keys, self.order)
            place = np.arange(at, at + len(bits))
            owner = np.searchsorted(owner_ends, place, side="right")
            bits[place - np.where(owner > 0, owner_ends[owner - 1], 0) < ORDER] = 0
            for i in range(len(self.languages)):
                total[:, i] += np.bincount(owner, weights=bits[:, i], minlength=len(texts))
        return total

    def predict(self, texts: list[str | None], evidence: int = EVIDENCE) -> tuple[list[str], np.ndarray]:
        data = [b"" if t is None else t.lower().encode("utf-8", "surrogatepass") for t in texts]
        lettered = [t is not None and LETTER.search(t) is not None for t in texts]
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        bits = self.lengths(data)
        size = np.maximum(1, np.array([len(d) for d in data]))
        weighed = bits * (np.minimum(size, evidence) / size)[:, None] if len(bits) else bits
        best = bits.argmin(1) if len(bits) else np.zeros(0, int)
        gap = np.exp2(-(weighed - weighed.min(1, keepdims=True))) if len(bits) else bits
        score = gap.max(1) / gap.sum(1) if len(bits) else np.zeros(0)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, lettered)], np.where(lettered, score, 0.0)


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int | None = 2, folds: int = 4, per_language: int = SAMPLE_DOCS, max_bytes: int = SAMPLE_BYTES, languages: int = SAMPLE_LANGUAGES) -> dict[str, list[bytes]]:
    """The training texts: of each language the first documents in a hashed order of ids and texts, whole, up to the two bounds.

    Of more languages than ``languages`` each has its share of the bounds, so what is collected is a number of documents that
    the parameters fix, and a row for each language.

    A hash threshold that counts have fixed leaves a few times ``per_language`` rows of each language, and a rank that Spark
    limits in every task before it shuffles holds that bound where rows tie, as those without id do.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if held_out is not None:
        rows = rows.where(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds != held_out)
    share = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col), F.lit("train")), 2)
    counts = rows.groupBy(lang_col).agg(F.count(F.lit(1)).alias("__n"), F.min(share).alias("__least")).collect()
    if not counts:
        return {}
    if len(counts) > languages:
        per_language, max_bytes = max(LEAST_DOCS, per_language * languages // len(counts)), max_bytes * languages // len(counts)
    candidates = 2 * per_language + 64
    # the least, as few different rows may all lie above the threshold
    limits = docs.sparkSession.createDataFrame([(lang, max(least, min((1 << 62) - 1, (candidates << 62) // n))) for lang, n, least in counts], "lang string, most long")
    picked = rows.select(F.col(lang_col).alias("lang"), share.alias("h"), F.xxhash64(F.col(text_col)).alias("x"), F.octet_length(text_col).alias("n"), F.col(text_col).alias("text"))
    picked = picked.join(F.broadcast(limits), "lang").where(F.col("h") <= F.col("most")).drop("most")
    place = F.row_number().over(W.partitionBy("lang").orderBy("h", "x", "n"))
    order: dict[str, list] = {}
    for r in picked.select("lang", "h", "x", "n", place.alias("place")).where(F.col("place") <= candidates).collect():
        order.setdefault(r["lang"], []).append((r["h"], r["x"], r["n"]))
    need: Counter = Counter()
    for lang, found in order.items():
        found.sort()
        size = taken = 0
        for h, x, n in found:
            # a text that does not fit is passed over, so a very long one takes no other's place
            if taken < per_language and size + n <= max_bytes:
                size, taken = size + n, taken + 1
                need[lang, h, x, n] += 1
        if not taken:
            need[(lang, *min(found, key=lambda x: x[2]))] = 1
    wanted = docs.sparkSession.createDataFrame(sorted(need), "lang string, h long, x long, n int")
    # no character is shorter than a byte, so this much holds the part that is used; rows that tie have one text
    rows = picked.join(F.broadcast(wanted), ["lang", "h", "x", "n"], "left_semi").withColumn("text", F.left("text", F.lit(max_bytes))).dropDuplicates(["lang", "h", "x", "n"]).collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"], r["x"], r["n"])):
        texts.setdefault(r["lang"], []).extend([r["text"].lower().encode("utf-8", "surrogatepass")[:max_bytes]] * need[r["lang"], r["h"], r["x"], r["n"]])
    return texts


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep``, lang_pred, score."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", *keep]
    sent = text_col if text_col in keep else "__text"  # a text that is kept is sent once

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                langs, scores = shared.value.predict(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, *([F.col(text_col).alias("__text")] if sent == "__text" else []))
    place = rows.columns.index(sent)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")
