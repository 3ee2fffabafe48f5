"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its five-word shingles, hashed to 64 bits. Two permutations of a fixed
universe make the whole signature: the first scatters the elements once, the second is circularly
shifted, and coordinate k is the least value of the second permutation read k places on from each
scattered element. The windows are contiguous in memory, so all coordinates come from one pass.
Bands of ``ROWS`` coordinates are hashed to keys; documents that share a key are candidates. A pair
at the threshold of 0.75 shares none of the 40 bands of 5 with a chance of about 2 in 100,000.

Work follows the number of documents, not the pairs of a group:

* documents with the same word sequence become one class with its smallest id as representative;
* in each bucket every member is compared with one centre; links are confirmed on the full sets,
  and links make components. Within a component no further comparison could change anything;
* documents of buckets that still hold several components are compared through their rarest
  shingles: two sets of the threshold's similarity share one of the first quarter of each, in any
  order of shingles that all documents follow. Here shingles that no two components share come
  first, and need no place in any table; the others follow by their exact count, so passages that
  many unlike documents share come last and make no pair. Shingles at which components meet in few
  pairs for each document give these pairs, left out only where sizes or places in the order rule
  the threshold out. All other shingles join their documents to a cluster, which is compared block
  by block with matrix products: only blocks of like set sizes meet, and never two of the cluster's
  largest component. No bucket is capped and no candidate is dropped.

What is shuffled are keys, and sets (sorted arrays of hashes) of documents that share a bucket with
another; texts are read where they lie. Keys that a large share of the rows has are joined by
broadcast, of fewer than ``HOT_KEYS`` rows. A centre's members are dealt in lots, each with a copy of
the centre's set, so a centre with a third of all documents is no task's burden; components come
from minimum labels and pointer jumps, each step written to the shared folder.

Defined cases: null or wordless text has an empty set, links with nothing and is its own component;
rows that repeat an id count as one document; an empty table gives an empty result; a null id is
taken apart from all others; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_hot, narrowed, settings, ship, stored
from .workers import tidied

SHINGLE, BANDS, ROWS, UNIVERSE_BITS, SEED = 5, 40, 5, 22, 20240229
LOT = 64
#: A shingle gives pairs if it gives each of its documents no more than PAIRS on average, and has no more than THIN documents.
PAIRS, THIN = 16, 4096
#: Documents of a cluster are compared in blocks of so many, in products of so many columns.
BLOCK, COLUMNS = 128, 1 << 15
REMEMBERED = 100_000
#: Texts and sets may be long, so few of them go to Python at once: what executors hold beside their heap follows this.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Texts to sorted sets of shingle hashes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def words(self, text: str | None) -> list[bytes]:
        """The words; bytes split and lower-case at ASCII characters only."""
        return (text or "").encode("utf-8", "surrogatepass").lower().split()

    def shingles(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > REMEMBERED:
            known.clear()
        n = max(1, len(h) - SHINGLE + 1)
        out = np.full(n, len(h) if len(h) < SHINGLE else SHINGLE, np.uint64)
        for i in range(min(SHINGLE, len(h))):
            out = mixed(out + h[i : i + n] * MULTIPLIERS[i])
        return np.unique(out)


@lru_cache(maxsize=1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the windows of the circular one: row i holds what all coordinates read at i."""
    rng = np.random.default_rng(SEED)
    size = 1 << UNIVERSE_BITS
    scatter = rng.permutation(size).astype(np.int32)
    circle = rng.permutation(size).astype(np.int32)
    k = BANDS * ROWS
    return scatter, np.lib.stride_tricks.sliding_window_view(np.append(circle, circle[: k - 1]), k)


def signature(shingles: np.ndarray) -> np.ndarray:
    scatter, windows = permutations()
    at = scatter[(shingles >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
    least = np.full(BANDS * ROWS, 1 << UNIVERSE_BITS, np.int32)
    for i in range(0, len(at), 2048):
        np.minimum(least, windows[at[i : i + 2048]].min(0), out=least)
    return least


def band_keys(sign: np.ndarray) -> np.ndarray:
    rows = sign.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = mixed(key + rows[:, i] * MULTIPLIERS[i])
    return key.view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the word sequence), n_shingles, bands (the keys; none for an empty set)."""
    ship(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                digests, sizes, bands = [], [], []
                for text in part.column(1).to_pylist():
                    words = shingler.words(text)
                    found = shingler.shingles(words)
                    digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    sizes.append(len(found))
                    bands.append(band_keys(signature(found)) if len(found) else np.zeros(0, np.int64))
                ends = np.cumsum([0, *map(len, bands)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bands)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), lists], ["doc_id", "digest", "n_shingles", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest binary, n_shingles long, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """From (rep, text): rep, keys (the sorted set of shingle hashes)."""
    ship(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays([part.column(0), listed([shingler.shingles(shingler.words(t)) for t in part.column(1).to_pylist()])], ["rep", "keys"])

    return docs.select("rep", "text").mapInArrow(run, "rep long, keys array<long>")


def listed(sets: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))


def unlisted(column: pa.ListArray) -> list[np.ndarray]:
    """The sets of a column, without copies."""
    ends, values = column.offsets.to_numpy().tolist(), column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """Of (a, b), a written table, those whose full shingle sets reach the similarity. ``sets``: rep, keys."""
    ship(pairs.sparkSession)
    lots = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).withColumn("lots", F.ceil(F.col("n") / LOT))
    members = join_hot(pairs, lots, ["a"], "n").select(F.col("b").alias("rep"), "a", F.pmod(F.xxhash64("b"), F.col("lots")).alias("lot"), F.lit(1).alias("role"))
    centres = lots.select(F.col("a").alias("rep"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot"), F.lit(0).alias("role"))
    needed = members.unionByName(centres)
    dealt = sets.join(needed, "rep").select("a", "lot", "role", "rep", "keys").repartition("a", "lot").sortWithinPartitions("a", "lot", "role")

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre = None, None
        for batch in batches:
            a, b = [], []
            for group, role, rep, own in zip(*(batch.column(i).to_numpy().tolist() for i in (0, 2, 3)), unlisted(batch.column(4)), strict=True):
                if role == 0:
                    if group != at:
                        at, centre = group, own.copy()
                    continue
                if group != at:
                    raise ValueError(f"document {group} isn't there")
                if 100 * min(len(own), len(centre)) < percent * max(len(own), len(centre)):
                    continue
                place = np.searchsorted(centre, own)
                common = int((centre[np.minimum(place, len(centre) - 1)] == own).sum())
                if 100 * common >= percent * (len(own) + len(centre) - common):
                    a.append(group)
                    b.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, label) of every end of an edge (a, b): the smallest id it can reach."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "edges")
    last = stored(both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("label")), "labels")
    vertices = last.count()
    while True:
        label = last.select("v", "label")
        near = both.join(label.select(F.col("v").alias("b"), F.col("label").alias("l")), "b").groupBy(F.col("a").alias("v")).agg(F.min("l").alias("near"))
        met = stored(label.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("l")), "steps")
        jump = label.select(F.col("v").alias("l"), F.col("label").alias("far"))
        # a label that many hold is a hot key: its one row is broadcast
        held = met.groupBy("l").agg(F.count(F.lit(1)).alias("n")).join(jump, "l")
        step = stored(join_hot(met, held, ["l"], "n", vertices).select("v", "old", F.least("l", "far").alias("label")), "labels")
        discard(last, met)
        last = step
        if step.where("old != label").isEmpty():
            discard(both)
            return step.select("v", "label")


def rarest(opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, rep, comp, n, place): the shingles that documents of (rep, comp) have to be compared through.

    Of the first n - ceil(percent / 100 n) + 1 shingles of each set of n, in the order of all sets, those that another component has.
    """
    single = sets.join(opened, "rep").select("rep", "comp", F.size("keys").cast("long").alias("n"), F.explode("keys").alias("key"))
    counts = single.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key", "c")
    counts = stored(counts, "shared")
    of_doc = join_hot(single, counts, ["key"], "c").groupBy("rep").agg(F.first("comp").alias("comp"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("c", "key"))).alias("shared"))
    need = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("long") + 1
    alone = F.col("n") - F.size("shared")
    used = of_doc.withColumn("alone", alone).withColumn("use", need - F.col("alone")).where("use > 0")
    return used.select("rep", "comp", "n", "alone", F.posexplode(F.slice("shared", 1, F.col("use").cast("int"))).alias("at", "s")).select("s.key", "rep", "comp", "n", (F.col("alone") + F.col("at")).alias("place"))


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (x of ``left``, y of ``right``) of the sets that reach the similarity."""
    sizes = np.array([len(s) for s in sets])
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, token, count = np.unique(tokens, return_inverse=True, return_counts=True)
    use = count[token] > 1
    rank = np.cumsum(count > 1) - 1
    token, owner = rank[token[use]], owner[use]
    common = np.zeros((len(left), len(right)), np.int64)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for at in range(0, int(rank[-1]) + 1 if len(rank) else 0, COLUMNS):
        a, b = np.searchsorted(token, (at, at + COLUMNS))
        part = np.zeros((len(sets), min(COLUMNS, int(rank[-1]) + 1 - at)), np.float32)
        part[owner[a:b], token[a:b] - at] = 1
        common += np.rint(part[left] @ part[right].T).astype(np.int64)
    return np.nonzero(100 * common >= percent * (sizes[left][:, None] + sizes[right][None] - common))


def block_links(clusters: DataFrame, opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components within (rep, cluster). ``opened``: rep, comp; ``sets``: rep, keys.

    Blocks hold documents of one size class, a class being so wide that only neighbours can reach the similarity;
    those of a cluster's largest component are blocks apart and don't meet.
    """
    width = math.log(100 / percent) * 1.001
    docs = clusters.join(opened, "rep").join(sets.select("rep", F.size("keys").alias("n")), "rep")
    docs = stored(docs.withColumn("class", F.floor(F.log(F.col("n")) / width).cast("int")), "clusters")
    parts = docs.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("cluster").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("members"))
    docs = join_hot(docs.drop("n"), main, ["cluster"], "members").withColumn("is_main", F.col("comp") == F.col("main")).drop("main")
    sizes = docs.groupBy("cluster", "members", "is_main", "class").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sizes = stored(sizes, "sizes")
    every = sizes.select("cluster", "members", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct("is_main", "class", k.alias("k")))).alias("block"))
    every = every.groupBy("cluster").agg(F.first("members").alias("members"), F.sort_array(F.collect_list("block")).alias("every"))
    own = join_hot(docs.drop("members"), every, ["cluster"], "members").drop("members")
    mine = F.filter("every", lambda x: (x["is_main"] == F.col("is_main")) & (x["class"] == F.col("class")))
    own = own.withColumn("own", F.element_at(mine, (F.pmod(F.xxhash64("rep"), F.size(mine)) + 1).cast("int")))
    meets = lambda x: (F.abs(x["class"] - F.col("class")) <= 1) & ~(x["is_main"] & F.col("is_main"))
    other = own.withColumn("other", F.explode(F.filter("every", meets)))
    dealt = other.select("rep", "comp", "cluster", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    dealt = dealt.select("rep", "comp", F.xxhash64("cluster", "lo", "hi").alias("pair"), (F.col("lo") == F.col("hi")).cast("int").alias("same"), "side")
    rows = sets.join(dealt, "rep").select("pair", "same", "side", "rep", "comp", "keys").repartition("pair").sortWithinPartitions("pair", "side")

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []

        def links() -> pa.RecordBatch:
            side, rep, comp = (np.array([g[i] for g in group], np.int64) for i in range(3))
            left = np.flatnonzero(side == 0)
            right = left if at[1] else np.flatnonzero(side == 1)
            x, y = similar([g[3] for g in group], left, right, percent) if len(left) and len(right) else (np.zeros(0, int),) * 2
            x, y = left[x], right[y]
            keep = (comp[x] != comp[y]) & ((rep[x] < rep[y]) | (not at[1]))
            a, b = rep[x[keep]], rep[y[keep]]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            for pair, same, side, rep, comp, keys in zip(*(batch.column(i).to_numpy().tolist() for i in range(5)), unlisted(batch.column(5)), strict=True):
                if (pair, same) != at:
                    if group:
                        yield links()
                    at, group = (pair, same), []
                group.append((side, rep, comp, keys.copy()))
        if group:
            yield links()

    return rows.mapInArrow(run, "a long, b long")


def fits(x, y, percent: int):
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def leftover_links(opened: DataFrame, sets: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Links between documents of (rep, comp) whose components differ, by their rarest shingles."""
    rare = stored(rarest(opened, sets, percent), "rare")
    at_key = rare.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("s")).groupBy("key").agg(F.sum("s").alias("t"), F.sum(F.col("s") * F.col("s")).alias("q"), F.count(F.lit(1)).alias("comps"))
    at_key = at_key.where("comps > 1").select("key", "t", ((F.col("t") * F.col("t") - F.col("q")) / 2 <= F.lit(PAIRS) * F.col("t")).alias("few"))
    met = stored(join_hot(rare, stored(at_key, "keys"), ["key"], "t"), "rare")
    thin, dense = met.where((F.col("t") <= THIN) & F.col("few")), met.where((F.col("t") > THIN) | ~F.col("few"))
    sides = thin.select("key", "comp").distinct()
    sides = sides.select("key", F.col("comp").alias("ca")).join(sides.select("key", F.col("comp").alias("cb")), "key").where("ca < cb")
    side = lambda x: thin.select("key", F.col("comp").alias("c" + x), F.col("rep").alias("r" + x), F.col("n").alias("n" + x), (F.col("n") - F.col("place")).alias("o" + x))
    pairs = sides.join(side("a"), ["key", "ca"]).join(side("b"), ["key", "cb"]).where(fits(F.col("na"), F.col("nb"), percent))
    # what is left of either set from the first common shingle on must be enough
    pairs = pairs.where((100 + percent) * F.least("oa", "ob") >= percent * (F.col("na") + F.col("nb")))
    pairs = pairs.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
    found = confirmed(stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs"), sets, percent)
    if not dense.isEmpty():
        first = dense.groupBy("key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n"))
        cluster = components(join_hot(dense.select("key", "rep"), stored(first, "first"), ["key"], "n").select("a", F.col("rep").alias("b")))
        found = found.union(block_links(cluster.select(F.col("v").alias("rep"), F.col("label").alias("cluster")), opened, sets, percent))
    return stored(found, "links")


def near_groups(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    with settings(docs.sparkSession, BATCHES):  # every step with Python is written before this returns
        return _near_groups(docs, percent, id_col, text_col)


def _near_groups(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    made = stored(signatures(docs, id_col, text_col), "signatures")
    full = made.where("n_shingles > 0 and doc_id is not null")
    classes = stored(full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = full.join(classes, (full.doc_id == classes.rep) & (full.digest == classes.digest)).select("rep", "n_shingles", "bands").dropDuplicates(["rep"])
    reps = stored(reps, "reps")
    spread = reps.select(F.explode("bands").alias("key"), "rep", F.col("n_shingles").alias("n"))
    buckets = stored(spread.groupBy("key").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("m")).where("m > 1"), "buckets")
    members = stored(join_hot(spread, buckets, ["key"], "m"), "members")
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    alike = stored(members.select("rep").distinct(), "alike")
    sets = stored(shingle_sets(narrowed(texts, F.col("rep"), alike, F.col("rep"))).join(alike, "rep").dropDuplicates(["rep"]), "sets")
    centres = reps.select(F.col("rep").alias("centre"), F.col("n_shingles").alias("cn"))
    pairs = members.where("rep != centre").select("centre", "rep", "n").distinct()
    sized = pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("m")).join(centres, "centre")
    tested = join_hot(stored(pairs, "pairs"), stored(sized, "centres"), ["centre"], "m").where(fits(F.col("n"), F.col("cn"), percent))
    tested = stored(tested.select(F.col("centre").alias("a"), F.col("rep").alias("b")), "pairs")
    links = stored(confirmed(tested, sets, percent), "links")
    label = components(links)
    named = stored(members.join(label.withColumnRenamed("v", "rep"), "rep", "left").select("key", "rep", F.coalesce("label", "rep").alias("comp")), "named")
    discard(members)
    split = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi").select("key", "m")
    opened = stored(join_hot(named, stored(split, "split"), ["key"], "m").select("rep", "comp").distinct(), "opened")
    if not opened.isEmpty():
        found = leftover_links(opened, sets, tested, percent)
        if not found.isEmpty():
            label = components(links.union(found))
    of_class = stored(classes.join(label.withColumnRenamed("v", "rep"), "rep", "left").select("digest", "copies", F.coalesce("label", "rep").alias("component_id")), "components")
    light = made.select("doc_id", "n_shingles", "digest")
    linked = join_hot(light.where("n_shingles > 0 and doc_id is not null"), of_class, ["digest"], "copies").select("doc_id", "n_shingles", "component_id")
    alone = light.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
