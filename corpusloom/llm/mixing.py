"""Mixing sources to target weights by blocks and indexes.

The documents of a source are dealt to buckets by a seeded hash. The words of a bucket are laid end
to end in the hash's order and cut into blocks of ``block_words`` (the last of a bucket may be
shorter), numbered through all buckets of the source. A source gets as many slots as its target needs. How many of them each output
shard gets is a multinomial draw (:func:`draws`): every slot of the source picks a shard by a
seeded hash and the picks are counted, so the counts of all shards add up to what the target needs.
The slots of a source are then numbered shard after shard. Slot j of a source with n blocks belongs
to epoch j div n and shows block pi(j mod n), where pi is a pseudorandom permutation of that source
and epoch (a swap-or-not shuffle: a few rounds of integer arithmetic, no table and no sort).
:func:`packed` joins slots and packed blocks by index and writes the mix, each block with its words
and the spans of documents they come from. Texts are shuffled once, to their buckets: blocks are
packed there, and the slots, which are light, come to them.

Targets: source i in code-point order, null last, weighs 3, 1, 2 and so on; together they get
``share`` times all words, none more than ``cap`` times its own (what is over goes to the others
by weight until none is above, found in closed form from running sums).

A block is shown once in an epoch and there are ``cap`` epochs at most, rounded up, so no document
exceeds so many times its size. A bucket holds about ``rows_per_bucket`` documents, so a source with
a third of all words is spread over all tasks. How many buckets a source has is broadcast for
sources with a large share of the rows, of which there are fewer than ``HOT_KEYS``.

Defined cases: null text or only white space has no words and is never taken; a null source is a
source of its own; repeated rows are rows of their own; an empty table gives an empty result; other
columns are not read. Reruns agree, as nothing but hashes of ids decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import HOT_KEYS, LEAST_HOT, SPACE, WORD, hex_bucket, join_hot, settings, shuffle_key, source_key, stored

#: Modulus and multiplier of the permutation's round keys (a full-period generator below 2^31).
PRIME, STEP = 2147483647, 48271
ROUNDS = 12


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """From (source_key, words): words, weight and target of each source. One row a source is sorted, never one a document."""
    every = W.partitionBy(F.lit(0))
    place = F.row_number().over(every.orderBy("source_key")) - 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("limit", F.lit(cap) * F.col("words")).withColumn("ratio", F.col("limit") / F.col("weight"))
    rising = every.orderBy("ratio", "source_key")
    earlier, onward = rising.rowsBetween(W.unboundedPreceding, -1), rising.rowsBetween(0, W.unboundedFollowing)
    level = weighed.withColumn("level", (F.lit(share) * F.sum("words").over(every) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))) / F.sum("weight").over(onward))
    water = F.max(F.when(F.col("level") < F.col("ratio"), F.col("level"))).over(every)
    full = F.col("level") >= F.col("ratio")
    return level.withColumn("target", F.when(full, F.col("limit")).otherwise(water * F.col("weight"))).select("source_key", "words", "weight", "target")


def permuted(df: DataFrame, index: str, size: str, key: str, rounds: int = ROUNDS) -> DataFrame:
    """Replace ``index`` in [0, size) by its image under the permutation that ``key`` (below PRIME) selects.

    Each round pairs x with (k - x) mod size and swaps the pair if a hash bit of the pair says so;
    both halves see the same bit, so a round is a permutation of any range. Rounds are columns, so they are compiled.
    """
    df = df.withColumn(key, F.col(key).cast("long")).withColumn(index, F.col(index).cast("long"))
    x, k, n, mate = F.col(index), F.col(key), F.col(size), F.col("__mate")
    for _ in range(rounds):
        df = df.withColumn(key, (k * STEP) % PRIME)
        df = df.withColumn("__mate", (k % n - x + n) % n)
        bit = (((F.greatest(x, mate) % PRIME) * k) % PRIME) % 2
        df = df.withColumn(index, F.when(bit == 1, mate).otherwise(x))
    return df.drop(key, "__mate")


def round_key(seed: str, source: Column, epoch: Column) -> Column:
    return F.conv(F.substring(shuffle_key(seed, source, epoch), 1, 7), 16, 10).cast("long") + 1


def bucketed(rows: DataFrame, hot: DataFrame, others: int) -> DataFrame:
    """``rows`` with ``b``, their bucket, by ``hot`` (source_key, buckets) and the number of buckets of all other sources."""
    return rows.join(F.broadcast(hot), "source_key", "left").withColumn("b", hex_bucket(F.col("h"), F.coalesce("buckets", F.lit(others)))).drop("buckets")


def laid_out(rows: DataFrame) -> DataFrame:
    """``rows`` with ``at``, the words of their bucket before theirs."""
    run = W.partitionBy("source_key", "b").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("at", F.sum("size").over(run) - F.col("size"))


def draws(slots: DataFrame, shards: int, seed: str) -> DataFrame:
    """From (source_key, slots, j), a row for each slot: source_key, slots, ends, the last-plus-one slot of each shard in turn.

    The counts of a source over the shards are a draw from the multinomial of equal chances.
    """
    shard = F.pmod(F.xxhash64(F.lit(f"{seed} draw"), "source_key", "j"), F.lit(shards))
    drawn = slots.groupBy("source_key", "slots", shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    counts = drawn.groupBy("source_key", "slots").agg(F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("n"))
    upto = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.try_element_at("n", s.cast("long")), F.lit(0).cast("long")))
    running = F.aggregate(upto, F.array().cast("array<bigint>"), lambda out, n: F.concat(out, F.array(n + F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0).cast("long")))))
    return counts.select("source_key", "slots", running.alias("ends"))


def plan(docs: DataFrame, block_words: int = 64, shards: int = 16, share: float = 1.5, cap: float = 2.0, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", rows_per_bucket: int = 1024) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(documents, slots, pieces) of :func:`mix`, the index of blocks by their place in buckets, and the texts by their place there."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    keys = F.col(id_col).alias("doc_id"), source_key(F.col(source_col)).alias("source_key"), size.alias("size"), shuffle_key(seed, F.col(id_col)).alias("h")
    base = stored(docs.select(F.monotonically_increasing_id().alias("row"), *keys), "sizes")
    sources = stored(base.groupBy("source_key").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "sources")
    total = sources.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_HOT, total // HOT_KEYS)
    hot = sources.where(F.col("n") > least).select("source_key", F.ceil(F.col("n") / rows_per_bucket).cast("int").alias("buckets"))
    others = -(-least // rows_per_bucket)
    wanted = targets(sources.select("source_key", "words"), share, cap)
    base = bucketed(base, hot, others)
    in_bucket = base.groupBy("source_key", "b").agg(F.sum("size").alias("in_words")).withColumn("in_blocks", F.ceil(F.col("in_words") / F.lit(block_words)).cast("long"))
    of_source = W.partitionBy("source_key")
    upto = of_source.orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    before = in_bucket.select("source_key", "b", *(F.coalesce(F.sum(f"in_{x}").over(upto), F.lit(0).cast("long")).alias(f"{x}_before") for x in ("words", "blocks")), F.sum("in_blocks").over(of_source).alias("blocks"))
    before = before.join(wanted, "source_key").drop("weight")
    before = stored(before.withColumn("slots", F.when(F.col("words") == 0, F.lit(0)).otherwise(F.round(F.col("target") * F.col("blocks") / F.col("words"))).cast("long")), "before")
    laid = stored(laid_out(base).join(before, ["source_key", "b"]).drop("h"), "laid")
    full = laid.where("size > 0")
    first, last = F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}")
    pieces = full.select("row", "source_key", "blocks_before", "at", "size", F.explode(F.sequence(first, last)).alias("k"))
    over = F.least(F.col("at") + F.col("size"), (F.col("k") + 1) * block_words) - F.greatest(F.col("at"), F.col("k") * block_words)
    pieces = pieces.select("row", "source_key", (F.col("blocks_before") + F.col("k")).alias("block"), F.greatest(F.col("k") * block_words - F.col("at"), F.lit(0)).alias("start"), over.alias("words"))
    # a document makes the slots whose number is that of a block that begins in it, plus whole epochs
    opened = full.withColumn("lo", F.expr(f"(at + {block_words - 1}) div {block_words}")).withColumn("hi", last).where("lo <= hi")
    index = opened.select("source_key", "b", "words_before", "blocks_before", F.explode(F.sequence("lo", "hi")).alias("k"))
    index = index.select("source_key", (F.col("blocks_before") + F.col("k")).alias("block"), "b", "k", "words_before")
    epochs = F.sequence(F.lit(0).cast("long"), F.lit(math.ceil(cap) - 1).cast("long"))
    opened = opened.select("source_key", "blocks", "slots", F.explode(epochs).alias("epoch"), (F.col("blocks_before") + F.col("lo")).alias("lo"), (F.col("blocks_before") + F.col("hi")).alias("hi")).where("lo + epoch * blocks < slots")
    opened = opened.select("source_key", "blocks", "slots", "epoch", F.explode(F.sequence("lo", "hi")).alias("block"))
    opened = opened.withColumn("j", F.col("block") + F.col("epoch") * F.col("blocks")).where("j < slots")
    ends = stored(draws(opened, shards, seed), "draws")
    slots = opened.withColumn("k", round_key(seed, F.col("source_key"), F.col("epoch"))).drop("epoch", "slots")
    # written, as the optimizer takes ages to infer filters through so many columns for a join above them
    slots = stored(permuted(slots, "block", "blocks", "k").drop("blocks"), "slots")
    slots = join_hot(slots, ends, ["source_key"], "slots")
    slots = slots.select("source_key", "j", "block", F.size(F.filter("ends", lambda e: e <= F.col("j"))).alias("shard"))
    documents = laid.select("row", "doc_id", "size", "source_key", F.when(F.col("size") > 0, F.col("words_before") + F.col("at")).alias("place"), F.col("words").alias("source_size"), "target")
    texts = laid_out(bucketed(docs.select(*keys, F.col(text_col).alias("text")), hot, others)).where("size > 0")
    return documents, slots, pieces, index, texts


def mix(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, slots, pieces).

    documents: row, doc_id, size, source_key, place, source_size, target, for every row of ``docs``;
    slots: source_key, j, block, shard, a row for each block of the mix;
    pieces: row, source_key, block, start, words, what a document adds to a block and where this starts in the document.
    """
    return plan(docs, **options)[:3]


#: Blocks lie with their buckets, and slots join them on bucket and block: the bucket alone decides where both go.
KEEP_BUCKETS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def packed(docs: DataFrame, block_words: int = 64, **options) -> tuple[DataFrame, DataFrame]:
    """(documents, mixed): those of :func:`mix`, and the mix itself, written.

    mixed: shard, source_key, slot, block, text, spans, a row for each block of the mix. ``text`` has the
    block's words with a space between; spans are, in their order, doc_id, place (of the document in its
    source, which tells rows of one id apart), start (the first word's number in the document) and words.
    """
    documents, slots, _, index, texts = plan(docs, block_words, **options)

    def cut(words: Column) -> Column:
        def one(k: Column) -> Column:
            first = F.greatest(F.col("at"), k * block_words)
            n = F.least(F.col("at") + F.col("size"), (k + 1) * block_words) - first
            mine = F.array_join(F.slice(words, (first - F.col("at") + 1).cast("int"), n.cast("int")), " ")
            return F.struct(k.alias("k"), (first - F.col("at")).alias("start"), n.alias("words"), mine.alias("text"))

        return F.transform(F.sequence(F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}")), one)

    # as the variable of a lambda the words of a text are split once, not once a block
    words = F.split(F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), f"{SPACE}+")
    parts = texts.select("source_key", "b", "doc_id", "at", F.explode(F.transform(F.array(words), cut)[0]).alias("p"))
    # documents lie in the order of their places, so this is the order of a block's words
    parts = parts.select("source_key", "b", "p.k", F.struct("at", "doc_id", "p.start", "p.words", "p.text").alias("part"))
    blocks = parts.groupBy("source_key", "b", "k").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    shown = stored(slots.join(index, ["source_key", "block"]), "shown")
    text = F.array_join(F.transform("parts", lambda p: p["text"]), " ")
    spans = F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), (F.col("words_before") + p["at"]).alias("place"), p["start"].alias("start"), p["words"].alias("words")))
    mixed = shown.join(blocks, ["source_key", "b", "k"]).select("shard", "source_key", F.col("j").alias("slot"), "block", text.alias("text"), spans.alias("spans"))
    with settings(docs.sparkSession, KEEP_BUCKETS):
        return documents, stored(mixed, "mix", compression="zstd")


def taken(docs: DataFrame, **options) -> DataFrame:
    """row, doc_id, size, source_key, source_size, target, taken: the words of each document in the written mix, repeats counted."""
    documents, mixed = packed(docs, **options)
    got = mixed.select("source_key", F.inline("spans")).groupBy("source_key", "place").agg(F.sum("words").alias("taken"))
    return documents.join(got, ["source_key", "place"], "left").drop("place").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def counted(docs: DataFrame, **options) -> DataFrame:
    """What :func:`taken` returns, from the pieces alone: for a use that needs no packed words."""
    documents, slots, pieces = mix(docs, **options)
    shown = slots.groupBy("source_key", "block").agg(F.count(F.lit(1)).alias("times"))
    got = pieces.join(shown, ["source_key", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return documents.drop("place").join(got, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
