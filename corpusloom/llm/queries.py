"""The thin queries of the training-data operators; see each operator's module for its method."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import edit_counts, exact_dedup, html_blocks, language, media, mixing, near_dedup, pieces, sharding, stamps, token_files, url_filter, vector_codes
from .common import remove_at_exit, shared_dir, table
from .oracles import ORACLES  # noqa: F401


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_media_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.with_media(table(spark, sf_dir, "documents"))
    read = media.with_probe(stored, payload=True)
    unit = F.lit(media.UNIT)
    key = lambda i, field: F.coalesce(F.get(F.col("keyframes"), i)[field].cast("string"), F.lit("-"))
    ranges = F.array_join(F.transform("keyframes", lambda k: F.concat_ws("+", k["offset"], k["size"])), ",")
    feature = F.concat_ws(
        ":", F.trim("codec"), F.concat_ws("/", "duration", "timescale"), F.col("n_samples"), F.size("keyframes"), key(F.lit(0), "offset"), key(F.size("keyframes") - 1, "offset"), F.substring(F.sha2(ranges.cast("binary"), 256), 1, 16)
    )
    payload = F.col("payload")
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, F.octet_length(payload) - unit + 1, unit)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
    )


def op2_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.Model(language.sample(docs))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), derive=pieces.DIGESTS)


def op3_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def made_edits(doc_id: Column, text: Column) -> Column:
    """The edits that op4 makes in every document: cut 9 characters, put in a phrase, replace 4 by two words, append a line."""
    n = F.char_length(text).cast("long")
    place = lambda salt: F.pmod(F.xxhash64(doc_id, F.lit(salt)), n + 1)
    one = lambda start, end, new: F.struct(start.alias("start"), end.alias("end"), F.lit(new).alias("text"))
    return F.array(
        one(place("cut"), place("cut") + 9, ""),
        one(place("put"), place("put"), " it's 42 new_words"),
        one(place("swap"), place("swap") + 4, "  two words'll "),
        one(n + 99, n + 99, "\nThe end."),
    )


def op4_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    where = tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), made_edits(F.col("doc_id"), text).alias("edits"))
    before = edit_counts.build(docs, *where, keep=("edits",)).withColumnRenamed("n_tokens", "n_before")
    trees = before.withColumn("doc_id", F.struct("doc_id", "n_before", "n_pretokens"))
    after = edit_counts.apply_edits(trees, *where)
    return after.select("doc_id.doc_id", "doc_id.n_before", "doc_id.n_pretokens", "n_edits", "n_tokens", "n_encoded", F.sha2(F.col("text").cast("binary"), 256).alias("edited_sha256"))


def op5_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def planted_pages(pages: DataFrame) -> DataFrame:
    """The pages with urls whose fourth segment tells even ids from odd ones."""
    branch = F.when(F.col("page_id") % 2 == 0, "spam").otherwise("news")
    url = F.concat(F.lit("http://h.test/a/b/c/"), branch, F.lit("/"), F.col("page_id").cast("string"), F.lit("/x"))
    return pages.select("page_id", url.alias("url"))


#: Only ids that begin with 1 or 2 are under a rule; all other pages are the method's to judge.
PLANTED_RULES = tuple((verdict, "test", f"/a/b/c/{branch}/{digit}") for verdict, branch in (("block", "spam"), ("allow", "news")) for digit in (1, 2))


def op5_planted_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator where labels differ below the third segment: what no rule covers goes as its branch goes."""
    judged = url_filter.judge(planted_pages(table(spark, sf_dir, "pages")), PLANTED_RULES)
    return judged.select("page_id", "verdict", F.col("rule").isNull().alias("by_method"))


def op7_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"), html_blocks.trained(), keep=("url",))


def op8_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(table(spark, sf_dir, "documents"), n_shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"), block_words=64).select("doc_id", "size", "source_size", "target", "taken")


def op9_mix_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix by source, held against what is asked of it: words near the target, no document above twice its size."""
    rows = mixing.taken(table(spark, sf_dir, "documents"), block_words=64)
    near = F.abs(F.sum("taken") - F.first("target")) <= F.greatest(F.lit(128.0), 0.02 * F.first("target"))
    return rows.groupBy("source_key").agg(F.count(F.lit(1)).alias("documents"), F.first("source_size").alias("source_size"), F.round(F.first("target"), 3).alias("target"), near.alias("near"), F.bool_and(F.col("taken") <= 2 * F.col("size")).alias("bounded"))


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-lists")
    remove_at_exit(spark, path)
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"))
    rows = token_files.with_global_start(spark, token_files.with_crc(token_files.read(spark, path)), path)
    return rows.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")


def op12_zone_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamps.normalise(table(spark, sf_dir, "stamps")).select("stamp_id", "utc_us", "rule", "ambiguous")


def op13_partial_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {f.__name__: f for f in (op1_media_column, op2_ppm_language, op3_stream_dedup, op4_edit_counts, op5_template_tree, op6_piece_spans, op7_block_labeller, op8_interleave, op9_block_mix, op10_circulant_minhash, op11_token_lists, op12_zone_stamps, op13_partial_distance, op5_planted_templates, op9_mix_of_sources)}
