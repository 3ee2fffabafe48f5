"""Media, language, counts, pieces, html and near duplicates: edge cases, brute force, round trips, held-out accuracy."""

import hashlib
import os
import random
import struct
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import common, edit_counts, html_blocks, language, media, near_dedup, pieces
from tests.llm.conftest import ODD

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
COUNTER = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


# ---- media ----


def test_media_round_trip(odd, none):
    read = media.with_probe(media.with_media(odd), payload=True)
    for r in read.collect():
        text = (next(t for i, t, *_ in ODD if i == r.doc_id) or "").encode()
        assert r.payload == media.padded(text) and r.n_bytes == len(text) and len(r.payload) % 64 == 0 and r.payload
        assert r.codec == "raw " and r.problem is None and r.n_samples == len(r.payload) // 64 and r.duration == 20 * r.n_samples and r.timescale == 600
        assert len(r.keyframes) == -(-r.n_samples // 16)
        for k in r.keyframes:
            at = k.time // 20 * 64
            assert r.media[k.offset : k.offset + k.size] == r.payload[at : at + 64]
    assert media.with_probe(media.with_media(none)).count() == 0


@pytest.mark.parametrize("n", [1, 15, 16, 17, 63, 64, 65, 128, 1000])
def test_track_sizes(n):
    payload = os.urandom(64 * n)
    p = media.probe(data := media.write_track(payload))
    assert media.read_track(data, p["track"]) == payload and p["n_samples"] == n


def test_two_tracks_odd_tables_and_broken_files(spark):
    def track(codec, sizes, chunk_offsets, runs, wide):
        offsets = media.full_box(b"co64", struct.pack(">I", len(chunk_offsets)), np.array(chunk_offsets, ">u8").tobytes()) if wide else media.full_box(b"stco", struct.pack(">I", len(chunk_offsets)), media.be32(chunk_offsets))
        stbl = media.box(b"stbl", media.full_box(b"stsd", struct.pack(">I", 1), media.box(codec, bytes(8))), media.full_box(b"stts", struct.pack(">III", 1, len(sizes), 5)), media.full_box(b"stsz", struct.pack(">II", 0, len(sizes)), media.be32(sizes)), media.full_box(b"stsc", struct.pack(">I", len(runs)), media.be32(runs)), offsets)
        return media.box(b"trak", media.box(b"mdia", media.full_box(b"mdhd", struct.pack(">IIII", 0, 0, 90, 5 * len(sizes))), media.box(b"minf", stbl)))

    mdat = media.box(b"mdat", b"0123456789abcdef")
    moov = media.box(b"moov", track(b"avc1", [2, 3, 1], [8, 15], [(1, 2, 1), (2, 1, 1)], True), track(b"mp4a", [4], [20], [(1, 1, 1)], False))
    found = media.tracks(memoryview(mdat + moov))
    assert [t["codec"] for t in found] == ["avc1", "mp4a"] and found[0]["offset"].tolist() == [8, 10, 15] and found[0]["sync"].tolist() == [0, 1, 2] and found[1]["offset"].tolist() == [20]
    assert media.read_track(mdat + moov, found[0]) == b"012347"
    good = media.write_track(b"x" * 640)
    bad = [None, b"", b"junk", good[:-100], good[:40], good.replace(b"stsz", b"free"), os.urandom(300)]
    rows = media.with_probe(spark.createDataFrame([(i, x, "c") for i, x in enumerate(bad)], "i int, media binary, codec string")).collect()
    assert all(r.problem and r.keyframes is None and r.codec is None for r in rows)


def test_hostile_counts_cost_nothing(spark):
    """Under a limit of memory that an honest reading of the counts would break."""
    good = media.write_track(b"x" * 640)
    size, time = good.index(b"stsz") + 4, good.index(b"stts") + 4
    runs = good.index(b"stsc") + 4
    bad = [
        good[: size + 8] + b"\xff" * 4 + good[size + 12 :], good[: size + 4] + struct.pack(">II", 0, 2**32 - 1) + good[size + 12 :],
        good[: runs + 12] + b"\xff" * 4 + good[runs + 16 :], b"".join((good[: size + 4], struct.pack(">II", 1, 2**32 - 1), good[size + 12 :])),
    ]
    many_times = good[: time + 8] + b"\xff" * 4 + good[time + 12 :]
    import tracemalloc

    tracemalloc.start()
    for data in bad:
        with pytest.raises(media.Broken):
            media.probe(data)
    assert media.probe(many_times)["n_samples"] == 10
    assert tracemalloc.get_traced_memory()[1] < 5_000_000
    tracemalloc.stop()
    rows = media.with_probe(spark.createDataFrame([(i, x) for i, x in enumerate(bad)], "i int, media binary")).collect()
    assert all(r.problem and r.tracks is None for r in rows)


def test_fragments_and_all_tracks(spark):
    def track(number, handler, codec):
        empty = [media.full_box(k, bytes(4)) for k in (b"stts", b"stsc", b"stco")]
        stbl = media.box(b"stbl", media.full_box(b"stsd", struct.pack(">I", 1), media.box(codec, bytes(8))), *empty, media.full_box(b"stsz", bytes(8)))
        mdia = media.box(b"mdia", media.full_box(b"mdhd", struct.pack(">IIII", 0, 0, 90, 0)), media.full_box(b"hdlr", bytes(4), handler, bytes(12)), media.box(b"minf", stbl))
        return media.box(b"trak", media.full_box(b"tkhd", struct.pack(">IIII", 0, 0, number, 0), bytes(64)), mdia)

    trex = [media.full_box(b"trex", struct.pack(">5I", n, 1, 10, 2, 0x10000)) for n in (1, 2)]
    moov = media.box(b"moov", track(1, b"soun", b"mp4a"), track(2, b"vide", b"avc1"), media.box(b"mvex", *trex))

    def fragment(shift):
        video = media.full_box(b"trun", struct.pack(">IiI", 3, shift, 0), struct.pack(">III", 4, 5, 6), flags=0x1 | 0x4 | 0x200)
        sound = media.full_box(b"trun", struct.pack(">Ii", 2, shift + 15), flags=0x1)
        head = lambda n: media.full_box(b"tfhd", struct.pack(">I", n), flags=0x20000)
        time = media.full_box(b"tfdt", struct.pack(">I", 700))
        return media.box(b"moof", media.box(b"traf", head(2), time, video), media.box(b"traf", head(1), sound))

    def whole():
        out = moov
        for mdat in (b"VVVVvvvvvwwwwwwAABB", b"vvvvVVVVVwwwwwwCCDD"):
            out += fragment(len(fragment(0)) + 8) + media.box(b"mdat", mdat)
        return out

    data = whole()
    p = media.probe(data)
    assert p["codec"] == "avc1" and p["n_samples"] == 6 and media.read_track(data, p["track"]) == b"VVVVvvvvvwwwwwwvvvvVVVVVwwwwww"
    assert [data[o : o + n] for o, n in zip(p["keyframes"][1], p["keyframes"][2], strict=True)] == [b"VVVV", b"vvvv"] and p["keyframes"][0].tolist() == [700, 700] and p["duration"] == 730
    assert [(t["handler"], t["n_samples"], t["n_keyframes"]) for t in p["tracks"]] == [("soun", 4, 0), ("vide", 6, 2)]
    assert media.read_track(data, media.tracks(memoryview(data))[0]) == b"AABBCCDD"
    row = media.with_probe(spark.createDataFrame([(data,)], "media binary"), payload=True).first()
    assert row.problem is None and len(row.tracks) == 2 and len(row.keyframes) == 2
    with pytest.raises(media.Broken):
        media.probe(data.replace(struct.pack(">Ii", 2, len(fragment(0)) + 23), struct.pack(">Ii", -1 & 0xFFFFFFFF, 8)))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_the_media_query_against_plain_reading(spark):
    import zlib

    from corpusloom.llm.queries import op1_media_column

    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op1_media_column(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = texts[r.doc_id]
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        file = media.write_track(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest())
        samples = len(payload) // 64
        keys = [file.index(payload) + 64 * k for k in range(0, samples, 16)]
        ranges = hashlib.sha256(",".join(f"{k}+64" for k in keys).encode()).hexdigest()[:16]
        assert r.feature == f"raw:{20 * samples}/600:{samples}:{len(keys)}:{keys[0]}:{keys[-1]}:{ranges}"


# ---- language ----


def brute_bits(text, sample, order):
    """Code length by walking context counts byte by byte."""
    counts = {}
    joined = language.PAD + language.PAD.join(sample) + language.PAD
    for at in range(len(language.PAD), len(joined)):
        for k in range(order + 1):
            counts.setdefault(joined[at - k : at], {}).setdefault(joined[at], 0)
            counts[joined[at - k : at]][joined[at]] += 1
    data, bits = language.PAD + text, 0.0
    for at in range(len(language.PAD), len(data)):
        for k in range(order, -1, -1):
            seen = counts.get(data[at - k : at])
            if seen is None:
                continue
            n, d = sum(seen.values()), len(seen)
            if data[at] in seen:
                bits -= np.log2(seen[data[at]] / (n + d))
                break
            bits -= np.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    samples = {"a": [b"abracadabra", b"bananas and bandanas"], "b": [b"xyzzy quux", b"plugh xyzzy"]}
    model = language.Model(samples)
    texts = [b"abra banana", b"xyzzy!", b"", b"\xc3\xa9", b"quux bandana " * 50]
    got = model.lengths(texts)
    for t, row in zip(texts, got, strict=True):
        assert np.allclose(row, [brute_bits(t, samples[x], language.ORDER) for x in model.languages], rtol=1e-4)


def test_identify(odd, none, make):
    model = language.Model(language.sample(odd, held_out=None))
    got = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 6)) and got[4].lang_pred in ("en", "fr") and all(0 <= r.score <= 1 for r in got.values())
    assert language.identify(none, model).count() == 0
    empty = language.Model(language.sample(none))
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}


def test_long_texts_do_not_take_the_place_of_others(make):
    rows = [(i, "long " * 1000 if i % 4 == 0 else f"{i:03} " + "short " * 9, "en") for i in range(100)] + [(i, "lang " * (1000 + i), "de") for i in range(200, 210)] + [(300, None, "fr")]
    got = language.sample(make(rows), held_out=None, max_bytes=1000)
    assert len(got["en"]) == 17 and all(len(t) == 58 and b"short" in t for t in got["en"])
    assert [len(t) for t in got["de"]] == [1000] and set(got) == {"en", "de"}


def test_rows_without_ids_and_repeats_do_not_break_the_bound(make):
    rows = [(None, f"words number {i} of a text", "en") for i in range(900)] + [(7, "the same text", "en")] * 900 + [(None, "eins zwei", "de")] * 700
    got = language.sample(make(rows), held_out=None, per_language=20)
    assert len(got["en"]) == 20 == len(got["de"]) and got == language.sample(make(rows).repartition(7), held_out=None, per_language=20)
    shared = language.sample(make(rows), held_out=None, per_language=20, languages=1)
    assert {k: len(v) for k, v in shared.items()} == {"en": 10, "de": 10} and shared["en"] == got["en"][:10]


def test_no_language_is_left_out(make):
    rows = [(i, f"text {i % 300} of its own", f"l{i % 300}") for i in range(900)]
    assert {k: len(v) for k, v in language.sample(make(rows), held_out=None).items()} == {f"l{i}": 3 for i in range(300)}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_held_out_accuracy(spark):
    from corpusloom.llm.queries import op2_ppm_language

    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = op2_ppm_language(spark, "/root/testdata/sf0.01").join(lang, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


# ---- counts ----


def test_edits_keep_the_count_of_the_whole_text():
    own, rnd, letters = edit_counts.counter(*COUNTER), random.Random(3), " \n'lsdtremv a1.,!é中\t  "
    for trial in range(150):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(3000 if trial % 10 == 0 else 200)))
        tree = edit_counts.plant(text, own)
        for _ in range(8):
            a = rnd.randrange(len(text) + 2)
            text, _ = edit_counts.edit(tree, text, a, a + rnd.choice((0, 1, 5, 100)), "".join(rnd.choice(letters) for _ in range(rnd.choice((0, 1, 30)))), own)
            assert tree.total == own.whole(text) and tree.chars == len(text)
            if trial % 3 == 0:
                tree = edit_counts.Tree.load(tree.dump())


def leaves_of(tree):
    return [x for s in range(tree.size) for x in zip(*tree.leaf(s), strict=True)]


def test_trees_after_many_edits_are_those_of_the_text():
    own, rnd = edit_counts.counter(*COUNTER), random.Random(8)
    text = "a few words, and a 42. " * 300
    tree = edit_counts.plant(text, own)
    for turn in range(400):
        a = rnd.randrange(len(text) + 1)
        text, _ = edit_counts.edit(tree, text, a, a + rnd.choice((0, 3, 900 if turn % 50 == 0 else 0)), rnd.choice(("", "new ", "x y z " * rnd.choice((3, 100)))), own)
        if turn % 20 == 0:
            fresh = edit_counts.plant(text, own)
            assert leaves_of(tree) == leaves_of(fresh)
            chars, tokens, used = tree.sums
            for node in range(1, tree.size):
                assert all(row[node] == row[2 * node] + row[2 * node + 1] for row in tree.sums)
            assert [chars[tree.size + s] for s in range(tree.size)] == [sum(tree.leaf(s)[0]) for s in range(tree.size)] and sum(tokens[tree.size :]) == own.whole(text)
            tree = edit_counts.Tree.load(tree.dump())


def test_an_edit_sums_only_paths(monkeypatch):
    own, moved = edit_counts.counter(*COUNTER), []
    text = "some words and more of them. " * 20_000
    tree = edit_counts.plant(text, own)
    spread = edit_counts.Tree._spread
    monkeypatch.setattr(edit_counts.Tree, "_spread", lambda self, node, leaves: (moved.append(len(leaves)), spread(self, node, leaves))[1])
    for i in range(200):
        text, _ = edit_counts.edit(tree, text, 290_000, 290_000, "put in some more words ", own)
    assert tree.total == own.whole(text) and sum(moved) < 3 * 200 and max(moved) < 100 < tree.sums[2][1]


def test_patterns_of_unknown_context_are_refused():
    pattern = r"\s*[\r\n]+|\s+|\S+"
    with pytest.raises(ValueError, match="context"):
        edit_counts.Counter(COUNTER[0], pattern)
    own = edit_counts.Counter(COUNTER[0], pattern, 50)
    text = "a" + " " * 10 + "b"
    tree = edit_counts.plant(text, own)
    text, _ = edit_counts.edit(tree, text, 11, 11, "\n", own)
    assert [n for n, _ in leaves_of(tree)] == [1, 11, 1] and tree.total == own.whole(text)


def test_an_edit_encodes_only_its_surroundings():
    own = edit_counts.counter(*COUNTER)
    text = "some words and more of them. " * 5000
    tree = edit_counts.plant(text, own)
    text, encoded = edit_counts.edit(tree, text, 70_000, 70_004, "new", own)
    assert encoded < 12 and tree.total == own.whole(text)


def test_count_columns(odd, none):
    from corpusloom.llm.queries import made_edits
    from pyspark.sql import functions as F

    text = F.coalesce(F.col("text"), F.lit(""))
    trees = edit_counts.build(odd.withColumn("edits", F.when(F.col("doc_id") != 4, made_edits(F.col("doc_id"), text))), *COUNTER, keep=("edits",))
    own = edit_counts.counter(*COUNTER)
    for r in edit_counts.apply_edits(trees, *COUNTER).collect():
        assert r.n_tokens == own.whole(r.text) and r.n_edits == (0 if r.doc_id == 4 else 4)
    assert edit_counts.build(none, *COUNTER).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_the_edit_query_against_whole_counts(spark):
    """Edits made by plain slices, and the tokens of the whole texts before and after."""
    from corpusloom.llm.queries import made_edits, op4_edit_counts
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own, wanted = edit_counts.counter(*COUNTER), {}
    for r in docs.withColumn("edits", made_edits(F.col("doc_id"), F.col("text"))).collect():
        text = r.text
        for e in r.edits:
            text = text[: e.start] + e.text + text[e.end :] if e.start <= len(text) else text + e.text
        wanted[r.doc_id] = (own.whole(r.text), own.whole(text), hashlib.sha256(text.encode()).hexdigest(), 4)
    got = {r.doc_id: (r.n_before, r.n_tokens, r.edited_sha256, r.n_edits) for r in op4_edit_counts(spark, "/root/testdata/sf0.001").collect()}
    assert got == wanted


# ---- pieces ----


def test_pieces_equal_the_library(odd, none):
    import sentencepiece as sp

    lib = sp.SentencePieceProcessor(model_file=MODEL)
    for r in pieces.encode(odd, MODEL).collect():
        text = next(t for i, t, *_ in ODD if i == r.doc_id) or ""
        assert r.ids == lib.encode(text, add_eos=True)
        raw = text.encode()
        assert (r.begins[0], r.ends[-1]) == (0, len(raw)) and all(a <= b for a, b in zip(r.begins, r.ends, strict=True)) and r.ends[:-1] == r.begins[1:]
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends, strict=True)) == raw
    assert pieces.encode(none, MODEL).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_the_pieces_query_against_the_library(spark):
    """Ids and text as the library has them; spans by the surfaces of its pieces, which for this model are stretches of the text itself."""
    import sentencepiece as sp

    from corpusloom.llm.queries import op6_piece_spans

    lib = sp.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    sha = lambda data: hashlib.sha256(data).hexdigest()
    rows = op6_piece_spans(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r.doc_id]
        ids = lib.encode(text, add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(lib.decode(ids).encode()))
        if "\u2581" in text:
            continue
        ends, at = [], 0
        for i in ids[:-1]:
            piece = lib.id_to_piece(i)
            at += 1 if lib.is_byte(i) else len(piece.replace("\u2581", " ").encode()) - (piece[0] == "\u2581" and not at)
            ends.append(at)
        begins = [0, *ends]
        ends = [*ends, at] if ids[:-1] else [0]
        assert r.spans_sha256 == sha(np.array(begins[: len(ids)], "<i8").tobytes() + np.array(ends, "<i8").tobytes()), r.doc_id


def test_random_texts_equal_the_library():
    import sentencepiece as sp

    lib, own, rnd = sp.SentencePieceProcessor(model_file=MODEL), pieces.Encoder(MODEL), random.Random(1)
    for _ in range(400):
        text = "".join(rnd.choice("  \n\tabcdetheing.,!?▁é中😀​'\"0123<s>") for _ in range(rnd.randrange(120)))
        ids, _, _ = own.encode(text)
        assert ids == lib.encode(text, add_eos=True) and own.digests(ids)[2] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "nfkc"])
def test_compiled_map_equals_the_library(rule):
    import sentencepiece as sp
    from sentencepiece import sentencepiece_model_pb2 as pb

    lib = sp.SentencePieceNormalizer(rule_name=rule)
    spec = pb.NormalizerSpec()
    spec.ParseFromString(lib.serialized_normalizer_spec())
    own, rnd = pieces.Normaliser(spec, False), random.Random(2)
    for _ in range(500):
        text = "".join(rnd.choice("  ab①ＡＢｶﾞ㌔ﬁé́ÄßİΣ　​\n.가각") for _ in range(rnd.randrange(20)))
        normal, source = own(text)
        assert normal == lib.normalize(text), repr(text)
        assert len(source) == len(normal.encode()) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(text.encode())


# ---- html ----

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=/a>Home</a><li>News</ul></nav><script>var a="</p>";</script>
<div class="cookie-notice"><p>We use cookies</p></div><article><h1>A  title&amp;</h1><p>First &lt;para&gt;<br>more text here, and so on. It goes on.<p>Second <b>para</b> with words. It is longer than the others are.</article>
<section id="comments"><p>Nice one, says a reader</p></section><form><label>Name</label></form><footer>&copy; 2024</footer>"""


@pytest.fixture(scope="session")
def net():
    return html_blocks.trained()


def test_blocks_and_labels(spark, net):
    texts = [b.text for b in html_blocks.blocks(PAGE)]
    assert texts == ["Home", "News", "We use cookies", "A title&", "First <para> more text here, and so on. It goes on.", "Second para with words. It is longer than the others are.", "Nice one, says a reader", "Name", "© 2024"]
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "<p><p></div><b"), (5, "u", "<p>" * 3000), (1, "u", PAGE)]
    got = html_blocks.extract(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string"), net, keep=("url",)).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got) and {r.text for r in got if r.page_id in (2, 3, 4, 5)} == {""}
    assert {r.text for r in got if r.page_id == 1} == {"\n".join(texts[3:6])}


def test_letters_that_grow_in_lower_case_move_nothing(net):
    odd = "\u0130" * 50
    page = f"<html><head><title>{odd}</title></head><body><h1>{odd} head</h1><p>{odd}</p><SCRIPT>var x = 'no'</SCRIPT ><p>Kept one.</p><style>{odd}</style><p>Kept two.</p><script>{odd}</script>end</body>"
    assert [b.text for b in html_blocks.blocks(page)] == [f"{odd} head", odd, "Kept one.", "Kept two.", "end"]


def test_unclosed_and_nested_hidden_elements():
    texts = lambda page: [b.text for b in html_blocks.blocks(page)]
    assert texts("<p>a<video src=x><p>b") == ["a", "b"] and texts("<p>a<svg><svg><text>t</text></svg>u</svg><p>b") == ["a", "b"]
    assert texts("<p>a<script>b<p>c") == ["a"] and texts("<p>a<object><p>x</object>b") == ["a b".replace(" ", "")]
    assert texts("<svg/><p>a</p><template>x</template>b<noscript>y</noscript>") == ["a", "b"]


def test_names_at_any_depth_reach_the_block(net):
    reader = html_blocks.Reader()
    for tag in ("nav", "aside"):
        far, = html_blocks.blocks(f"<{tag}>" + "<div>" * 40 + "text" + "</div>" * 40)
        plain, = html_blocks.blocks("<div>" * 41 + "text")
        at = html_blocks.slot("<" + tag, html_blocks.PATH_DIMS)
        assert reader.path(far.node)[at] > 0.6 and reader.path(plain.node)[at] == 0
    assert len(html_blocks.blocks("<div>x" * 50_000)) == 50_000 and len(html_blocks.blocks("<h1>x" * 50_000)) == 50_000


def test_long_pages_are_read_in_stretches_with_equal_chances(net, monkeypatch):
    rng, reader = np.random.default_rng(5), html_blocks.Reader()
    found = [html_blocks.blocks("".join(html_blocks.made_page(rng)[0] for _ in range(4)))]
    whole = net.labelled(found, reader)[0]
    assert np.allclose(whole, net.streamed(found[0], reader, 7), atol=1e-4)
    monkeypatch.setattr(html_blocks, "LONG", 5)
    assert np.allclose(net.labelled([*found, []], reader)[0], whole, atol=1e-4)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_the_query_finds_the_articles(spark):
    """Against the article element of the tables' pages, whose paragraphs are read here by plain means."""
    import html as h
    import re

    from corpusloom.llm.queries import op7_block_labeller

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    right = total = 0
    for r in op7_block_labeller(spark, "/root/testdata/sf0.001").collect():
        article = re.search(r"<article[^>]*>(.*?)</article>", pages[r.page_id], re.S)[1]
        article = re.sub(r"<(script|style|aside|nav|form|figure)\b.*?</\1>|<!--.*?-->", "\n", article, flags=re.S)
        article = re.sub(r"<div[^>]*>.*?</div>", "\n", article, flags=re.S)
        words = Counter(h.unescape(re.sub(r"<[^>]+>", " ", article)).split())
        mine = Counter(r.text.split())
        right, total = right + 2 * sum((words & mine).values()), total + sum(words.values()) + sum(mine.values())
        assert r.n_chars == len(r.text)
    assert right / total > 0.98


def test_held_out_pages(net):
    rng, reader, right, total = np.random.default_rng(1234), html_blocks.Reader(), 0, 0
    for _ in range(150):
        page, main = html_blocks.made_page(rng)
        left = [" ".join(m.split()) for m in main]
        found = html_blocks.blocks(page)
        for b, c in zip(found, net.chances([reader.page(found)])[0], strict=True):
            mine = b.text in left
            if mine:
                left.remove(b.text)
            right, total = right + ((c >= 0.5) == mine), total + 1
        assert not left
    assert right / total > 0.95


def test_gradient():
    rng = np.random.default_rng(0)
    small = html_blocks.Labeller(1, 3)
    small.w = {k: v.astype(np.float64) for k, v in small.w.items()}
    x, mask, y = rng.normal(size=(4, 2, html_blocks.WIDTH)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float), rng.integers(0, 2, (4, 2)).astype(float)

    def loss():
        c = small.run(x, mask)
        return -(mask * (y * np.log(c) + (1 - y) * np.log(1 - c))).sum() / mask.sum()

    for name, g in small.gradient(x, y, mask).items():
        flat, at = small.w[name].reshape(-1), int(rng.integers(small.w[name].size))
        old = flat[at]
        flat[at] = old + 1e-3
        up = loss()
        flat[at] = old - 1e-3
        assert abs((up - loss()) / 2e-3 - np.asarray(g).reshape(-1)[at]) < 1e-3
        flat[at] = old


# ---- near duplicates ----


def truth(rows):
    sets = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {i: (len(sets[i]), label[i]) for i in ids}


def check(docs, rows):
    got = near_dedup.near_groups(docs).collect()
    wanted = truth(rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, *wanted[i]) for i, *_ in rows)


def test_near_groups_on_odd_rows(odd, none):
    check(odd, ODD)
    assert near_dedup.near_groups(none).count() == 0


def test_cloud_of_variants_and_shared_passages(make, monkeypatch):
    rnd = random.Random(4)
    base, passage = [f"w{i}" for i in range(150)], [f"p{i}" for i in range(80)]
    rows = []
    for i in range(120):  # variants, some too far from any other
        w = list(base)
        for _ in range(rnd.randrange(9)):
            w[rnd.randrange(len(w))] = f"x{rnd.random()}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join([f"u{i}_{k}" for k in range(60)] + passage)) for i in range(60)]
    rows += [(300 + i, rows[i][1].upper()) for i in range(5)]
    check(make(rows), rows)
    for name, value in (("PAIRS", 1), ("BLOCK", 8), ("COLUMNS", 64), ("LOT", 4)):
        monkeypatch.setattr(near_dedup, name, value)
    monkeypatch.setattr(common, "LEAST_HOT", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 40)
    check(make(rows), rows)


def test_similar_blocks():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(40)]
    x, y = near_dedup.similar(sets, np.arange(20), np.arange(20, 40), 50)
    wanted = {(a, b) for a in range(20) for b in range(20) if 100 * len(np.intersect1d(sets[a], sets[20 + b])) >= 50 * len(np.union1d(sets[a], sets[20 + b]))}
    assert set(zip(x.tolist(), y.tolist())) == wanted
