"""Exact dedup, URL templates, sharding and mixing against plain Python."""

import math
import os
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import common, exact_dedup, mixing, sharding, url_filter
from tests.llm.conftest import ODD


def dedup_truth(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i))
    return Counter((i, min(g)[1], len(g)) for g in groups.values() for _, i in g)


def test_dedup(odd, none):
    got = exact_dedup.dedup(odd).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == dedup_truth(ODD)
    assert all(r.kept == (r.doc_id == r.keep_id) and len(r.text_sha256) == 64 and r.keep_locator for r in got)
    assert exact_dedup.dedup(none).count() == 0


def test_dedup_over_several_batches_and_with_clashing_digests(make):
    rows = [(i, f"text  {i % 7}" + " " * (i % 3)) for i in range(200)]
    docs = make(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup(docs, batches=16).collect()) == dedup_truth(rows)
    weak = lambda t: F.crc32(t.cast("binary")).cast("string").substr(1, 1).cast("binary")
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup(docs, digest=weak).collect()) == dedup_truth(rows)


def test_a_hot_digest_and_ids_of_text(spark, monkeypatch):
    monkeypatch.setattr(common, "LEAST_HOT", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 10)
    rows = [(f"d{i:03}", "same  text" + " " * (i % 2) if i % 3 else f"own {i}") for i in range(90)]
    got = exact_dedup.dedup(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == dedup_truth(rows)


def test_the_stream_runs_in_several_batches_and_checks_bytes_by_locator(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i % 40}") for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    seen = []
    run = exact_dedup.stream_state
    monkeypatch.setattr(exact_dedup, "stream_state", lambda stream, folder: (seen.append(folder), run(stream, folder))[1])
    got = exact_dedup.dedup(spark.read.parquet(str(tmp_path / "docs"))).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == dedup_truth(rows)
    assert len(os.listdir(seen[0].removeprefix("file://") + "/state/commits")) >= 2 * 4  # with their checksums
    assert {r.keep_locator.rpartition("#")[2] for r in got} == {str(i) for i in range(40)}


def test_state_goes_on_in_the_same_folder(spark, make, tmp_path):
    for turn in range(2):
        log = exact_dedup.arrivals(make([(turn * 2, "a b"), (turn * 2 + 1, f"{turn}")]))
        log.write.mode("append").parquet(str(tmp_path / "in"))
        state = exact_dedup.stream_state(spark.readStream.schema(log.schema).parquet(str(tmp_path / "in")), str(tmp_path / "s"))
        sizes = sorted(r.group_size for r in state.collect())
        assert sizes == ([1, 1] if not turn else [1, 1, 2])


URLS = [
    (1, "https://Sub.Example.ORG/es/x?q#f", "sub.example.org", "/es/x", "example.org/es/", "block"), (2, "http://a.org/es/", "a.org", "/es/", "org/", "allow"), (3, "http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    (4, "http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"), (5, "ftp://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"), (6, "http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    (7, "no url", "", "", None, None), (8, None, "", "", None, None), (9, "http://org", "org", "", None, None), (10, "http://x.net?a/b", "x.net", "", None, None), (10, "http://x.net?a/b", "x.net", "", None, None), (11, "http://É.com#/de/", "É.com", "", None, None),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u, *_ in URLS], "page_id long, url string, verdict string, host string")
    got = {(r.page_id, r.host, r.path, r.rule): r.verdict for r in url_filter.judge(pages).collect()}
    assert set(got) == {(i, h, p, r) for i, _, h, p, r, _ in URLS}
    assert all(got[i, h, p, r] == v for i, _, h, p, r, v in URLS if v) and set(got.values()) == {"allow", "block"}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_pure_templates_are_rejected_and_mixed_ones_are_not(spark):
    rules = (("block", "bad.net", "/spam/1"), ("allow", "bad.net", "/news/1"))
    rows = [(i, f"http://bad.net/spam/{i}/p") for i in range(100, 200)] + [(i, f"http://bad.net/spam/2{i}/p") for i in range(200, 220)]
    rows += [(i, f"http://bad.net/news/{i - 200}") for i in range(300, 400)] + [(i, f"http://bad.net/news/2{i}") for i in range(400, 420)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert {got[i].verdict for i in range(200, 220)} == {"block"} and {got[i].verdict for i in range(400, 420)} == {"allow"}
    assert got[205].rule is None and got[205].template == got[105].template == "/spam/{n}/p" and got[405].template == got[305].template


def test_branches_without_labels_are_not_judged_by_others(spark):
    rows = [(i, f"http://a.com/{'de' if i < 7 else 'fr'}/w{'abcdefghi'[i]}") for i in range(9)] + [(100 + i, f"http://b.com/de/w{c}") for i, c in enumerate("abcdefghijkl")]
    rows += [(300 + i, f"http://c.com/fr/{i}") for i in range(20)]
    rows += [(200 + i, f"http://{h}.com/{p}/w") for i, (h, p) in enumerate((h, p) for h in "ab" for p in ("en", "es", "about"))]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert {got[i].verdict for i in range(200, 206)} == {"allow"} == {got[i].verdict for i in (7, 8)} and {got[i].template for i in range(200, 206)} == {"/?/~"}
    assert {got[i].verdict for i in [*range(7), *range(100, 112)]} == {"block"} and got[0].template != got[8].template
    assert len({got[i].score for i in range(200, 206)}) == 1


def test_deep_and_long_urls(spark):
    deep = "http://deep.net/" + "/".join(f"s{i}x" for i in range(3000))
    rows = [(1, deep), (2, "http://deep.net/" + "y" * 100_000), (3, "http://deep.net/a/b/c/d/e/f/g"), (4, "http://deep.net/a/b/c/d/e/f/h"), (5, "http://deep.net/a/b"), (6, "http://deep.net/a/b/")]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert len(got) == 6 and got[3].template == got[4].template != got[5].template != got[6].template and got[1].path == deep[15:]
    assert {r.verdict for r in got.values()} == {"allow"}


def plain_templates(paths, z=1.96, many=16, few=4.0):
    """Groups of paths that share a template, level by level; paths are (parts, pages, labels, blocked labels)."""
    level, out = {"": list(paths)}, {}
    at = 0
    while level:
        onward = {}
        for t, rows in level.items():
            kids = {}
            for r in rows:
                if len(r[0]) == at:
                    out.setdefault(t, set()).add(r[0])
                else:
                    kids.setdefault(r[0][at], []).append(r)
            sums = {k: [sum(r[i] for r in v) for i in (1, 2, 3)] for k, v in kids.items()}
            pn, ps, pb = (sum(x[i] for x in sums.values()) for i in range(3))
            for k, (_, cs, cb) in sums.items():
                name = "?" if not cs and ps else "~"
                if k == "":
                    name = ""
                elif len(kids) > many and pn < few * len(kids):
                    name = "*"
                elif cs and ps != cs and 0 < pb < ps:
                    share = pb / ps
                    if abs(cb / cs - (pb - cb) / (ps - cs)) >= z * math.sqrt(share * (1 - share) * (1 / cs + 1 / (ps - cs))):
                        name = k
                onward.setdefault(f"{t}/{name}", []).extend(kids[k])
        level, at = onward, at + 1
    return {frozenset(v) for v in out.values()}


def test_rounds_that_skip_what_paths_share_give_the_tree_of_levels(spark):
    random.seed(4)
    for turn in (0, 2):
        words, shared = ["a", "b", "", "~", "c", *(f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz")], [["s"] * 9, ["a", "", "b"], []]
        paths = {tuple([*random.choice(shared), *random.choices(words[: 4 + 9 * turn], k=random.randrange(1, 6)), *random.choice(shared)]): None for _ in range(90)}
        rows = [(p, n := random.randrange(1, 9), s := random.randrange(n + 1) * (random.random() < 0.7), random.choice([0, s, random.randrange(s + 1)])) for p in paths]
        df = spark.createDataFrame([("h", "/".join(p), n, int(s), int(b)) for p, n, s, b in rows], "host string, raw string, n long, seen long, bad long")
        got = {}
        for r in url_filter.grown(df, 1.96, 16, 4.0, len(rows)).collect():
            got.setdefault(r["template"], set()).add(tuple(r["raw"].split("/")))
        assert {frozenset(v) for v in got.values()} == plain_templates([(p, n, int(s), int(b)) for p, n, s, b in rows])


def test_what_deep_urls_share_takes_no_rounds(spark):
    rows = [(k, "http://deep.net/" + "/".join(["s"] * 3000) + f"/{'abcde'[k % 5]}/{k}") for k in range(20)]
    began = time.time()
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert time.time() - began < 60 and len({r.template for r in got}) == 1 and len(got) == 20


def test_labels_below_the_third_segment_decide(spark):
    from corpusloom.llm.queries import PLANTED_RULES, planted_pages

    got = url_filter.judge(planted_pages(spark.range(300).withColumnRenamed("id", "page_id")), PLANTED_RULES).collect()
    assert all(r.verdict == ("allow" if r.page_id % 2 else "block") for r in got) and sum(r.rule is None for r in got) > 70
    assert {r.template for r in got} == {"/~/~/~/spam/{n}/x", "/~/~/~/news/{n}/x"}


def test_interleave(odd, none, make):
    rows = [(i, "x" * (i % 5), None, "hot" if i % 3 else f"s{i % 7}") for i in range(1000)]
    got = sharding.interleave(make(rows), n_shards=16).collect()
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    assert sorted(shards) == list(range(16)) and {len(v) for v in shards.values()} <= {62, 63}
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in shards.values())
    hot = [sum(r.source_key == "=hot" for r in v) for v in shards.values()]
    assert max(hot) - min(hot) <= 2
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted((r.doc_id, r.shard, r.slot) for r in sharding.interleave(make(rows)).collect())
    for r in sharding.interleave(odd, 3).collect():
        text = next(t for i, t, *_ in ODD if i == r.doc_id) or ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
    assert sharding.interleave(none).count() == 0


def water(sizes, share=1.5, cap=2.0):
    """Targets by handing the excess on again and again."""
    names = sorted(sizes, key=lambda k: (k is None, k or ""))
    weight = {k: (3, 1, 2)[i % 3] for i, k in enumerate(names)}
    left, out = share * sum(sizes.values()), {}
    open_ = set(names)
    while open_:
        level = left / sum(weight[k] for k in open_)
        over = {k for k in open_ if level * weight[k] > cap * sizes[k]}
        for k in over or open_:
            out[k] = cap * sizes[k] if over else level * weight[k]
            left -= out[k]
        open_ -= over or open_
    return out


def test_mix(make, odd, none):
    rows = [(i, "w " * (i * 37 % 400), None, [None, "a", "b", "hot", "hot"][i % 5]) for i in range(600)] + [(1000, "tiny", None, "z")]
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    want = water(sizes)
    got = mixing.taken(make(rows), block_words=16).collect()
    taken = Counter()
    source = {i: s for i, _, _, s in rows}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        assert r.taken <= 2 * r.size and abs(r.target - want[source[r.doc_id]]) < 1e-6 and r.source_size == sizes[source[r.doc_id]]
    assert all(abs(taken[s] - want[s]) <= 16 for s in want)
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in mixing.taken(make(rows), block_words=16).collect())
    assert mixing.taken(odd).count() == len(ODD) and mixing.taken(none).count() == 0


def test_permutations_are_permutations(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(F.col("id").alias("x"), F.lit(n).cast("long").alias("n"), F.lit(12345).cast("long").alias("k"))
        got = [r.x for r in mixing.permuted(df, "x", "n", "k").collect()]
        assert sorted(got) == list(range(n)) and (n < 100 or got != list(range(n)))


def test_slots_join_blocks_of_their_source(make):
    rows = [(i, "w " * 50, None, f"s{i % 3}") for i in range(90)]
    documents, slots, pieces = mixing.mix(make(rows), block_words=10)
    assert slots.groupBy("source_key", "block").count().agg(F.max("count")).first()[0] <= 2
    assert slots.join(pieces, ["source_key", "block"], "left_anti").count() == 0 and documents.count() == 90
    assert slots.select("shard").distinct().count() == 16


@pytest.mark.parametrize("rows_per_bucket", [1024, 8])
def test_the_mix_can_be_rebuilt_from_its_shards(make, odd, none, rows_per_bucket):
    rows = [(i if i % 9 else None, " ".join(f" {i}w{k}\n" for k in range(i * 37 % 200)), None, [None, "a", "hot", "hot"][i % 4]) for i in range(200)] + [(7, " ".join(f"x{k}" for k in range(59)), None, "hot")]
    documents, mixed = mixing.packed(make(rows), block_words=16, rows_per_bucket=rows_per_bucket)
    got = mixed.collect()
    texts = defaultdict(list)
    for i, t, _, s in rows:
        texts["~" if s is None else f"={s}", i].append(t.split())
    taken, blocks, places = Counter(), {}, {}
    for r in got:
        words, at = r.text.split(" "), 0
        assert blocks.setdefault((r.source_key, r.block), (r.text, r.spans)) == (r.text, r.spans)
        for s in r.spans:
            mine = words[at : (at := at + s.words)]
            assert any(t[s.start : s.start + s.words] == mine for t in texts[r.source_key, s.doc_id])
            assert places.setdefault((r.source_key, s.place), s.doc_id) == s.doc_id
            assert rows_per_bucket < 1024 or s.place + s.start == r.block * 16 + at - s.words
            taken[r.source_key, s.place] += s.words
        assert at == len(words) <= 16
    slots = mixing.mix(make(rows), block_words=16, rows_per_bucket=rows_per_bucket)[1].collect()
    assert sorted((r.source_key, r.slot, r.block, r.shard) for r in got) == sorted((r.source_key, r.j, r.block, r.shard) for r in slots)
    key = lambda r: str((r.doc_id, r.size, r.source_key, r.source_size, r.target, r.taken))
    want = sorted(str((r.doc_id, r.size, r.source_key, r.source_size, r.target, taken[r.source_key, r.place])) for r in documents.collect())
    assert want == sorted(map(key, mixing.taken(make(rows), block_words=16, rows_per_bucket=rows_per_bucket).collect())) == sorted(map(key, mixing.counted(make(rows), block_words=16, rows_per_bucket=rows_per_bucket).collect()))
    assert mixing.packed(odd)[1].where("text = ''").count() == 0 and mixing.packed(none)[1].count() == 0


def test_the_state_of_dedup_is_cut_by_its_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "shared_dir", lambda _, what: f"file://{tmp_path}/{what}")
    docs = spark.createDataFrame([(i, f"text {i % 3}") for i in range(12)], "doc_id long, text string")
    with exact_dedup.settings(spark, {"spark.sql.shuffle.partitions": "40"}):
        got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.dedup(docs).collect()}
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    assert got == {i: (i % 3, 4) for i in range(12)}
    parts = [n for n in os.listdir(tmp_path / "dedup/state/state/0") if n.isdigit()]
    assert len(parts) == 2 * spark.sparkContext.defaultParallelism  # once 40: a store for each of the session's partitions
    monkeypatch.setattr(exact_dedup, "PART_BYTES", 16)
    size = sum(f.stat().st_size for f in (tmp_path / "dedup/arrivals").glob("*.parquet"))
    assert exact_dedup.parts_for(spark, f"file://{tmp_path}/dedup/arrivals") == -(-size // 16) > len(parts)
