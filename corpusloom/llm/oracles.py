"""DuckDB SQL for the queries that SQL can express; written from the contracts and methods, not from the DataFrame code."""

from __future__ import annotations

from . import mixing, url_filter

WS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3 = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[{WS}]+', '', 'g') AS t FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""


def _op5(depth: int = 10) -> str:
    """Written for paths of ``depth`` segments, which no table at hand reaches."""
    rules = [("block", "example.org", "/en/1"), ("block", "example.org", "/es/"), ("allow", "com", "/fr/"), ("block", "com", "/de/"), ("allow", "org", "/")]
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in rules) + " END"
    fixed = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in rules) + " END"
    part = "CASE " + " ".join(f"WHEN regexp_matches(x, '{pattern}') THEN '{name}'" for pattern, name in url_filter.CLASSES) + " ELSE x END"
    sql = f"""WITH u AS (
      SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), v AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
    ), cut AS (
      SELECT *, {rule} AS rule, {fixed} AS fixed, list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda x: {part}) AS s FROM v
    ), tree0 AS (
      SELECT host, s, '' AS t, count(*)::DOUBLE AS n, (count(*) FILTER (fixed IS NOT NULL))::DOUBLE AS seen, (count(*) FILTER (fixed = 'block'))::DOUBLE AS bad FROM cut GROUP BY ALL
    )"""
    for i in range(depth):
        sql += f""", kids{i} AS (
      SELECT host, t, s[{i + 1}] AS seg, sum(n) AS cn, sum(seen) AS cs, sum(bad) AS cb FROM tree{i} WHERE len(s) > {i} GROUP BY ALL
    ), all{i} AS (
      SELECT *, count(*) OVER x AS kids, sum(cn) OVER x AS pn, sum(cs) OVER x AS ps, sum(cb) OVER x AS pb FROM kids{i} WINDOW x AS (PARTITION BY host, t)
    ), named{i} AS (
      SELECT host, t, seg, CASE WHEN seg = '' THEN '' WHEN kids > 16 AND pn < 4 * kids THEN '*' WHEN cs = 0 AND ps > 0 THEN '?' WHEN cs = 0 OR ps = cs OR pb = 0 OR pb = ps THEN '~'
        WHEN abs(cb / cs - (pb - cb) / (ps - cs)) >= 1.96::DOUBLE * sqrt(pb / ps * (1 - pb / ps) * (1 / cs + 1 / (ps - cs))) THEN seg ELSE '~' END AS name FROM all{i}
    ), tree{i + 1} AS (
      SELECT r.* EXCLUDE (t), CASE WHEN k.seg IS NULL THEN r.t ELSE r.t || '/' || k.name END AS t FROM tree{i} r LEFT JOIN named{i} k ON k.host = r.host AND k.t = r.t AND k.seg = r.s[{i + 1}]
    )"""
    return sql + f""", leaves AS (
      SELECT host, t, sum(seen) AS seen, sum(bad) AS bad FROM tree{depth} GROUP BY ALL
    ), hosts AS (
      SELECT host, sum(seen) AS hs, sum(bad) AS hb FROM leaves GROUP BY 1
    ), priors AS (
      SELECT host, base, (hb + 4 * base) / (hs + 4) AS prior FROM hosts, (SELECT coalesce(sum(hb) / nullif(sum(hs), 0), 0) AS base FROM hosts)
    ), scored AS (
      SELECT host, t, CASE WHEN seen = 0 THEN base ELSE (bad + 4 * prior) / (seen + 4) END AS score FROM leaves JOIN priors USING (host)
    )
    SELECT page_id, cut.host, path, rule, coalesce(fixed, CASE WHEN score >= 0.8 THEN 'block' ELSE 'allow' END) AS verdict
    FROM cut JOIN tree{depth} r ON r.host = cut.host AND r.s = cut.s JOIN scored ON scored.host = r.host AND scored.t = r.t"""


#: What must come out where urls are planted (see ``planted_pages``), from the planting alone.
PLANTED = "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'block' ELSE 'allow' END AS verdict, left(page_id::VARCHAR, 1) NOT IN ('1', '2') AS by_method FROM pages"


#: CRC-32 by half bytes, the low one first; the table of 16 follows from the reversed polynomial.
CRC = """bytes AS (
  SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM documents
), nibbles AS (
  SELECT doc_id, list_prepend(4294967295::BIGINT, flatten(list_transform(b, lambda x: [x & 15, x >> 4]))) AS b FROM bytes
), tab AS (
  SELECT list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t
), crc AS (
  SELECT doc_id, xor(list_reduce(b, lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1])), 4294967295::BIGINT) AS text_crc32 FROM nibbles, tab
)"""

OP8 = f"""WITH {CRC}, d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, CASE WHEN source IS NULL THEN '~' ELSE '=' || source END AS k, md5('interleave:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY h, doc_id, size) AS r, count(*) OVER (PARTITION BY k) AS n, count(*) OVER () AS total FROM d
), p AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2 * n)::DOUBLE, k, r) - 1 AS p FROM r
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p * 16 // total)::INTEGER AS shard, row_number() OVER (PARTITION BY p * 16 // total ORDER BY p) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM p JOIN crc USING (doc_id)"""


def _op9(block: int = 64) -> str:
    steps, at = "", "perm0"
    for i in range(mixing.ROUNDS):
        steps += f""", key{i} AS (
      SELECT * EXCLUDE (rk), rk * {mixing.STEP} % {mixing.PRIME} AS rk FROM {at}
    ), mate{i} AS (
      SELECT *, (rk % blocks - x + blocks) % blocks AS mate FROM key{i}
    ), perm{i + 1} AS (
      SELECT * EXCLUDE (x, mate), CASE WHEN (greatest(x, mate) % {mixing.PRIME} * rk) % {mixing.PRIME} % 2 = 1 THEN mate ELSE x END AS x FROM mate{i}
    )"""
        at = f"perm{i + 1}"
    return f"""WITH d0 AS (
      SELECT row_number() OVER () AS rid, doc_id, coalesce(len(regexp_extract_all(text, '[^{WS}]+')), 0) AS size, CASE WHEN source IS NULL THEN '~' ELSE '=' || source END AS k, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
    ), d AS (
      SELECT *, (('0x' || substr(h, 1, 8))::BIGINT * ceil(count(*) OVER (PARTITION BY k) / 1024)::BIGINT) >> 32 AS b FROM d0
    ), s AS (
      SELECT k, sum(size)::BIGINT AS words FROM d GROUP BY 1
    ), w AS (
      SELECT *, [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY k) - 1) % 3 + 1] AS weight, 2.0::DOUBLE * words AS lim FROM s
    ), l AS (
      SELECT *, lim / weight AS ratio, (1.5::DOUBLE * sum(words) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY lim / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
    ), t AS (
      SELECT k, words, CASE WHEN level >= ratio THEN lim ELSE max(CASE WHEN level < ratio THEN level END) OVER () * weight END AS target FROM l
    ), buckets AS (
      SELECT k, b, ceil(sum(size) / {block})::BIGINT AS n FROM d GROUP BY ALL
    ), before AS (
      SELECT k, b, coalesce(sum(n) OVER (PARTITION BY k ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM buckets
    ), n AS (
      SELECT *, CASE WHEN words = 0 THEN 0 ELSE round(target * blocks / words) END::BIGINT AS slots FROM t JOIN (SELECT k, sum(n)::BIGINT AS blocks FROM buckets GROUP BY 1) USING (k)
    ), laid AS (
      SELECT rid, doc_id, size, k, b, sum(size) OVER (PARTITION BY k, b ORDER BY h, doc_id, size, rid ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start FROM d
    ), pieces AS (
      SELECT rid, k, before + block AS block, least(start + size, (block + 1) * {block}) - greatest(start, block * {block}) AS words
      FROM (SELECT *, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) AS block FROM laid WHERE size > 0) JOIN before USING (k, b)
    ), perm0 AS (
      SELECT k, blocks, j % blocks AS x, ('0x' || substr(md5('mix:' || k || ':' || (j // blocks)), 1, 7))::BIGINT + 1 AS rk FROM (SELECT *, unnest(range(slots)) AS j FROM n)
    ){steps}, shown AS (
      SELECT k, x AS block, count(*) AS times FROM {at} GROUP BY ALL
    ), got AS (
      SELECT rid, sum(words * times)::BIGINT AS taken FROM pieces JOIN shown USING (k, block) GROUP BY 1
    )
    SELECT doc_id, size, words AS source_size, target, coalesce(taken, 0) AS taken FROM laid JOIN n USING (k) LEFT JOIN got USING (rid)"""


#: From the contract alone: targets by handing excess on again and again, at most once a source.
MIX = rf"""WITH RECURSIVE d AS (
  SELECT CASE WHEN source IS NULL THEN '~' ELSE '=' || source END AS k, coalesce(len(regexp_extract_all(text, '[^{WS}]+')), 0) AS size FROM documents
), s AS (
  SELECT k, count(*) AS documents, sum(size)::BIGINT AS words, CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM d GROUP BY k
), turns AS (
  SELECT 0 AS turn, k, false AS full_, words, weight FROM s
  UNION ALL
  SELECT turn + 1, k, full_ OR weight * (1.5 * sum(words) OVER () - coalesce(sum(2.0 * words) FILTER (full_) OVER (), 0)) > 2.0 * words * sum(weight) FILTER (NOT full_) OVER (), words, weight
  FROM turns WHERE turn < (SELECT count(*) FROM s)
), last AS (
  SELECT * FROM turns WHERE turn = (SELECT count(*) FROM s)
), t AS (
  SELECT k, CASE WHEN full_ THEN 2.0 * words ELSE weight * (1.5 * sum(words) OVER () - coalesce(sum(2.0 * words) FILTER (full_) OVER (), 0)) / sum(weight) FILTER (NOT full_) OVER () END AS target FROM last
)
SELECT k AS source_key, documents, words AS source_size, round(target::DOUBLE, 3) AS target, true AS near, true AS bounded FROM s JOIN t USING (k)"""

OP10 = rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^{WS}]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, a AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
), found AS (
  SELECT doc_id, min(other) AS least FROM reach GROUP BY 1
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, w.doc_id) AS component_id, w.doc_id = coalesce(least, w.doc_id) AS kept FROM w LEFT JOIN n USING (doc_id) LEFT JOIN found USING (doc_id)"""

def _op12() -> str:
    """One pattern for all stamps, casts for the calendar, and DuckDB's own time zones for the offsets."""
    clock = r"(?:[T ](\d\d):([0-5]\d)(?::([0-5]\d))?(?: ?([AP])M)?(?: ?(Z|[+-](?:0\d|1[0-4]):?[0-5]\d))?)?".replace(r"\d", "[0-9]")
    two, year, month = "([0-9]{2})", "(20[0-9]{2})", "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
    forms = {
        "iso": (f"{year}-{two}-{two}", "ymd"), "packed": (f"{year}{two}{two}", "ymd"), "dotted": (rf"{two}\.{two}\.{year}", "dmy"), "named": (f"{two} {month} {year}", "dmy"), "slashed": (f"{two}/{two}/{year}", "dmy"),
    }
    names = lambda order: "[" + ", ".join(f"'{x}'" for x in (*order, "h", "i", "s", "half", "z")) + "]"
    parts = "CASE " + " ".join(f"WHEN regexp_full_match(t, '{p}{clock}') THEN struct_pack(f := '{n}', p := CAST(regexp_extract(t, '{p}{clock}', {names(o)}) AS STRUCT(y VARCHAR, m VARCHAR, d VARCHAR, h VARCHAR, i VARCHAR, s VARCHAR, half VARCHAR, z VARCHAR)))" for n, (p, o) in forms.items()) + " END"
    wall = lambda m, d: f"epoch_us(TRY_CAST(format('{{}}-{{}}-{{}} {{}}:{{}}:{{}}', y, {m}, {d}, h, i, s) AS TIMESTAMP))"
    shift = lambda us: f"(epoch_us(timezone(zone, make_timestamptz({us}))) - ({us}))"
    return f"""WITH a AS (
      SELECT stamp_id, source, zone, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM stamps
    ), b AS (
      SELECT *, CASE WHEN regexp_full_match(t, '[0-9]{{10}}') THEN TRY_CAST(t AS BIGINT) * 1000000 WHEN regexp_full_match(t, '[0-9]{{13}}') THEN TRY_CAST(t AS BIGINT) * 1000 END AS epoch, {parts} AS q FROM a
    ), c AS (
      SELECT stamp_id, source, zone, epoch, q.f AS form, q.p.y AS y, CASE WHEN q.f = 'named' THEN lpad(CAST((strpos('JanFebMarAprMayJunJulAugSepOctNovDec', q.p.m) + 2) // 3 AS VARCHAR), 2, '0') ELSE q.p.m END AS m, q.p.d AS d,
        CASE WHEN q.p.half = '' THEN CASE WHEN q.p.h = '' THEN '00' WHEN TRY_CAST(q.p.h AS INT) < 24 THEN q.p.h END WHEN TRY_CAST(q.p.h AS INT) BETWEEN 1 AND 12 THEN lpad(CAST(TRY_CAST(q.p.h AS INT) % 12 + CASE WHEN q.p.half = 'P' THEN 12 ELSE 0 END AS VARCHAR), 2, '0') END AS h,
        CASE WHEN q.p.i = '' THEN '00' ELSE q.p.i END AS i, CASE WHEN q.p.s = '' THEN '00' ELSE q.p.s END AS s,
        CASE WHEN q.p.z = 'Z' THEN 0 WHEN q.p.z <> '' THEN (CASE WHEN q.p.z[1] = '-' THEN -1 ELSE 1 END) * (TRY_CAST(q.p.z[2:3] AS BIGINT) * 60 + TRY_CAST(q.p.z[-2:] AS BIGINT)) * 60000000 END AS off
      FROM b
    ), w AS (
      SELECT *, CASE WHEN h IS NOT NULL AND (off IS NOT NULL OR zone IS NOT NULL) THEN {wall("m", "d")} END AS dm, CASE WHEN h IS NOT NULL AND (off IS NOT NULL OR zone IS NOT NULL) AND form = 'slashed' THEN {wall("d", "m")} END AS md FROM c
    ), v AS (
      SELECT source, count(*) FILTER (form = 'slashed' AND dm IS NOT NULL AND md IS NULL) AS dn, count(*) FILTER (form = 'slashed' AND dm IS NULL AND md IS NOT NULL) AS mn FROM w GROUP BY 1
    ), o AS (
      SELECT w.*, coalesce(dm <> md, false) AS open, dn > 10 * mn OR mn > 10 * dn AS won, CASE WHEN dm <> md AND mn > 10 * dn THEN md ELSE coalesce(dm, md) END AS local FROM w JOIN v ON w.source IS NOT DISTINCT FROM v.source
    ), z AS (
      SELECT *, CASE WHEN off IS NULL THEN {shift("local - 86400000000")} END AS early, CASE WHEN off IS NULL THEN {shift("local + 86400000000")} END AS late FROM o
    ), r AS (
      SELECT *, early <> late AND {shift("local - early")} = early AS e_ok, early <> late AND {shift("local - late")} = late AS l_ok FROM z
    )
    SELECT stamp_id, coalesce(epoch, local - coalesce(off, CASE WHEN e_ok AND NOT l_ok THEN early ELSE late END)) AS utc_us,
      CASE WHEN epoch IS NOT NULL THEN 'epoch' WHEN local IS NULL THEN 'bad' WHEN open AND won THEN 'votes' WHEN open THEN 'default' ELSE 'plain' END AS rule,
      open OR coalesce(early <> late AND e_ok = l_ok, false) AS ambiguous
    FROM r"""


def _op13(rounds: int = 6) -> str:
    """Every distance in full, in whole numbers; a round is an assignment and the means of what each entry got."""
    sql = """WITH kept AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS v, len(embedding) // 8 AS w FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
      SELECT vec_id, label, p, v[p * w + 1:(p + 1) * w] AS x FROM kept, (SELECT unnest(range(8)) AS p)
    ), book0 AS MATERIALIZED (
      SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, x AS c FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
    )"""
    for i in range(rounds + 1):
        sql += f""", near{i} AS MATERIALIZED (
      SELECT vec_id, label, p, x, unnest(min_by(struct_pack(e := e, d := d), struct_pack(d := d, e := e)))
      FROM (SELECT *, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM parts JOIN book{i} USING (p)) GROUP BY vec_id, label, p, x
    )"""
        if i < rounds:
            sql += f""", sums{i} AS MATERIALIZED (
      SELECT p, e, k, CAST(sum(y) AS BIGINT) AS s, count(*) AS n FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS k FROM near{i}) GROUP BY ALL
    ), book{i + 1} AS MATERIALIZED (
      SELECT p, e, coalesce(m, c) AS c FROM book{i} LEFT JOIN (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS m FROM sums{i} GROUP BY ALL) USING (p, e)
    )"""
    return sql + f""", coded AS (
      SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY ALL
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
    FROM coded"""


ORACLES = {"op3_stream_dedup": OP3, "op5_template_tree": _op5(), "op5_planted_templates": PLANTED, "op8_interleave": OP8, "op9_block_mix": _op9(), "op9_mix_of_sources": MIX, "op10_circulant_minhash": OP10, "op12_zone_stamps": _op12(), "op13_partial_distance": _op13()}
