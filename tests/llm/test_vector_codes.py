"""Codes of vectors: the search against full distances, the whole against plain integers, odd vectors."""

import hashlib
import math

import numpy as np
import pytest

from corpusloom.llm import vector_codes as V


@pytest.mark.parametrize("size,spread", [(1, 3), (5, 2), (8, 4000), (48, 10)])
def test_search_equals_full_distances(size, spread):
    rng = np.random.default_rng(size)
    for k in (1, 2, 16):
        x, book = rng.integers(-spread, spread, (700, size)), rng.integers(-spread, spread, (k, size))
        full = ((x[:, None] - book[None]) ** 2).sum(2)
        code, d = V.nearest(x, book, V.variance_order(book))
        assert (code == full.argmin(1)).all() and (d == full.min(1)).all()


def test_order_of_dimensions():
    assert V.variance_order(np.array([[0, 5, 1], [0, -5, 3]])).tolist() == [1, 2, 0]
    assert V.variance_order(np.array([[1, 2], [2, 1]])).tolist() == [0, 1]


def plain(rows, rounds=6, parts=8):
    """Brute force over (id, vector, label), with Python's own integers."""
    bad = lambda v: v is None or any(x is None or not math.isfinite(x) for x in v)
    rows = [(i, [math.floor(4096 * x) for x in v], la) for i, v, la in rows if not bad(v)]
    w = len(rows[0][1]) // parts
    part = lambda v, p: v[p * w : p * w + w]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    ids = sorted({r[0] for r in rows})[:16]
    books = [[min(part(r[1], p) for r in rows if r[0] == i) for i in ids] for p in range(parts)]
    def assign():
        return [[min((far(part(v, p), c), e) for e, c in enumerate(books[p])) for p in range(parts)] for _, v, _ in rows]
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(ids)):
                mine = [part(r[1], p) for r, g in zip(rows, got, strict=True) if g[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = [(i, "".join(f"{e:02x}" for _, e in g), sum(d for d, _ in g), la) for (i, _, la), g in zip(rows, assign(), strict=True)]
    return sorted((i, c, e, sum(x[2] for x in out if x[3] == la), sha) for i, c, e, la in out)


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, __n int").repartition(3)


def got(df):
    return sorted(tuple(r) for r in V.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(i % 5, 1, 24)], [None, 1, 2][i % 3]) for i in range(150)]
    rows += [(3, rows[3][1], 1), (500, rows[3][1], None), (501, [0.0] * 24, 2)]
    odd = [(-1, None, 1), (-2, [0.0] * 23 + [math.nan], 1), (-3, [math.inf] + [0.0] * 23, 1), (-4, [None] + [0.0] * 23, 1)]
    wanted = plain(rows + odd)
    assert len(wanted) == 153
    assert got(made(spark, rows + odd)) == wanted
    monkeypatch.setattr(V, "BLOCK", 7)  # the driver's own part of the work only; tasks have theirs
    ints = np.floor(4096 * np.array([r[1] for r in rows])).astype(np.int64).reshape(len(rows), 8, 3)
    books = V.Codebooks(np.ascontiguousarray(ints[:16].transpose(1, 0, 2)), 24)
    full = ((ints[:, :, None] - books.entries[None]) ** 2).sum(3)
    codes, error = V.assigned(ints, books)
    assert (codes == full.argmin(2)).all() and (error == full.min(2).sum(1)).all()


def test_few_and_odd_vectors(spark):
    one = [(7, [0.5] * 8, None)]
    assert got(made(spark, one)) == plain(one)
    # other lengths, and components too large for 64 bits, are left out; what 8 does not divide is filled up
    more = [*one, (8, [0.25] * 8, 1), (1, [1.0] * 9, 1), (2, [3e38] * 8, 1), (3, [-3e38] * 8, 1), (4, [], 1)]
    assert got(made(spark, more)) == plain([one[0], more[1]])
    assert [r[:3] for r in got(made(spark, [(1, [0.5, 0.25], 1), (2, [0.5, 0.5], 1)]))] == [(1, "00" * 8, 0), (2, "0001" + "00" * 6, 0)]


def test_ids_without_value_and_no_rows(spark):
    out = V.compress(made(spark, [(None, [1.0] * 8, 1), (2, [0.0] * 8, 1)])).collect()
    assert {(r["vec_id"], r["code"]) for r in out} == {(None, "01" * 8), (2, "00" * 8)}
    for rows in ([], [(1, None, 1)], [(1, [math.nan] * 8, 1)]):
        empty = V.compress(made(spark, rows))
        assert empty.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
