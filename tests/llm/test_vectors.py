"""Vector code compression against brute force."""

import hashlib
import math

import numpy as np
import pytest

from txnlake.llm import vector_codes as vc

LONG_MAX = (1 << 63) - 1


def nearest(point, entries):
    return min((sum((int(a) - int(b)) ** 2 for a, b in zip(point, e)), i) for i, e in enumerate(entries))


@pytest.mark.parametrize(("spread", "dims", "entries"), [(3, 1, 64), (40, 4, 64), (5, 2, 7), (10**6, 8, 33), (10**30, 3, 20), (200, 4, 1)])
def test_slices_give_the_nearest_entry(spread, dims, entries):
    rng = np.random.default_rng(entries * dims)
    draw = lambda n: np.array([[int(v * spread) for v in row] for row in rng.normal(size=(n, dims))], dtype=object if spread > 10**9 else np.int64)
    book, points = draw(entries), np.concatenate([draw(300), draw(20) * 50])
    points[:5] = book[0]
    index, d2 = vc.SliceIndex(book).nearest(points)
    want = [nearest(p, book) for p in points]
    assert [(int(d), int(i)) for d, i in zip(d2, index)] == want


def test_masks_are_the_box_around_a_point():
    rng = np.random.default_rng(1)
    book, points = rng.integers(-9, 9, (64, 3)), rng.integers(-12, 12, (200, 3))
    radius = rng.integers(0, 8, 200)
    masks = vc.SliceIndex(book).masks(points, radius)
    for p, r, m in zip(points, radius, masks):
        assert int(m) == sum(1 << i for i, e in enumerate(book) if np.abs(e - p).max() <= r)


def test_a_codebook_has_a_bit_per_entry():
    with pytest.raises(ValueError):
        vc.SliceIndex(np.zeros((65, 2), np.int64))


SCHEMA = "vec_id long, embedding array<float>, label int, Error string, label_error string"


def brute(rows, parts=16):
    """(vec_id, vector, label) rows to sorted (vec_id, code, error, label_error, sha)."""
    fine = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and math.isfinite(x) for x in r[1])]
    by_id = {}
    for i, v, _ in fine:
        if i is not None:
            by_id[i] = min(by_id.get(i, v), v)
    if not by_id:
        return sorted(((r[0], None, None, None, hashlib.sha256(b"").hexdigest()) for r in fine), key=str)
    dims = len(by_id[min(by_id)])
    fine = [r for r in fine if len(r[1]) == dims]
    # floats above 2**54 have no fraction, so that multiplying their integer value is exact
    whole = lambda v: [int(x) * 256 if abs(x) > 2**54 else math.floor(256 * x) for x in v]
    w = dims // parts
    cut = lambda v: [whole(v)[p * w : (p + 1) * w] for p in range(parts)]
    first = [cut(v) for i, v in sorted(by_id.items()) if len(v) == dims][:64]
    books = [[f[p] for f in first] for p in range(parts)]
    points = [cut(r[1]) for r in fine]
    for _ in range(2):
        fresh = []
        for p in range(parts):
            near = [nearest(x[p], books[p])[1] for x in points]
            own = [[x[p] for x, e in zip(points, near) if e == k] for k in range(len(books[p]))]
            fresh.append([[sum(c) // len(got) for c in zip(*got)] if got else books[p][k] for k, got in enumerate(own)])
        books = fresh
    near = [[nearest(x[p], books[p]) for p in range(parts)] for x in points]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [min(sum(d for d, _ in n), LONG_MAX) for n in near]
    labels = {}
    for r, e in zip(fine, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    out = [(r[0], "".join(f"{e:02x}" for _, e in n), d, min(labels[r[2]], LONG_MAX), sha) for r, n, d in zip(fine, near, errors)]
    return sorted(out, key=str)


def judged(spark, rows):
    df = spark.createDataFrame([(*r, "old", "old") for r in rows], SCHEMA)
    got = vc.compressed(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted((tuple(r) for r in got), key=str)


def vectors(n, dims, seed, scale=0.3):
    rng = np.random.default_rng(seed)
    return [[float(np.float32(x)) for x in row] for row in rng.normal(scale=scale, size=(n, dims))]


def test_codes_of_awkward_rows(spark):
    v = vectors(150, 32, 3)
    rows = [(i * 7 % 151, x, None if i % 3 == 0 else i % 4) for i, x in enumerate(v)]
    rows += [rows[5], rows[5], (rows[9][0], v[10], 1), (None, v[0], None), (None, None, None), (1, None, 2)]
    rows += [(2, [], 1), (3, v[0][:31], 1), (4, v[0][:16], 1), (-5, [float("nan")] * 32, 1), (-6, [float("inf")] + v[1][1:], 1), (-7, [None] + v[1][1:], 1)]
    rows += [(1000 + i, v[20], 0) for i in range(40)]  # a common vector
    assert judged(spark, rows) == brute(rows)


def test_codes_of_huge_numbers(spark):
    v = vectors(70, 16, 4)
    rows = [(i, [float(np.float32(x * 10.0 ** (i % 38))) for x in row], i % 2) for i, row in enumerate(v)]
    got = judged(spark, rows)
    assert got == brute(rows)
    assert any(r[2] == LONG_MAX for r in got)


def test_codes_of_few_and_no_rows(spark):
    few = [(i, x, None) for i, x in enumerate(vectors(5, 16, 5))]
    assert judged(spark, few) == brute(few)
    assert judged(spark, []) == []
    nameless = [(None, x, 1) for x in vectors(4, 16, 6)]
    assert judged(spark, nameless) == brute(nameless)


def test_dimension_is_the_smallest_ids(spark):
    rows = [(i, x, 1) for i, x in enumerate(vectors(80, 32, 7))] + [(100 + i, x, 1) for i, x in enumerate(vectors(10, 16, 8))]
    rows[3] = (3, vectors(1, 48, 9)[0], 1)
    assert judged(spark, rows) == brute(rows)


def test_decoded_vectors_are_the_entries(spark):
    rows = [(i, x, 1) for i, x in enumerate(vectors(90, 16, 10))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    books = vc.train(df)
    for r in vc.decode(vc.encode(df, books), books).collect():
        entries = [books.entries[p][int(r["code"][2 * p : 2 * p + 2], 16)] for p in range(16)]
        assert r["approximation"] == [float(c) / 256 for e in entries for c in e]
        assert r["error"] == sum((math.floor(256 * x) - int(c)) ** 2 for x, c in zip(rows[r["vec_id"]][1], [c for e in entries for c in e]))


def test_sums_do_not_overflow():
    for value in (0, 1, -1, 2**31, -(2**40) - 5, 10**30, -(10**25)):
        assert sum(d << (32 * place) for place, d in vc._limbs(value)) == value
