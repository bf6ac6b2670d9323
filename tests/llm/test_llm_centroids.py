import hashlib
import math
import random

import numpy as np
import pytest

from harrow.llm import centroids


def plain(rows, k, rounds, width, seed):
    kept = [(i, [math.floor(256 * x) if abs(x) < 2 ** 53 else 256 * int(x) for x in v])
            for i, v in rows if v is not None and len(v) == width
            and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(
        f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in first[:k]]

    def nearest(v):
        far = [sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centres]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[0], []).append(v)
        centres = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else old
                   for c, old in enumerate(centres)]
    last = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for *_, d in last)
    sums = {c: sum(e for *_, b, e in last if b == c) for c in range(k)}
    long = lambda x: x if x < 2 ** 63 else None
    short = all(d < 2 ** 63 for *_, d in last)  # else the sum is not known
    whole = {c: all(e < 2 ** 63 for *_, b, e in last if b == c) for c in range(k)}
    return sorted([(i, c, long(d), long(sums[c]) if whole[c] else None,
                    long(total) if short else None, hashlib.sha256(
        ",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in last], key=repr)


def got(spark, rows, k, rounds, width, parts=3):
    df = spark.createDataFrame([(i, v, i, "x") for i, v in rows],
                               "id long, vector array<double>, cluster long, distance string")
    found = centroids.cluster(df.repartition(parts), k, rounds, width)
    assert [f"{a} {b}" for a, b in found.dtypes] == [
        x.strip().replace("long", "bigint") for x in centroids._FIELDS.split(",")]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed, n, k, width, high", [
    (1, 200, 7, 4, 1.0), (2, 90, 12, 3, 0.02), (3, 60, 5, 2, 3e7), (4, 40, 4, 3, 1e6),
    (5, 15, 40, 2, 0.5)])
def test_equal_to_plain_rounds(spark, seed, n, k, width, high):
    """Coarse values give many ties; large ones pass the exact range of doubles."""
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-high, high) for _ in range(width)]) for i in range(n)]
    rows += [(i + 1000, v) for i, v in rows[:n // 3]] + rows[:3]
    rows += [(None, rows[0][1]), (2000, None), (2001, [0.0] * (width + 1)), (2002, []),
             (2003, [None] + [0.1] * (width - 1)), (2004, [float("nan")] * width),
             (2005, [float("-inf")] + [0.0] * (width - 1))]
    assert got(spark, rows, k, 3, width) == plain(rows, k, 3, width, centroids.SEED)


def test_a_third_of_all_rows_alike_and_empty_centroids(spark):
    rows = [(i, [0.5, 0.5]) for i in range(40)] + [(100 + i, [i / 7, -i / 9]) for i in range(60)]
    assert got(spark, rows, 20, 4, 2) == plain(rows, 20, 4, 2, centroids.SEED)


def test_numbers_of_any_size(spark):
    """What no long can hold is null; the clusters stay exact."""
    rows = [(i, [float(i % 3), 0.0]) for i in range(9)] + [(9, [1e300, 1.0]), (10, [-1e200, 2.0]),
                                                          (11, [1e17, 0.0]), (12, [3e17, 0.0])]
    found = got(spark, rows, 5, 2, 2)
    assert found == plain(rows, 5, 2, 2, centroids.SEED)
    assert any(r[2] is None for r in found) and all(r[4] is None for r in found)


def test_no_vectors(spark):
    assert got(spark, [], 3, 2, 2) == []
    assert got(spark, [(1, None), (2, [1.0])], 3, 2, 2) == []


def test_tests_of_a_tournament():
    """k - 1 signs find the nearest centroid, the smallest number among equal ones."""
    rng = np.random.default_rng(5)
    for scale in (3, 1000, 1 << 30, 1 << 60):
        centres = rng.integers(-scale, scale, (9, 5))
        centres[7] = centres[2]
        x = rng.integers(-scale, scale, (300, 5))
        x[:9] = centres
        far = ((x.astype(object)[:, None] - centres.astype(object)) ** 2).sum(axis=2)
        assert (centroids.Bisectors(centres).nearest(x) == far.argmin(axis=1)).all()
