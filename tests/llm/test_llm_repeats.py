import hashlib
import random
from collections import Counter

import llm_cases
import numpy as np
import pytest

from harrow.llm import repeats


def plain(texts, length):
    """(bytes, removed, runs, digest) of each text, string by string."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return sorted((r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in df.collect())


def test_covers_reach_every_difference():
    for period, cover in repeats.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert repeats.cover_for(200)[0] == 91 and repeats.cover_for(1)[0] == 1


def test_sorted_numbers_are_packed_without_loss():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        values = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert (repeats.unpack_sorted(repeats.pack_sorted(values)) == values).all()


@pytest.mark.parametrize("length, seed", [(20, 1), (6, 2)])
def test_small_units_and_buckets(spark, length, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randint(3, 40))) for _ in range(12)]
    texts = ["".join(rng.choice(pool) if rng.random() < 0.4 else
                     "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 30)))
                     for _ in range(rng.randint(0, 6))) for _ in range(60)]
    texts += [texts[0], texts[1], texts[1], None, "", "aaaa" * 20, "x" * (length - 1)] + ["y" * length] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = found(repeats.find_repeats(docs, length, unit_bytes=300, bucket_bytes=500))
    assert got == sorted(plain(texts, length))


def test_rows_of_all_kinds(spark):
    docs = llm_cases.documents(spark, ["unique " + "".join(map(chr, range(200, 500)))])
    texts = [r.text for r in docs.collect()]
    got = repeats.find_repeats(docs.select(docs.doc_id.alias("id"), "text", docs.lang.alias("row")))
    assert found(got) == sorted(plain(texts, 200))
    none = llm_cases.empty(spark).selectExpr("doc_id id", "text")
    assert repeats.find_repeats(none).count() == 0


def test_rows_that_repeat_id_and_text_take_part_once(spark, monkeypatch):
    rng = random.Random(5)
    a, b, c = ("".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(3))
    data = [(None, a)] * 40 + [(5, b)] * 40 + [(6, c), (7, c[:100] + b[50:120]), (8, None)]
    rng.shuffle(data)
    docs = spark.createDataFrame(data, "id long, text string").repartition(4)
    paths = []

    def work_path(spark, name, path=repeats.work_path):
        paths.append(path(spark, name))
        return paths[-1]

    monkeypatch.setattr(repeats, "work_path", work_path)
    assert found(repeats.find_repeats(docs, 50)) == sorted(plain([t for _, t in data], 50))
    (path,) = paths
    texts = spark.read.parquet(path)
    assert texts.count() == texts.select("row").distinct().count() == 4
