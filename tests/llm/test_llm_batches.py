import numpy as np
import pyarrow as pa

from harrow.llm import batches, bits

SPACE = np.zeros(256, bool)
SPACE[32] = True


def test_chunks_hold_all_texts_in_order():
    texts = ["ab", None, "", "é" * 10, "x" * 50, "y"]
    for array in (pa.array(texts), pa.array(["skipped", *texts]).slice(1), pa.array(texts, pa.large_string())):
        for size in (1, 7, 1000):
            got = []
            for first, data, offsets in batches.chunks(array, size):
                assert first == len(got) and offsets[0] == 0
                got += [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            assert got == [t or "" for t in texts]


def test_words_end_with_their_text():
    (_, data, offsets), = batches.chunks(pa.array(["ab cd", "", "ef ", " gh", "i"]))
    starts, ends, texts = batches.words(SPACE, data, offsets)
    got = [(bytes(data[a:b]).decode(), int(t)) for a, b, t in zip(starts, ends, texts, strict=True)]
    assert got == [("ab", 0), ("cd", 0), ("ef", 2), ("gh", 3), ("i", 4)]


def test_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    starts = rng.integers(0, 3900, 3000)
    ends = starts + rng.integers(0, 6, 3000)
    found = batches.Hashes(data)(starts, ends)
    by_text = {}
    for s, e, h in zip(starts, ends, found, strict=True):
        by_text.setdefault(bytes(data[s:e]), set()).add(int(h))
    assert all(len(h) == 1 for h in by_text.values())
    assert len({min(h) for h in by_text.values()}) == len(by_text)
    upper = np.frombuffer(b"ABCabc", np.uint8)
    a, b = batches.Hashes(upper, batches.folded_symbols())(np.array([0, 3]), np.array([3, 6]))
    assert a == b


def test_filters_hold_every_key(spark):
    keys = spark.range(1000).selectExpr("id * 7919 - 5000 key")
    packed = bits.key_filter(keys, "key")
    found = bits.is_set(packed, np.arange(bits.FILTER_BITS))
    own = [r[0] for r in keys.select(bits.bit_of("key")).collect()]
    assert len(found) == bits.FILTER_BITS and found[own].all() and found.sum() == len(set(own))
    assert not bits.key_filter(keys.limit(0), "key").any()


def test_columns_are_added_batch_by_batch(spark):
    df = spark.range(10).selectExpr("id", "string(id) text").repartition(3)
    got = batches.add_columns(df, lambda b: [[len(x) for x in b.column("text").to_pylist()]],
                              "n long", ["id"])
    assert got.columns == ["id", "n"] and got.agg({"n": "sum"}).first()[0] == 10
