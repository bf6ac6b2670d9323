import random
import tracemalloc

import llm_cases
import pytest

from harrow.llm import jaccard
from harrow.llm.components import components


def shingles(text):
    own = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        own = own.replace(c, " ")
    own = [w for w in own.split(" ") if w]
    return {tuple(own[i:i + 3]) for i in range(max(1, len(own) - 2))} if own else set()


def plain(rows, percent):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    members = {}
    for i, (own, _) in enumerate(rows):
        members.setdefault(find(i), []).append(own)
    least = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    return sorted(((own, len(sets[i]), least[find(i)]) for i, (own, _) in enumerate(rows)), key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["the", "The", "of"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(25))
    texts = []
    for _ in range(10):  # groups of near copies, some of them large
        base = [rng.choice(vocabulary) for _ in range(rng.randint(2, 60))]
        for _ in range(rng.choice([1, 2, 4, 25])):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                k = rng.randint(0, len(own) - 1)
                own[k:k + 1] = rng.choice([[], [rng.choice(vocabulary)], [own[k], "x"]])
            texts.append(rng.choice([" ", "\n", "\t "]).join(own))
    texts += [f"{passage} tail {i} {rng.random()}" for i in range(20)]  # one passage in many
    texts += [passage] * 15 + [None, "", "a", "A", "a b", "b a"]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(None, passage), (None, "lonely words here"), (3, texts[3])]


@pytest.mark.parametrize("seed, percent, hot", [(1, 90, 1 << 18), (2, 60, 10)])
def test_components_equal_all_pairs(spark, seed, percent, hot, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_SHINGLES", hot)
    data = case(seed)
    docs = spark.createDataFrame(data, "id long, text string").repartition(3)
    got = jaccard.similar_components(docs, percent)
    assert got.columns == ["id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(data, percent)


def test_prefixes_are_long_enough(spark):
    for percent in (1, 50, 90, 100):
        sizes = spark.range(1, 200).select("id", jaccard._short("id", percent).alias("short"))
        short = {r.id: r.short for r in sizes.collect()}
        for n in range(1, 200):
            least = -(-n * percent // 100)  # shingles that a linked set must share at least
            assert jaccard._prefix_length(n, percent) == n - least + 1
            same = -(-2 * n * percent // (100 + percent))  # and one that is no smaller
            assert short[n] == n - same + 1


def test_long_chains_are_one_component(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (900, 900)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_rows_of_all_kinds(spark):
    docs = llm_cases.documents(spark)
    got = jaccard.similar_components(docs.selectExpr("doc_id id", "text", "lang n", "source shingle"))
    data = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(data, 90)
    assert jaccard.similar_components(llm_cases.empty(spark).selectExpr("doc_id id", "text")).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5])
def test_shingles_of_any_size(spark, size):
    texts = ["a b c d e f g h i j", "a b c d e f g h i k", "k i h g f e d c b a", "a b c", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    sets = [{tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}
            for w in map(str.split, texts)]
    found = {r.id: r for r in jaccard.similar_components(docs, 70, size).collect()}
    assert [found[i].n_shingles for i in range(5)] == [len(x) for x in sets]
    for i in range(5):
        like = [j for j in range(5) if 100 * len(sets[i] & sets[j]) >= 70 * len(sets[i] | sets[j])]
        assert found[i].component_id == min(like)


def test_only_sets_of_repeated_rows_are_shuffled_to_leave_one(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words[:59], "x"]), " ".join([*words[:50], *"abcdefgh"])]
    data = [*enumerate(texts), (0, texts[0]), (0, texts[0])]
    docs = spark.createDataFrame(data, "id long, text string").selectExpr(
        "xxhash64(id, text) row", "id", "text")
    rows = sorted({r.id: r.row for r in docs.collect()}.items())
    again = jaccard.key_filter(docs.groupBy("row").count().filter("count > 1"), "row")
    pairs = spark.createDataFrame([(rows[0][1], rows[1][1]), (rows[1][1], rows[2][1])], "a long, b long")
    write, held = jaccard.materialize, []

    def written(df, name):
        held.append(write(df, name))
        return held[-1]

    monkeypatch.setattr(jaccard, "materialize", written)
    got = jaccard._verified(docs, pairs, again, 90, 3)
    want = [(rows[0][1], rows[1][1])]
    assert sorted(map(tuple, got.collect())) == want
    assert sorted((r.row, r.again) for r in held[0].collect()) == sorted(
        [(rows[0][1], True)] * 3 + [(row, False) for _, row in rows[1:]])
    assert sorted(map(tuple, jaccard.similar_components(docs.select("id", "text"), 90).collect())) == plain(data, 90)


def test_counting_shingles_holds_little_more_than_them(monkeypatch):
    monkeypatch.setattr(jaccard, "COUNTED", 1 << 17)
    texts = [" ".join(f"w{i}x{j}" for j in range(250)) for i in range(1000)]
    texts += texts[:3]
    batch = [jaccard.pa.record_batch([jaccard.pa.array(texts)], names=["text"])]
    want = list(jaccard._counted(3)(batch))  # also makes the tables of powers
    tracemalloc.start()
    try:
        found = list(jaccard._counted(3)(batch))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == want and most < 48 * jaccard.TEXT_BYTES + 12 * jaccard.COUNTED
    monkeypatch.setattr(jaccard, "COUNTED", 1 << 20)
    together, = jaccard._counted(3)(batch)
    assert together.num_rows == 3 * 248 and set(together.column(1).to_pylist()) == {2}


def test_bits_that_stand_twice_are_found_from_places_of_two_bytes(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PLACES", 50)
    rng = random.Random(5)
    bits = jaccard.SHINGLE_BITS
    values = [rng.randrange(1 << 63) for _ in range(60)] + [0, bits - 1, -1, -bits]
    data = [(i, [rng.choice(values) for _ in range(rng.randint(0, 30))]) for i in range(40)]
    data += [(40, [77, 77, 77]), (41, [78]), (42, [79]), (42, [79 + bits])]
    marked = spark.createDataFrame(data, "bit long, prefix array<long>").repartition(4)
    chosen = [i for i in range(43) if i % 5]
    packed = jaccard.np.zeros(16, jaccard.np.uint8)
    for i in chosen:
        packed[i >> 3] |= 1 << (i & 7)
    counts = {}
    for i, prefix in data:
        for x in prefix if i in chosen else []:
            counts[x % bits] = counts.get(x % bits, 0) + 1
    found = jaccard._standing_twice(marked, packed)
    at = jaccard.np.flatnonzero(jaccard.np.unpackbits(found, bitorder="little"))
    assert at.tolist() == sorted(x for x, n in counts.items() if n > 1) and 79 in at and 77 not in at
    assert not jaccard._standing_twice(marked.limit(0), packed).any()
    lists = [list(range(i, 4 * bits, 1 << 12)) for i in range(3)]
    batch = jaccard.pa.record_batch([jaccard.pa.array(lists), jaccard.pa.array([1, 1, 1])], ["prefix", "bit"])
    dealt = list(jaccard._in_buckets(packed)(iter([batch])))
    assert sum(x.nbytes for x in dealt) < 3 * sum(map(len, lists))  # eight bytes each before


def test_texts_are_verified_from_their_packed_bytes(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TEXT_BYTES", 3000)  # several rounds in a batch
    base = " ".join(f"word{i % 150} and so on" for i in range(200))
    texts = [f"{base} tail {i}" for i in range(12)] + ["short one here", None, "short one here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 13)] + [(12, 14), (12, 13)], "a long, b long")
    write, held = jaccard.materialize, []

    def written(df, name):
        held.append(write(df, name))
        return held[-1]

    monkeypatch.setattr(jaccard, "materialize", written)
    got = jaccard._verified(docs, pairs, jaccard.np.zeros(1 << 20, jaccard.np.uint8), 90, 3)
    assert sorted(map(tuple, got.collect())) == [(0, i) for i in range(1, 12)] + [(12, 14)]
    shuffled = {r.row: len(r[1]) for r in held[0].collect()}
    assert len(shuffled) == 15
    assert all(shuffled[i] < 8 * len(shingles(texts[i])) for i in range(12))  # those of the set before


def test_sketches_keep_counts_of_two_bytes():
    counts = jaccard.np.array([0, 1, 255, 256, 65_534, 65_535, 70_000, *range(57)])
    packed = jaccard.pa.array([jaccard._sketch(counts), jaccard._sketch(counts[::-1])], jaccard.pa.binary())
    found = jaccard._sketches(packed)
    want = jaccard.np.minimum(counts, jaccard.MOST)
    assert (found[0] == want).all() and (found[1] == want[::-1]).all()
    assert found.dtype == jaccard.np.uint16
