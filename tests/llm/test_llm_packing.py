import itertools
import random
import zlib
from collections import defaultdict

import llm_cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from harrow.llm import packing
from harrow.llm.tokens import tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_the_text():
    rng = random.Random(1)
    pool = "abzAZéÉßÀ×÷ÿ09'’.,!|#<>&́ªµ \n\tſK<|endoftext|>漢"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    texts += ["don't WE'LL 'S ''s it's", "<|endoftext|> x<|startoftext|>y", "Σας İ ẞ ½", "\x1c\x1d a\x85b\xa0c"]
    own = tokenizer(PATH)
    for text in texts:
        assert own.encode(text) == np.array(ids(text), "<u4").tobytes(), text


def test_best_pattern_equals_trying_all():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = np.sort(rng.choice(np.arange(1, 9), 3, replace=False))
        prices = rng.random(3)
        value, pattern = packing.best_pattern(sizes, prices, 12)
        every = [p for p in itertools.product(*(range(12 // s + 1) for s in sizes)) if p @ sizes <= 12]
        assert value == pytest.approx(max(np.dot(p, prices) for p in every))
        assert pattern @ sizes <= 12 and pattern @ prices == pytest.approx(value)


def test_patterns_cover_the_demand_at_the_best_rate():
    sizes, demand = np.array([3, 4, 5]), np.array([200, 300, 100])
    patterns, amounts, bound = packing.solve_patterns(sizes, demand.astype(float), 10)
    assert (patterns @ sizes <= 10).all() and bound <= amounts.sum() <= (1 + packing.GAP) * bound + 1e-3
    assert (patterns.T @ amounts >= demand - 1e-6).all()
    # No fewer than the total size allows, and 10 = 5 + 5 = 3 + 3 + 4 fill sequences.
    assert amounts.sum() == pytest.approx(max(2300 / 10, 50 + 100 + 100), abs=21)
    assert amounts.sum() >= 2300 / 10 - 1e-9
    plan = packing.plan_patterns(sizes, demand, 10)
    assert (sum(p * c for p, c in plan) == demand).all()
    assert sum(c for _, c in plan) <= np.ceil(amounts.sum()) + 3
    assert packing.plan_patterns(np.zeros(0, int), np.zeros(0, int), 10) == []


@pytest.mark.parametrize("seed, sizes, high", [
    (1, np.arange(1, 257), 2000), (2, np.arange(1, 257), 3), (3, np.arange(60, 130), 5000),
    (4, np.arange(1, 257), 10 ** 9), (5, np.array([3, 70, 90, 100, 120, 129, 200]), 4000)])
def test_full_histograms_are_solved(seed, sizes, high):
    """The program ends at the bound that its prices prove; the plan is next to it."""
    demand = np.random.default_rng(seed).integers(1, high, len(sizes))
    patterns, amounts, bound = packing.solve_patterns(sizes, demand.astype(float), 256)
    assert (patterns @ sizes <= 256).all() and (patterns.T @ amounts >= demand - 1e-3).all()
    assert bound <= amounts.sum() * (1 + 1e-9) and amounts.sum() <= (1 + packing.GAP) * bound + 1e-2
    plan = packing.plan_patterns(sizes, demand, 256)
    assert (sum(p * c for p, c in plan) == demand).all()
    n = sum(c for _, c in plan)
    assert n <= 1.01 * bound + 1
    assert n <= sum(c for _, c in packing.first_fit(sizes, demand, 256))
    assert bound >= demand @ sizes / 256 - 1e-6 * demand.sum()


def check(docs, pieces, capacity):
    """Whole documents, whole sequences; gives the share of padding."""
    want = sorted(((r.doc_id, ids(r.text) + [2]) for r in docs.collect()), key=str)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    for doc, group in itertools.groupby(want, key=lambda x: x[0]):
        expected = sorted((len(x), a, len(x[a:a + capacity]),
                           zlib.crc32(np.array(x[a:a + capacity], "<u4").tobytes()))
                          for _, x in group for a in range(0, len(x), capacity))
        assert sorted((p.doc_tokens, p.start, p.length, p.ids_crc32) for p in by_doc.pop(doc)) == expected
    assert not by_doc
    used = [sum(p.length for p in own) for own in by_sequence.values()]
    padded = sum(u if u & (u - 1) == 0 else capacity for u in used)
    return 1 - sum(used) / max(padded, 1)


@pytest.mark.parametrize("capacity", [64, 100])
def test_every_id_lies_in_one_piece(spark, capacity):
    rng = random.Random(capacity)
    texts = [" ".join(rng.choice(["oak", "mills", "zzyzx", "Ünï"]) for _ in range(rng.randint(1, 150)))
             for _ in range(300)]
    docs = llm_cases.documents(spark, texts)
    pieces = packing.pack(docs, PATH, capacity).collect()
    assert check(docs, pieces, capacity) < 0.15
    assert packing.pack(llm_cases.empty(spark), PATH).count() == 0


def test_query_pads_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = packing.op7_packing(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check(docs, found.collect(), 4096) < 0.03
