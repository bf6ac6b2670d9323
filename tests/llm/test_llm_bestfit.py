import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from harrow.llm import bestfit, byte_tokens
import llm_cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def check(found, rows, plain, capacity):
    """Every id lies in one piece, cut as stated; sequences have no gap; gives their number."""
    documents = defaultdict(list)
    for r in found:
        documents[r["doc_id"]].append(r)
    want = defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(plain.encode(text or "", add_special_tokens=False).ids + [bestfit.END])
    assert documents.keys() == want.keys()
    for doc_id, texts in want.items():
        expected = []
        for ids in texts:
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            expected += [(i, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes()))
                         for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(tuple(r[1:5]) for r in documents[doc_id]) == sorted(expected)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def sequential(sizes, capacity):
    """Best fit, the largest first, one after another."""
    gaps = []
    for s in sorted(sizes, reverse=True):
        fits = [g for g in gaps if g >= s]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


@pytest.mark.parametrize("seed, rows_per_range", [(1, 1 << 16), (2, 7)])
def test_whole_and_tight(spark, plain, monkeypatch, seed, rows_per_range):
    monkeypatch.setattr(bestfit, "RANGE_ROWS", rows_per_range)
    rng = random.Random(seed)
    word = ["a", "the", "Größe", "naïve", "x = 1;", "\n\n", "  ", "日本", "1234567", "<|endoftext|>"]
    rows = [(i, " ".join(rng.choices(word, k=rng.choice([3, 9, 20, 60])))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + rows[:3]
    rows += [(None, "no id"), (None, None), (500, None), (501, "")]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows],
                               "doc_id long, text string, size int, item string").repartition(3)
    found = bestfit.pack_best_fit(df, capacity=64)
    assert found.dtypes == [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"),
                            ("length", "bigint"), ("ids_crc32", "bigint"),
                            ("sequence_id", "bigint"), ("offset", "bigint")]
    found = found.collect()
    n = check(found, rows, plain, 64)
    assert n <= 1.04 * sequential([r["length"] for r in found], 64) + 1


@pytest.mark.parametrize("seed", range(4))
def test_about_as_few_as_one_after_another(spark, monkeypatch, seed):
    monkeypatch.setattr(bestfit, "RANGE_ROWS", 40)
    rng = random.Random(seed)
    sizes = [[rng.randint(1, 100) for _ in range(250)], [rng.randint(20, 45) for _ in range(200)],
             [34] * 150 + [rng.randint(1, 100) for _ in range(60)], [100, 100, 1, 1]][seed]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size long")
    found = bestfit.best_fit(items, 100).collect()
    ends = defaultdict(list)
    for r in found:
        ends[r["sequence"]].append((r["offset"], sizes[r["item"]]))
    assert sorted(r["item"] for r in found) == list(range(len(sizes)))
    for pieces in ends.values():
        assert [o for o, _ in sorted(pieces)] == np.cumsum([0, *(s for _, s in sorted(pieces))])[:-1].tolist()
        assert sum(s for _, s in pieces) <= 100
    assert len(ends) <= 1.04 * sequential(sizes, 100)


def test_a_round_is_one_sweep_whatever_the_ranges():
    """Ranges and what they pass down give the matches of one sweep over everything."""
    rng = np.random.default_rng(8)
    for _ in range(200):
        sizes = np.sort(rng.integers(1, 12, 60))[::-1]
        is_gap = rng.random(60) < rng.random()
        order = np.lexsort((~is_gap, -sizes))
        sizes, is_gap = sizes[order], is_gap[order]
        documents, gaps, _ = bestfit.sweep(sizes, is_gap)
        want = dict(zip(documents.tolist(), gaps.tolist(), strict=True))
        cuts = np.sort(rng.integers(0, 61, 4))
        found, left = {}, {}
        for r, (a, b) in enumerate(zip([0, *cuts], [*cuts, 60])):
            d, g, free = bestfit.sweep(sizes[a:b], is_gap[a:b])
            found |= dict(zip((d + a).tolist(), (g + a).tolist(), strict=True))
            alone = [i for i in range(a, b) if not is_gap[i] and i not in found]
            left[r] = alone, (free + a).tolist()
        for r, first, n, above, top in bestfit.carry([(r, *map(len, x)) for r, x in left.items()]):
            found |= {left[r][0][first + i]: left[above][1][top - i] for i in range(n)}
        assert found == want
        assert all(sizes[g] >= sizes[d] for d, g in found.items())


def test_odd_rows_and_none(spark, plain):
    rows = llm_cases.documents(spark)
    check(bestfit.pack_best_fit(rows).collect(), [(r["doc_id"], r["text"]) for r in rows.collect()],
          plain, bestfit.CAPACITY)
    assert bestfit.pack_best_fit(llm_cases.empty(spark)).collect() == []


def test_ids_are_the_tokenizers(plain):
    own = byte_tokens.byte_tokenizer(PATH)
    assert own.quick
    settled = "\t\n\r" + "".join(map(chr, [*range(32, 127), *range(0xa1, 0x250), *range(0x2010, 0x2027), 0x20ac]))
    texts = [f"a{c}b {c} {c}{c}1{c}" for c in settled]
    rng = random.Random(4)
    texts += ["".join(rng.choices(settled + "  'ste" * 20, k=80)) for _ in range(3000)]
    texts += ["".join(rng.choices("aeinrst", k=200)) for _ in range(300)]
    texts += ["\u0085 \x1c\x0b x", "日本語 テキスト", "x<|endoftext|> y", "", " ", "　  z"]
    for t in texts:
        assert own.encode(t) == array("I", plain.encode(t, add_special_tokens=False).ids).tobytes(), t


def test_other_files_go_to_their_own_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own = byte_tokens.ByteTokenizer(path)
    assert own.quick is None
    want = Tokenizer.from_file(path).encode("Some text", add_special_tokens=False).ids
    assert own.encode("Some text") == array("I", want).tobytes()


def test_last_rounds_in_one_task_change_nothing(spark, monkeypatch):
    sizes = [100, 98] * 20 + [7, 3, 5] * 2 + [1]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size long")
    rounds, own = [], bestfit._round
    monkeypatch.setattr(bestfit, "_round", lambda *a: rounds.append(a) or own(*a))
    found, n = [], []
    for last in (0, 1 << 14):
        monkeypatch.setattr(bestfit, "LAST_ROWS", last)
        rounds.clear()
        found.append(sorted(map(tuple, bestfit.best_fit(items, 100).collect())))
        n.append(len(rounds))
    assert found[0] == found[1]
    assert sorted(r[0] for r in found[0]) == list(range(len(sizes)))
    assert n[1] < n[0] / 2 and n[0] > 4
