import random
import re
from collections import Counter

import numpy as np
import pytest

from harrow.llm import collocations as co
import llm_cases


def plain(rows, least, top, inside):
    out = []
    by_lang = {}
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        by_lang.setdefault(lang if lang is not None else "und", []).extend(
            re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", low))
    for lang, pieces in by_lang.items():
        f = Counter(tuple(p[i:i + m]) for p in pieces for m in range(1, 5)
                    for i in range(len(p) - m + 1))
        n = sum(c for w, c in f.items() if len(w) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        listed = []
        for p, a in found.items():
            longer = [q for q in found if len(q) > len(p) and any(
                q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * found[q] >= inside * a for q in longer):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            listed.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s)
                for i, (s, a, p, l, r) in enumerate(sorted(listed)[:top], 1)]
    return sorted(out)


def got(spark, rows, least, top, inside, parts=3):
    df = spark.createDataFrame([(t, lang, lang, 1) for lang, t in rows],
                               "text string, lang string, phrase string, n int")
    found = co.collocations(df.repartition(parts), least, top, inside)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in found.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(tuple(r) for r in found.collect())


def sentences(rng, n, vocabulary):
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "! ", " .. "]
    return "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(n))


@pytest.mark.parametrize("seed, least, top, inside", [(1, 3, 50, 80), (2, 2, 7, 40), (3, 5, 1000, 100)])
def test_equal_to_plain_counts(spark, seed, least, top, inside, monkeypatch):
    monkeypatch.setattr(co, "RANGE_ROWS", 50)
    rng = random.Random(seed)
    words = ["a", "B", "the", "é", "É", "z-z", "x'y", "\U0001f600", " ", "ǅ"]
    rows = [(rng.choice(["en", "fr", None, "und"]), sentences(rng, rng.randint(0, 60), words))
            for _ in range(60)]
    rows += [("en", "new york city hall. New York. new york City")] * 9 + [("en", None), (None, None)]
    assert got(spark, rows, least, top, inside) == plain(rows, least, top, inside)


def test_one_phrase_makes_up_a_third(spark):
    """A hot leading word and pair are dealt to many ranges, whole."""
    rng = random.Random(7)
    rows = [("en", "of the " + " of the ".join(f"w{rng.randint(0, 300)}" for _ in range(40)))
            for _ in range(50)]
    rows += [("en", sentences(rng, 50, [f"v{i}" for i in range(40)])) for _ in range(50)]
    assert got(spark, rows, 4, 400, 80, 6) == plain(rows, 4, 400, 80)


def test_words_that_share_a_hash_get_another_one(spark, monkeypatch):
    plain_hashes = co._hashes

    def clashing(lang, vocabulary, seed):
        found = plain_hashes(lang, vocabulary, seed)
        return found if seed == 2 else np.where(found % 2 == 0, 5, found)

    monkeypatch.setattr(co, "_hashes", clashing)
    words = [f"w{i}" for i in range(8)]
    rows = [("en", sentences(random.Random(i), 30, words)) for i in range(20)]
    assert got(spark, rows, 3, 100, 80) == plain(rows, 3, 100, 80)


def test_odd_rows(spark):
    rows = llm_cases.documents(spark, ["a b c"] * 4)
    found = [tuple(r) for r in co.collocations(rows, 4, 10, 80).collect()]
    want = plain([(r["lang"], r["text"]) for r in rows.collect()], 4, 10, 80)
    assert sorted(found) == want and want
    assert co.collocations(llm_cases.empty(spark)).collect() == []


def test_partitions_of_equal_prefixes():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 4, (4, 3000)) * (rng.random((4, 3000)) < 0.9)
    for i in range(1, 4):
        keys[i][keys[i - 1] == 0] = 0
    weights = rng.integers(1, 9, 3000)
    want = Counter()
    for column, w in zip(keys.T.tolist(), weights.tolist(), strict=True):
        for d in range(1, 5):
            if column[d - 1]:
                want[tuple(column[:d])] += w
    depth, pointer, n = co.equal_partitions(keys, weights, 200)
    found = {tuple(keys[:d, p].tolist()): c for d, p, c in zip(depth, pointer, n, strict=True)}
    assert found == {k: c for k, c in want.items() if c >= 200} and len(found) == len(n)
