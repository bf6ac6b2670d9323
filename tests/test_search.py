import random

import pytest
from conftest import rows

from harrow.operators.search import rows_with_any_term


def plain(texts, terms):
    terms = [t.lower() for t in terms if t is not None]
    return sorted((i, t) for i, t in texts if t is not None and any(x in t.lower() for x in terms))


@pytest.mark.parametrize("terms", [
    ["ab", "CAB", "b"], ["abcab", "é!", "zzz", None], [""], [], ["a", "ab", "abc", "abca", "abca"], ["ÉA"]])
def test_equal_to_plain_search(spark, terms):
    rng = random.Random(len(terms))
    texts = [(i, "".join(rng.choices("abcABCéÉ! ", k=rng.randint(0, 9)))) for i in range(150)]
    texts += [(900, None), texts[3], (901, texts[4][1])]
    df = spark.createDataFrame(texts, "id int, title string")
    assert rows(rows_with_any_term(df, "title", terms)) == plain(texts, terms)


def test_ten_thousand_terms(spark):
    """The plan does not grow with the list, and the terms may stand in a table."""
    texts = [(i, f"item {i * 7919 % 100_000:05d} of many") for i in range(3_000)]
    terms = [f" {n:05d} OF" for n in range(0, 100_000, 10)]
    df = spark.createDataFrame(texts, "id int, title string")
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    found = rows_with_any_term(df, "title", table)
    assert rows(found) == plain(texts, terms)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and plan.lower().count("contains") < 5


def test_terms_that_share_all_their_grams_but_one(spark):
    texts = [(i, f"#000000{i:03d}") for i in range(400)]
    terms = [f"000000{i:03d}" for i in range(0, 400, 3)]
    df = spark.createDataFrame(texts, "id int, title string")
    assert rows(rows_with_any_term(df, "title", terms)) == plain(texts, terms)
