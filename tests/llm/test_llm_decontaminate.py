import random
import re

import llm_cases
import pyarrow as pa
import pytest

from harrow.llm import decontaminate as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def listed(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def plain(texts, items, window):
    asked = {}
    for item, text in items:
        own = listed(text)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            asked.setdefault(tuple(own[i:i + window]), set()).add(str(item))
    out = []
    for text in texts:
        own, hit, found = listed(text), set(), set()
        for n in {len(w) for w in asked}:
            for i in range(len(own) - n + 1):
                if names := asked.get(tuple(own[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)))
    return out


def case(seed):
    rng = random.Random(seed)
    word = [f"w{i}" for i in range(30)] + ["Ünï", "THE", "the", "5"]

    def text(n):
        return "".join(rng.choice(word) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))

    items = [(i, text(rng.randint(1, 9))) for i in range(25)] + [(90, None), (91, "...")]
    texts = []
    for _ in range(60):
        parts = [text(rng.randint(0, 40))]
        parts += [rng.choice(items)[1] or "" for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    return texts + [None, "", "Ünï", "the the the the the the"], items


@pytest.mark.parametrize("seed, block_bytes", [(1, 1 << 25), (2, 200)])
def test_equal_to_plain_search(spark, seed, block_bytes, monkeypatch):
    monkeypatch.setattr(dec, "SHARD_BYTES", 500)
    texts, items = case(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dec.find_contamination(docs, bench, window=4, block_bytes=block_bytes).collect()
    got = [(r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in sorted(found, key=lambda r: r.id)]
    assert got == plain(texts, items, 4)
    for r in found:
        own = sum(s.length for s in r.spans)
        assert own == r.n_hit and not set(r["items"]) & set(r.near)


def test_terms_near_their_places(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu"
    moved = "alpha beta x gamma delta epsilon zeta eta theta y iota kappa lamda mu nu"
    docs = spark.createDataFrame([(1, item), (2, moved), (3, "alpha beta"), (4, moved[::-1])],
                                 "id long, text string")
    bench = spark.createDataFrame([("q", item)], "item_id string, text string")
    got = {r.id: (list(r["items"]), list(r.near)) for r in dec.find_contamination(docs, bench).collect()}
    assert got == {1: (["q"], []), 2: ([], ["q"]), 3: ([], []), 4: ([], [])}


def test_windows_of_items():
    windows = dec.benchmark_windows([("a", "x y z"), ("b", "x y"), ("c", "")], 2)
    assert len(windows.terms) == 3 and len(windows.windows) == 2
    assert sorted(windows.items) == [["a"], ["a", "b"]]


def test_long_documents_keep_their_own_shard():
    batch = pa.record_batch([pa.array([7, 8]), pa.array([70, None], pa.int64()),
                             pa.array(["w " * 2_000_000, "w"])], names=["row", "id", "text"])
    terms = dec.text_terms(*list(dec.chunks(pa.array(["w"])))[0][1:])[0]
    shards = list(dec._index(terms)(iter([batch])))
    assert [s.num_rows for s in shards] == [2, 2]
    assert len(shards[0].column("positions")[1]) == 2_000_000


def test_rows_of_all_kinds(spark):
    item = " ".join(f"word{i}" for i in range(15))
    docs = llm_cases.documents(spark, [f"{item} and more"]).selectExpr(
        "doc_id id", "text", "lang items", "source `row`")
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "y"), (None, item, "z")],
                                  "item_id long, text string, near string")
    got = dec.find_contamination(docs, bench).collect()
    want = plain([r.text for r in docs.collect()], [(1, item)], 13)
    assert sorted((r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got) == sorted(want)
    none = llm_cases.empty(spark).selectExpr("doc_id id", "text")
    assert dec.find_contamination(none, bench).count() == 0
    got = dec.find_contamination(docs, bench.limit(0)).collect()
    assert len(got) == docs.count() and not any(r.contaminated for r in got)


@pytest.mark.parametrize("block_bytes", [1 << 25, 100])
def test_items_without_an_id_are_searched(spark, block_bytes):
    own, other = (" ".join(f"{x}{i}" for i in range(15)) for x in ("own", "other"))
    docs = spark.createDataFrame([(1, f"{own} and {other}"), (2, own), (3, "nothing")],
                                 "id long, text string")
    bench = spark.createDataFrame([(None, own), (8, other), (None, own + " too"), (9, None)],
                                  "item_id long, text string")
    found = dec.find_contamination(docs, bench, block_bytes=block_bytes).collect()
    got = {r.id: (r.n_hit, list(r["items"]), r.unnamed, list(r.near), r.contaminated) for r in found}
    assert got == {1: (30, ["8"], True, [], True), 2: (15, [], True, [], True),
                   3: (0, [], False, [], False)}


def test_query_counts_items_without_an_id_as_its_sql(spark, tmp_path):
    own, other = (" ".join(f"{x}{i}" for i in range(15)) for x in ("own", "other"))
    spark.createDataFrame([(1, f"{own} and {other}"), (2, own), (3, "nothing")],
                          "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, own), (8, other)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    duckdb = pytest.importorskip("duckdb").connect()
    for name in ("documents", "benchmark"):
        duckdb.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = duckdb.execute(dec.ORACLE_CONTAMINATION).fetchall()
    got = dec.op3_decontamination(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert [r.n_items for r in sorted(got)] == [2, 1, 0]


def test_a_term_after_the_rarest_may_be_missing(spark):
    words = [f"word{i}" for i in range(13)]
    common = " ".join(f"{w} x" for w in words[5:] for _ in range(3))
    docs = [(1, " ".join([*words[:12], "other"])), (2, common)]
    bench = spark.createDataFrame([("q", " ".join(words))], "item_id string, text string")
    one = spark.createDataFrame(docs, "id long, text string").coalesce(1)
    for apart in (False, True):
        with pytest.MonkeyPatch.context() as patch:
            if apart:
                patch.setattr(dec, "SHARD_BYTES", 1)
            got = {r.id: (list(r["items"]), list(r.near)) for r in dec.find_contamination(one, bench).collect()}
        assert got == {1: ([], ["q"]), 2: ([], [])}, apart
