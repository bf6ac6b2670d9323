import random

import pytest
from conftest import rows

from harrow.llm import urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, path = rest[:n], rest[n:]
    path = path[:next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain(url, rules):
    host, path = parts(url)
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else urls.DEFAULT


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_plain_rules(spark, seed):
    rng = random.Random(seed)
    names = ["com", "a.com", "b.a.com", "net", "x.net", "É.net", "a..com", "com."]
    paths = ["", "/", "/en/", "/en", "/en/a", "/fr/", "//"]
    rules = [(rng.choice(names), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(15)]
    shapes = ["http://{h}{p}", "{h}{p}", "x://{h}{p}?q=://z/", "a://b://{h}{p}", "http://{h}{p}#f/en/",
              "HTTP://W.{h}{p}x", "http://{h}?{p}", "http:///{p}", "://", "\n://{h}\n{p}"]
    given = [rng.choice(shapes).format(h=rng.choice(names).upper() if rng.random() < 0.3 else
                                       rng.choice(names), p=rng.choice(paths)) for _ in range(200)]
    given += [None, "", given[0], "http://a.com/en/" + "x" * 50_000]
    table = spark.createDataFrame([(u, "kept") for u in given], "url string, rule string")
    table = table.withColumnRenamed("rule", "host")  # a column of a name that is added
    listed = spark.createDataFrame([*rules, (None, "/", "block")],
                                   "host string, path string, verdict string")
    got = urls.judge_urls(table, listed)
    assert got.columns == ["url", "host", "path", "rule", "verdict"]
    assert rows(got.fillna("-")) == sorted(
        tuple("-" if x is None else x for x in (u, *plain(u, rules))) for u in given)


def test_empty_tables(spark):
    table = spark.createDataFrame([("http://a.com/",)], "url string")
    rules = spark.createDataFrame([("a.com", "/", "block")], "host string, path string, verdict string")
    assert rows(urls.judge_urls(table, rules.limit(0)), "verdict") == [("allow",)]
    assert urls.judge_urls(table.limit(0), rules).count() == 0


def test_main_path_is_built_in(spark):
    table = spark.createDataFrame([("http://a.com/",)], "url string")
    rules = spark.createDataFrame([("a.com", "/", "block")], "host string, path string, verdict string")
    plan = urls.judge_urls(table, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
