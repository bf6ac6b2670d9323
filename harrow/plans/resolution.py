"""Entity resolution of documents against benchmark passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.operators import evaluation as ev
from harrow.operators import similarity as sim
from harrow.operators import weights as wt
from harrow.operators.parse import parse_gold_pairs, parse_products, status_counts
from harrow.plans.inputs import (
    CORPUS_SQL,
    GOLD_SQL,
    PRODUCT_LINES_SQL,
    SCORES_SQL,
    STOP_SQL,
    STOP_WORDS,
    corpus,
    documents,
    gold_lines,
    gold_pairs,
    passages,
    product_lines,
    table,
)
from harrow.session import materialize

BAR = 0.01  # the pair lists below hold all pairs of at least this similarity


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _index(spark, sf_dir, bar=BAR):
    return sim.build_index(documents(spark, sf_dir), passages(spark, sf_dir), STOP_WORDS, bar)


def _pairs(spark, sf_dir, bar=BAR):
    """Every pair of similarity ``bar`` or more."""
    return sim.similar_pairs(_index(spark, sf_dir, bar))


def _true_pairs(spark, sf_dir):
    """Every gold pair with a common word, however low it scores."""
    gold = gold_pairs(spark, sf_dir)
    return ev.true_pairs(sim.pair_similarity(_index(spark, sf_dir), gold), gold)


def _gold_scores(spark, sf_dir):
    return ev.indexed_gold_scores(_index(spark, sf_dir), gold_pairs(spark, sf_dir))


def _judged(spark, sf_dir):
    """The bins of all pairs, and the gold scores."""
    index = _index(spark, sf_dir)
    scores = ev.indexed_gold_scores(index, gold_pairs(spark, sf_dir))
    return ev.index_bins(index), materialize(scores, "scores")


def _tokens(spark, sf_dir):
    return wt.record_tokens(corpus(spark, sf_dir), STOP_WORDS).select(
        "id", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("tokens"))


def _common(spark, sf_dir):
    index = _index(spark, sf_dir)
    return sim.common_tokens(index, sim.similar_pairs(index)).select(
        "id_a", "id_b", "n_common", F.array_join("tokens", " ").alias("tokens"))


def _turn_pairs(spark, sf_dir):
    """Similarity of each turn of a conversation to the next one.

    All rows of a turn make up its text, counted word by word and never put together.
    """
    def number(turn):
        return F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    first = rows.select(number(F.col("turn")).alias("pair_id"), F.lit("a").alias("side"), "text")
    second = rows.select(number(F.col("turn") - 1).alias("pair_id"), F.lit("b").alias("side"),
                         "text")
    sides = first.unionByName(second)
    both = (sides.groupBy("pair_id").agg(F.min("side").alias("x"), F.max("side").alias("y"))
            .filter("x <> y").select("pair_id"))
    turns = rows.select(number(F.col("turn")).alias("id"), "text")
    idf = wt.inverse_document_frequency(turns, STOP_WORDS, unique_ids=False)
    found = wt.side_similarity(sides.join(both, "pair_id"), idf, STOP_WORDS,
                               parts=wt.text_parts(sides))
    return _rounded(found, "similarity")


def _lookup(spark, sf_dir):
    """The similarity of the longest document and the longest passage.

    Only the words of these two are counted over the corpus.
    """
    def longest(records, mark, side):
        found = wt.biggest_record(records, STOP_WORDS).select("id")
        return records.join(found, "id").select(F.col("id").alias(f"id_{side}"),
                                                F.lit(side).alias("side"), "text"), mark

    docs, items = documents(spark, sf_dir), passages(spark, sf_dir)
    (a, _), (b, _) = longest(docs, "d", "a"), longest(items, "b", "b")
    pair = a.select("id_a").join(b.select("id_b"), F.lit(True))
    sides = a.select(F.lit(0).alias("pair_id"), "side", "text").unionByName(
        b.select(F.lit(0).alias("pair_id"), "side", "text"))
    own = wt.inverted_pairs(sides.select(F.col("side").alias("id"), "text"), STOP_WORDS)
    records = corpus(spark, sf_dir)
    held = wt.inverted_pairs(records, STOP_WORDS).join(own.select("token").distinct(), "token")
    n = records.agg(F.count_distinct("id")).scalar()
    idf = held.groupBy("token").agg((n / F.count("*")).alias("idf"))
    found = wt.side_similarity(sides, idf, STOP_WORDS, parts=1)
    return pair.join(found, F.lit(True)).select(
        "id_a", "id_b", F.round(F.coalesce("similarity", F.lit(0.0)), 6).alias("similarity"))


def _status(spark, sf_dir):
    products = status_counts(parse_products(product_lines(spark, sf_dir)))
    gold = status_counts(parse_gold_pairs(gold_lines(spark, sf_dir)))
    return (products.withColumn("kind", F.lit("products"))
            .unionByName(gold.withColumn("kind", F.lit("gold"))))


QUERIES = {
    "er_parse_products": lambda s, d: parse_products(product_lines(s, d)),
    "er_parse_gold": lambda s, d: parse_gold_pairs(gold_lines(s, d)),
    "er_parse_status": _status,
    "er_tokens_no_stop": _tokens,
    "er_token_count": lambda s, d: wt.token_total(corpus(s, d), STOP_WORDS),
    "er_biggest_record": lambda s, d: wt.biggest_record(corpus(s, d), STOP_WORDS),
    "er_inverted_pairs": lambda s, d: wt.inverted_pairs(corpus(s, d), STOP_WORDS),
    "er_tf": lambda s, d: _rounded(wt.term_frequency(corpus(s, d), STOP_WORDS), "tf"),
    "er_idf": lambda s, d: _rounded(
        wt.inverse_document_frequency(corpus(s, d), STOP_WORDS), "idf"),
    "er_tfidf": lambda s, d: _rounded(wt.tfidf(corpus(s, d), STOP_WORDS), "weight"),
    "er_norms": lambda s, d: _rounded(wt.norms(wt.tfidf(corpus(s, d), STOP_WORDS)), "norm"),
    "er_cosine_pairs": _turn_pairs,
    "er_cosine_inverted": _pairs,
    "er_cosine_brute": lambda s, d: _rounded(
        sim.all_pairs_summary(_index(s, d)), "sum_similarity", "mean_similarity"),
    "er_overlapping_pairs": lambda s, d: sim.overlapping_pair_count(_index(s, d)),
    "er_common_tokens": _common,
    "er_pair_lookup": _lookup,
    "er_pair_key": lambda s, d: ev.pair_key(_pairs(s, d)).select("key", "similarity"),
    "er_true_dups": _true_pairs,
    "er_non_dups": lambda s, d: ev.false_pairs(_pairs(s, d), gold_pairs(s, d)),
    "er_avg_sims": lambda s, d: _rounded(
        ev.mean_similarities(_index(s, d), gold_pairs(s, d)), "mean_true", "mean_other"),
    "er_gold_scores": _gold_scores,
    "er_histogram": lambda s, d: ev.histogram(*_judged(s, d)),
    "er_confusion": lambda s, d: ev.confusion(*_judged(s, d)),
    "er_pr_curve": lambda s, d: _rounded(
        ev.precision_recall(ev.confusion(*_judged(s, d))), "precision", "recall", "f_measure"),
}

_CORPUS = f"WITH {CORPUS_SQL}"
_JUDGED = f"""{_CORPUS},{GOLD_SQL},{SCORES_SQL},
bins AS (SELECT unnest(range(101)) AS bin),
pair_bins AS (
  SELECT CAST(floor(similarity * CAST(100 AS DOUBLE)) AS INTEGER) AS bin, count(*) AS n
  FROM sims WHERE similarity >= 0.01 GROUP BY 1
  UNION ALL SELECT 0, (SELECT count(*) FROM documents) * (SELECT count(*) FROM benchmark)
    - (SELECT count(*) FROM sims WHERE similarity >= 0.01)),
gold_bins AS (
  SELECT CAST(floor(similarity * CAST(100 AS DOUBLE)) AS INTEGER) AS bin, count(*) AS n
  FROM scores GROUP BY 1),
histogram AS (
  SELECT CAST(bin AS INTEGER) AS bin, coalesce(p.n, 0) AS n_pairs, coalesce(g.n, 0) AS n_gold,
    coalesce(p.n, 0) - coalesce(g.n, 0) AS n_false
  FROM bins LEFT JOIN pair_bins p USING (bin) LEFT JOIN gold_bins g USING (bin)),
thresholds AS (SELECT CAST(unnest(range(100)) AS DOUBLE) / 100 AS threshold),
confusion AS (
  SELECT threshold,
    (SELECT CAST(sum(n_false) AS BIGINT) FROM histogram
     WHERE CAST(bin AS DOUBLE) / 100 >= threshold) AS n_fp,
    (SELECT count(*) FROM scores WHERE similarity < threshold) AS n_fn,
    (SELECT count(*) FROM scores WHERE similarity >= threshold) AS n_tp
  FROM thresholds),
rates AS (
  SELECT threshold, n_tp / nullif(CAST(n_tp + n_fp AS DOUBLE), 0) AS p,
    n_tp / nullif(CAST(n_tp + n_fn AS DOUBLE), 0) AS r FROM confusion)
"""
_BAR = f"similarity >= {BAR}"
_PRODUCT = r"'^(.+),\"(.+)\",(.*),(.*),(.*)'".replace('\\"', '"')
_PRODUCTS = f"""{PRODUCT_LINES_SQL},
products AS (
  SELECT value, CASE WHEN NOT regexp_matches(value, {_PRODUCT}) THEN 'invalid'
    WHEN regexp_extract(value, {_PRODUCT}, 1) = '"id"' THEN 'header' ELSE 'ok' END AS status
  FROM lines)"""
_GOLD_LINES = f"""{GOLD_SQL},
gold_lines AS (
  SELECT '"d' || id_a || '","b' || id_b || '"' AS value, 'ok' AS status,
    'd' || id_a AS id_a, 'b' || id_b AS id_b FROM gold
  UNION ALL SELECT '"idAmazon","idGoogleBase"', 'header', NULL, NULL)"""


def _counts_sql(table_name, kind):
    return f"""SELECT '{kind}' AS kind, count(*) AS n_read,
  count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'header') AS n_header,
  count(*) FILTER (status = 'invalid') AS n_invalid FROM {table_name}"""


ORACLE = {
    "er_parse_products": f"""WITH {_PRODUCTS}
SELECT value, status,
  CASE status WHEN 'ok' THEN replace(regexp_extract(value, {_PRODUCT}, 1), '"', '') END AS id,
  CASE status WHEN 'ok' THEN regexp_extract(value, {_PRODUCT}, 2) || ' '
    || regexp_extract(value, {_PRODUCT}, 3) || ' '
    || regexp_extract(value, {_PRODUCT}, 4) END AS text FROM products""",
    "er_parse_gold": f"WITH {_GOLD_LINES}\nSELECT value, status, id_a, id_b FROM gold_lines",
    "er_parse_status": f"WITH {_PRODUCTS},{_GOLD_LINES}\n" + _counts_sql("products", "products")
                       + "\nUNION ALL " + _counts_sql("gold_lines", "gold"),
    "er_tokens_no_stop": rf"""WITH {CORPUS_SQL},
lists AS (
  SELECT id, list_filter(regexp_split_to_array(lower(text), '\W+'),
    lambda x: x <> '' AND x NOT IN ({STOP_SQL})) AS tokens FROM corpus)
SELECT id, CAST(len(tokens) AS INTEGER) AS n, array_to_string(tokens, ' ') AS tokens FROM lists""",
    "er_token_count": _CORPUS + "\nSELECT count(*) AS n_tokens FROM kept",
    "er_biggest_record": _CORPUS + """
SELECT id, CAST(size AS INTEGER) AS n_tokens FROM sizes ORDER BY size DESC, id LIMIT 1""",
    "er_inverted_pairs": _CORPUS + "\nSELECT token, id FROM counted",
    "er_tf": _CORPUS + "\nSELECT id, token, round(tf, 6) AS tf FROM tf",
    "er_idf": _CORPUS + "\nSELECT token, round(idf, 6) AS idf FROM idf",
    "er_tfidf": _CORPUS + "\nSELECT id, token, round(weight, 6) AS weight FROM weights",
    "er_norms": _CORPUS + "\nSELECT id, round(norm, 6) AS norm FROM norms",
    "er_cosine_pairs": rf"""WITH turns AS (
  SELECT DISTINCT conv_id, turn, conv_id || ':' || turn AS id FROM conversations),
words AS (
  SELECT conv_id || ':' || turn AS id, unnest(regexp_split_to_array(lower(text), '\W+')) AS token
  FROM conversations),
counted AS (
  SELECT id, token, count(*) AS n FROM words
  WHERE token <> '' AND token NOT IN ({STOP_SQL}) GROUP BY id, token),
sizes AS (SELECT id, sum(n) AS size FROM counted GROUP BY id),
idf AS (
  SELECT token, (SELECT count(*) FROM turns) / CAST(count(*) AS DOUBLE) AS idf
  FROM counted GROUP BY token),
weights AS (
  SELECT id, token, n / CAST(size AS DOUBLE) * idf AS weight
  FROM counted JOIN sizes USING (id) JOIN idf USING (token)),
norms AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY id),
pairs AS (
  SELECT a.id AS id_a, b.id AS id_b FROM turns a
  JOIN turns b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
dots AS (
  SELECT p.id_a, sum(a.weight * b.weight) AS dot FROM pairs p
  JOIN weights a ON a.id = p.id_a JOIN weights b ON b.id = p.id_b AND b.token = a.token
  GROUP BY p.id_a)
SELECT p.id_a AS pair_id,
  round(CASE WHEN a.norm IS NULL OR b.norm IS NULL THEN NULL
    ELSE coalesce(dot, 0) / (a.norm * b.norm) END, 6) AS similarity
FROM pairs p LEFT JOIN dots USING (id_a)
LEFT JOIN norms a ON a.id = p.id_a LEFT JOIN norms b ON b.id = p.id_b""",
    "er_cosine_inverted": _CORPUS + f"\nSELECT * FROM sims WHERE {_BAR}",
    "er_cosine_brute": _CORPUS + """,
every AS (
  SELECT coalesce(sum(va.unit * vb.unit), 0) AS dot
  FROM documents d CROSS JOIN benchmark b
  LEFT JOIN va ON va.id_a = d.doc_id LEFT JOIN vb ON vb.id_b = b.item_id AND vb.token = va.token
  GROUP BY d.doc_id, b.item_id)
SELECT count(*) AS n_pairs, round(sum(dot), 6) AS sum_similarity,
  round(sum(dot) / count(*), 6) AS mean_similarity FROM every""",
    "er_overlapping_pairs": _CORPUS + "\nSELECT count(*) AS n_pairs FROM sims",
    "er_common_tokens": _CORPUS + f"""
SELECT id_a, id_b, count(*) AS n_common, string_agg(token, ' ' ORDER BY token) AS tokens
FROM sims JOIN va USING (id_a) JOIN vb USING (id_b, token) WHERE {_BAR} GROUP BY id_a, id_b""",
    "er_pair_lookup": _CORPUS + """,
pair AS (
  SELECT (SELECT CAST(substr(id, 2) AS BIGINT) FROM sizes WHERE id[1] = 'd'
          ORDER BY size DESC, CAST(substr(id, 2) AS BIGINT) LIMIT 1) AS id_a,
         (SELECT CAST(substr(id, 2) AS BIGINT) FROM sizes WHERE id[1] = 'b'
          ORDER BY size DESC, CAST(substr(id, 2) AS BIGINT) LIMIT 1) AS id_b)
SELECT id_a, id_b, coalesce(similarity, 0.0) AS similarity
FROM pair LEFT JOIN sims USING (id_a, id_b)""",
    "er_pair_key": _CORPUS + f"""
SELECT id_a || ' ' || id_b AS key, similarity FROM sims WHERE {_BAR}""",
    "er_true_dups": f"""{_CORPUS},{GOLD_SQL}
SELECT id_a, id_b, similarity FROM sims JOIN gold USING (id_a, id_b)""",
    "er_non_dups": f"""{_CORPUS},{GOLD_SQL}
SELECT id_a, id_b, similarity FROM sims ANTI JOIN gold USING (id_a, id_b) WHERE {_BAR}""",
    "er_avg_sims": f"""{_CORPUS},{GOLD_SQL},
every AS (
  SELECT d.doc_id AS id_a, b.item_id AS id_b, coalesce(sum(va.unit * vb.unit), 0) AS similarity
  FROM documents d CROSS JOIN benchmark b
  LEFT JOIN va ON va.id_a = d.doc_id LEFT JOIN vb ON vb.id_b = b.item_id AND vb.token = va.token
  GROUP BY d.doc_id, b.item_id)
SELECT count(*) FILTER (g.id_a IS NOT NULL) AS n_true,
  round(avg(similarity) FILTER (g.id_a IS NOT NULL), 6) AS mean_true,
  count(*) FILTER (g.id_a IS NULL) AS n_other,
  round(avg(similarity) FILTER (g.id_a IS NULL), 6) AS mean_other
FROM every e LEFT JOIN gold g USING (id_a, id_b)""",
    "er_gold_scores": f"{_CORPUS},{GOLD_SQL},{SCORES_SQL}\nSELECT * FROM scores",
    "er_histogram": _JUDGED + "SELECT bin, n_pairs, n_gold, n_false FROM histogram",
    "er_confusion": _JUDGED + "SELECT threshold, n_fp, n_fn, n_tp FROM confusion",
    "er_pr_curve": _JUDGED + """SELECT threshold, round(p, 6) AS precision, round(r, 6) AS recall,
  round(2 * r * p / nullif(r + p, 0), 6) AS f_measure FROM rates""",
}
