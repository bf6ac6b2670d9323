"""Secret scan: keywords by automaton, anchored expressions at their hits, checksums.

One Aho-Corasick automaton finds the keywords of all kinds in a single pass over the
text; an expression is tried only where one of its keywords stands, and tokens that
carry a checksum count only if it agrees.  Runs of hexadecimal digits have no
keyword and are found by their own expression.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.batches import add_columns

# The kinds, their keywords and expressions.  The first three are the
# base kinds.  The other two are public token formats: 30 characters, then six of the
# CRC-32 of these in base 62.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = 3
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
EXPRESSIONS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                         r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII),
    "access": re.compile(r"(AKIA)([A-Z0-9]+)"),
    "hex": re.compile(r"[0-9a-f]{16,}"),
    "github": re.compile(r"(gh[pousr]_)([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"(npm_)([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
}
BASE_62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_62(payload: str) -> str:
    """The CRC-32 of ASCII characters as six digits in base 62."""
    rest, digits = zlib.crc32(payload.encode("ascii")), ""
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits = BASE_62[digit] + digits
    return digits


def _valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= 12
    if kind == "access":
        return len(match[0]) >= 18
    return checksum_62(match[2][:30]) == match[2][30:]


@cache
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, keywords in KEYWORDS.items():
        for keyword in keywords:
            automaton.add_word(keyword, (kind, len(keyword)))
    automaton.make_automaton()
    return automaton


def find_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind.

    Matches of a kind are leftmost and do not overlap; a match that fails its length
    or checksum still uses up its characters.
    """
    if not text:
        return []
    raw = text.encode("utf-8")
    # One character per byte: all patterns are ASCII, and lower() then keeps lengths.
    shown = text if len(raw) == len(text) else raw.decode("latin-1")
    lowered = raw.lower().decode("latin-1")
    hits: dict[str, list[int]] = {}
    for last, (kind, length) in _automaton().iter(lowered):
        hits.setdefault(kind, []).append(last - length + 1)
    found = [(m.start(), m.end(), "hex") for m in EXPRESSIONS["hex"].finditer(shown)]
    for kind, starts in hits.items():
        free = 0
        for start in sorted(starts):
            if start >= free and (match := EXPRESSIONS[kind].match(shown, start)):
                free = match.end()
                if _valid(kind, match):
                    found.append((start, free, kind))
    if len(raw) != len(text) and found:
        places, at, n = {}, 0, 0
        for place in sorted({x for start, end, _ in found for x in (start, end)}):
            n += len(raw[at:place].decode("utf-8"))
            places[place], at = n, place
        found = [(places[start], places[end], kind) for start, end, kind in found]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with every span, or run of overlapping spans, replaced by ``[secret]``."""
    if not spans:
        return text
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _scan(batch: pa.RecordBatch) -> list:
    texts = batch.column("text").to_pylist()
    found = [find_secrets(text) for text in texts]
    spans = [[{"kind": k, "start": s, "end": e} for s, e, k in own] for own in found]
    return [spans, [redact(text, own) for text, own in zip(texts, found, strict=True)]]


SPANS = "array<struct<kind: string, start: int, end: int>>"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``secrets`` (its spans) and ``redacted`` (the text without them).

    Needs a column ``text``; columns of these two names are replaced.  A null or
    empty text has no spans and stays as it is.  Repeated rows give repeated results.
    """
    docs = docs.drop("secrets", "redacted")
    return add_columns(docs, _scan, f"secrets {SPANS}, redacted string", docs.columns)


def _digests(batch: pa.RecordBatch) -> list:
    columns = [[] for _ in range(5)]
    for text in batch.column("text").to_pylist():
        found = find_secrets(text)
        shown = [(f"{kind}:{start}:{end}", kind) for start, end, kind in found]
        base = ",".join(x for x, kind in shown if kind in KINDS[:BASE_KINDS])
        kinds = [kind for _, kind in shown]
        row = [*(kinds.count(k) for k in KINDS[:BASE_KINDS]),
               hashlib.sha256(base.encode()).hexdigest(), ",".join(x for x, _ in shown)]
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    return columns


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts, digest of the base spans, all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    return add_columns(docs, _digests, "n_assign long, n_access long, n_hex long, "
                       "base_sha256 string, spans string", ["doc_id"])


# A match starts after the pieces between matches, and the matches, that precede it.
_SECRET = "(?i:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?"
_SQL_KINDS = (("assign", _SECRET + "[A-Za-z0-9+/_.=-]+"), ("access", "AKIA[A-Z0-9]+"),
              ("hex", "[0-9a-f]+"), ("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
              ("npm", "npm_[A-Za-z0-9]{36,}"))
_SPLIT = " UNION ALL ".join(
    f"""SELECT r, '{kind}' AS kind, {rank} AS rank, unnest(regexp_extract_all(t, '{p}')) AS shown,
    unnest(regexp_split_to_array(t, '{p}')) AS gap,
    generate_subscripts(regexp_split_to_array(t, '{p}'), 1) AS i FROM docs"""
    for rank, (kind, p) in enumerate(_SQL_KINDS))
# The bits of the CRC-32 one by one: 1000 + byte is added in, 0 is a step.
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(range(5, 35),
    lambda i: [1000 + ascii(substr(shown, i::INT, 1)), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[])),
    lambda c, d: CASE WHEN d >= 1000 THEN xor(c, d - 1000)
                      ELSE xor(c // 2, (c % 2) * 3988292384) END))"""
_DIGITS = " || ".join(f"substr('{BASE_62}', (crc // {62 ** (5 - i)} % 62 + 1)::INT, 1)"
                      for i in range(6))
ORACLE_SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS ({_SPLIT}),
placed AS (SELECT *, sum(length(gap) + coalesce(length(shown), 0))
      OVER (PARTITION BY r, rank ORDER BY i) - coalesce(length(shown), 0) AS start FROM split),
summed AS (SELECT *, CASE WHEN rank >= 3 THEN {_CRC} END AS crc FROM placed
  WHERE shown IS NOT NULL),
spans AS (SELECT r, rank, kind, start, kind || ':' || start || ':' || (start + length(shown)) AS span
  FROM summed WHERE CASE rank
    WHEN 0 THEN length(regexp_replace(shown, '^{_SECRET}', '')) >= 12
    WHEN 1 THEN length(shown) >= 18 WHEN 2 THEN length(shown) >= 16
    ELSE {_DIGITS} = substr(shown, 35) END)
SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
  count(*) FILTER (rank = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3), ''))
    AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM docs LEFT JOIN spans USING (r) GROUP BY r, doc_id
"""

QUERIES = {"op1_secret_scan": op1_secret_scan}
ORACLE = {"op1_secret_scan": ORACLE_SECRETS}
