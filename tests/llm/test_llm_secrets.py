import hashlib
import random
import re
import zlib

import llm_cases
from conftest import rows

from harrow.llm import secrets

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)")


def plain(text):
    """The base kinds by the definitions, on the text itself."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(s, e, secrets.KINDS[k]) for s, k, e in sorted(found)]


def test_base_kinds_equal_plain_expressions():
    rng = random.Random(1)
    parts = ["token", "Secret", "PASSWD", "password", "api_key", "ApiKey", "apikey", "=", ": ", " ", '"',
             "'", "abcdef0123456789", "AKIA", "akia", "A" * 16, "0" * 15, "é", "ſ", "K", "x.y/z+", "\n",
             "😀", "tokentoken=aaaaaaaaaaaa", "token: token: abcdefghijklmnop"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        got = [x for x in secrets.find_secrets(text) if x[2] in secrets.KINDS[:3]]
        assert got == plain(text), text


def test_tokens_with_a_checksum():
    payload = "Zz0123456789ghijklmnopABCDEFGH"
    digits, rest = "", zlib.crc32(payload.encode())
    while rest:
        rest, d = divmod(rest, 62)
        digits = secrets.BASE_62[d] + digits
    good = payload + digits.rjust(6, "0")
    assert secrets.find_secrets(f"é ghp_{good} end") == [(2, 42, "github")]
    assert secrets.find_secrets(f"npm_{good}")[-1] == (0, 40, "npm")
    wrong = good[:-1] + ("0" if good[-1] != "0" else "1")
    for text in (f"ghp_{wrong}", f"GHP_{good}", f"ghp_{good}x", f"ghp_{good[:-1]}"):
        assert not [x for x in secrets.find_secrets(text) if x[2] == "github"], text


def test_redaction_joins_overlaps():
    text = 'say token = "0123456789abcdef" twice'
    spans = secrets.find_secrets(text)
    assert [k for *_, k in spans] == ["assign", "hex"]
    assert secrets.redact(text, spans) == 'say [secret]" twice'
    assert secrets.redact(None, []) is None


def test_rows_of_all_kinds(spark):
    docs = llm_cases.documents(spark, ["key: token=abcdefghijkl"]).withColumnRenamed("score", "secrets")
    found = secrets.scan_secrets(docs)
    assert found.columns == [*[c for c in docs.columns if c != "secrets"], "secrets", "redacted"]
    got = found.collect()
    assert len(got) == docs.count()
    for r in got:
        want = plain(r.text) if r.text else []
        assert [(s.start, s.end, s.kind) for s in r.secrets] == want
        assert r.redacted == secrets.redact(r.text, want)
    assert sum(len(r.secrets) for r in got) == 3  # the row and its two repeats
    assert secrets.scan_secrets(llm_cases.empty(spark)).count() == 0


def test_query(spark, tmp_path):
    docs = llm_cases.documents(spark, ["é token=abcdefghijkl 0123456789abcdef AKIA" + "B" * 14])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = rows(secrets.op1_secret_scan(spark, str(tmp_path)).filter("doc_id = 0").distinct())
    base = "assign:2:20,hex:21:37,access:38:56"
    assert got == [(0, 1, 1, 1, hashlib.sha256(base.encode()).hexdigest(), base)]
