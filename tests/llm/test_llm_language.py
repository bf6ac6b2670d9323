import math
import sys
from collections import Counter

import llm_cases
import numpy as np
import pytest
from conftest import rows

from harrow.llm import language

PIECES = ["a", "ab", "b", "ba", "▁", "▁a", "▁ab", "▁b"]


def model():
    rng = np.random.default_rng(1)
    p = rng.random((len(PIECES), 2))
    return language.LanguageModel(["x", "y"], PIECES, p / p.sum(axis=0))


def every_segmentation(word, m, column):
    """The sum over all ways of cutting the word, one by one."""
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        piece = word[:n]
        if piece in m.pieces:
            p = m.probabilities[m.pieces.index(piece), column]
        else:
            p = language.UNKNOWN if n == 1 else 0.0
        total += p * every_segmentation(word[n:], m, column)
    return total


def test_forward_equals_a_sum_over_all_segmentations():
    m = model()
    words = ["▁a", "▁ab", "▁abba", "▁bbab", "abab", "▁aéb", "▁" + "ab" * 8]
    scores = m.word_scores(words)
    for w, own in zip(words, scores, strict=True):
        for k in range(2):
            assert own[k] == pytest.approx(math.log(every_segmentation(w, m, k)))


def test_text_score_is_the_posterior_of_its_words():
    m = model()
    texts = ["ab ba", "AB, ab!", None, "", "12 !!", "é", "²½", "a²"]
    names, scores = m.score(texts)
    for text, name, score in zip(texts, names, scores, strict=True):
        words = language.text_words(text)
        if not words:
            assert (name, score) == ("und", 0.0)
            continue
        own = [math.prod(every_segmentation(w, m, k) for w in words) for k in range(2)]
        assert name == m.languages[int(np.argmax(own))]
        assert score == pytest.approx(max(own) / sum(own))
    assert m.score(texts) == (names, scores)  # again, from the words remembered


def test_a_full_memory_is_emptied(monkeypatch):
    m, fresh = model(), model()
    monkeypatch.setattr(language, "CACHED_BYTES", 300)
    for text in ("ab ba", "abab", "ab ba", "a b ab ba abab bb"):
        assert m.score([text]) == fresh.score([text])
    assert len(m._known) <= 6 and len(m._table) <= 6


def test_few_texts_at_a_time(monkeypatch):
    texts = ["ab ba", None, "abab " * 9, "b", "", "a" * 30, "ba"]
    want = model().score(texts)
    monkeypatch.setattr(language, "TEXT_CHARS", 10)
    assert model().score(texts) == want


def test_pieces_are_not_looked_up_one_by_one():
    rng = np.random.default_rng(3)
    words = ["▁" + "".join(rng.choice(list("abé"), 12)) for _ in range(200)]
    m, calls = model(), []
    m.word_scores(words[:1])
    sys.setprofile(lambda frame, event, called: calls.append(called) if event == "c_call" else None)
    try:
        m.word_scores(words)
    finally:
        sys.setprofile(None)
    assert len(calls) < 2 * len(words)  # of 200 * 13 * 3 / 2 stretches and more
    for first, last in ((1, 13), (5, 9), (13, 13)):
        found = m._lattice(words, first, last)
        for w, own in zip(words, found, strict=True):
            for end in range(first, last + 1):
                want = [w[end - n:end] if n <= end else "" for n in range(1, own.shape[1] + 1)]
                assert [PIECES.index(p) + 1 if p in PIECES else 0 for p in want] == list(own[end - first])


def forward_by_logs(word, m, column):
    """The sum over all ways of cutting, end by end and in logarithms."""
    logs = [0.0]
    for end in range(1, len(word) + 1):
        parts = []
        for start in range(end):
            piece = word[start:end]
            if piece in m.pieces:
                parts.append(logs[start] + math.log(m.probabilities[m.pieces.index(piece), column]))
            elif len(piece) == 1:
                parts.append(logs[start] + math.log(language.UNKNOWN))
        logs.append(np.logaddexp.reduce(parts))
    return logs[-1]


@pytest.mark.parametrize("window", [1, 5, 16, 2048])
def test_long_runs_are_scored_whole(monkeypatch, window):
    monkeypatch.setattr(language, "WINDOW", window)
    run = "abéab" * 300
    assert language.text_words(run + " ab") == ["▁" + run, "▁ab"]
    m = model()
    scores = m.word_scores(["▁" + run, "▁ab"])
    for k in range(2):
        assert scores[0, k] == pytest.approx(forward_by_logs("▁" + run, m, k), rel=1e-12)
        assert scores[0, k] < -1000  # far below the smallest double


@pytest.mark.parametrize("window", [1, 5, 2048])
def test_uses_of_pieces_in_long_words(monkeypatch, window):
    """The derivative of the logarithm of a word's probability, by small steps."""
    monkeypatch.setattr(language, "WINDOW", window)
    m, words = model(), ["▁" + "abaéb" * 40, "▁ab", "▁bab"]
    uses = language.expected_uses(m, words, np.array([0, 1, 0]), np.array([2.0, 3.0, 1.0]))
    for i in range(len(PIECES)):
        for k, own in ((0, [(words[0], 2), (words[2], 1)]), (1, [(words[1], 3)])):
            logs = []
            for step in (1e-6, -1e-6):
                p = m.probabilities.copy()
                p[i, k] *= math.exp(step)
                moved = language.LanguageModel(m.languages, PIECES, p)
                logs.append(sum(n * forward_by_logs(w, moved, k) for w, n in own))
            assert uses[i, k] == pytest.approx((logs[0] - logs[1]) / 2e-6, abs=1e-4)


def test_all_pieces_of_the_vocabulary_are_kept():
    import public_tokenizers
    import sentencepiece
    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    kept = {own.id_to_piece(i).lower() for i in range(own.get_piece_size())
            if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i))}
    assert set(language.vocabulary()) == kept - {""}


def test_copies_of_a_text_train_once(spark):
    texts = [("x", "abc abd")] * 500 + [("x", "fgh"), ("y", "klm")]
    one = [("x", "abc abd"), ("x", "fgh"), ("y", "klm")]
    many, few = (language.learn_languages(spark.createDataFrame(t, "lang string, text string"))
                 for t in (texts, one))
    assert np.allclose(many.probabilities, few.probabilities)


def test_training_raises_the_likelihood():
    counts = [("x", "▁abab", 9), ("x", "▁ab", 4), ("y", "▁bbb", 7), ("y", "▁ba", 3), ("x", "▁ba", 1)]

    def likelihood(m):
        return sum(n * m.word_scores([w])[0, m.languages.index(lang)] for lang, w, n in counts)

    steps = [likelihood(language.train(counts, PIECES, rounds)) for rounds in range(5)]
    assert all(b >= a - 1e-6 for a, b in zip(steps[:2], steps[1:3], strict=True))
    assert steps[-1] > steps[0]


def test_every_word_of_the_sample_trains(spark):
    rng = np.random.default_rng(3)
    common = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(17_000)]
    own = ["".join(rng.choice(list("opqrstuv"), 6)) for _ in range(60)]
    texts = [("x", " ".join(common[i:i + 100] * 2)) for i in range(0, len(common), 100)]
    texts += [("y", " ".join(own[i:i + 20])) for i in range(0, len(own), 20)]
    found = language.learn_languages(spark.createDataFrame(texts, "lang string, text string"))
    counts = Counter((lang, w) for lang, text in texts for w in language.text_words(text))
    want = language.train([(*k, n) for k, n in sorted(counts.items())], found.pieces)
    assert found.languages == want.languages == ["x", "y"]
    assert np.allclose(found.probabilities, want.probabilities, rtol=1e-4)
    assert found.probabilities[:, 1].max() > 2 * found.probabilities[:, 1].min()


def test_predictions_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language.op10_language_id(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = found.join(docs, "doc_id").filter("held_out").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    want = docs.selectExpr("doc_id", "crc32(string(doc_id)) % 4 = 2")
    assert rows(found, "doc_id", "held_out") == rows(want)


def test_rows_of_all_kinds(spark):
    docs = llm_cases.documents(spark, ["the mill by the river", "die Mühle am Fluss"]).withColumnRenamed(
        "source", "lang_pred")
    got = language.identify(docs, language.learn_languages(docs))
    assert got.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score"]
    got = got.collect()
    assert len(got) == docs.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred, r.score > 0) == (("en", True) if letters else ("und", False))
    none = llm_cases.empty(spark)
    nothing = language.learn_languages(none)
    assert language.identify(none, nothing).count() == 0
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
