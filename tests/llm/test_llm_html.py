import llm_cases  # noqa: F401  (the shared cases' folder is on the path)
import numpy as np
import pytest

from harrow.llm import html

PAGE = """<!DOCTYPE html><html><head><title>Old mill</title><style>p{}</style>
<script>var t="</p>";track(1 < 2);</script></head><body class=home><nav><ul><li><a href="/a">Home</a></li>
<li><a href='/b>'>About us</a></ul></nav><!-- <p>not shown</p> --><div class="ad">Buy  now</div><article>
<h1>Old mill &amp; river</h1><p><b>The river runs
past&nbsp;the old mill.<br><p>It turns a wheel &lt;of oak&gt;.</p>{extra}</article>
<section class="comments"><p>Nice post</p></section><footer>&copy; someone</footer>"""


def test_blocks_of_a_page():
    blocks = html.page_blocks(PAGE)
    assert [(b[1], html.is_main(b[0])) for b in blocks] == [
        ("Old mill", False), ("Home", False), ("About us", False), ("Buy now", False),
        ("Old mill & river", True), ("The river runs past the old mill.", True),
        ("It turns a wheel <of oak>.", True), ("{extra}", True), ("Nice post", False),
        ("© someone", False)]
    assert blocks[1][0][-3:] == ("nav", "ul", "li") and blocks[1][2] == 4 and blocks[4][2] == 0
    assert ".home" in blocks[4][0]


@pytest.mark.parametrize("page, want", [
    (None, []), ("", []), ("<p>", []), ("text", ["text"]), ("<p>a<p class='x", ["a"]),
    ("a < b > c", ["a < b > c"]), ("<script>x", []), ("<p>a</div>b</p>c", ["a", "b", "c"]),
    ("<td>1<td>2<tr>3", ["1", "2", "3"]), ("<p title=\"a>b\">x</p>", ["x"]), ("<p title='>x</p>y", ["x", "y"]),
    ("&#0;&#x41;&bogus;", ["�A&bogus;"]), ("<!-- open <p>x", []), ("<DIV>A<BR/>b</DIV>", ["A b"]),
])
def test_odd_markup(page, want):
    assert [b[1] for b in html.page_blocks(page)] == want


@pytest.mark.parametrize("page, want", [
    ("<p>a<svg/>b</p><p>c", ["ab", "c"]), ("<svg viewBox='0 />' /><p>a", ["a"]),
    ("<SVG class=x /><p>a</p><svg><text>no</text></svg><p>b", ["a", "b"]),
    ("<svg a=\"x\"/><p>a", ["a"]), ("<svg a=x/>no</svg><p>a", ["a"]), ("<svg a=/b/>no</svg>c", ["c"]),
    ("<svg viewBox='/>'>no</svg>c", ["c"]), ("<script src=x />no</script>c", ["c"]),
    ("<p>for <math><mi>x</mi><mo>=</mo><mn>2</mn></math> it is<math/> so", ["for x=2 it is so"]),
])
def test_foreign_elements(page, want):
    assert [b[1] for b in html.page_blocks(page)] == want


def test_long_pages_take_time_in_proportion():
    assert len(html.page_blocks("<p>x" * 50_000)) == 50_000
    assert html.page_blocks("<" * 200_000 + "\"'" * 50_000)[0][1].startswith("<<")


def test_slopes_equal_differences():
    rng = np.random.default_rng(2)
    pages = [(html.page_blocks(PAGE)[:n], [bool(i % 2) for i in range(n)]) for n in (4, 1, 6)]
    model = html.train([])
    model.weights = [rng.normal(size=w.shape).astype(np.float64) * 0.3 for w in model.weights]
    table = np.concatenate([html.features([p]) for p, _ in pages]).astype(np.float64)
    lengths = [len(x) for _, x in pages]
    labels = np.concatenate([x for _, x in pages]).astype(float)

    def likelihood():
        p = html._sigmoid(model.logits(table, lengths).astype(np.float64))
        return np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    slopes = model.slopes(table, lengths, labels)
    for k, w in enumerate(model.weights):
        for place in {tuple(int(rng.integers(0, n)) for n in w.shape) for _ in range(6)}:
            kept, step = w[place], 1e-3
            w[place] = kept + step
            up = likelihood()
            w[place] = kept - step
            down = likelihood()
            w[place] = kept
            assert slopes[k][place] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_directions_and_batches_agree():
    model = html.train([])
    pages = [html.page_blocks(PAGE), html.page_blocks("<p>alone</p>"), html.page_blocks(PAGE)[:3]]
    together = model.logits(html.features(pages), [len(p) for p in pages])
    alone = np.concatenate([model.logits(html.features([p]), [len(p)]) for p in pages])
    assert together == pytest.approx(alone, abs=1e-5)


def test_learned_on_given_pages(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    model = html.learn_layout(given)
    main = [PAGE.replace("{extra}", e) for e in ("", "<p>It is old &amp; made of stone.</p>")]
    odd = ("<body><div class='cookie-notice'>We use cookies</div><main><p>The old mill stands by the "
           "river.</p><p>Its wheel is made of oak.</p></main><div class=sidebar><p>Read more</p></div>"
           "<form><p>Your name</p></form></body>")
    pages = spark.createDataFrame([(0, main[0], "x"), (1, main[1], "x"), (2, odd, "x"), (3, None, "x"),
                                   (4, "", "x"), (0, main[0], "x")], "page_id int, html string, text string")
    found = html.extract_text(pages, model)
    assert found.columns == ["page_id", "html", "text", "n_chars"]
    got = sorted((r.page_id, r.text, r.n_chars) for r in found.collect())
    text = "Old mill & river\nThe river runs past the old mill.\nIt turns a wheel <of oak>."
    longer = text + "\nIt is old & made of stone."
    plain = "The old mill stands by the river.\nIts wheel is made of oak."
    assert got == [(0, text, len(text))] * 2 + [(1, longer, len(longer)), (2, plain, len(plain)),
                                                (3, "", 0), (4, "", 0)]
    assert html.extract_text(pages.limit(0), model).count() == 0

    right = 0
    for r in html.extract_text(given, model).collect():
        blocks = html.page_blocks(r.html)
        right += r.text == "\n".join(b[1] for b in blocks if "article" in b[0])
    assert right == given.count()


def test_without_pages(spark):
    none = spark.createDataFrame([(1, None)], "page_id int, html string")
    assert html.extract_text(none, html.learn_layout(none)).first().text == ""


def test_long_pages_train_in_runs_with_whole_texts(spark, monkeypatch):
    n = 2 * html.TRAINING_BLOCKS + 7
    page = "<body>" + "".join(f"<p>{'word ' * 900}{i}</p>" for i in range(n)) + "</body>"
    given = spark.createDataFrame([(page,), (page,), (None,), ("",)], "html string")
    seen = []
    monkeypatch.setattr(html, "TRAINING_PAGES", 100)
    monkeypatch.setattr(html, "LAYOUTS", 0)
    monkeypatch.setattr(html, "train", seen.extend)
    html.learn_layout(given)
    assert sorted(len(blocks) for blocks, _ in seen) == [7] + [html.TRAINING_BLOCKS] * 2
    assert sorted(text for blocks, _ in seen for _, text, _ in blocks) == sorted(
        f"{'word ' * 900}{i}" for i in range(n))
