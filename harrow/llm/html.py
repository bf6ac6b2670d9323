"""HTML main-text extraction: a recurrent labeller of a page's blocks.

A page is read as a sequence of blocks, each with the path of elements it stands in and
its text.  A bidirectional LSTM reads vectors of hashed path and word features and
labels every block as main text or not, with the whole page as context.  It is trained
on a bounded sample of pages, whose blocks are labelled by the meaning of their
elements, and on the same blocks set into other page layouts.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.batches import Hashes, add_columns, chunks, words

TRAINING_PAGES = 200   # pages that train, about; a bounded sample
TRAINING_BLOCKS = 80   # blocks that train together; a longer page is several runs of them
LAYOUTS = 1_200        # other layouts that the training pages are set into, about
PATH_WIDTH, LAST_WIDTH, WORD_WIDTH, HIDDEN = 224, 32, 32, 16
STEPS, BATCH, RATE = 600, 32, 0.01
KEEP_FROM = -2.0       # a block is kept unless it is fairly sure not to be main text
WIDTH = PATH_WIDTH + LAST_WIDTH + WORD_WIDTH + 6

# Elements that end a run of text, elements without text of the page,
# and names (of elements, classes or ids) that mark what is not main text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe "
    "legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "textarea tfoot th thead title tr ul".split())
SILENT = frozenset("script style template noscript svg object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDES = frozenset(
    "ad ads advert advertisement alert aside banner breadcrumb breadcrumbs button comment comments "
    "consent cookie cookies dialog disclaimer disqus footer form head header login menu modal nav "
    "navbar navigation newsletter notice notification overlay pagination popup promo promoted "
    "recommended related replies reply reviews search select share sharing sidebar signup skip "
    "social sponsor sponsored subscribe tags textarea title toc toolbar widget".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
              "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # Only an svg may end in its own tag, unless the slash belongs to a bare value.
    r"|<(?!svg\b(?:=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)|[^>\"'=/]|\"[^\"]*\"|'[^']*'|/(?!>))*+/>)"
    r"(?P<silent>script|style|template|noscript|svg|object)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    r".*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*\Z", re.IGNORECASE | re.DOTALL)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")


def page_blocks(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters inside links) of every block with text, in page order.

    Path entries are element names, followed by the words of class, id and role after a
    dot.  Character references are decoded and white space is one space.
    """
    blocks, stack, parts = [], [], []
    linked, link = 0, False

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            blocks.append((tuple(x for entry in stack for x in entry[1]), text,
                           min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(names: set[str], below: int = 0) -> None:
        for i in range(len(stack) - 1, below - 1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return

    at, page = 0, page or ""
    for tag in _TAG.finditer(page):
        if tag.start() > at:
            parts.append(page[at:tag.start()])
            linked += (tag.start() - at) * link
        at = tag.end()
        name = (tag["name"] or "").lower()
        if name == "a":
            link = not tag["end"]
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            flush()
            if tag["end"]:
                close({name})
            else:
                if name not in ("option",):
                    close({"p"}, max((i for i, e in enumerate(stack) if e[0] in ("td", "div", "article")),
                                     default=0))
                lists = max((i for i, e in enumerate(stack) if e[0] in ("ul", "ol", "dl", "table")),
                            default=0)
                close(_CLOSED_BY.get(name, set()), lists)
                if name not in VOID:
                    named = " ".join("".join(m) for m in _NAMES.findall(tag["rest"] or ""))
                    marks = ["." + w for w in _PART.findall(named.lower())]
                    stack.append((name, [name, *marks]))
    parts.append(page[at:])
    flush()
    return blocks


def is_main(path: tuple[str, ...]) -> bool:
    """Whether no element around a block says that it is something beside the main text."""
    return not any(x.lstrip(".") in ASIDES for x in path)


def features(pages: list[list[tuple[tuple[str, ...], str, int]]]) -> np.ndarray:
    """A row per block, page after page: hashed path, hashed words and a few numbers."""
    blocks = [b for page in pages for b in page]
    table = np.zeros((len(blocks), WIDTH), np.float32)
    words_at = PATH_WIDTH + LAST_WIDTH
    known: dict[tuple, np.ndarray] = {}
    for i, (path, _, _) in enumerate(blocks):
        if path not in known:
            places = [zlib.crc32(x.encode()) % PATH_WIDTH for x in path]
            last = [PATH_WIDTH + zlib.crc32(path[-1].encode()) % LAST_WIDTH] if path else []
            known[path] = np.array(places + last, np.int64)
        table[i, known[path]] = 1
    separator = np.ones(256, bool)
    separator[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
    numbers = table[:, words_at + WORD_WIDTH:]
    for first, data, offsets in chunks(pa.array([b[1] for b in blocks], pa.large_string())):
        starts, ends, texts = words(separator, data, offsets)
        n = len(offsets) - 1
        place = (Hashes(data)(starts, ends) % np.uint64(WORD_WIDTH)).astype(np.int64)
        found = np.bincount(texts * WORD_WIDTH + place, minlength=n * WORD_WIDTH)
        count = np.bincount(texts, minlength=n)
        own = slice(first, first + n)
        table[own, words_at:words_at + WORD_WIDTH] = (
            found.reshape(n, WORD_WIDTH) / np.maximum(count, 1)[:, None])
        numbers[own, 0] = np.log1p(count) / 5
    sizes = np.array([len(b[1]) for b in blocks])
    numbers[:, 1] = np.log1p(sizes) / 8
    numbers[:, 2] = np.array([b[2] for b in blocks]) / np.maximum(sizes, 1)
    numbers[:, 3] = [b[1][-1] in ".!?" for b in blocks]
    places = np.concatenate([np.arange(len(p)) / max(len(p), 1) for p in pages] or [[]])
    numbers[:, 4] = places
    numbers[:, 5] = 1
    return table


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _index(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of padded sequences [time, sequence], forwards and backwards; padding is the last row."""
    total, steps = sum(lengths), max(lengths, default=0)
    ahead = np.full((steps, len(lengths)), total)
    back = ahead.copy()
    start = 0
    for i, n in enumerate(lengths):
        ahead[:n, i] = np.arange(start, start + n)
        back[:n, i] = np.arange(start + n - 1, start - 1, -1)
        start += n
    return ahead, back


def _run(inputs: np.ndarray, index: np.ndarray, again: np.ndarray) -> tuple:
    """States of one LSTM over padded sequences; ``inputs`` has one row more, for padding."""
    steps, n = index.shape
    size = again.shape[0]
    h, c = np.zeros((2, n, size), np.float32)
    states, gates, cells = [], [], []
    for t in range(steps):
        z = inputs[index[t]] + h @ again
        gate = _sigmoid(z[:, :3 * size])
        fresh = np.tanh(z[:, 3 * size:])
        cells.append(c)
        c = gate[:, size:2 * size] * c + gate[:, :size] * fresh
        gates.append((gate, fresh, c, h))
        h = gate[:, 2 * size:] * np.tanh(c)
        states.append(h)
    return states, gates, cells


def _run_back(slopes: np.ndarray, index: np.ndarray, again: np.ndarray, gates: list,
              cells: list, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the inputs and of the recurrent weights, given those of the states."""
    size = again.shape[0]
    inputs = np.zeros((rows + 1, 4 * size), np.float32)
    weights = np.zeros_like(again)
    dh, dc = np.zeros((2, index.shape[1], size), np.float32)
    for t in range(index.shape[0] - 1, -1, -1):
        gate, fresh, c, h = gates[t]
        i, f, o = gate[:, :size], gate[:, size:2 * size], gate[:, 2 * size:]
        dh = dh + slopes[index[t]]
        bent = np.tanh(c)
        dc = dc + dh * o * (1 - bent * bent)
        dz = np.concatenate([dc * fresh * i * (1 - i), dc * cells[t] * f * (1 - f),
                             dh * bent * o * (1 - o), dc * i * (1 - fresh * fresh)], 1)
        dz[index[t] == rows] = 0
        inputs[index[t]] = dz
        weights += h.T @ dz
        dh, dc = dz @ again.T, dc * f
    return inputs[:rows], weights


@dataclass
class BlockLabeller:
    """Weights of both directions (input, recurrent) and of the output."""

    weights: list[np.ndarray]

    def logits(self, table: np.ndarray, lengths: list[int], keep: list | None = None) -> np.ndarray:
        """One number per block: the log-odds that it is main text."""
        rows = len(table)
        out = np.full(rows, self.weights[5][0], np.float32)
        for k, index in enumerate(_index(lengths)):
            enter, again, leave = self.weights[2 * k], self.weights[2 * k + 1], self.weights[4]
            inputs = np.vstack([table @ enter, np.zeros((1, enter.shape[1]), np.float32)])
            states, gates, cells = _run(inputs, index, again)
            hidden = np.zeros((rows + 1, again.shape[0]), np.float32)
            for t, state in enumerate(states):
                hidden[index[t]] = state
            out += hidden[:rows] @ leave[k]
            if keep is not None:
                keep.append((index, gates, cells, hidden[:rows]))
        return out

    def slopes(self, table: np.ndarray, lengths: list[int], labels: np.ndarray) -> list[np.ndarray]:
        """Slopes of the mean log-likelihood with respect to all weights."""
        keep: list = []
        error = ((labels - _sigmoid(self.logits(table, lengths, keep))) / len(labels)).astype(np.float32)
        found, leave = [], np.zeros_like(self.weights[4])
        for k, (index, gates, cells, hidden) in enumerate(keep):
            back = np.vstack([error[:, None] * self.weights[4][k],
                              np.zeros((1, hidden.shape[1]), np.float32)])
            inputs, again = _run_back(back, index, self.weights[2 * k + 1], gates, cells, len(table))
            found += [table.T @ inputs, again]
            leave[k] = hidden.T @ error
        return [*found, leave, np.array([error.sum()], np.float32)]


def train(pages: list[tuple[list, list[bool]]]) -> BlockLabeller:
    """A labeller fitted to (blocks, whether each is main text) by stochastic gradient steps."""
    rng = np.random.default_rng(7)

    def start(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.1).astype(np.float32)

    model = BlockLabeller([start(WIDTH, 4 * HIDDEN), start(HIDDEN, 4 * HIDDEN),
                           start(WIDTH, 4 * HIDDEN), start(HIDDEN, 4 * HIDDEN),
                           start(2, HIDDEN), start(1)])
    tables = [features([blocks]) for blocks, _ in pages]
    labels = [np.array(own, np.float32) for _, own in pages]
    m1 = [np.zeros_like(w) for w in model.weights]
    m2 = [np.zeros_like(w) for w in model.weights]
    order = np.zeros(0, np.int64)
    for step in range(1, STEPS + 1 if pages else 1):
        if len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(pages))])
        part, order = order[:BATCH], order[BATCH:]
        found = model.slopes(np.concatenate([tables[i] for i in part]),
                             [len(labels[i]) for i in part],
                             np.concatenate([labels[i] for i in part]))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, slope in enumerate(found):
            m1[k] = 0.9 * m1[k] + 0.1 * slope
            m2[k] = 0.99 * m2[k] + 0.01 * slope * slope
            model.weights[k] = model.weights[k] + rate * (m1[k] / (1 - 0.9 ** step)) / (
                np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
    return model


# Containers of main text and of other text, as paths below the body.
_MAIN = ("article", "main", "main article", "div .content", "div .main", "div .post", "section",
         "div .page div .content", "div .entry", "article div .body", "")
_TEXT = ("p", "p", "p", "h1", "h2", "div", "ul li", "ol li", "blockquote", "pre", "")
_OTHER = ("header", "nav ul li", "div .menu ul li", "aside", "div .sidebar", "div .sidebar ul li",
          "footer", "div .footer", "div .ad", "div .ads", "div .banner", "div .promo", "form",
          "form .search", "div .cookie .notice", "div .notice", "div .alert", "div .newsletter form",
          "section .comments", "div .comments div .comment", "ol .comments li", "div .related ul li",
          "div .share", "div .social", "dialog", "div .popup", "div .login form", "div .breadcrumbs")


def other_layout(blocks: list, labels: list[bool], rng: np.random.Generator) -> tuple[list, list[bool]]:
    """The blocks of a page in another layout: other containers, and texts beside the main one."""
    main = [b for b, good in zip(blocks, labels, strict=True) if good]
    around = str(rng.choice(_MAIN)).split()
    root = (("html", "body"), ("html", "body"), ("body",), ())[int(rng.integers(0, 4))]
    first = int(rng.integers(0, max(len(main), 1)))
    kept = main[first:first + int(rng.integers(1, 12))] if rng.random() < 0.5 else main
    # Some texts change places, so that the path has to tell.
    kept = [blocks[int(rng.integers(0, len(blocks)))] if rng.random() < 0.2 else b for b in kept]
    inner = [((*root, *around, *str(rng.choice(_TEXT)).split()), b[1], b[2]) for b in kept]
    found: list = [inner]
    for _ in range(int(rng.integers(1, 6))):
        where = str(rng.choice(_OTHER)).split()
        n = int(rng.integers(1, 6))
        borrowed = [blocks[int(i)] for i in rng.integers(0, len(blocks), n)]
        outer = (*root, *(around if rng.random() < 0.3 else ()), *where)
        tail = ("p",) if rng.random() < 0.5 else ()
        beside = [((*outer, *tail), b[1], len(b[1]) if where[-1] == "li" else 0) for b in borrowed]
        found.insert(int(rng.integers(0, len(found) + 1)), beside)
    title = [b for b in blocks if "title" in b[0]]
    ordered = [*title, *(b for part in found for b in part)]
    inside = {id(b) for b in inner}
    return ordered, [id(b) in inside for b in ordered]


def learn_layout(pages: DataFrame) -> BlockLabeller:
    """A labeller learned from a bounded sample of ``html``, picked by its hash.

    About TRAINING_PAGES different pages are cut into runs of up to TRAINING_BLOCKS blocks,
    and at most twice as many runs train, those with the smallest hashes.  Without any page
    the labeller learns from nothing and keeps its start.
    """
    texts = pages.select("html").dropna()
    place = F.pmod(F.xxhash64("html"), F.lit(1_000_000)) / 1_000_000.0
    sample = (texts.filter(place < TRAINING_PAGES / max(texts.count(), 1)).distinct()
              .orderBy(place, "html").limit(2 * TRAINING_PAGES))

    def work(batch: pa.RecordBatch) -> list[list]:
        return [[[[{"path": list(p), "text": t, "linked": n} for p, t, n in
                   blocks[a:a + TRAINING_BLOCKS]] for a in range(0, len(blocks), TRAINING_BLOCKS)]
                 for blocks in map(page_blocks, batch.column("html").to_pylist())]]

    kind = "runs array<array<struct<path: array<string>, text: string, linked: int>>>"
    rows = (add_columns(sample, work, kind, []).select(F.explode("runs").alias("run"))
            .orderBy(F.xxhash64("run")).limit(2 * TRAINING_PAGES).collect())
    rng = np.random.default_rng(3)
    found = sorted([(tuple(b["path"]), b["text"], b["linked"]) for b in r[0]] for r in rows)
    pages = []
    for blocks in found:
        labels = [is_main(path) for path, _, _ in blocks]
        pages.append((blocks, labels))
        pages += [other_layout(blocks, labels, rng) for _ in range(-(-LAYOUTS // len(found)))]
    return train(pages)


def extract_text(pages: DataFrame, model: BlockLabeller, keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` (the main text) and ``n_chars``; columns of these names are replaced.

    Needs a column ``html``.  The text holds all blocks labelled as main text, in page
    order, one per line; it is empty for a null or empty page and for one without such
    blocks.  Repeated rows get equal results.  ``keep`` names the columns to keep.
    """
    pages = pages.drop("text", "n_chars")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> list[list]:
        texts = []
        column = batch.column("html")
        for at in range(0, len(column), 200):
            blocks = [page_blocks(page) for page in column.slice(at, 200).to_pylist()]
            order = sorted(range(len(blocks)), key=lambda i: len(blocks[i]))
            found = [""] * len(blocks)
            for start in range(0, len(order), 50):  # pages of about one length together
                part = [i for i in order[start:start + 50] if blocks[i]]
                table = features([blocks[i] for i in part])
                good = shared.value.logits(table, [len(blocks[i]) for i in part]) > KEEP_FROM
                first = 0
                for i in part:
                    own = good[first:first + len(blocks[i])]
                    found[i] = "\n".join(b[1] for b, g in zip(blocks[i], own, strict=True) if g)
                    first += len(blocks[i])
            texts += found
        return [texts, [len(t) for t in texts]]

    return add_columns(pages, work, "text string, n_chars long", keep or pages.columns)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return extract_text(pages, learn_layout(pages), ["page_id", "url"])


QUERIES = {"op8_html_extraction": op8_html_extraction}
ORACLE = {}
