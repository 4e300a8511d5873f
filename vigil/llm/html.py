"""HTML extraction: a bidirectional LSTM labels every text block of a page as main text or not.

A page is cut into leaf blocks in page order. A block's vector holds the hashed names on its
tag path (tags, classes, ids), its hashed words and a few figures (length, share of link text,
place). Two recurrent passes, forwards and backwards over the whole page, give every block the
context of the document; one output per block decides.

The labeller is trained in one task on a bounded sample of ``sample`` pages (a parameter), the
pages of least hash. No labels exist, so blocks of the sample are taught by a rule on tag paths
(see ``taught``), on the pages themselves and on pages put together anew from their text with
other containers, sidebars, notices, forms and comments. The rule is not used on other pages.

Defined cases: null and empty pages give an empty text; comments and the raw text of script,
style, textarea and iframe that are never closed run to the end of the page, other elements
without an end tag hide nothing; rows that repeat an id are extracted one by one; without pages
there is nothing to learn and nothing to label; other columns are passed on, ``text`` and
``n_chars`` replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vigil.llm.common import lean
from vigil.llm.words import feature_hash, split

SAMPLE, REMADE = 300, 800
PATH_BINS, WORD_BINS, FIGURES = 512, 32, 8
WIDTH = PATH_BINS + WORD_BINS + FIGURES
HIDDEN = 16
EPOCHS = 12
PAGES_AT_ONCE, CELLS_AT_ONCE = 128, 8192

# Attributes as HTML reads them, in one pass: a quote opens a value only after "="; one that is
# never closed is a character like others.
_ATTRIBUTES = (
    r"""(?:[\s/]++|[^\s/>][^\s/>=]*+"""
    r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+)*+"""
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|textarea|iframe)(?=[\s/>]){_ATTRIBUTES}>"
    r".*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)"
    rf"|<(/?)([a-z][^\s/>]*+)({_ATTRIBUTES})(>|\Z)"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNQUOTED = re.compile(r"""=\s*[^\s"'>][^\s>]*\Z""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Elements whose tags end a block, and those that have no end tag.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot "
    "th thead title tr ul button label".split()
)
_EMPTY = frozenset("hr br img input meta link area base col embed source track wbr param".split())
# Elements whose content is no text of the page, where their end tag comes.
_HIDDEN = frozenset("template noscript svg select object".split())
_MAY_HIDE = re.compile(f"</(?:{'|'.join(sorted(_HIDDEN))})", re.I)
_CLOSED_BY_SIBLING = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}


def _hidden(page: str) -> dict[int, int]:
    """Where each hidden element of the page starts and ends. An element without an end tag hides
    nothing; svg may end in its own tag."""
    out: dict[int, int] = {}
    if not _MAY_HIDE.search(page):
        return out
    opened: dict[str, list[int]] = {name: [] for name in _HIDDEN}
    for token in _TOKEN.finditer(page):
        tag = (token[3] or "").lower()
        if tag not in _HIDDEN or not token[5]:
            continue
        if token[2]:
            if opened[tag]:
                out[opened[tag].pop()] = token.end()
            continue
        if tag == "svg" and token[4].endswith("/") and not _UNQUOTED.search(token[4]):
            continue
        opened[tag].append(token.start())
    return out


def blocks(page: str) -> list[tuple[str, str, float]]:
    """Tag path, text and share of link text of every block with text.

    A path lists the open block elements as ``tag.name.name``, joined by spaces. Character
    references are decoded, white space inside a block becomes one space.
    """
    out: list[tuple[str, str, float]] = []
    stack: list[str] = []
    tags: list[str] = []
    text: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush():
        nonlocal linked
        if text:
            said = " ".join("".join(text).split())
            if said:
                out.append((" ".join(stack), said, min(1.0, linked / len(said))))
            text.clear()
        linked = 0

    def close(upto: int):
        del stack[upto:], tags[upto:]

    hidden = _hidden(page)
    for token in _TOKEN.finditer(page):
        if token.start() < at:
            continue
        if token[5] == "":  # a tag that never ends is text
            break
        if token.start() > at:
            said = page[at : token.start()]
            if "&" in said:
                said = unescape(said)
            text.append(said)
            if in_link:
                linked += len(said)
        at = hidden.get(token.start(), token.end())
        tag = token[3]
        if tag is None or at > token.end():
            continue
        tag, ends = tag.lower(), token[2] == "/"
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            in_link = not ends
        elif tag in _BLOCKS:
            flush()
            if ends:
                if tag in tags:
                    close(len(tags) - 1 - tags[::-1].index(tag))
                continue
            if tags and tags[-1] == "p":
                close(len(tags) - 1)
            siblings = _CLOSED_BY_SIBLING.get(tag, ())
            while tags and tags[-1] in siblings:
                close(len(tags) - 1)
            if tag not in _EMPTY:
                stack.append(_element(tag, token[4]))
                tags.append(tag)
    if at < len(page):
        said = page[at:]
        text.append(unescape(said) if "&" in said else said)
    flush()
    return out


# Names that tell what a container holds.
_ASIDE = frozenset(
    "nav footer aside form menu navbar navigation sidebar ad ads adbox advert adverts advertisement "
    "sponsor sponsored promo promotion banner cookie cookies consent notice gdpr popup modal overlay "
    "comment comments disqus reply replies respond discussion share sharing social related "
    "recommended recommendations newsletter subscribe subscription signup login signin search "
    "breadcrumb breadcrumbs pagination pager toolbar widget masthead topbar legal copyright dialog "
    "button label alert disclaimer teaser outbrain taboola trending popular title head".split()
)
_MAIN = frozenset(
    "article main content post entry story articlebody body-text prose maintext".split()
)
# Names of _ASIDE that also begin or end names of article sections ("share-price", "title-race").
_LOOSE = frozenset(
    "alert button copyright dialog discussion form head label legal notice popular promotion "
    "recommended related replies reply respond search share sharing social subscription teaser "
    "title trending".split()
)
# Words that say nothing of a container beside another name.
_PLAIN = frozenset(
    "area articles bar block body bottom box button buttons card center col column container "
    "count field group header holder icons inner input item items left line links list message "
    "module page pane panel posts region right row section set site slot stories text thread "
    "top user view wide with wrap wrapper".split()
)


@lru_cache(maxsize=10_000)
def _named(name: str) -> tuple[str, ...]:
    """A class, id or role in its parts; whole, where a loose part stands beside other words."""
    parts = tuple(part.lower() for part in _PARTS.findall(name))
    told = [part for part in parts if part in _ASIDE]
    known = _ASIDE | _MAIN | _PLAIN
    if told and all(part in _LOOSE for part in told) and any(part not in known for part in parts):
        return ("-".join(parts),)
    return parts


def _element(tag: str, attributes: str) -> str:
    names = []
    for found in _NAMES.finditer(attributes):
        for name in (found[2] or found[3] or found[4] or "").split():
            names += _named(name)
    return ".".join([tag, *names])


def taught(paths: list[str]) -> list[bool]:
    """The rule of the training pages: text below a main container, with nothing else between;
    on pages without such a container, any paragraph or heading outside of other containers.
    A discussion below a main container is a section of it."""
    split_up = [[set(e.split(".")) for e in path.split(" ")] for path in paths]
    aside = []
    for path in split_up:
        top = next((n for n, e in enumerate(path) if e & _MAIN), len(path))
        aside.append(any(e & _ASIDE - ({"discussion"} if n > top else set())
                         for n, e in enumerate(path)))
    inside = [any(e & _MAIN for e in path) for path in split_up]
    for i, path in enumerate(split_up):
        named = next((n for n, e in enumerate(path) if "header" in e), None)
        if named is not None and not any(e & _MAIN for e in path[:named]):
            aside[i] = True
    if any(inside):
        return [a and not b for a, b in zip(inside, aside)]
    return [not b and bool(path[-1] & {"p", "h1", "h2", "h3", "pre"})
            for path, b in zip(split_up, aside)]


_path_vectors: dict[str, np.ndarray] = {}


def _path_vector(path: str) -> np.ndarray:
    vector = _path_vectors.get(path)
    if vector is None:
        vector = np.zeros(PATH_BINS, dtype=np.float32)
        elements = path.split(" ")
        for depth, element in enumerate(reversed(elements)):
            for name in element.split("."):
                vector[zlib.crc32(name.encode()) % PATH_BINS] = 1.0
                if depth == 0:
                    vector[zlib.crc32(b"leaf " + name.encode()) % PATH_BINS] = 1.0
        if len(_path_vectors) > 20_000:
            _path_vectors.clear()
        _path_vectors[path] = vector
    return vector


def vectors(pages: list[list[tuple[str, str, float]]]) -> np.ndarray:
    """One row per block of all pages."""
    texts = [text for page in pages for _, text, _ in page]
    out = np.zeros((len(texts), WIDTH), dtype=np.float32)
    if not texts:
        return out
    out[:, :PATH_BINS] = [_path_vector(path) for page in pages for path, _, _ in page]
    words = split(pa.array(texts, pa.large_string()), lower=True, hashed=False)
    count = np.diff(words.first)
    owner = np.repeat(np.arange(len(texts)), count)
    bins = owner * WORD_BINS + (feature_hash(words) >> np.uint64(59)).astype(np.int64)
    tally = np.bincount(bins, minlength=len(texts) * WORD_BINS).reshape(-1, WORD_BINS)
    out[:, PATH_BINS : PATH_BINS + WORD_BINS] = tally / np.maximum(count, 1)[:, None]
    size = np.diff(np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    place = np.concatenate([(np.arange(len(p)) + 0.5) / max(1, len(p)) for p in pages])
    stops = np.array([t.count(".") + t.count(",") for t in texts])
    figures = [
        np.array([share for page in pages for _, _, share in page]),
        np.log1p(size) / 8,
        np.log1p(count) / 6,
        np.minimum(stops / np.maximum(count, 1), 1),
        np.array([t[-1] in ".!?:" for t in texts]),
        count < 5,
        place,
        np.ones(len(texts)),
    ]
    out[:, PATH_BINS + WORD_BINS :] = np.stack(figures, axis=1)
    return out


class BiLstm:
    """A bidirectional LSTM with one output per place, in numpy.

    Sequences are padded to a common length; padding follows the end, and the backward pass
    reads sequences reversed within their length, so padding never reaches a real place.
    """

    def __init__(self, width: int = WIDTH, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden = hidden

        def matrix(rows, columns):
            return rng.normal(0, 1 / np.sqrt(rows), (rows, columns))

        self.weights = {"out": np.zeros(2 * hidden), "level": np.zeros(1)}
        for way in ("ahead", "back"):
            self.weights[way] = matrix(width + hidden, 4 * hidden)
            self.weights[f"{way}_level"] = np.zeros(4 * hidden)
            self.weights[f"{way}_level"][hidden : 2 * hidden] = 1.0  # keep at first

    def _run(self, way: str, x: np.ndarray) -> tuple[np.ndarray, list]:
        """States over time for x (time, sequence, width), and what the gradient needs."""
        n = self.hidden
        weights, level = self.weights[way], self.weights[f"{way}_level"]
        given = x @ weights[: x.shape[2]] + level
        h = c = np.zeros((x.shape[1], n), dtype=given.dtype)
        states, kept = np.zeros((*x.shape[:2], n), dtype=given.dtype), []
        for t in range(len(x)):
            gates = given[t] + h @ weights[x.shape[2] :]
            i, f, o = (_sigmoid(gates[:, k * n : k * n + n]) for k in range(3))
            g = np.tanh(gates[:, 3 * n :])
            before, previous = c, h
            c = f * c + i * g
            bent = np.tanh(c)
            h = o * bent
            states[t] = h
            kept.append((i, f, o, g, before, previous, bent))
        return states, kept

    def _gradient(self, way: str, x: np.ndarray, kept: list, into: np.ndarray) -> dict:
        n, width = self.hidden, x.shape[2]
        weights = self.weights[way]
        dw, dlevel = np.zeros_like(weights), np.zeros(4 * n)
        dh = dc = np.zeros((x.shape[1], n), dtype=weights.dtype)
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, before, previous, bent = kept[t]
            dh = dh + into[t]
            dc = dc + dh * o * (1 - bent**2)
            gates = np.hstack(
                [dc * g * i * (1 - i), dc * before * f * (1 - f),
                 dh * bent * o * (1 - o), dc * i * (1 - g**2)]
            )
            dw[:width] += x[t].T @ gates
            dw[width:] += previous.T @ gates
            dlevel += gates.sum(axis=0)
            dh, dc = gates @ weights[width:].T, dc * f
        return {way: dw, f"{way}_level": dlevel}

    @staticmethod
    def _turned(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Each sequence reversed within its length."""
        t = np.arange(len(x))[:, None]
        source = np.where(t < sizes, sizes - 1 - t, t)
        return x[source, np.arange(x.shape[1])]

    def forward(self, x: np.ndarray, sizes: np.ndarray):
        ahead, kept_ahead = self._run("ahead", x)
        turned = self._turned(x, sizes)
        back, kept_back = self._run("back", turned)
        states = np.concatenate([ahead, self._turned(back, sizes)], axis=2)
        scores = states @ self.weights["out"] + self.weights["level"][0]
        return scores, (states, turned, kept_ahead, kept_back)

    def gradients(self, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict:
        scores, (states, turned, kept_ahead, kept_back) = self.forward(x, sizes)
        real = np.arange(len(x))[:, None] < sizes
        error = np.where(real, _sigmoid(scores) - labels, 0).astype(scores.dtype)
        error = error / scores.dtype.type(real.sum())
        out = {"out": np.tensordot(error, states, 2), "level": np.array([error.sum()])}
        into = error[:, :, None] * self.weights["out"]
        n = self.hidden
        out |= self._gradient("ahead", x, kept_ahead, into[:, :, :n])
        out |= self._gradient("back", turned, kept_back, self._turned(into[:, :, n:], sizes))
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _padded(rows: np.ndarray, first: np.ndarray, chosen: np.ndarray):
    sizes = (first[1:] - first[:-1])[chosen]
    x = np.zeros((int(sizes.max()), len(chosen), rows.shape[1]), dtype=rows.dtype)
    for column, (i, size) in enumerate(zip(chosen, sizes)):
        x[:size, column] = rows[first[i] : first[i] + size]
    return x, sizes


def train(pages: list[list[tuple[str, str, float]]], epochs: int = EPOCHS) -> BiLstm:
    """Adam over small batches of pages, taught by the rule."""
    model = BiLstm()
    pages = [page for page in pages if page]
    if not pages:
        return model
    model.weights = {name: w.astype(np.float32) for name, w in model.weights.items()}
    rows = vectors(pages)
    labels = np.concatenate([taught([b[0] for b in page]) for page in pages]).astype(np.float32)
    first = np.concatenate([[0], np.cumsum([len(p) for p in pages])])
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in model.weights.items()}
    rng, step = np.random.default_rng(1), 0
    for epoch in range(epochs):
        # Pages of like length share a batch, so that little is padded.
        order = rng.permutation(len(pages))
        order = order[np.argsort(np.diff(first)[order], kind="stable")]
        for low in 16 * rng.permutation(-(-len(order) // 16)):
            chosen = order[low : low + 16]
            x, sizes = _padded(rows, first, chosen)
            y, _ = _padded(labels[:, None], first, chosen)
            # Words must not decide what the path says: some word vectors are blanked.
            blank = rng.random(x.shape[:2]) < 0.3
            x[blank, PATH_BINS : PATH_BINS + WORD_BINS] = 0.0
            step += 1
            for name, slope in model.gradients(x, sizes, y[:, :, 0]).items():
                slope = np.clip(slope, -1, 1) + 1e-5 * model.weights[name]
                m, v = moments[name]
                m += 0.1 * (slope - m)
                v += 0.01 * (slope**2 - v)
                rate = float(0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step))
                model.weights[name] -= rate * m / (np.sqrt(v) + 1e-8)
    return model


def remade(page: list[tuple[str, str, float]], rng: np.random.Generator) -> str:
    """A page of another layout with the text of a page: other main containers with paragraphs,
    short lists, tables, headings, captions and named sections, and around and inside of them
    sidebars, notices, adverts, forms, share links, footers without links and comments."""
    main = [text for (path, text, _), good in zip(page, taught([b[0] for b in page])) if good]
    other = [text for (path, text, _), good in zip(page, taught([b[0] for b in page])) if not good]
    texts = main + other or ["text"]
    names = sorted(_ASIDE - {"title", "head"}) + ["header"]
    pick = lambda given: given[int(rng.integers(len(given)))]

    def said() -> str:
        text = pick(texts)
        return escape(text[: int(rng.integers(20, 400))])

    def brief(most: int) -> str:
        words = pick(texts).split()
        low = int(rng.integers(len(words)))
        return escape(" ".join(words[low : low + int(rng.integers(1, most + 1))]))

    def listed(tag: str, most: int = 6) -> str:
        items = (f"<li>{brief(most)}</li>" for _ in range(rng.integers(2, 7)))
        return f"<{tag}>{''.join(items)}</{tag}>"

    def tabled() -> str:
        width = int(rng.integers(2, 5))
        rows = [["th"] * width] + [["td"] * width for _ in range(rng.integers(1, 5))]
        cells = ("".join(f"<{t}>{brief(2)}</{t}>" for t in row) for row in rows)
        return f"<table>{''.join(f'<tr>{row}</tr>' for row in cells)}</table>"

    def piece() -> str:
        """A part of an article that is no plain paragraph."""
        kind = rng.integers(7)
        if kind == 0:
            return listed(pick(["ul", "ol"]))
        if kind == 1:
            return tabled()
        if kind == 2:
            level = pick(["h2", "h3", "h4"])
            return f"<{level}>{brief(4)}</{level}><p>{brief(3)}</p>"
        if kind == 3:
            return f"<p>{brief(4)}</p>"
        if kind == 4:
            return f"<figure><img src='a'><figcaption>{brief(8)}</figcaption></figure>"
        if kind == 5:
            terms = (f"<dt>{brief(2)}</dt><dd>{brief(8)}</dd>" for _ in range(rng.integers(1, 4)))
            return f"<dl>{''.join(terms)}</dl>"
        return f"<blockquote>{brief(10)}</blockquote>"

    def section(inside: str) -> str:
        """A named section of an article; some names hold a word of other containers."""
        word = "".join(c for c in brief(1).lower() if "a" <= c <= "z") or "part"
        name = pick([word, "discussion", f"{pick(sorted(_LOOSE))}-{word}", "part", "chapter"])
        tag = pick(["section", "div"])
        return f'<{tag} {pick(["class", "id"])}="{name}">{inside}</{tag}>'

    def wrapped(name: str) -> str:
        if name in ("nav", "footer", "aside", "form", "header", "button", "label"):
            return f"<{name}>{inner(name)}</{name}>"
        tag = pick(["div", "div", "section", "ul", "aside"])
        attribute = pick(["class", "class", "id"])
        extra = pick(["", "-box", " block", "-area", "_list", "-container", " wide",
                      f"-{pick(names)}", f"-{pick(sorted(_PLAIN))}"])
        return f'<{tag} {attribute}="{name}{extra}">{inner(name)}</{tag}>'

    def inner(name: str) -> str:
        kind = rng.integers(7)
        if kind == 4:
            return listed(pick(["ul", "ol"]))
        if kind == 5:
            return f"<p>{brief(8)}</p>"
        if kind == 6:
            return piece()
        if kind == 0:
            return "".join(f"<li><a href='#'>{said()[:20]}</a></li>" for _ in range(rng.integers(2, 7)))
        if kind == 1:
            return "".join(f"<p>{said()}</p>" for _ in range(rng.integers(1, 4)))
        if kind == 2:
            return f"<h3>{said()[:30]}</h3><div>{said()}</div>"
        return said()

    around = lambda most: "".join(wrapped(pick(names)) for _ in range(rng.integers(0, most)))
    body = []
    for text in main or [said()]:
        tag = pick(["p", "p", "p", "p", "div", "li", "blockquote", "h2", "pre", "td"])
        body.append(f"<{tag}>{escape(text)}</{tag}>")
        if rng.random() < 0.35:
            body.append("".join(piece() for _ in range(rng.integers(1, 3))))
        if rng.random() < 0.12:
            body[-2:] = [section("".join(body[-2:]))]
        if rng.random() < 0.12:
            body.append(wrapped(pick(names)))
    box = pick(["article", "main", "article", "div class=content", 'div class="post-content"',
                'div id="main"', 'section class="story"', 'div class="entry"', 'main role="main"'])
    top = f"<h1>{escape(main[0][:60])}</h1>" if main and rng.random() < 0.7 else ""
    if top and rng.random() < 0.3:
        top = f"<header>{top}</header>"
    middle = f"<{box}>{top}{''.join(body)}</{box.split()[0]}>"
    for _ in range(rng.integers(0, 3)):
        middle = f"<div class=\"{pick(['wrap', 'page', 'row', 'col', 'site', 'outer'])}\">{middle}</div>"
    head = f"<head><title>{said()[:60]}</title></head>"
    after = wrapped(pick(["comments", "discussion", "replies"])) if rng.random() < 0.3 else ""
    return f"<html>{head}<body>{around(7)}{middle}{after}{around(7)}</body></html>"


def training_pages(sample: list[str]) -> list[list[tuple[str, str, float]]]:
    """The sample's pages and, page by page in turn, REMADE pages of other layouts."""
    rng = np.random.default_rng(7)
    own = [page for page in map(blocks, sample) if page]
    return own + [blocks(remade(own[i % len(own)], rng)) for i in range(REMADE if own else 0)]


def _fit(epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [page for batch in batches for page in batch.column(0).to_pylist()]
        weights = train(training_pages(sample), epochs).weights
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(weights)), pa.array([w.ravel().tolist() for w in weights.values()])],
            names=["name", "weight"],
        )

    return run


def fit(pages: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> BiLstm:
    """The labeller learned from the ``sample`` rows of ``pages`` (page_id, html) of least hash."""
    known = pages.select("page_id").filter("page_id is not null").distinct()
    known = known.orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    chosen = pages.select("page_id", "html").join(F.broadcast(known), "page_id")
    learned = (
        chosen.filter("html is not null")
        .select("html", F.xxhash64("page_id", "html").alias("place"))
        .repartition(1)
        .sortWithinPartitions("place")
        .mapInArrow(lean(_fit(epochs)), "name string, weight array<double>")
        .collect()
    )
    model = BiLstm()
    for row in learned:
        model.weights[row["name"]] = np.array(row["weight"]).reshape(model.weights[row["name"]].shape)
    return model


def _groups(order: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Pages of like size, so many that their padded blocks stay few; a long page is alone."""
    low = 0
    while low < len(order):
        high = min(len(order), low + PAGES_AT_ONCE)
        while high > low + 1 and (high - low) * sizes[order[high - 1]] > CELLS_AT_ONCE:
            high -= 1
        yield order[low:high]
        low = high


def main_text(pages: list[str | None], model: BiLstm) -> list[str]:
    """The main text of each page: its blocks labelled so, joined by an empty line."""
    cut = [blocks(page) if page else [] for page in pages]
    sizes = np.array([len(page) for page in cut], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    rows = vectors(cut)
    scores = np.zeros(len(rows))
    filled = np.flatnonzero(sizes)
    filled = filled[np.argsort(sizes[filled], kind="stable")]
    for chosen in _groups(filled, sizes):
        x, length = _padded(rows, first, chosen)
        found, _ = model.forward(x, length)
        for column, i in enumerate(chosen):
            scores[first[i] : first[i + 1]] = found[: sizes[i], column]
    return [
        "\n\n".join(b[1] for b, s in zip(page, scores[a:]) if s >= 0)
        for page, a in zip(cut, first)
    ]


_RESULT = [StructField("text", StringType()), StructField("n_chars", LongType())]


def extract(pages: DataFrame, model: BiLstm, with_html: bool = True) -> DataFrame:
    """``pages`` with the main ``text`` of ``html`` and its number of code points."""
    rest = pages.drop("text", "n_chars")
    kept = [f for f in rest.schema if with_html or f.name != "html"]
    names = [f.name for f in kept]
    sent = pages.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = BiLstm()
        labeller.weights = {k: w.astype(np.float32) for k, w in sent.value.items()}
        for batch in batches:
            html = batch.column(batch.schema.get_field_index("html")).to_pylist()
            texts = main_text(html, labeller)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(name)) for name in names),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[*names, "text", "n_chars"],
            )

    return rest.mapInArrow(lean(run), StructType(kept + _RESULT))
