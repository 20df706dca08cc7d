"""Main text of web pages by boosted trees over the nodes of the page.

Each element is described by its tag, attribute words, depth, the density of text, links and
punctuation in its subtree, and how it compares with its siblings; the same of its parent's
attributes. Boosted trees give the probability that it is main text. The decisions of a page are
then made together: every node is main text, other matter or mixed; what is below main text is main
text, what is below other matter is other matter, and the likeliest such labelling is taken.

The trees are fitted to pages with known main text that ``sample_pages`` lays out in many styles.
"""

from __future__ import annotations


import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import trees
from stratum.llm.common import map_arrow
from stratum.llm.dom import Page, read

TAGS = (
    "p", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "li", "a",
    "table", "td", "figure", "figcaption", "blockquote", "pre", "button", "label", "body",
)
#: Attribute words, each a feature of a node and of its ancestors.
WORDS = (
    "nav", "menu", "header", "footer", "side", "ad", "ads", "promo", "banner", "cookie", "notice", "consent",
    "share", "social", "related", "comment", "reply", "form", "newsletter", "subscribe", "login", "search",
    "breadcrumb", "widget", "sponsor", "popup", "content", "article", "post", "main", "entry", "body", "text", "story",
)
MAIN_WORDS = frozenset(("content", "article", "post", "main", "entry", "body", "text", "story"))
OTHER_TAGS = frozenset(("nav", "footer", "aside", "form", "button", "label", "dialog", "menu", "search"))
_WORD_PATTERN = re.compile("[a-z]+")


def _attribute_words(attributes: str) -> set[int]:
    if not attributes:
        return set()
    found = set()
    for token in _WORD_PATTERN.findall(attributes):
        for i, word in enumerate(WORDS):
            if token == word or (len(word) > 3 and word in token):
                found.add(i)
    return found


def node_features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    chars, links, marks, words, paragraphs = (np.zeros(n) for _ in range(5))
    parent = page.parent
    tag = page.tag
    in_link = [False] * n
    depth = [0] * n
    children: list[int] = [0] * n
    place = [0] * n
    for i in range(1, n):
        p = parent[i]
        in_link[i] = in_link[p] or tag[i] == "a"
        depth[i] = depth[p] + 1
        place[i] = children[p]
        children[p] += 1
        if tag[i] == "p":
            paragraphs[i] = 1
    for node, text in page.texts:
        size = len(text.strip())
        if size:
            chars[node] += size
            words[node] += text.count(" ") + 1
            marks[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
            if in_link[node]:
                links[node] += size
    below = np.ones(n)
    own_chars = chars.copy()
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        marks[p] += marks[i]
        words[p] += words[i]
        paragraphs[p] += paragraphs[i]
        below[p] += below[i]
    total = max(chars[0], 1.0)
    has_main = float("article" in tag or "main" in tag)
    columns = len(TAGS) + 2 * len(WORDS) + 20
    x = np.zeros((n, columns), np.float32)
    above = [set()] * n
    other_above, article_above = [0] * n, [0] * n
    kin_chars = np.zeros(n)
    np.add.at(kin_chars, np.maximum(parent, 0), chars)
    tag_no = {t: i for i, t in enumerate(TAGS)}
    base = len(TAGS)
    for i in range(n):
        own = _attribute_words(page.attributes[i])
        p = parent[i]
        above[i] = own if p < 0 else above[p] | own
        other_above[i] = (tag[i] in OTHER_TAGS) + (other_above[p] if p >= 0 else 0)
        article_above[i] = (tag[i] in ("article", "main")) or (p >= 0 and article_above[p])
        k = tag_no.get(tag[i])
        if k is not None:
            x[i, k] = 1
        for w in own:
            x[i, base + w] = 1
        for w in above[i]:
            x[i, base + len(WORDS) + w] = 1
    up = np.maximum(parent, 0)
    safe = np.maximum(chars, 1.0)
    siblings = np.maximum(np.array(children, float)[up], 1.0)
    heading = np.array([len(t) == 2 and t[0] == "h" and t[1].isdigit() for t in tag], float)
    numbers = np.stack(
        [
            np.array(depth, float),
            np.log1p(chars),
            np.log1p(own_chars),
            np.log1p(words),
            links / safe,
            marks / np.maximum(words, 1.0),
            chars / np.maximum(words, 1.0),
            np.log1p(below),
            chars / below,
            np.log1p(paragraphs),
            np.array(children, float),
            siblings,
            np.array(place, float) / siblings,
            chars / np.maximum(kin_chars[up], 1.0),
            chars / total,
            chars * siblings / np.maximum(kin_chars[up], 1.0),
            heading,
            np.array(other_above, float),
            np.array(article_above, float),
            np.full(n, has_main),
        ],
        axis=1,
    )
    x[:, base + 2 * len(WORDS) :] = numbers
    return x


def decode(page: Page, probability: np.ndarray) -> np.ndarray:
    """For each node whether its own text is main text, as the likeliest consistent labelling."""
    n = len(page.tag)
    has_text = np.zeros(n, bool)
    own_text = np.zeros(n, bool)
    for node, text in page.texts:
        if text.strip():
            own_text[node] = True
    has_text[:] = own_text
    for i in range(n - 1, 0, -1):
        if has_text[i]:
            has_text[page.parent[i]] = True
    p = np.clip(probability, 1e-3, 1 - 1e-3)
    main = np.where(has_text, np.log(p), 0.0)
    other = np.where(has_text, np.log1p(-p), 0.0)
    # Scores of a subtree: all main, all other, or free below a mixed node, whose own text goes by
    # its own probability and which costs a little, as pages have few of them.
    all_main, all_other = main.copy(), other.copy()
    free = np.where(own_text, np.maximum(main, other), 0.0) - 0.05 * has_text
    for i in range(n - 1, 0, -1):
        q = page.parent[i]
        all_main[q] += all_main[i]
        all_other[q] += all_other[i]
        free[q] += max(all_main[i], all_other[i], free[i])
    label = np.zeros(n, np.int8)  # 1: main, 0: mixed, -1: other
    keep = np.zeros(n, bool)
    for i in range(n):
        above = label[page.parent[i]] if i else 0
        if above:
            label[i] = above
        else:
            best = max(all_main[i], all_other[i], free[i])
            label[i] = 0 if best == free[i] and i == 0 else 1 if best == all_main[i] else -1 if best == all_other[i] else 0
        keep[i] = label[i] == 1 or (label[i] == 0 and main[i] > other[i])
    return keep


def blocks(page: Page, keep: np.ndarray) -> str:
    """The texts of the kept nodes: one line per block, its white space as single spaces."""
    lines, current = [], []

    def flush() -> None:
        line = " ".join("".join(current).split())
        if line:
            lines.append(line)
        current.clear()

    for node, text in page.texts:
        if text == "":
            flush()
        elif keep[node]:
            current.append(text)
    flush()
    return "\n".join(lines)


def _nonsense(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        word = "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiouäé") for _ in range(rng.randint(1, 4)))
        out.append(word + rng.choice(["", "", "", "", "", ",", ".", "%%%", "&amp;"]))
    return " ".join(out).capitalize() + rng.choice([".", ".", "", "!"])


def sample_pages(count: int, seed: int = 11) -> Iterator[str]:
    """Pages in many layouts. Main text is inside elements that carry the attribute word xmain,
    other matter inside elements that carry xother; ``train`` takes the words out again."""
    rng = random.Random(seed)
    for number in range(count):
        yield _sample_page(rng, number)


def _sample_page(rng: random.Random, number: int) -> str:
    def other(kind: str, inner: str) -> str:
        tags = {
            "nav": ["nav", "div", "ul", "div"],
            "header": ["header", "div"],
            "footer": ["footer", "div"],
            "aside": ["aside", "div", "section"],
            "form": ["form", "form", "div"],
        }.get(kind, ["div", "div", "section", "aside", "p"])
        names = {
            "nav": ["nav", "menu", "main-menu", "navbar", "breadcrumb", "nav-menu"],
            "header": ["header", "site-header", "top", "masthead", "page-header"],
            "footer": ["footer", "site-footer", "bottom", "page-footer"],
            "aside": ["sidebar", "side", "widget", "widget-area"],
            "ad": ["ad", "ads", "advert", "banner-ad", "sponsor", "promo", "ad-slot"],
            "notice": ["cookie", "cookie-notice", "notice", "consent", "banner", "popup"],
            "share": ["share", "social", "share-bar"],
            "related": ["related", "related-posts", "more-stories"],
            "comment": ["comments", "comment-list", "comment", "replies"],
            "form": ["newsletter", "subscribe", "login", "search", "form", "contact-form"],
        }[kind]
        tag = rng.choice(tags)
        word = rng.choice(names) if rng.random() < 0.8 or tag in ("div", "p", "section") else ""
        place = rng.choice(["class", "class", "class", "id"])
        if place == "id":
            return f'<{tag} class="xother" id="{word}">{inner}</{tag}>'
        return f'<{tag} class="xother {word}">{inner}</{tag}>'

    def link(n: int) -> str:
        return f'<a href="/{rng.randint(1, 99)}">{_nonsense(rng, n)}</a>'

    def linklist(n: int) -> str:
        return "<ul>" + "".join(f"<li>{link(rng.randint(1, 4))}</li>" for _ in range(n)) + "</ul>"

    def prose() -> str:
        words = rng.choice([1, 2, 4, 8, 15, 30, 60, 90, 150])
        body = _nonsense(rng, words)
        if rng.random() < 0.2:
            body += " " + link(rng.randint(1, 5)) + " " + _nonsense(rng, rng.randint(1, 20))
        if rng.random() < 0.2:
            body = f"<b>{body}" + ("</b>" if rng.random() < 0.6 else "")
        if rng.random() < 0.15:
            body += "<br>" + (_nonsense(rng, rng.randint(1, 12)) if rng.random() < 0.5 else "")
        return body

    def block() -> str:
        r = rng.random()
        if r < 0.72:
            return f"<p>{prose()}" + ("</p>" if rng.random() < 0.8 else "")
        if r < 0.78:
            return f"<h{(k := rng.randint(2, 4))}>{_nonsense(rng, rng.randint(1, 9))}</h{k}>"
        if r < 0.84:
            return "<ul>" + "".join(f"<li>{_nonsense(rng, rng.randint(2, 25))}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        if r < 0.88:
            return f"<blockquote><p>{prose()}</p></blockquote>"
        if r < 0.91:
            return f"<pre>{_nonsense(rng, 12)}</pre>"
        if r < 0.94:
            rows = "".join(f"<tr><td>{_nonsense(rng, 2)}</td><td>{_nonsense(rng, 3)}</td></tr>" for _ in range(rng.randint(1, 4)))
            return f"<table>{rows}</table>"
        if r < 0.97:
            return f'<figure><img src="x.png"><figcaption>{_nonsense(rng, rng.randint(2, 12))}</figcaption></figure>'
        return f"<div>{prose()}</div>"

    inside = {
        "ad": lambda: rng.choice([_nonsense(rng, rng.randint(2, 14)), f"<p>{_nonsense(rng, rng.randint(3, 20))}</p>", link(5)]),
        "share": lambda: linklist(3),
        "related": lambda: f"<h3>{_nonsense(rng, 2)}</h3>" + linklist(rng.randint(2, 5)),
        "form": lambda: f"<label>{_nonsense(rng, 3)}</label><input><button>{_nonsense(rng, 1)}</button>" + (f"<p>{_nonsense(rng, 12)}</p>" if rng.random() < 0.5 else ""),
        "notice": lambda: f"<p>{_nonsense(rng, rng.randint(5, 40))}</p><button>{_nonsense(rng, 1)}</button>",
        "comment": lambda: (f"<h3>{_nonsense(rng, 2)}</h3>" if rng.random() < 0.5 else "")
        + "".join(f'<{(t := rng.choice(["div", "li", "article", "div"]))} class="{rng.choice(["comment", "comment-body", "reply", "c"])}"><p>{_nonsense(rng, rng.randint(2, 60))}</p></{t}>' for _ in range(rng.randint(1, 5))),
        "nav": lambda: linklist(rng.randint(2, 9)) if rng.random() < 0.8 else " ".join(link(1) for _ in range(4)),
        "header": lambda: (f"<h1>{_nonsense(rng, 2)}</h1>" if rng.random() < 0.4 else link(2)) + (f"<p>{_nonsense(rng, 6)}</p>" if rng.random() < 0.5 else ""),
        "footer": lambda: f"&copy; {_nonsense(rng, rng.randint(2, 25))}" + (linklist(3) if rng.random() < 0.4 else ""),
        "aside": lambda: f"<h3>{_nonsense(rng, 2)}</h3>" + rng.choice([linklist(4), f"<p>{_nonsense(rng, rng.randint(5, 50))}</p>"]),
    }

    def matter(kind: str) -> str:
        return other(kind, inside[kind]())

    def some(share: float, *kinds: str) -> str:
        return "".join(matter(k) for k in kinds if rng.random() < share)

    length = rng.choice([0, 1, 2, 3, 5, 8, 12, 20])
    body = [f"<h1>{_nonsense(rng, rng.randint(2, 10))}</h1>"] if rng.random() < 0.85 else []
    if length:
        body += [block() for _ in range(length)]
    elif not body:
        body = [f"<p>{prose()}</p>"]
    # Runs of main text are wrapped so that they can be told apart; other matter may stand between.
    parts, run = [], []
    for b in body:
        run.append(b)
        if rng.random() < 0.06:
            parts += [f'<x class="xmain">{"".join(run)}</x>', matter(rng.choice(["ad", "share", "related", "form", "aside"]))]
            run = []
    if run:
        parts.append(f'<x class="xmain">{"".join(run)}</x>')
    if rng.random() < 0.3:
        parts.append(matter(rng.choice(["share", "related", "form", "comment"])))
    wrapper = rng.choice(
        ["article", "article", "article", "main", 'div class="content"', 'div id="main"', 'div class="post-body"', 'div class="entry"', "div", "section", 'div class="story"']
    )
    core = f"<{wrapper}>{''.join(parts)}</{wrapper.split()[0]}>"
    if rng.random() < 0.35:
        outer = rng.choice(["main", "div", 'div class="wrap"', 'div id="page"', 'div class="container"'])
        core = f"<{outer}>{core}{some(0.3, 'comment', 'aside', 'related')}</{outer.split()[0]}>"
    top = some(0.55, "notice", "header", "nav", "ad")
    end = some(0.4, "comment", "related", "aside", "form", "ad") + some(0.8, "footer")
    if rng.random() < 0.5:
        top = matter("nav") + top
    return f"<html><head><title>{_nonsense(rng, 4)}</title><script>var x = '</p>';</script></head><body>{top}{core}{end}</body></html>"


def _marked(source: str) -> tuple[Page, np.ndarray]:
    """A sample page as it would come, and for its nodes 1 (main), 0 (other) or -1 (both, neither)."""
    page = read(source)
    n = len(page.tag)
    mark = [""] * n
    for i in range(1, n):
        own = page.attributes[i].split()
        found = "main" if "xmain" in own else "other" if "xother" in own else ""
        mark[i] = found or mark[page.parent[i]]
    counts = np.zeros((n, 2))
    for node, text in page.texts:
        if text.strip() and mark[node]:
            counts[node, int(mark[node] == "main")] += 1
    for i in range(n - 1, 0, -1):
        counts[page.parent[i]] += counts[i]
    label = np.where(counts.sum(axis=1) == 0, -1, np.where(counts[:, 0] == 0, 1, np.where(counts[:, 1] == 0, 0, -1)))
    # Take the wrappers and marks out: their children belong to the wrapper's parent.
    at, clean = {0: 0}, Page()
    kept = [0]
    for i in range(1, n):
        if page.tag[i] == "x":
            at[i] = at[page.parent[i]]
            continue
        at[i] = len(clean.tag)
        clean.tag.append(page.tag[i])
        clean.parent.append(at[page.parent[i]])
        clean.attributes.append(" ".join(w for w in page.attributes[i].split() if w not in ("xmain", "xother")))
        kept.append(i)
    clean.texts = [(at[node], text) for node, text in page.texts]
    return clean, label[kept]


_models: dict = {}


def train(pages: int = 300, seed: int = 11) -> trees.Boosted:
    """Fit the node classifier; a few seconds on the driver, the same model every time."""
    if (pages, seed) not in _models:
        features, labels = [], []
        for source in sample_pages(pages, seed):
            page, label = _marked(source)
            x = node_features(page)
            features.append(x[label >= 0])
            labels.append(label[label >= 0])
        _models[pages, seed] = trees.fit(
            np.concatenate(features).astype(np.float64),
            np.concatenate(labels).astype(np.float64),
            trees=50,
            depth=5,
            rate=0.25,
            bins=32,
            rows_per_tree=0.7,
            seed=seed,
        )
    return _models[pages, seed]


def _extract_batch(sources: list[str], model: trees.Boosted) -> list[str]:
    pages = [read(s) for s in sources]
    features = [node_features(p) for p in pages]
    if not pages:
        return []
    margin = model.margin(np.concatenate(features))
    probability = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    out, at = [], 0
    for page in pages:
        n = len(page.tag)
        out.append(blocks(page, decode(page, probability[at : at + n])))
        at += n
    return out


def extract(
    pages: DataFrame, html_col: str = "html", out: str = "text", model: trees.Boosted | None = None
) -> DataFrame:
    """``pages`` with the main text of each whole page in the column ``out`` (replaced if it exists).

    One line per block. Null and empty pages, and pages without main text, have an empty text.
    Equal pages have equal texts, and an empty table gives an empty one. Nothing is shuffled; a task
    holds the nodes of a hundred pages at a time.
    """
    model = model or train()
    rest = [c for c in pages.columns if c.lower() != out.lower() or c == html_col]
    kept = pages.select(*[F.col(f"`{c}`") for c in rest])
    names = [*[c for c in rest if c.lower() != out.lower()], out]
    at = rest.index(html_col)
    schema = kept.select(*[F.col(f"`{c}`") for c in names[:-1]]).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for lo in range(0, batch.num_rows, 100):
                sources = batch.column(at).slice(lo, 100).to_pylist()
                texts += _extract_batch([s or "" for s in sources], model)
            columns = [batch.column(rest.index(c)) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=names)

    return map_arrow(kept, run, schema)
