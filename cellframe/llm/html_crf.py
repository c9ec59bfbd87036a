"""Main text of web pages: a linear-chain CRF over the leaf blocks of the DOM.

A block's features are its ancestors' tags and name parts (class, id, role), its
own tag, and its text's shape: length, share of links, punctuation, place on the
page, and its words if it is short. Two labels, main text or not, with weights
for each feature and for each pair of neighbouring labels; trained by gradient
steps on the log likelihood (forward-backward), decoded by Viterbi.

Labelled pages: a bounded sample of the pages themselves (`SAMPLE_PAGES`), those
first that are no longer than `SAMPLE_CHARS` and have a landmark for their article
(<article>, <main>, role=main). Such a page is labelled by it. Every sampled page's
blocks are also laid out anew in other markups (`variant`), in which each block's
label is known, so that the model learns names and shapes besides landmarks; of a
page without a landmark the long blocks and half of the others stand for the article there. So a table
without any landmark is read by what its own texts look like in generic markups.
Only hashed features reach the driver.

Null or empty html: empty text. Repeated rows are extracted alike; pages of any
length are one task's work, linear in their length. An empty table gives none.
Columns beside page_id, url and html may have any name and type.
"""

from __future__ import annotations

import random
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.llm.common import map_columns, same
from cellframe.llm.dom import Block, Node, blocks

SAMPLE_PAGES = 300
SAMPLE_CHARS = 200_000
# Words from which a block of a page without a landmark counts as long.
LONG_BLOCK = 12
VARIANTS = 5
SLOT_BITS = 17
EPOCHS = 4
RATE = 0.2
DECAY = 1e-5

_KEEPS = {"article", "main"}
_DROPS = {
    "nav", "header", "footer", "aside", "form", "head", "title", "menu", "button",
    "select", "textarea", "fieldset", "dialog",
}
_DROP_NAMES = {
    "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "sidebar",
    "comment", "comments", "menu", "nav", "navigation", "breadcrumb", "breadcrumbs",
    "footer", "cookie", "consent", "notice", "popup", "modal", "newsletter", "subscribe",
    "share", "social", "related", "widget", "form", "login", "search", "disqus", "respond",
    "toolbar", "pagination", "copyright",
}


# What may be a landmark; pages with it are sampled first.
_LANDMARK = r"(?i)<(article|main)\b|\bmain\b[^<>]*>"


def _framed(above: tuple[bool, bool], node: Node) -> tuple[bool, bool]:
    """Whether an element is inside a landmark, and inside of what frames it."""
    inside, dropped = above
    if node.tag in _KEEPS or "main" in node.names:
        inside, dropped = True, False
    if node.tag in _DROPS or not _DROP_NAMES.isdisjoint(node.names):
        dropped = True
    return inside, dropped


def landmark_labels(page: list[Block]) -> list[int] | None:
    """1 for blocks inside the article's landmark and outside of what frames it;
    None for a page without one."""
    found = [b.node.worked_out("framed", (False, False), _framed) for b in page]
    if not any(inside for inside, _ in found):
        return None
    return [int(inside and not dropped) for inside, dropped in found]


# Markups of the variants. {t}: text of one block; {l}: its words as a link.
_CONTENT = [
    "<article{}>", "<main{}>", "<div{}>", "<section{}>", '<div class="content"{}>', '<div id="content"{}>',
    '<div class="post-body"{}>', '<div class="article-text"{}>', '<div id="main"{}>',
    '<section class="story"{}>', '<div class="entry-content"{}>', '<div class="text"{}>',
    '<article class="post"{}>', '<div class="page"><div class="body-copy"{}>',
]
_MAIN = [
    "<p>{t}</p>", "<p>{t}</p>", "<p>{t}</p>", "<p>{t}</p>", "<div>{t}</div>", "<p>{t}",
    "<ul><li>{t}</li></ul>", "<ol><li>{t}</li></ol>", "<blockquote>{t}</blockquote>",
    "<pre>{t}</pre>", "<table><tr><td>{t}</td></tr></table>", "<p><b>{t}</b></p>",
    "<dl><dd>{t}</dd></dl>", "<figure><figcaption>{t}</figcaption></figure>",
]
_HEADS = ["<h1>{t}</h1>", "<h2>{t}</h2>", "<h3>{t}</h3>"]
_LINKS = [
    "<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>',
    '<ul class="nav">{}</ul>', '<ul id="main-menu">{}</ul>',
    '<div class="breadcrumbs"><ul>{}</ul></div>', "<header><ul>{}</ul></header>",
    '<aside><ul class="related">{}</ul></aside>', '<div class="share"><ul>{}</ul></div>',
    '<div class="sidebar"><ul>{}</ul></div>', '<footer><ul>{}</ul></footer>',
]
_FRAMES = [
    '<div class="ad">{t}</div>', '<div class="advert"><p>{t}</p></div>',
    '<div class="banner">{t}</div>', '<div class="sponsored"><p>{t}</p></div>',
    "<aside><p>{t}</p></aside>", '<aside class="sidebar"><p>{t}</p></aside>',
    '<div id="sidebar"><div>{t}</div></div>', '<div class="widget"><p>{t}</p></div>',
    '<div class="cookie-notice"><p>{t}</p></div>', '<div class="notice">{t}</div>',
    '<div class="cookie-banner">{t}</div>', '<div role="alert">{t}</div>',
    '<div id="consent"><p>{t}</p></div>', '<div class="popup"><p>{t}</p></div>',
    '<form action="/s"><label>{t}</label><input name="q"></form>',
    '<form class="newsletter"><p>{t}</p></form>', "<form><button>{t}</button></form>",
    '<div class="subscribe"><p>{t}</p></div>', '<div class="promo">{t}</div>',
    '<div class="related"><p>{t}</p></div>', '<div class="author-box"><p>{t}</p></div>',
]
_TOPS = [
    "<header><p>{t}</p></header>", '<div class="header">{t}</div>',
    '<div id="top"><div class="logo">{t}</div></div>', "<header><h1>{t}</h1></header>",
    '<div class="site-title">{t}</div>', '<div class="toolbar">{t}</div>',
]
_COMMENTS = [
    '<section class="comments"><div class="comment"><p>{t}</p></div></section>',
    '<div id="comments"><p>{t}</p></div>', '<div class="comment-body">{t}</div>',
    '<ol class="commentlist"><li class="comment"><p>{t}</p></li></ol>',
    '<div class="reply"><p>{t}</p></div>', '<div class="comment">{t}</div>',
    '<section id="discussion"><article class="comment"><p>{t}</p></article></section>',
]
_ENDS = [
    "<footer>&copy; {t}</footer>", "<footer><p>{t}</p></footer>",
    '<div class="footer">{t}</div>', '<div id="footer"><p>&copy; {t}</p></div>',
    '<div class="copyright">{t}</div>', '<div class="legal">{t}</div>',
]


def variant(main: list[str], other: list[str], seed: int) -> tuple[str, list[int]]:
    """A page of the same texts in another markup, and the label of every block."""
    pick = random.Random(seed)
    html: list[str] = ["<html><body>"]
    labels: list[int] = []
    escape = str.maketrans({"<": "&lt;", ">": "&gt;", "&": "&amp;"})
    words = " ".join(main + other).split() or ["x"]

    def phrase(low: int, high: int) -> str:
        at = pick.randrange(len(words))
        return " ".join(words[at : at + pick.randint(low, high)])

    def frame(kinds: list[str], low: int, high: int) -> None:
        html.append(pick.choice(kinds).replace("{t}", phrase(low, high).translate(escape)))
        labels.append(0)

    def links() -> None:
        items = [phrase(1, 3).translate(escape) for _ in range(pick.randint(2, 7))]
        each = "".join(f'<li><a href="/x">{i}</a></li>' for i in items)
        html.append(pick.choice(_LINKS).replace("{}", each))
        labels.extend([0] * len(items))

    for _ in range(pick.randint(0, 3)):
        pick.choice([links, lambda: frame(_TOPS, 1, 12), lambda: frame(_FRAMES, 2, 40)])()
    opening = pick.choice(_CONTENT).replace("{}", "")
    html.append(opening)
    for i, text in enumerate(main):
        if i and pick.random() < 0.12:
            pick.choice([links, lambda: frame(_FRAMES, 2, 40)])()
        head = i == 0 or len(text.split()) < 9 and pick.random() < 0.4
        kind = pick.choice(_HEADS if head else _MAIN)
        html.append(kind.replace("{t}", text.translate(escape)))
        labels.append(1)
    if pick.random() < 0.3:
        frame(_COMMENTS, 5, 60)
    html.append("</p>" + "".join(
        f"</{tag.split()[0].strip('<>')}>" for tag in reversed(opening.split("><"))
    ))
    for _ in range(pick.randint(0, 3)):
        frame(_COMMENTS, 5, 60)
    for _ in range(pick.randint(0, 2)):
        pick.choice([links, lambda: frame(_FRAMES, 2, 60)])()
    for _ in range(pick.randint(0, 2)):
        frame(_ENDS, 2, 20)
    html.append("</body></html>")
    return "".join(html), labels


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) >> (32 - SLOT_BITS)


def _own_names(node: Node) -> set[str]:
    return {f"has {node.tag}", *(f"name {part}" for part in node.names)}


def _place_names(node: Node) -> list[str]:
    """Features of the innermost element and its place; the root stands for none."""
    names = node.names
    above = node.parent.tag if node.parent else ""
    near = node.worked_out("near", (), lambda outer, n: n.names or outer)
    return [
        f"tag {node.tag}", f"tags {above} {node.tag}", f"depth {min(node.depth, 8)}",
        *(f"own {part}" for part in dict.fromkeys(names)),
        *(f"near {part}" for part in dict.fromkeys(near)),
    ]


def _more(seen: tuple[frozenset, ...], new: frozenset) -> tuple[frozenset, ...]:
    """Adds to sets of falling sizes, so that a deep path copies little."""
    while seen and len(seen[-1]) <= len(new):
        new, seen = new | seen[-1], seen[:-1]
    return (*seen, new)


def _seen(above: tuple, node: Node) -> tuple:
    """(names of all ancestors, those that this one adds)."""
    seen = above[0]
    new = frozenset(n for n in _own_names(node) if not any(n in s for s in seen))
    return (_more(seen, new) if new else seen), new


def path_slots(node: Node) -> list[int]:
    """Features of a block's ancestors."""
    seen = node.worked_out("seen", ((), frozenset()), _seen)[0]
    return [_slot(n) for n in [*(n for s in seen for n in s), *_place_names(node)]]


def text_slots(block: Block, place: int, count: int) -> list[int]:
    """Features of a block's text and place."""
    text = block.text
    words = text.split(" ")
    size = len(words).bit_length()
    share = 4 * block.linked // max(len(text), 1)
    end = text[-1] if text[-1] in ".!?:;," else "-"
    names = [
        "bias", f"size {size}", f"links {share}", f"end {end}",
        f"shape {size} {share} {end}", f"place {5 * place // count}",
        f"comma {',' in text}", "first" if place == 0 else "later",
        "last" if place == count - 1 else "earlier",
    ]
    if "©" in text:
        names.append("copyright")
    if len(words) <= 8:
        names += [f"word {w.lower()}" for w in words]
    return [_slot(n) for n in names]


@dataclass(frozen=True)
class Crf:
    """Score of label 1 over label 0 for each slot; scores of label pairs."""

    slots: np.ndarray
    values: np.ndarray
    start: tuple[float, float]
    moves: tuple[tuple[float, float], tuple[float, float]]

    def labeller(self):
        """A function blocks -> labels for one worker."""
        weight = dict(zip(self.slots.tolist(), self.values.tolist()))
        get = weight.get

        def worth(names) -> float:
            return sum(get(_slot(n), 0.0) for n in names)

        def names_worth(above: float, node: Node) -> float:
            node.worked_out("seen", ((), frozenset()), _seen)
            return above + worth(node.memo["seen"][1])

        def label(page: list[Block]) -> list[int]:
            emit = []
            for place, block in enumerate(page):
                node = block.node
                known = node.memo.get("worth")
                if known is None:
                    known = node.worked_out("names worth", 0.0, names_worth)
                    known = node.memo["worth"] = known + worth(_place_names(node))
                emit.append(
                    known + sum(get(s, 0.0) for s in text_slots(block, place, len(page)))
                )
            return viterbi(emit, self.start, self.moves)

        return label


def viterbi(emit: list[float], start, moves) -> list[int]:
    """Best labels; `emit` scores label 1, label 0 scores 0."""
    if not emit:
        return []
    zero, one = start[0], start[1] + emit[0]
    back: list[tuple[int, int]] = []
    (m00, m01), (m10, m11) = moves
    for score in emit[1:]:
        to_zero = int(one + m10 > zero + m00)
        to_one = int(one + m11 > zero + m01)
        zero, one = (
            (one + m10 if to_zero else zero + m00),
            (one + m11 if to_one else zero + m01) + score,
        )
        back.append((to_zero, to_one))
    labels = [int(one > zero)]
    for choice in reversed(back):
        labels.append(choice[labels[-1]])
    return labels[::-1]


def fit(pages: list[tuple[list[np.ndarray], np.ndarray]], epochs: int = EPOCHS) -> Crf:
    """Gradient steps (Adagrad) on the log likelihood, a page at a time.

    A page is a list of slot arrays, one per block, and its labels.
    """
    w = np.zeros(1 << SLOT_BITS)
    start, moves = np.zeros(2), np.zeros((2, 2))
    seen = np.full(1 << SLOT_BITS, 1e-2)
    seen_s, seen_m = np.full(2, 1e-2), np.full((2, 2), 1e-2)
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for i in order.permutation(len(pages)):
            slots, labels = pages[i]
            n = len(labels)
            emit = np.zeros((n, 2))
            emit[:, 1] = [w[s].sum() for s in slots]
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = start + emit[0]
            for t in range(1, n):
                forward[t] = emit[t] + np.logaddexp(
                    forward[t - 1, 0] + moves[0], forward[t - 1, 1] + moves[1]
                )
            for t in range(n - 2, -1, -1):
                after = emit[t + 1] + backward[t + 1]
                backward[t] = np.logaddexp(moves[:, 0] + after[0], moves[:, 1] + after[1])
            total = np.logaddexp(*forward[-1])
            single = np.exp(forward + backward - total)
            slope = single[:, 1] - labels
            for s, g in zip(slots, slope):
                step = g + DECAY * w[s]
                seen[s] += step * step
                w[s] -= RATE * step / np.sqrt(seen[s])
            step = single[0] - np.eye(2)[labels[0]]
            seen_s += step * step
            start -= RATE * step / np.sqrt(seen_s)
            if n > 1:
                pairs = np.exp(
                    forward[:-1, :, None] + moves
                    + (emit[1:] + backward[1:])[:, None, :] - total
                ).sum(axis=0)
                np.subtract.at(pairs, (labels[:-1], labels[1:]), 1)
                seen_m += pairs * pairs
                moves = moves - RATE * pairs / np.sqrt(seen_m)
    used = np.flatnonzero(w)
    return Crf(
        used, w[used], tuple(start.tolist()), tuple(map(tuple, moves.tolist()))
    )


def _sequence(page: list[Block]) -> list[np.ndarray]:
    return [
        np.array(path_slots(b.node) + text_slots(b, i, len(page)), np.int32)
        for i, b in enumerate(page)
    ]


def labelled_sequences(html: str | None, seed: int) -> list[tuple[list, list[int]]]:
    """A page labelled by its landmark, if it has one, and the same texts in other
    markups."""
    page = blocks(html)
    if not page:
        return []
    labels = landmark_labels(page)
    if labels and any(labels):
        found = [(_sequence(page), labels)]
    else:
        # In another markup any text may be the article's: long ones and half of the rest.
        pick = random.Random(seed)
        sizes = [len(b.text.split()) for b in page]
        labels = [int(n >= min(LONG_BLOCK, max(sizes)) or pick.random() < 0.5) for n in sizes]
        found = []
    main = [b.text for b, y in zip(page, labels) if y]
    other = [b.text for b, y in zip(page, labels) if not y]
    for n in range(VARIANTS):
        # Short articles too: some of the article's blocks, in order.
        pick = random.Random(f"{seed} {n}")
        few = [t for t in main if n % 2 or pick.random() < 0.3] or main[:1]
        again, marks = variant(few, other, seed * VARIANTS + n)
        parsed = blocks(again)
        if len(parsed) == len(marks):
            found.append((_sequence(parsed), marks))
    return found


def train(pages: DataFrame, rows: int = SAMPLE_PAGES) -> Crf:
    """Learn from at most `rows` pages: those with a landmark and of usual length
    first, then by a hash of page_id. Of rows with one page_id one is taken."""
    html = F.coalesce(F.col("html"), F.lit(""))
    fit_for = F.struct(
        (F.length(html) <= SAMPLE_CHARS).alias("usual"),
        html.rlike(_LANDMARK).alias("marked"),
        F.xxhash64("html").alias("hash"),
    )
    chosen = (
        pages.groupBy("page_id").agg(F.max(fit_for).alias("fit"))
        .orderBy(
            F.desc("fit.usual"), F.desc("fit.marked"), F.xxhash64("page_id", F.lit(3)), "page_id"
        )
        .limit(rows)
        .select(F.col("page_id").alias("chosen_id"), F.col("fit.hash").alias("chosen_hash"))
    )
    sample = (
        pages.select("page_id", "html")
        .join(
            F.broadcast(chosen),
            same(F.col("page_id"), F.col("chosen_id"))
            & (F.xxhash64("html") == F.col("chosen_hash")),
        )
        .groupBy("page_id").agg(F.min("html").alias("html"))
    )

    def run(ids: list, texts: list) -> list[list]:
        out_ids, slots, ends, marks = [], [], [], []
        for page_id, html in zip(ids, texts):
            for sequence, labels in labelled_sequences(html, page_id or 0):
                out_ids.append(page_id)
                slots.append(np.concatenate(sequence).tobytes())
                ends.append(np.cumsum([len(s) for s in sequence]).tolist())
                marks.append(labels)
        return [out_ids, slots, ends, marks]

    got = map_columns(
        sample.select("page_id", "html"),
        "page_id long, slots binary, ends array<int>, labels array<int>",
        run,
    ).orderBy("page_id", "slots").toArrow().to_pylist()
    return fit([
        (
            np.split(np.frombuffer(r["slots"], np.int32), r["ends"][:-1]),
            np.array(r["labels"]),
        )
        for r in got
    ])


def extract(pages: DataFrame, model: Crf) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_main) of every page, in one pass."""
    sent = pages.sparkSession.sparkContext.broadcast(model)
    cached: list = []

    def run(ids: list, urls: list, texts: list) -> list[list]:
        if not cached:
            cached.append(sent.value.labeller())
        out = [ids, urls, [], [], [], []]
        root, paths = Node(None, "", ()), 0
        for html in texts:
            page = blocks(html, root)
            labels = cached[0](page)
            paths += len(page)
            if paths > 100_000:  # long pages may have a path for each block
                root, paths = Node(None, "", ()), 0
            text = " ".join(b.text for b, y in zip(page, labels) if y)
            for column, value in zip(out[2:], (text, len(text), len(page), sum(labels))):
                column.append(value)
        return out

    return map_columns(
        pages.select("page_id", "url", "html"),
        "page_id long, url string, text string, n_chars long, n_blocks int, n_main int",
        run,
    )
