"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between tags that begin or end a block.  Each block has
features of its ancestors (tags, words of class and id) and of its text (length, links, punctuation,
place).  The field scores a block as main text or not and the change between neighbours; the Viterbi
path over the whole page decides, and the blocks it marks are the text, in page order.

It is trained on labelled pages: a bounded sample of given pages whose markup tells the article
(``article`` or ``main``), and pages made from their blocks under other containers, with the parts
that pages have around and within an article.  Weights are fitted by gradient ascent on the
conditional likelihood, forwards and backwards over all training pages at once.

Defined results: a null or empty page, and one without main text, has an empty text; broken markup is
read as browsers do in spirit (open elements end with the page, a paragraph ends the one before);
null ids stay null; repeated rows are read one by one; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.batches import map_slices
from tablecheck.llm.sampling import least

#: Elements that stand within a line, have no content, or hold no markup.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr "
    "annotation annotation-xml math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: An open element that a new one of the same kind ends.
ENDS_ITSELF = frozenset("p li dt dd tr td th option".split())
#: Raw elements and others whose text is never shown as part of a page.
HIDDEN = frozenset("script style textarea title iframe noembed noframes xmp head template select option svg object annotation annotation-xml".split())
#: Elements that leave an open head open; any other ends it, and so does text.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL,
)
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


class Block(NamedTuple):
    """Text with white space joined, the elements around it, and its share of link text.

    ``score`` is what the elements around it weigh, where weights were given in place of a path.
    """

    text: str
    path: tuple[tuple[str, str], ...]
    linked: float
    score: float = 0.0


class _Open:
    """The elements that are open, with what depends on them kept up to date.

    Opening and closing cost what the element itself has, however deep it lies.  With ``weights`` the
    weight of the features around a block is kept as a sum, each feature once.
    """

    def __init__(self, weights: dict[str, float] | None):
        self.weights, self.score = weights, 0.0
        self.stack: list[tuple[str, str]] = []
        self.outer: list[tuple[str, str]] = []
        self.names: dict[str, int] = {}
        self.features: dict[str, int] = {}
        self.hidden = 0

    def push(self, name: str, words: str) -> None:
        self.stack.append((name, words))
        self.names[name] = self.names.get(name, 0) + 1
        self.hidden += name in HIDDEN
        if name not in INLINE:
            self.outer.append((name, words))
            self._weigh(name, words, 1)

    def cut(self, i: int) -> None:
        """Close all elements from the i-th on."""
        while len(self.stack) > i:
            name, words = self.stack.pop()
            self.names[name] -= 1
            self.hidden -= name in HIDDEN
            if name not in INLINE:
                self.outer.pop()
                self._weigh(name, words, -1)

    def _weigh(self, name: str, words: str, step: int) -> None:
        if self.weights is None:
            return
        for feature in element_features(name, words):
            n = self.features.get(feature, 0)
            self.features[feature] = n + step
            if n + step == (step > 0):
                self.score += step * self.weights.get(feature, 0.0)
        if not self.outer:
            self.score = 0.0  # nothing is left of rounding

    def block(self, text: str, linked: float) -> Block:
        if self.weights is None:
            return Block(text, tuple(self.outer), linked)
        last = self.weights.get(f"at {self.outer[-1][0]}", 0.0) if self.outer else 0.0
        return Block(text, (), linked, self.weights.get("bias", 0.0) + self.score + last)


def leaf_blocks(page: str, weights: dict[str, float] | None = None) -> list[Block]:
    """The blocks of a page in order; text of scripts, styles and the like is left out."""
    out: list[Block] = []
    now = _Open(weights)
    stack, opened = now.stack, now.names
    texts: list[str] = []
    linked = [0]

    def flush() -> None:
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                out.append(now.block(text, min(1.0, linked[0] / len(text))))
            texts.clear()
            linked[0] = 0

    def end_head() -> None:
        if opened.get("head"):
            names = [tag for tag, _ in stack]
            if not set(names[names.index("head") :]) - {"head", "noscript"}:
                now.cut(names.index("head"))

    def add(raw: str) -> None:
        if raw.strip(" \t\n\f\r"):
            end_head()
        if raw and not now.hidden:
            text = entities.unescape(raw) if "&" in raw else raw
            texts.append(text)
            if opened.get("a"):
                linked[0] += len(text.strip())

    at = 0
    while True:
        found = _TAG.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            if name not in INLINE:
                flush()
            for i in range(len(stack) - 1 if opened.get(name) else -1, -1, -1):
                if stack[i][0] == name:
                    now.cut(i)
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if name == "head" and len(stack) > opened.get("html", 0):
            continue  # a second one, or one within the body, is none
        if name not in IN_HEAD:
            end_head()
        if name == "br":
            texts.append(" ")
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        attributes = found[3] if found[2] else found[6]
        words = " ".join(m[2] or m[3] or m[4] or "" for m in _NAME.finditer(attributes)) if attributes else ""
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(page, at)
            at = close.start() if close else len(page)
            now.push(name, words)
            continue
        if name in ENDS_ITSELF:
            for i in range(len(stack) - 1 if opened.get(name) else -1, -1, -1):
                if stack[i][0] == name:
                    now.cut(i)
                    break
                if stack[i][0] not in INLINE and stack[i][0] not in ENDS_ITSELF:
                    break
        if not attributes or not attributes.endswith("/"):
            now.push(name, words)
    flush()
    return out


#: Words in class and id names, by what they hint at.
HINTS = {
    "main": "article content main post entry story body text",
    "comment": "comment comments reply replies discussion disqus respond thread",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pager pagination tabs toc",
    "edge": "header footer masthead copyright colophon topbar bottom legal",
    "side": "sidebar aside side widget related recommended popular share social tags meta",
    "advert": "ad ads advert advertisement sponsor sponsored promo banner",
    "notice": "cookie cookies consent notice alert modal popup newsletter subscribe signup gdpr",
    "form": "form login search register contact input",
}
_HINT = {word: hint for hint, words in HINTS.items() for word in words.split()}


def element_features(tag: str, names: str) -> list[str]:
    """What an element tells of the blocks in it, each once."""
    words = set(_WORD.findall(names.lower()))
    hints = {_HINT[word] for word in words if word in _HINT}
    return [f"in {tag}", *(f"name {word}" for word in words), *(f"hint {hint}" for hint in hints)]


def path_features(path: tuple[tuple[str, str], ...]) -> list[str]:
    out = {"bias"}
    for tag, names in path:
        out.update(element_features(tag, names))
    if path:
        out.add(f"at {path[-1][0]}")
    return sorted(out)


def text_features(block: Block, place: int, total: int) -> list[str]:
    n = len(block.text.split())
    return [
        f"words {min(6, n.bit_length())}",
        f"linked {int(block.linked * 3.99)}",
        f"ends {block.text[-1] in '.!?…:;\"'}",
        f"place {min(3, 4 * place // max(1, total))}",
        f"sign {block.text[0] in '©®™'}",
    ]


class Field:
    """Weights: of features for main text against other text, and of neighbours."""

    def __init__(self, weights: dict[str, float], start: np.ndarray, change: np.ndarray):
        self.weights, self.start, self.change = weights, start.tolist(), change.tolist()

    def marks(self, blocks: list[Block]) -> list[bool]:
        """The best sequence of marks by Viterbi, for blocks that were weighed."""
        if not blocks:
            return []
        get, change = self.weights.get, self.change
        other, main = self.start
        back: list[tuple[bool, bool]] = []
        for i, block in enumerate(blocks):
            score = block.score + sum(get(f, 0.0) for f in text_features(block, i, len(blocks)))
            if i:
                to_other = (other + change[0][0], main + change[1][0])
                to_main = (other + change[0][1], main + change[1][1])
                back.append((to_other[1] > to_other[0], to_main[1] > to_main[0]))
                other, main = max(to_other), max(to_main)
            main += score
        marks = [main > other]
        for choice in reversed(back):
            marks.append(choice[marks[-1]])
        return marks[::-1]

    def text(self, page: str) -> str:
        blocks = leaf_blocks(page, self.weights)
        return "\n".join(b.text for b, mark in zip(blocks, self.marks(blocks)) if mark)


def labelled(page: str) -> list[tuple[Block, bool]] | None:
    """Blocks of a page whose markup tells its article; None where it doesn't."""
    blocks = leaf_blocks(page)
    apart = {"nav", "footer", "aside", "form", "header"}
    tags = [{t for t, _ in b.path} for b in blocks]
    marks = [bool(t & {"article", "main"}) and not t & apart for t in tags]
    return list(zip(blocks, marks)) if any(marks) else None


def _made(page: list[tuple[Block, bool]], rng: np.random.Generator) -> list[tuple[Block, bool]]:
    """The blocks of a labelled page under other containers, with what else pages hold."""
    pick = lambda *x: x[rng.integers(len(x))]
    prose = [b.text for b, mark in page if mark] or ["text"]
    menu = [b.text for b, mark in page if not mark] or ["menu"]
    some = lambda pool, n: [pool[rng.integers(len(pool))] for _ in range(n)]
    outer = (("html", ""), ("body", ""))
    wrap = pick((), (("div", "wrapper"),), (("div", "page"), ("div", "container")))
    main = pick(
        (("article", ""),), (("main", ""),), (("main", ""), ("article", "post")), (("div", "content"),),
        (("div", "post-body entry-content"),), (("section", "main-content"),), (("div", "article-text"),), (("div", "story"),),
    )
    out: list[tuple[Block, bool]] = []

    def put(texts: list[str], path: tuple, mark: bool, linked: float = 0.0) -> None:
        out.extend((Block(t, outer + path, linked), mark) for t in texts)

    def around(place: str) -> None:
        kinds = {
            "top": [((("header", "site-header"), ("div", "logo")), 0.5), ((("nav", "menu"), ("ul", ""), ("li", "")), 1.0), ((("div", "cookie-notice"), ("p", "")), 0.1), ((("div", "top-banner ad"), ("p", "")), 0.3), ((("form", "search"), ("div", "")), 0.0)],
            "bottom": [((("footer", ""), ("p", "")), 0.2), ((("aside", "sidebar"), ("p", "")), 0.3), ((("aside", "related"), ("ul", ""), ("li", "")), 1.0), ((("section", "comments"), ("div", "comment"), ("p", "")), 0.0), ((("div", "newsletter"), ("p", "")), 0.0), ((("div", "footer legal"), ("p", "")), 0.2), ((("form", "contact"), ("p", "")), 0.0), ((("div", "sidebar widget"), ("div", "")), 0.5), ((("div", "ad"),), 0.0)],
        }[place]
        for k in rng.permutation(len(kinds))[: rng.integers(1, 4)]:
            path, linked = kinds[k]
            put(some(menu if linked > 0.4 else prose + menu, int(rng.integers(1, 5))), wrap + path, False, linked)

    around("top")
    for i, text in enumerate(prose):
        put([text], wrap + main + pick((("p", ""),), (("p", ""),), (("h1", ""),) if not i else (("h2", ""),), (("blockquote", ""), ("p", "")), (("ul", ""), ("li", "")), (("pre", ""),), ()), True)
        if rng.random() < 0.08:
            inner = pick((("div", "ad"),), (("aside", "related"), ("p", "")), (("div", "share social"),), (("section", "comments"), ("p", "")), (("div", "newsletter-signup"), ("form", "")))
            put(some(prose + menu, 1), wrap + main + inner, False)
    if rng.random() < 0.3:
        put(some(prose, int(rng.integers(1, 4))), wrap + main + (("div", "comments"), ("p", "")), False)
    around("bottom")
    return out


#: Blocks of a training page at most; longer ones only train nothing.
LONGEST = 120


def train(pages: list[str], made: int = 2, rounds: int = 80, seed: int = 3) -> Field:
    """Fit the field on labelled pages and ``made`` further ones from the blocks of each."""
    rng = np.random.default_rng(seed)
    known = [p for p in map(labelled, pages) if p and len(p) <= LONGEST]
    known += [[(Block(f"A sentence of page {i}.", (("body", ""), ("p", "")), 0.0), True), (Block("Menu", (("body", ""), ("nav", "")), 1.0), False)] for i in range(8)]
    sequences = [*known, *(_made(p, rng) for p in known for _ in range(made))]
    names: dict[str, int] = {}
    flat, owner, truth = [], [], np.full((len(sequences), max(map(len, sequences))), -1)
    place = 0
    for s, sequence in enumerate(sequences):
        for i, (block, mark) in enumerate(sequence):
            for feature in [*path_features(block.path), *text_features(block, i, len(sequence))]:
                flat.append(names.setdefault(feature, len(names)))
                owner.append(place)
            truth[s, i] = mark
            place += 1
    flat, owner = np.array(flat), np.array(owner)
    there = truth >= 0
    pages_n, most = truth.shape
    last = there.sum(axis=1) - 1
    weights, start, change = np.zeros(len(names)), np.zeros(2), np.zeros((2, 2))
    squares = [np.full_like(x, 1e-8) for x in (weights, start, change)]
    pair = there[:, 1:]
    want_change = np.array([[((truth[:, :-1] == a) & (truth[:, 1:] == b) & pair).sum() for b in (0, 1)] for a in (0, 1)])
    want_start = np.array([(truth[:, 0] == a).sum() for a in (0, 1)])
    want = np.bincount(flat, weights=(truth[there] == 1).astype(float)[owner], minlength=len(names))
    total = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for _ in range(rounds):
        emit = np.zeros((pages_n, most, 2))
        emit[..., 1][there] = np.bincount(owner, weights=weights[flat], minlength=place)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = start + emit[:, 0]
        for i in range(1, most):
            ahead[:, i] = total(ahead[:, i - 1, :, None] + change, 1) + emit[:, i]
        for i in range(most - 2, -1, -1):
            step = total(change + (emit[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
            behind[:, i] = np.where((i < last)[:, None], step, 0.0)
        norm = total(ahead[np.arange(pages_n), last], 1)
        single = np.exp(ahead + behind - norm[:, None, None])
        double = np.exp(ahead[:, :-1, :, None] + change + (emit + behind)[:, 1:, None, :] - norm[:, None, None, None])
        slopes = (
            want - np.bincount(flat, weights=single[..., 1][there][owner], minlength=len(names)) - 0.5 * weights,
            want_start - single[:, 0].sum(axis=0) - 0.5 * start,
            want_change - double[pair].sum(axis=0) - 0.5 * change,
        )
        for value, slope, square in zip((weights, start, change), slopes, squares):
            square += slope**2
            value += 0.5 * slope / np.sqrt(square)
    return Field(dict(zip(names, weights.tolist())), start, change)


#: Pages of the training sample; the only bound, on labelled rows alone.
TRAINING_PAGES = 120


def fitted(df: DataFrame, key: str = "page_id", page: str = "html", sample: int = TRAINING_PAGES) -> Field:
    """A field trained on up to ``sample`` pages, those of least hash."""
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{page}`").cast("string").alias("page"))
    rows = rows.where("page is not null and length(page) < 100000")
    return train([r.page for r in least(rows, F.xxhash64("id", "page"), sample).collect()])


def main_text(df: DataFrame, field: Field | None = None, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    field = field or fitted(df, key, page)
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{page}`").cast("string"), F.lit("")).alias("page"),
    )
    parameters = (field.weights, np.array(field.start), np.array(field.change))

    def make():
        local = Field(*parameters)

        def step(piece: pa.RecordBatch) -> pa.RecordBatch:
            texts = [local.text(p) for p in piece.column(2).to_pylist()]
            return pa.record_batch(
                [piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

        return step

    return map_slices(rows, make, "page_id long, url string, text string, n_chars long")
