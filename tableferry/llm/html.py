"""Operator 8, main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

:func:`blocks` cuts a page into leaf blocks (text between block-level tags) with the tags, classes and ids above them.
:func:`fit` learns, by forward-backward and gradient ascent, weights of hashed features (ancestor tags and their names, parent,
text measures) and of label transitions from labelled pages. The pages of :func:`labelled_pages` are labelled by construction:
a generator writes articles among menus, notices, adverts, forms and comments in many layouts; any other labelled
sequences can be passed. :func:`extract` decodes each page by Viterbi on the executors.

Defined results: null or blank html and pages without a content block give an empty text; unclosed and stray tags are tolerated;
a line break inside a block is white space; repeated rows get equal texts; very long pages are read whole.
"""

from __future__ import annotations

import html as references
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.textkit import read_table

BITS = 14
PAGES = 600
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr br".split()) | frozenset(
    # Formulas and fallback text are part of the paragraph that they stand in.
    "object canvas math semantics annotation maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is raw text up to their end tag, or to the end of the page, and no text of the page.
RAW = frozenset("script style textarea title iframe noembed noframes".split())
#: Elements that are seldom content: nodes whose names are features. Without an end tag they are passed over.
ODD = frozenset("svg select noscript template".split())
_ODD = re.compile(rf"<(/?)({'|'.join(sorted(ODD))})\b", re.I)
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table div section article main aside nav header footer body form blockquote".split())

class Node:
    """An open block element below its parent. Equal paths of the pages of one tree are one node, so a path is never copied;
    ``inherited`` holds the distinct tags and names on it and is shared with the parent where an element adds none."""

    __slots__ = ("tag", "names", "parent", "below", "inherited")

    def __init__(self, tag: str = "", names: tuple[str, ...] = (), parent: Node | None = None):
        self.tag, self.names, self.parent = tag, names, parent
        self.below: dict[tuple[str, tuple[str, ...]], Node] = {}
        above = parent.inherited if parent else frozenset()
        own = {f"tag {tag}", *(f"name {y}" for y in names)} if parent else set()
        self.inherited: frozenset[str] = above if own <= above else above | own

    def child(self, tag: str, names: tuple[str, ...]) -> Node:
        found = self.below.get((tag, names))
        if found is None:
            found = self.below[tag, names] = Node(tag, names, self)
        return found

    def nearest(self, n: int) -> list[Node]:
        """The last ``n`` elements of the path, from the outermost."""
        out, at = [], self
        while at.parent is not None and len(out) < n:
            out.append(at)
            at = at.parent
        return out[::-1]


@dataclass
class Block:
    path: Node
    text: str
    linked: int  # characters inside links


class _Open:
    """The open elements, with the places of each tag, so that looking for one does not go through all of them."""

    def __init__(self, root: Node):
        self.root, self.stack, self.places, self.scopes = root, [], {}, []

    @property
    def node(self) -> Node:
        return self.stack[-1][1] if self.stack else self.root

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in _SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append((tag, self.node if tag in INLINE else self.node.child(tag, names)))

    def holds(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def in_scope(self, tag: str) -> bool:
        """Whether ``tag`` is open with no element of :data:`_SCOPE` inside it."""
        return self.holds(tag) and (not self.scopes or self.scopes[-1] <= self.places[tag][-1])

    def close(self, tag: str) -> None:
        """Close the innermost ``tag`` and all inside it; without one, nothing."""
        if not self.holds(tag):
            return
        first = self.places[tag][-1]
        while len(self.stack) > first:
            inner = self.stack.pop()[0]
            self.places[inner].pop()
            if inner in _SCOPE:
                self.scopes.pop()


def blocks(page: str, root: Node | None = None) -> list[Block]:
    """The leaf blocks in page order, character references decoded, white space joined; paths are nodes of the tree ``root``."""
    out: list[Block] = []
    open_ = _Open(root or Node())
    parts: list[str] = []
    linked, at, end = 0, 0, len(page)
    paired: set[int] = set()  # where elements of ODD with an end tag start
    open_odd: dict[str, list[int]] = {x: [] for x in ODD}
    for m in _ODD.finditer(page):
        starts = open_odd[m[2].lower()]
        if not m[1]:
            starts.append(m.start())
        elif starts:
            paired.add(starts.pop())

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                out.append(Block(open_.node, text, linked))
            parts.clear()
        linked = 0

    while at < end:
        tag = _TAG.search(page, at)
        text = page[at : tag.start() if tag else end]
        if text:
            parts.append(text)
            if open_.holds("a"):
                linked += len(text)
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:
            if name not in INLINE:
                flush()
            open_.close(name)
            continue
        if name == "br":
            parts.append(" ")
        if name in RAW:
            if not tag[3].rstrip().endswith("/"):
                over = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = over.end() if over else end
            continue
        if name not in INLINE:
            flush()
            for other in ("p", *_CLOSES.get(name, ())):
                if open_.in_scope(other):
                    open_.close(other)
        if name not in VOID and (name not in ODD or tag.start() in paired) and not (name in ODD and tag[3].rstrip().endswith("/")):
            names = _NAME.findall(" ".join(filter(None, (y for x in _NAMES.findall(tag[3]) for y in x))).lower()) if tag[3] else ()
            open_.push(name, tuple(names))
    flush()
    return out


def _hash(name: str, bits: int) -> int:
    return zlib.crc32(name.encode()) & ((1 << bits) - 1)


def path_features(path: Node, bits: int = BITS) -> list[int]:
    """Ancestor tags, their names (class, id, role), parent and grandparent."""
    near = path.nearest(3)
    tags = [x.tag for x in near]
    found = path.inherited | {f"parent {tags[-1] if tags else ''}", f"above {'/'.join(tags[-2:])}"}
    found |= {f"near {x.tag} {y}" for x in near for y in x.names}
    return sorted({_hash(x, bits) for x in found})


def text_features(block: Block, at: int, n: int, bits: int = BITS) -> list[int]:
    """Length, link share, sentence marks, digits and place of the block."""
    text = block.text
    size = len(text)
    found = [
        "always", f"size {min(size.bit_length(), 12)}", f"links {round(4 * min(1.0, block.linked / size))}", f"stops {min(3, text.count('. ') + text.endswith(('.', '!', '?')))}",
        f"commas {min(3, text.count(','))}", f"place {4 * at // max(1, n)}", f"words {min(6, (text.count(' ') + 1).bit_length())}",
    ]
    found += ["rights"] * ("©" in text or "(c)" in text[:40].lower()) + ["bar"] * ("|" in text) + ["digits"] * (sum(c.isdigit() for c in text[:80]) > 8) + ["first"] * (at == 0) + ["last"] * (at == n - 1)
    return [_hash(f"text {x}", bits) for x in found]


def page_features(page: list[Block], known: dict[Node, list[int]], bits: int = BITS) -> list[list[int]]:
    out = []
    for i, block in enumerate(page):
        above = known.get(block.path)
        if above is None:
            above = known[block.path] = path_features(block.path, bits)
        out.append(above + text_features(block, i, len(page), bits))
    return out


@dataclass(frozen=True)
class Crf:
    weights: np.ndarray  # features: score of "content" against "other"
    moves: np.ndarray  # 2 x 2: from label to label
    bits: int

    def decode(self, found: list[list[int]]) -> list[bool]:
        """The best labelling (Viterbi)."""
        if not found:
            return []
        (a, b), (c, d) = self.moves.tolist()
        score = [float(self.weights[x].sum()) for x in found]
        other, content, back = 0.0, score[0], []
        for s in score[1:]:
            back.append((content + c > other + a, content + d >= other + b))  # whether each label is best reached from content
            other, content = max(other + a, content + c), max(other + b, content + d) + s
        labels = [content > other]
        for before in reversed(back):
            labels.append(before[labels[-1]])
        return labels[::-1]


def fit(pages: list[tuple[list[list[int]], list[bool]]], bits: int = BITS, rounds: int = 12, rate: float = 0.5, penalty: float = 1e-4, seed: int = 7) -> Crf:
    """Weights that raise the log-likelihood of the labelled sequences (features of each block, content or not)."""
    w, moves = np.zeros(1 << bits), np.zeros((2, 2))
    seen_w, seen_m, order = np.full(1 << bits, 1e-6), np.full((2, 2), 1e-6), random.Random(seed)
    pages = [x for x in pages if x[0]]
    for _ in range(rounds):
        order.shuffle(pages)
        for found, truth in pages:
            n = len(found)
            score = np.zeros((n, 2))
            score[:, 1] = [w[x].sum() for x in found]
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = score[0]
            for i in range(1, n):
                ahead[i] = np.logaddexp(ahead[i - 1, 0] + moves[0], ahead[i - 1, 1] + moves[1]) + score[i]
            for i in range(n - 2, -1, -1):
                nxt = score[i + 1] + behind[i + 1]
                behind[i] = np.logaddexp(moves[:, 0] + nxt[0], moves[:, 1] + nxt[1])
            total = np.logaddexp(*ahead[-1])
            label = np.array(truth, float)
            slope = label - np.exp(ahead[:, 1] + behind[:, 1] - total)
            at, step = np.concatenate(found), np.repeat(slope, [len(x) for x in found])
            g = np.bincount(at, step, 1 << bits) - penalty * w
            seen_w += g**2
            w += rate * g / np.sqrt(seen_w)
            if n > 1:
                pair = np.exp(ahead[:-1, :, None] + moves[None] + (score[1:] + behind[1:])[:, None, :] - total).sum(axis=0)
                real = np.zeros((2, 2))
                np.add.at(real, (label[:-1].astype(int), label[1:].astype(int)), 1)
                g = real - pair - penalty * moves
                seen_m += g**2
                moves += rate * g / np.sqrt(seen_m)
    return Crf(w, moves, bits)


def labelled_pages(count: int = PAGES, seed: int = 11) -> Iterator[tuple[str, list[bool]]]:
    """(html, label of each block): invented pages; the label of a block is known when it is written."""
    r = random.Random(seed)
    syllables = "an be con der ent fa gi ho in jo ka lo mi nu or pe qui ra so ti un va wo ze".split()

    def words(low: int, high: int) -> str:
        return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def prose(low: int = 4, high: int = 60) -> str:
        return ". ".join(words(3, 14).capitalize() for _ in range(r.randint(1, max(1, high // 12)))) + r.choice([".", ".", ".", "!", "?", ""]) if high > 12 else words(low, high)

    def tagged(tag: str, names: str, inner: str) -> str:
        kind = r.choice(["class", "class", "id"])
        return f'<{tag} {kind}="{names}">{inner}</{tag}>' if names else f"<{tag}>{inner}</{tag}>"

    for _ in range(count):
        labels: list[bool] = []

        def block(tag: str, text: str, content: bool, names: str = "") -> str:
            labels.append(content)
            if content and r.random() < 0.15:  # tags that are never closed
                return f"<{tag}><b>{text}<br>" if tag == "p" else tagged(tag, names, text)
            if r.random() < 0.1:
                text = f"<{(x := r.choice(['b', 'i', 'em', 'span', 'strong']))}>{text}</{x}>"
            return tagged(tag, names, text)

        def links(n: int) -> str:
            return "".join(block("li", f'<a href="/{words(1, 1)}">{words(1, 3)}</a>', False) for _ in range(n))

        def prose_list(content: bool) -> str:
            return "".join(block("li", prose(3, 30), content) for _ in range(r.randint(2, 5)))

        def noise(where: str) -> str:
            kind = r.choice(where.split())
            if kind == "nav":
                inner = f"<ul>{links(r.randint(2, 7))}</ul>"
                return f"<nav>{inner}</nav>" if r.random() < 0.5 else tagged("div", r.choice(["menu", "nav", "navbar", "breadcrumb", "main-menu", "topnav", "pagination", "toc"]), inner)
            if kind == "header":
                return tagged("header", r.choice(["", "site-header", "masthead", "top"]), block(r.choice(["div", "h1", "p"]), words(1, 6), False, r.choice(["logo", "brand", "tagline", ""])))
            if kind == "ad":
                return block(r.choice(["div", "div", "aside", "section", "p"]), prose(), False, r.choice(["ad", "ad", "ads", "advert", "sponsored", "promo", "banner", "ad-box", "advertisement"]))
            if kind == "notice":
                return tagged(r.choice(["div", "section"]), r.choice(["cookie-notice", "notice", "consent", "cookie-banner", "alert", "gdpr", "newsletter", "subscribe", "popup", "modal"]), "".join(block("p", prose(), False) for _ in range(r.randint(1, 2))))
            if kind == "sidebar":
                return tagged(r.choice(["aside", "aside", "div"]), r.choice(["sidebar", "side", "related", "widget", "rail", "recommended", "share", "social", "sidebar"]), block("h3", words(1, 3), False) + (f"<ul>{links(r.randint(2, 5))}</ul>" if r.random() < 0.6 else block("p", prose(), False)))
            if kind == "plain":
                return f"<aside>{block('p', prose(), False)}</aside>"
            if kind == "form":
                return f"<form>{block(r.choice(['p', 'div', 'legend']), prose(2, 20), False)}<input type=text><select>{block('option', words(1, 2), False)}</select>{block('div', f'<button>{words(1, 2)}</button>', False)}</form>"
            if kind == "hidden":
                tag = r.choice(["noscript", "template", "svg"])
                return f"<{tag}>{block('text' if tag == 'svg' else r.choice(['p', 'div']), prose(2, 20), False)}</{tag}>"
            if kind == "footer":
                return tagged("footer", r.choice(["", "", "site-footer", "footer"]), "".join(block(r.choice(["p", "div"]), r.choice(["&copy; " + words(1, 3) + " &middot; " + prose(), prose(), words(2, 6)]), False) for _ in range(r.randint(1, 3))))
            said = "".join(tagged(r.choice(["div", "li", "article"]), r.choice(["comment", "reply", "comment-body", "comment"]), (block("p", words(1, 3), False, "author") if r.random() < 0.5 else "") + block("p", prose(), False)) for _ in range(r.randint(1, 5)))
            return tagged(r.choice(["section", "div", "ol"]), r.choice(["comments", "comments", "responses", "discussion", "replies", "comment-list"]), (block("h3", words(1, 2), False) if r.random() < 0.5 else "") + said)

        def article() -> str:
            out = [block(r.choice(["h1", "h1", "h2"]), prose(2, 14), True)] if r.random() < 0.9 else []
            for _ in range(r.randint(1, 14)):
                kind = r.random()
                if kind < 0.7:
                    out.append(block("p", prose(3, 90), True))
                elif kind < 0.78:
                    out.append(block(r.choice(["h2", "h3", "h4"]), words(1, 8), True))
                elif kind < 0.84:
                    out.append(f"<{(x := r.choice(['ul', 'ol']))}>{prose_list(True)}</{x}>")
                elif kind < 0.88:
                    out.append(f"<blockquote>{block('p', prose(), True)}</blockquote>")
                elif kind < 0.9:
                    out.append(block("pre", prose(), True))
                elif kind < 0.92:
                    out.append("<table><tr>" + "".join(block("td", words(1, 5), True) for _ in range(r.randint(2, 4))) + "</tr></table>")
                elif kind < 0.94:
                    out.append(f"<figure><img src=x>{block('figcaption', prose(), True)}</figure>")
                else:
                    out.append(noise("ad sidebar notice nav plain form hidden"))
            inner = "".join(out)
            if r.random() < 0.2:
                inner = tagged("div", r.choice(["content", "post-body", "entry-content", "article-body", "text", "body"]), inner)
            tail = noise("comments") if r.random() < 0.15 else ""
            kind = r.random()
            if kind < 0.6:
                return f"<article>{inner}{tail}</article>"
            if kind < 0.75:
                return tagged("main", r.choice(["", "content", "main"]), inner + tail)
            if kind < 0.85:
                return f"<main><article>{inner}</article>{tail}</main>"
            return tagged("div", r.choice(["content", "main-content", "post", "entry", "article", "story", "main", "article-content"]), inner) + tail

        parts = ["".join(noise("nav nav header ad notice hidden") for _ in range(r.randint(0, 4)))]
        if r.random() < 0.97:
            parts.append(article())
        parts.append("".join(noise("ad sidebar comments form nav notice") for _ in range(r.randint(0, 3))))
        if r.random() < 0.8:
            parts.append(noise("footer"))
        inner = "".join(parts)
        if r.random() < 0.3:
            inner = tagged("div", r.choice(["wrapper", "page", "container", "site"]), inner)
        yield f'<!DOCTYPE html><html><head><title>{words(1, 5)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>{inner}</body></html>', labels


def learn(count: int = PAGES) -> Crf:
    """The field of the invented pages; pages whose blocks don't match their labels would be a fault of the generator."""
    known: dict[Node, list[int]] = {}
    root, pages = Node(), []
    for page, labels in labelled_pages(count):
        found = blocks(page, root)
        if len(found) != len(labels):
            raise ValueError(f"{len(found)} blocks for {len(labels)} labels")
        pages.append((page_features(found, known), labels))
    return fit(pages)


def extract(pages: DataFrame, model: Crf, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns, text: the content blocks joined by an empty line, and blocks: how many there are."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    named = pages.select(*keep, F.col(html).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, known = Node(), {}
        for batch in batches:
            texts, counts = [], []
            for page in batch.column(batch.num_columns - 1).to_pylist():
                if len(known) > 50_000:
                    known.clear()
                    root = Node()
                found = blocks(page or "", root)
                kept = [x.text for x, good in zip(found, shared.value.decode(page_features(found, known, shared.value.bits)), strict=True) if good]
                texts.append("\n\n".join(kept))
                counts.append(len(kept))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(counts, pa.int32())], [*batch.schema.names[:-1], "text", "blocks"])

    return named.mapInArrow(run, f"{schema}{', ' if schema else ''}text string, blocks int")


def q_op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), learn(), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
