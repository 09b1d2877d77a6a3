"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, the runs of text between block-level tags, each below the node of
its innermost open element; nodes point to their parents and are shared by all blocks below them.
Features are the ancestors' names and the words of their class and id, the block's own tag, what
kind of text it is, what kind its neighbours and the other blocks of its container are, and the
words of the heading before it. The field has two labels (main or not), weights for features and
label pairs, is trained on the labelled pages of ``labelled_pages`` by gradient steps on the
regularised log-likelihood (forward-backward), and is decoded by Viterbi. Training is small and
runs where the query is planned; extraction is one Arrow pass, page by page, and takes time and
memory in proportion to a page's length, however it is nested or broken.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.llm.labelled_pages import MARK
from quillframe.llm.labelled_pages import pages as labelled_pages

#: Elements that begin and end blocks, that hold no element, and whose content is no markup.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset(["script", "style", "textarea", "iframe", "noembed", "noframes"])
#: Elements whose text isn't shown as text; a block tag ends the first of them.
HIDDEN_TAGS = frozenset(["svg", "template"])
#: Elements that tell which part of a page they are.
PARTS = frozenset("article aside footer form head header main nav section".split())
#: Parts whose blocks aren't taken for an article for want of another.
NO_MAIN = frozenset(["aside", "footer", "form", "nav"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
#: An open paragraph ends when one of these begins.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section summary table ul".split()
)
#: Elements without an end tag of their own: each ends the nearest open one of its kind.
KINDS = {"p": "p", "li": "li", "dt": "dt", "dd": "dt", "tr": "tr", "td": "td", "th": "td", "option": "option"}
#: An implied end doesn't reach beyond these; cells don't shield their row.
SCOPES = frozenset("ul ol dl table article aside body div footer form header html main nav section select td th".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_STOP = re.compile(r"""[>"']""")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
NAME_WORD = re.compile(r"[a-z]+")
WORD = re.compile(r"[^\W\d_]+")
#: Characters of attributes up to which their name words are kept for the next tag like it.
KEPT_ATTRIBUTES = 4096
#: How much less likely labels with a main block may be than labels without one.
DOUBT = 4.5
#: Characters up to which a text counts as a label, whose words are features.
LABEL = 30


def _names(attributes: str) -> tuple[str, ...]:
    return (_kept_names if len(attributes) <= KEPT_ATTRIBUTES else _kept_names.__wrapped__)(attributes)


@lru_cache(maxsize=4096)
def _kept_names(attributes: str) -> tuple[str, ...]:
    found = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower()
    return tuple(sorted(set(NAME_WORD.findall(found))))


class Node:
    """An open element: its parent, the nearest of ``PARTS`` that it is in, how deep it is, its features with all its ancestors', and, for each
    kind of element that ends others, how deep the nearest one is that may be ended from here."""

    __slots__ = ("parent", "tag", "depth", "found", "ends", "hidden", "part")

    def __init__(self, parent: Node | None, tag: str, names: tuple[str, ...], known: frozenset | None):
        self.parent, self.tag = parent, tag
        self.depth = parent.depth + 1 if parent else 0
        self.part = tag if tag in PARTS or parent is None else parent.part
        self.hidden = tag in HIDDEN_TAGS or parent is not None and parent.hidden
        own = [f"in {tag}", *(f"named {w}" for w in names)]
        before = parent.found if parent else frozenset()
        fresh = [f for f in own if f not in before and (known is None or f in known)]
        self.found = before.union(fresh) if fresh else before
        ends = parent.ends if parent else {}
        if tag in SCOPES:
            ends = {k: v for k, v in ends.items() if k in ("tr", "td")} if tag in ("td", "th") else {}
        kind = KINDS.get(tag)
        self.ends = ends | {kind: self.depth} if kind else ends


class Block:
    """A leaf block: the node it is in, its text, and how many of its characters are inside links."""

    __slots__ = ("node", "text", "linked")

    def __init__(self, node: Node, text: str, linked: int):
        self.node, self.text, self.linked = node, text, linked


def _tag_end(page: str, at: int, unpaired: set) -> int:
    """Where a tag that goes on at ``at`` has its ``>``; -1 if it has none. Quotes count after ``=``; one that
    is never closed counts for nothing (``unpaired`` keeps which those are, so that no page is searched twice)."""
    while m := TAG_STOP.search(page, at):
        k, c = m.start(), m[0]
        if c == ">":
            return k
        at = k + 1
        before = k - 1
        while before > 0 and page[before] in " \t\r\n":
            before -= 1
        if page[before] == "=" and c not in unpaired:
            closed = page.find(c, at)
            if closed < 0:
                unpaired.add(c)
            else:
                at = closed + 1
    return -1


def blocks(page: str, known: frozenset | None = None) -> list[Block]:
    """The leaf blocks of a page, in page order. With ``known``, nodes keep only features that are in it.

    Comments, declarations, scripts and the like, and text inside drawings and templates are no
    text; an unfinished tag at the end is dropped. Character references are decoded, white space
    becomes one space.
    """
    out: list[Block] = []
    node = root = Node(None, "", (), known)
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    linked = links_open = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(node, text, linked))
            parts.clear()
        linked = 0

    def close(depth: int) -> Node:
        """The node that is left when the elements from ``depth`` on are closed."""
        left = node
        while left.depth >= depth:
            open_tags[left.tag] -= 1
            left = left.parent
        return left

    def add(text: str) -> None:
        nonlocal linked
        if text and not node.hidden:
            parts.append(text)
            if links_open:
                linked += len(text)

    at, unpaired, raw_ends = 0, set(), {}
    while (lt := page.find("<", at)) >= 0:
        add(page[at:lt])
        after = page[lt + 1 : lt + 2]
        if after in ("!", "?"):
            if page.startswith("!--", lt + 1):
                end = page.find("-->", lt + 4)
                at = end + 3 if end >= 0 else len(page)
            else:
                end = page.find(">", lt)
                at = end + 1 if end >= 0 else len(page)
            continue
        ending = after == "/"
        m = NAME.match(page, lt + 1 + ending)
        if not m:
            add("<")
            at = lt + 1
            continue
        end = _tag_end(page, m.end(), unpaired)
        if end < 0:
            at = len(page)
            break
        name, at = m[0].lower(), end + 1
        if ending:
            if name == "a":
                links_open = 0
            if name in BLOCK_TAGS:
                flush()
            if open_tags[name] > 0:
                left = node
                while left.tag != name:
                    left = left.parent
                node = close(left.depth)
            continue
        if name == "br":
            add(" ")
        if name in BLOCK_TAGS:
            flush()
            if node.hidden and open_tags["svg"] > 0:
                left = node
                while left.tag != "svg":
                    left = left.parent
                node = close(left.depth)
            if name in ENDS_P and "p" in node.ends:
                node = close(node.ends["p"])
            kind = KINDS.get(name)
            if kind and kind != "p" and (kind in node.ends or name == "tr" and "td" in node.ends):
                node = close(node.ends.get(kind, node.ends.get("td")))
        if name in VOID_TAGS:
            continue
        if name in RAW_TAGS:
            if raw_ends.get(name) != -1:
                found = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
                raw_ends[name] = found.start() if found else -1
            if raw_ends[name] < 0:
                at = len(page)
                break
            end = _tag_end(page, raw_ends[name], unpaired)
            at = end + 1 if end >= 0 else len(page)
            continue
        if name == "a":
            links_open = 1
        if name in BLOCK_TAGS or name in HIDDEN_TAGS and page[end - 1] != "/":
            node = Node(node, name, _names(page[m.end() : end]), known)
            open_tags[name] += 1
    add(page[at:])
    flush()
    assert root.parent is None
    return out


def _long(block: Block) -> bool:
    """Whether a block reads like running text: some length, sentences, few links."""
    n = len(block.text)
    return n >= 80 and 3 * block.linked < n and sum(block.text.count(c) for c in ".!?。؟।") >= 1


def _label_words(text: str) -> frozenset[str]:
    return frozenset(WORD.findall(text.lower())) if len(text) <= LABEL else frozenset()


def features(found: list[Block]) -> list[list[str]]:
    """The features of each block of a page, apart from those of its node."""
    long = [_long(b) for b in found]
    # The container is what a paragraph, an item or a cell stands in.
    containers = [b.node.parent if b.node.parent is not None and b.node.tag in ("p", "li", "td", "th", "dt", "dd") or b.node.tag in HEADINGS else b.node for b in found]
    running = Counter(id(c) for c, x in zip(containers, long, strict=True) if x)
    linked = Counter()
    for c, b in zip(containers, found, strict=True):
        linked[id(c)] += 2 * b.linked > len(b.text)
    most = max(running.values(), default=0)
    # What bare blocks, one beside another, stand in.
    around = [b.node.parent or b.node for b in found]
    beside = Counter(id(c) for c, x in zip(around, long, strict=True) if x)
    out = []
    under: frozenset[str] = frozenset()
    heading: Node | None = None
    seen = 0
    for k, b in enumerate(found):
        n, share = len(b.text), b.linked / len(b.text)
        if b.node.tag in HEADINGS and b.node.tag != "h1":
            under, heading = _label_words(b.text), b.node.parent
        elif heading is not None and b.node.depth < heading.depth:
            under, heading = frozenset(), None  # outside what the heading heads
        here = running[id(containers[k])]
        seen += long[k]
        own = [
            "always",
            f"tag {b.node.tag}",
            f"part {b.node.part}",
            f"length {0 if n < 12 else 1 if n < 40 else 2 if n < 100 else 3}",
            f"links {0 if share < 0.1 else 1 if share < 0.6 else 2}",
            f"ends {int(b.text[-1] in '.!?:;。؟।')}",
            f"sign {int('©' in b.text or '|' in b.text)}",
            f"first {int(k == 0)}",
            f"long {int(long[k])}",
            f"before {int(k > 0 and long[k - 1])}",
            f"after {int(k + 1 < len(found) and long[k + 1])}",
            f"container {min(here, 3)}",
            f"beside {min(beside[id(around[k])], 3)}",
            f"richest {int(here == most and most > 0)}",
            f"menu {min(linked[id(containers[k])], 3)}",
            f"begun {int(seen - long[k] > 0)}",
        ]
        own += [f"under {w}" for w in under]
        own += [f"says {w}" for w in _label_words(b.text)]
        out.append(own)
    return out


class Field:
    """Weights by feature for label main against the other, and for label pairs (2 x 2)."""

    def __init__(self, weights: dict[str, float], pairs: list[list[float]]):
        self.weights, self.pairs = weights, pairs
        self.known = frozenset(weights)

    def decode(self, found: list[Block]) -> list[int]:
        """The most likely labels of a page's blocks; of equals, not main. Where that leaves no main block, the most likely
        labels with one are taken, if they are less likely by a factor of e to the ``DOUBT`` at most: a page
        has an article more often than not."""
        own: dict[frozenset, float] = {}
        get = self.weights.get
        scores = []
        for block, more in zip(found, features(found), strict=True):
            path = block.node.found
            if path not in own:
                own[path] = sum(get(f, 0.0) for f in sorted(path))
            scores.append(own[path] + sum([get(f, 0.0) for f in more]))
        labels, best, _ = self._viterbi(scores)
        if scores and not any(labels):
            # The best path through main at each place: what leads there and what follows.
            ahead, behind = self._viterbi(scores)[2], self._viterbi(scores[::-1], back=True)[2][::-1]
            through = [a + b - x for a, b, x in zip(ahead, behind, scores, strict=True)]
            able = [k for k, b in enumerate(found) if b.node.part not in NO_MAIN]
            k = max(able, key=through.__getitem__, default=-1)
            if k >= 0 and through[k] >= best - DOUBT:
                labels = self._viterbi(scores, k)[0]
        return labels

    def _viterbi(self, scores: list[float], main: int = -1, back: bool = False) -> tuple[list[int], float, list[float]]:
        """Labels, their score, and for each place the score of the best start that is main there. ``main`` is a place
        that must be main; ``back`` swaps the label pairs, for a page read from its end."""
        (stay0, to1), (to0, stay1) = self.pairs
        if back:
            to0, to1 = to1, to0
        zero, one, choices, ones = 0.0, 0.0, [], []
        for place, score in enumerate(scores):
            if not place:
                zero, one = 0.0, score
            else:
                from1_0, from0_1 = one + to0 > zero + stay0, zero + to1 >= one + stay1
                choices.append((from1_0, not from0_1))
                zero, one = (one + to0 if from1_0 else zero + stay0), (zero + to1 if from0_1 else one + stay1) + score
            if place == main:
                zero = float("-inf")
            ones.append(one)
        labels = [int(one > zero)] if scores else []
        for pair in reversed(choices):
            labels.append(int(pair[labels[-1]]))
        return labels[::-1], max(zero, one), ones

    def text(self, page: str | None) -> str:
        """The main blocks of a page, joined by one space."""
        found = blocks(page, self.known) if page else []
        return " ".join(b.text for b, label in zip(found, self.decode(found), strict=True) if label)


def main_labels(page: str) -> tuple[list[Block], list[int]]:
    """The blocks of a labelled page without its marks, and whether each is main."""
    labels = [int(b.text.startswith(MARK)) for b in blocks(page)]
    return blocks(page.replace(MARK, "")), labels


def train(pages: list[str] | None = None, steps: int = 200, rate: float = 0.4, ridge: float = 0.05) -> Field:
    """The field fitted to labelled pages, in which every main block begins with ``MARK``; without
    pages every block counts as main."""
    chains = []
    names: dict[str, int] = {}
    for page in labelled_pages() if pages is None else pages:
        found, labels = main_labels(page)
        rows = [[names.setdefault(f, len(names)) for f in (*sorted(b.node.found), *more)] for b, more in zip(found, features(found), strict=True)]
        if rows:
            chains.append((rows, np.array(labels)))
    if not chains:
        return Field({"always": 1.0}, [[0.0, 0.0], [0.0, 0.0]])
    return _fitted(chains, names, steps, rate, ridge)


def _fitted(chains: list[tuple[list[list[int]], np.ndarray]], names: dict[str, int], steps: int, rate: float, ridge: float) -> Field:
    """Weights by gradient steps on the log-likelihood of all pages at once (padded to the longest)."""
    size = np.array([len(y) for _, y in chains])
    pages, longest = len(chains), int(size.max())
    inside = np.arange(longest)[None, :] < size[:, None]
    y = np.zeros((pages, longest), int)
    y[inside] = np.concatenate([labels for _, labels in chains])
    rows = [r for own, _ in chains for r in own]
    feature = np.concatenate([np.array(r) for r in rows])
    owner = np.repeat(np.flatnonzero(inside.reshape(-1)), [len(r) for r in rows])
    both = inside[:, 1:] & inside[:, :-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
    w, pairs = np.zeros(len(names)), np.zeros((2, 2))
    # Words are many and each is seen little.
    shrink = np.array([ridge * (20 if f.startswith(("says ", "under ")) else 1) for f in names])
    # Steps of each weight shrink with its own past gradients.
    past_w, past_p = np.full(len(names), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(steps):
        e = np.zeros((pages, longest, 2))
        e[:, :, 1] = np.bincount(owner, w[feature], pages * longest).reshape(pages, longest)
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for k in range(1, longest):
            new = np.logaddexp.reduce(ahead[:, k - 1, :, None] + pairs, axis=1) + e[:, k]
            ahead[:, k] = np.where(inside[:, k, None], new, ahead[:, k - 1])
        for k in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(pairs + (e[:, k + 1] + behind[:, k + 1])[:, None, :], axis=2)
            behind[:, k] = np.where(inside[:, k + 1, None], new, 0.0)
        z = np.logaddexp.reduce(ahead[:, -1], axis=1)
        p = np.exp(ahead[:, :, 1] + behind[:, :, 1] - z[:, None])
        miss = np.where(inside, y - p, 0.0).reshape(-1)
        gw = np.bincount(feature, miss[owner], len(names)) - shrink * w
        expected = np.exp(ahead[:, :-1, :, None] + pairs + (e[:, 1:] + behind[:, 1:])[:, :, None, :] - z[:, None, None, None])
        gp = seen - expected[both].sum(axis=0) - ridge * pairs
        past_w += gw * gw
        past_p += gp * gp
        w += rate * gw / np.sqrt(past_w)
        pairs += rate * gp / np.sqrt(past_p)
    return Field({f: float(w[k]) for f, k in names.items()}, pairs.tolist())


def extract(
    pages: DataFrame, field: Field, id_col: str = "page_id", html_col: str = "html", keep: list[str] | None = None
) -> DataFrame:
    """For each row: ``id_col``, the columns named in ``keep``, and text, the page's main text.

    Null and empty pages, and pages without main blocks, have an empty text. Repeated rows stay;
    other columns are left out; an empty table gives an empty one.
    """
    columns = [id_col, *(keep or [])]
    schema = T.StructType([*pages.select(*columns).schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [field.text(x.as_py()) for x in batch.column(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(columns))), pa.array(out, pa.string())], names=schema.names
            )

    return pages.select(*columns, F.col(html_col).cast("string").alias("page read")).mapInArrow(run, schema)
