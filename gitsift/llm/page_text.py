"""Main text of web pages: the maximum-scoring subsequence of their words and tags.

Words score positive and tags negative. How much depends on the element they stand in
and is learned from labelled pages: those whose markup says with ``article`` or ``main``
where the text is. The markers themselves are not features, so the weights also serve
pages that lack them. Learning counts, over all labelled pages, each feature inside and
outside the text; the features are bounded by the element names, so the sums are small.
One linear scan then finds the contiguous region of largest sum. Elements that are never
text (menus, forms, scripts, adverts, comments...) are cut out of the region, so what is
inside them scores nothing: an advert must not part an article from its last lines.

Which elements these are is learned too. Every word of a class, id or role is counted with
the words that stand below it, inside and outside the text of labelled pages; one that
stands outside by ``HOLE`` or more (log odds) is cut out. So are those of a fixed list:
labelled pages cannot teach what stands inside their text without belonging to it, as an
advert in an article. The list is asked for whole words, or words made of its words alone
(``cookie-notice``, but not ``with-sidebar``). At most ``MAX_MARKS`` marks are remembered,
those with most words below them. Hidden are elements by the attribute ``hidden``, by their
style or by ``aria-hidden``.

* null or empty html: empty text. Repeated rows and null page_ids: rows like others.
* broken markup: end tags may be missing or wrong, a page may stop anywhere. A tag whose
  quote or bracket never ends is text up to the next tag.
* very long pages are taken whole, in time proportional to their length, however broken
  or deep they are. Further columns, whatever their names, are not looked at.
* ties: of regions with equal sums the first, and of those the shortest.
* no labelled page in the table: the weights are those of ``UNSEEN``, the marks those of the
  list. An empty table gives no rows.
"""

from __future__ import annotations

import html as html_module
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitsift.llm.common import map_batches
from gitsift.session import materialise

# Elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby "
    "rb rp rt s samp small span strike strong sub sup time tt u var wbr br".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Start tags that end an open element of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select body html article main".split())
#: Elements whose content is never main text.
NEVER = frozenset(
    "head nav footer aside form menu noscript template button select option svg canvas audio "
    "video dialog".split()) | RAW
#: Words of class, id or role that mark such content, whatever has been learned.
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner menu nav navbar navigation breadcrumb breadcrumbs sidebar aside header masthead footer "
    "comment comments commentlist discussion disqus reply replies cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations widget toolbar pagination pager search "
    "complementary contentinfo form".split())
#: Elements that mark the text itself.
MARKERS = frozenset({"article", "main"})
#: Scores of features that no labelled page has.
UNSEEN = {"word": 1.0, "block": -0.5, "inline": -0.05}
#: Scores stay within these.
MOST, LEAST_TAG = 3.0, -0.02
#: Log odds from which on a mark stands for what is not text.
HOLE = -1.0
#: Marks that are remembered.
MAX_MARKS = 10_000

_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([A-Za-z][^\s/>]*))")
_SPECIAL = re.compile("[>\"']")
_LOOSE = re.compile(r"</?[A-Za-z][^<>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PARTS = re.compile("[-_]+")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of brackets and quotes, and where a tag ends that has reached each of them unquoted.

    -1 says that it never ends. Worked out from the last place to the first, once a page.
    """
    places = [m.start() for m in _SPECIAL.finditer(page)]
    ends = [-1] * (len(places) + 1)
    later: dict[str, int] = {}  # the nearest later place of each quote
    for k in range(len(places) - 1, -1, -1):
        char = page[places[k]]
        if char == ">":
            ends[k] = places[k]
        else:
            ends[k] = ends[later[char] + 1] if char in later else -1
            later[char] = k
    return places, ends


def marks_of(attributes: str) -> tuple[list[str], bool]:
    """The words of class, id and role, and whether the element is hidden."""
    marks, hidden = [], False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            marks += value.lower().split()
        elif name == "hidden":
            hidden |= value.lower() != "false"
        elif name == "style":
            hidden |= bool(_NO_DISPLAY.search(value))
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
    return marks, hidden


def _is_listed(mark: str) -> bool:
    return mark in NEVER_WORDS or NEVER_WORDS.issuperset(_PARTS.split(mark))


def _is_never(name: str, marks: list[str], hidden: bool, in_text: bool, odds: dict[str, float]) -> bool:
    if name in NEVER or name == "header" and not in_text:
        return True
    if name in ("html", "body", "article", "main"):
        return False
    return hidden or any(odds.get(m, 0.0) <= HOLE or _is_listed(m) for m in marks)


class _Stack:
    """Open elements, with the places of each kind at hand, so that nothing walks through them."""

    def __init__(self) -> None:
        # (name, never text, inside a marker, words of class, id and role)
        self.items: list[tuple[str, bool, bool, list[str]]] = [("", False, False, [])]
        self.at: dict[str, list[int]] = {}
        self.not_inline: list[int] = [0]

    def push(self, item: tuple[str, bool, bool, list[str]]) -> None:
        self.at.setdefault(item[0], []).append(len(self.items))
        if item[0] not in INLINE:
            self.not_inline.append(len(self.items))
        self.items.append(item)

    def cut(self, depth: int) -> list[tuple[str, bool, bool, list[str]]]:
        """Closes all elements from ``depth`` on."""
        gone = self.items[depth:]
        for name, *_ in gone:
            self.at[name].pop()
        del self.items[depth:]
        while self.not_inline[-1] >= depth:
            self.not_inline.pop()
        return gone

    def last(self, names) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=0)


def tokens(page: str, odds: dict[str, float] | None = None):
    """Yields (kind, value, context, never, marked, marks) of a page.

    ``kind`` is "text" with the characters, "tag" with the element's name, or "end" for each
    element that has been closed, with its name. ``context`` is the innermost open element;
    ``never`` and ``marked`` say whether an open element is never text, or marks it. ``marks``
    are the words of class, id and role of an element that begins ("tag") or ends ("end").
    ``odds`` are those of marks.
    """
    odds = odds or {}
    stack = _Stack()
    places, ends = _tag_ends(page)
    at = text_from = 0
    size = len(page)

    def top():
        return stack.items[-1][:3]

    def closed(depth: int):
        for name, never, marked, marks in reversed(stack.cut(depth)):
            yield "end", name, name, never, marked, marks

    while at < size:
        found = _OPEN.search(page, at)
        if not found:
            break
        start, name = found.start(), found[2]
        if name is not None:
            reached = bisect_left(places, found.end())
            end = ends[reached]
            if end < 0:
                at = found.end()  # never ends: text, cleaned of what looks like a tag below
                continue
            after, attributes = end + 1, page[found.end():end]
        elif found[0] == "<!--":
            end = page.find("-->", found.end())
            after = size if end < 0 else end + 3
        elif found[0] == "<![CDATA[":
            end = page.find("]]>", found.end())
            after = size if end < 0 else end + 3
        else:
            end = page.find(">", found.end())
            after = size if end < 0 else end + 1
        if start > text_from:
            yield "text", page[text_from:start], *top(), []
        at = text_from = after
        if name is None:
            if found[0] == "<![CDATA[":
                yield "text", page[found.end():size if end < 0 else end], *top(), []
            continue
        name = name.lower()
        if found[1]:
            if stack.at.get(name):
                yield from closed(stack.at[name][-1])
            yield "tag", name, *top(), []
            continue
        if name in BLOCKS and stack.items[stack.not_inline[-1]][0] == "p":
            yield from closed(stack.not_inline[-1])  # a block ends an open paragraph, and what is inline in it
        if name in CLOSES:
            ended = stack.last(CLOSES[name])
            if ended > stack.last(SCOPES - CLOSES[name]):
                yield from closed(ended)
        _, never, marked, _ = stack.items[-1]
        if name == "body" or name in MARKERS and not stack.at.get("aside"):
            never = False  # what is still open before it was left open by mistake
        inside = marked or name in MARKERS
        marks, hidden = marks_of(attributes) if attributes else ([], False)
        yield "tag", name, *top(), marks
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = text_from = close.end() if close else size
        elif name not in VOID and not attributes.endswith("/"):
            stack.push((name, never or _is_never(name, marks, hidden, inside, odds), inside, marks))
    if text_from < size:
        yield "text", _LOOSE.sub(" ", page[text_from:]), *top(), []  # and a tag that the page stops in
    yield from closed(1)


def _features(kind: str, value: str, context: str) -> str:
    """What a score depends on; the names are bounded, unknown elements share one."""
    def known(name: str) -> str:
        return name if name in BLOCKS or name in INLINE or name in VOID or name in NEVER else "other"

    return f"word {known(context)}" if kind == "text" else f"tag {known(value)}"


def count_features(page: str) -> Counter:
    """(feature, is text) of a labelled page; nothing of others.

    A mark counts the words below it, once however many open elements have it.
    """
    out: Counter = Counter()
    labelled = False
    below: list[list[int]] = []  # words inside and outside, of the open elements with marks
    opened: Counter = Counter()
    for kind, value, context, never, marked, marks in tokens(page):
        if kind == "end":
            if marks:
                counts = below.pop()
                if below:
                    below[-1][0] += counts[0]
                    below[-1][1] += counts[1]
                for mark in set(marks):
                    opened[mark] -= 1
                    if not opened[mark]:
                        for side, n in zip((True, False), counts):
                            if n:
                                out[f"mark {mark}", side] += n
            continue
        if kind == "tag":
            if marks and value not in VOID and value not in RAW:
                below.append([0, 0])
                opened.update(set(marks))
            if value in MARKERS:
                labelled = True
                continue
        n = len(value.split()) if kind == "text" else 1
        if kind == "text" and n and below:
            below[-1][not marked] += n
        if n and not never:
            out[_features(kind, value, context), marked] += n
    return out if labelled else Counter()


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Log odds of each feature and mark, from all labelled pages; features keep the method's signs."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter = Counter()
        for page in batch.column("html").to_pylist():
            total.update(count_features(page or ""))
        return pa.RecordBatch.from_pydict({
            "feature": pa.array([f for f, _ in total], pa.string()),
            "inside": pa.array([i for _, i in total], pa.bool_()),
            "n": pa.array(list(total.values()), pa.int64())})

    counts = (map_batches(pages.select("html"), run, "feature string, inside boolean, n long")
              .groupBy("feature").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"),
                                      F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("outside")))
    counts = materialise(counts, "features")  # read twice below, and counted once
    is_mark = F.col("feature").startswith("mark ")
    # Marks may be as many as there are authors: the bound is on what is kept of them.
    kept = counts.filter(~is_mark).unionByName(counts.filter(is_mark).orderBy(
        F.desc(F.col("inside") + F.col("outside")), "feature").limit(MAX_MARKS))
    weights = {}
    for row in kept.collect():  # as many rows as there are features, and at most MAX_MARKS
        odds = math.log((row.inside + 1) / (row.outside + 1))
        if row.feature.startswith("mark "):
            weights[row.feature] = odds
        else:
            tag = row.feature.startswith("tag")
            weights[row.feature] = max(-MOST, min(LEAST_TAG if tag else MOST, odds))
    return weights


def marks_in(weights: dict[str, float]) -> dict[str, float]:
    """The odds of marks alone."""
    return {f.removeprefix("mark "): w for f, w in weights.items() if f.startswith("mark ")}


def _score(feature: str, weights: dict[str, float]) -> float:
    if feature in weights:
        return weights[feature]
    if feature.startswith("word"):
        return UNSEEN["word"]
    return UNSEEN["inline" if feature.split()[1] in INLINE else "block"]


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of largest sum: the first of several, and the shortest."""
    best, span, running, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if running <= 0:
            running, start = 0.0, k
        running += score
        if running > best:
            best, span = running, (start, k + 1)
    return span


def main_text(page: str, weights: dict[str, float], odds: dict[str, float] | None = None) -> str:
    """The text of the best region, a line for each block. ``odds`` are ``marks_in(weights)``."""
    items = [x[:5] for x in tokens(page, marks_in(weights) if odds is None else odds) if x[0] != "end"]
    best_span = best_region([
        0.0 if never else _score(_features(kind, value, context), weights) * (
            len(value.split()) if kind == "text" else 1)
        for kind, value, context, never, _ in items])
    lines, block = [], []

    def close() -> None:
        line = " ".join(html_module.unescape("".join(block)).split())
        if line:
            lines.append(line)
        block.clear()

    for kind, value, _, never, _ in items[slice(*best_span)]:
        if kind == "text":
            if not never:
                block.append(value)
        elif value == "br":
            block.append(" ")
        elif value in BLOCKS:
            close()
    close()
    return "\n".join(lines)


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row; weights are learned from ``pages`` if not given."""
    weights = learn_weights(pages) if weights is None else weights
    odds = marks_in(weights)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page or "", weights, odds) for page in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"),
            "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return map_batches(pages.select("page_id", "url", "html"), run,
                       "page_id long, url string, text string, n_chars long")
