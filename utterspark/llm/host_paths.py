"""HTML extraction by consensus host paths.

Pass 1 scores the containers of every page: text of its blocks minus link text, credited to the
nearest article or main element, else to the nearest container and by half to the one around it. A
container is named by its path of tags and classes, generalised (digits to #, ids left out). Pages
vote with their score shares; Spark sums votes per (host, path) and the best path of each host wins.
Pass 2 extracts each page again by its host's winning path, all matching containers in page order, so
a page whose own scores mislead (little text, many links) follows its host. Where the winning path
does not occur, the page's own best container serves.

Dropped inside containers: menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments - by element, role or ``hidden`` attribute, and by class and id words unless
these name a wrapper: an element with such a word stays when its text is ``WRAPS`` times all that would
be left without it, it has at least ``LEAST_TEXT`` characters and most of them are outside links; with a
word of comments, adverts or notices it must also be an article or hold the page's main or first
heading. Words of state ("with-sidebar", "comments-open") do not count at all. Blocks are separated by block-level tags; white space in a block becomes one space; character references are decoded once.

Votes are summed per task before the shuffle, so a host with a third of all pages costs a row per
path and task. Winners are one row per host: broadcast behind a measured size, else joined.

Defined results: null and empty pages give an empty text; a null or malformed url counts as host "";
cut-off tags at the end are dropped, missing end tags implied; equal votes go to the path that sorts
last; a repeated row votes and returns again.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterspark.llm.common import bounded_broadcast, prepare

BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article center div main section td blockquote details figure fieldset form nav aside header footer dialog menu ul ol dl table".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre".split())
DROPPED = frozenset("nav header footer aside form menu dialog button select fieldset iframe object noscript template".split())
RAW = frozenset("script style textarea title xmp noscript iframe template svg math select button".split())
KEPT = frozenset(["main"])
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
HINT = re.compile(r"(?:^|[\s_-])(?:sidebar\w*|side|menu\w*|nav\w*|breadcrumbs?|footer|masthead|header|popup|modal|overlay|related|recommend\w*|share\w*|sharing|social|widget\w*|toolbar|pagination|pager|search\w*|form)(?=$|[\s_-])", re.I)
STRONG_HINT = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice\w*|alert|newsletter|subscri\w+|paywall|comments?\w*|disqus\w*|repl(?:y|ies)|respond|discussion|login|signup)(?=$|[\s_-])", re.I)
STATE = re.compile(r"^(?:(?:with|has|no|without|is|not|hide|show)[_-].*|.*[_-](?:open|opened|closed|enabled|disabled|on|off))$", re.I)
WRAPS, LEAST_TEXT = 4, 250
VOTES_HELD = 100_000
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")  # whole names; values are consumed
DIGITS = re.compile(r"\d+")
SPACE = re.compile(r"\s+")
MOST_PATH = 400


def _label(tag: str, attrs: str) -> tuple[str, bool, int]:
    """(generalised tag.class, whether the element is page furniture, 1 or 2 if its words say so)."""
    drop, hint = tag in DROPPED, 0
    classes = ""
    if attrs and not attrs.isspace():
        words = []
        for name, *values in ATTRIBUTE.findall(attrs):
            value, name = "".join(values), name.lower()
            if name == "class":
                classes = value
                words.append(value)
            elif name == "id":
                words.append(value)
            elif name == "role":
                drop |= value.strip().lower() in ROLES
            elif name == "hidden":
                drop |= tag not in KEPT
        if words and tag not in KEPT:
            said = " ".join(w for w in " ".join(words).split() if not STATE.match(w))
            hint = 2 if STRONG_HINT.search(said) else int(bool(HINT.search(said)))
    label = ".".join([tag, *sorted({DIGITS.sub("#", c) for c in classes.split()})]) if classes else tag
    return label, drop, hint


class Container:
    """A container's path, the container around it and the path of the nearest article or main."""

    __slots__ = ("path", "above", "semantic")

    def __init__(self, path: str, above: "Container | None", semantic: str | None):
        self.path, self.above, self.semantic = path, above, semantic


def _wrappers(found: list[tuple], suspects: list[list]) -> set[int]:
    """The suspects (element around it, strength, whether it looks like an article) that wrap the page's
    text.

    ``found`` has (text, link characters, container, innermost suspect or -1). From outside in: a suspect
    stays if its own text outweighs all that is left outside the suspects, as the docstring states."""
    text, links = [0] * len(suspects), [0] * len(suspects)
    rest = 0
    for s, in_links, _, who in found:
        rest += len(s) if who < 0 else 0
        if who >= 0:
            text[who] += len(s)
            links[who] += in_links
    inner_text, inner_links = text[:], links[:]
    for i in range(len(suspects) - 1, -1, -1):  # an element comes after those around it
        around = suspects[i][0]
        if around >= 0:
            inner_text[around] += inner_text[i]
            inner_links[around] += inner_links[i]
            suspects[around][2] |= suspects[i][2] == 2 and 2
    kept: set[int] = set()
    while True:
        # those that would be dropped as they are: inside nothing dropped
        heads = [i for i, (around, strength, like) in enumerate(suspects)
                 if i not in kept and (around < 0 or around in kept) and (strength == 1 or like)]
        best = max(heads, key=lambda i: inner_text[i], default=None)
        if best is None or inner_text[best] < LEAST_TEXT or 2 * inner_links[best] > inner_text[best]:
            return kept
        if inner_text[best] <= rest * WRAPS:
            return kept
        kept.add(best)
        rest += text[best]


def blocks(page: str) -> list[tuple[str, int, Container]]:
    """(text, characters in links, innermost container) of every block that is not furniture, in page
    order."""
    out: list[tuple[str, int, Container, int]] = []
    suspects: list[list] = []  # element around it, strength of its words, 1 an article or 2 with the page's main or heading
    # tag, container, dropped, innermost suspect
    stack: list[tuple[str, Container, bool, int]] = [("", Container("", None, None), False, -1)]
    open_tags: dict[str, int] = {}
    text: list[str] = []
    links, in_link, pos, n = 0, False, 0, len(page)

    def flush() -> None:
        nonlocal links
        if text:
            s = SPACE.sub(" ", html_lib.unescape("".join(text))).strip()
            text.clear()
            if s:
                out.append((s, min(links, len(s)), stack[-1][1], stack[-1][3]))
        links = 0

    def push(tag: str, attrs: str) -> None:
        _, box, dropped, who = stack[-1]
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if tag in ("html", "body"):  # their classes differ from page to page; the root path stands for both
            stack.append((tag, box, dropped, who))
            return
        label, drop, hint = _label(tag, attrs)
        if hint and not (dropped or drop):
            suspects.append([who, hint, int(tag == "article")])
            who = len(suspects) - 1
        if who >= 0 and tag in ("h1", "main"):
            suspects[who][2] = 2
        if tag in CONTAINERS:
            path = f"{box.path}>{label}" if box.path else label
            if len(path) > MOST_PATH:  # very deep nesting: the path so far by its digest
                path = f"~{hash_text(box.path)}>{label}"
            box = Container(path, box, path if tag in ("article", "main") else box.semantic)
        stack.append((tag, box, dropped or drop, who))

    def pop() -> str:
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        return tag

    while pos < n:
        m = TOKEN.search(page, pos)
        end = m.start() if m else n
        if end > pos and not stack[-1][2]:
            piece = page[pos:end]
            text.append(piece)
            if in_link:
                links += len(piece)
        if not m:
            break
        pos = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            if tag == "a":
                in_link = False
            elif tag in BLOCKS or tag in DROPPED:
                flush()
                if open_tags.get(tag):  # a stray end tag closes nothing
                    while pop() != tag:
                        pass
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, pos) if not m.group(3).endswith("/") else None
            if close:
                pos = close.end()
            elif tag in ("script", "style", "title", "textarea"):
                pos = n
            continue
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            in_link = not m.group(3).endswith("/")
        elif tag in BLOCKS or tag in DROPPED:
            flush()
            in_link = False
            same = CLOSES_SAME.get(tag, ())
            while len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] in same or (tag[0] == "h" and tag[1:].isdigit() and stack[-1][0] in LEAVES and stack[-1][0][0] == "h")):
                pop()
            if tag != "hr" and not m.group(3).endswith("/"):
                push(tag, m.group(3))
    flush()
    if not suspects:
        return [b[:3] for b in out]
    kept, stays = _wrappers(out, suspects), []
    for i, (around, _, _) in enumerate(suspects):
        stays.append(i in kept and (around < 0 or stays[around]))
    return [b[:3] for b in out if b[3] < 0 or stays[b[3]]]


def hash_text(s: str) -> str:
    import hashlib
    return hashlib.md5(s.encode("utf-8", "surrogatepass")).hexdigest()[:16]


def page_scores(found: list[tuple[str, int, Container]]) -> dict[str, float]:
    """Score by container path."""
    scores: dict[str, float] = {}
    for text, links, box in found:
        worth = len(text) - 2 * links + min(text.count(","), 5) * 5
        near = box.path if box.semantic is None else box.semantic
        scores[near] = scores.get(near, 0.0) + worth
        if box.semantic is None and box.above is not None:
            scores[box.above.path] = scores.get(box.above.path, 0.0) + worth / 2
    return {p: s for p, s in scores.items() if s > 0}


def _inside(found: list[tuple[str, int, Container]], path: str) -> list[str]:
    """Texts of the blocks in a container with the path."""
    known: dict[int, bool] = {}
    out = []
    for text, _, box in found:
        chain, x = [], box
        while x is not None and id(x) not in known and x.path != path:
            chain.append(x)
            x = x.above
        hit = x is not None and (x.path == path or known[id(x)])
        known.update((id(y), hit) for y in chain)
        if hit:
            out.append(text)
    return out


def extract(page: str | None, winner: str | None) -> str:
    """Text of the containers with the winning path; without one, of the page's own best path."""
    if not page:
        return ""
    found = blocks(page)
    hit = _inside(found, winner) if winner is not None else []
    if not hit:
        scores = page_scores(found)
        if not scores:
            return ""
        hit = _inside(found, max(scores, key=lambda p: (scores[p], p)))
    return "\n\n".join(hit)


def host_of(url: Column) -> Column:
    h = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:\s]*)", 1))
    return F.regexp_replace(h, r"\.$", "")


def _vote_task(batches):
    """(host, path, votes) summed over a task, in portions of ``VOTES_HELD``: all of a page's paths share
    one vote by score."""
    votes: dict[tuple[str, str], int] = {}

    def portion():
        keys = list(votes)
        out = pa.RecordBatch.from_pydict({"host": pa.array([k[0] for k in keys], pa.string()), "path": pa.array([k[1] for k in keys], pa.string()),
                                          "votes": pa.array([votes[k] for k in keys], pa.int64())})
        votes.clear()
        return out

    for b in batches:
        for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            scores = page_scores(blocks(page)) if page else {}
            whole = sum(scores.values())
            for path, s in scores.items():
                # votes as whole millionths: their sum does not depend on the order of tasks
                votes[host, path] = votes.get((host, path), 0) + round(s / whole * 1e6)
            if len(votes) > VOTES_HELD:
                yield portion()
    yield portion()


def host_winners(pages: DataFrame) -> DataFrame:
    """(host, path) with the most votes, from (host, html)."""
    votes = pages.mapInArrow(_vote_task, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return votes.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("w")).select("host", F.col("w.path").alias("path"))


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with a string column ``out``; every row and all columns stay."""
    spark = pages.sparkSession
    prepare(spark)
    p = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    winners = host_winners(p).checkpoint(eager=True)
    host, path = f"_h_{out}", f"_p_{out}"
    w = bounded_broadcast(winners.select(F.col("host").alias(host + "w"), F.col("path").alias(path)))

    @F.arrow_udf("string")
    def run(page: pa.Array, winner: pa.Array) -> pa.Array:
        # extract page by page: one page's blocks at a time are in memory
        return pa.array([extract(h, x) for h, x in zip(page.to_pylist(), winner.to_pylist())], pa.string())

    x = pages.withColumn(host, host_of(F.col(url_col))).join(w, F.col(host) == F.col(host + "w"), "left")
    return x.withColumn(out, run(F.col(html_col).cast("string"), F.col(path))).drop(host, host + "w", path)
