"""Main text of web pages by union-free regular-expression wrappers.

A page is a stream of block tags and text slots.  Within a page repeated
stretches fold into repeated groups; then the streams of one host are aligned
one after the other, and every mismatch is resolved by making the stretch that
only one side has optional, or a text that differs a slot.  The outcome is a
regular expression without alternatives, the host's wrapper: fixed tags,
``( )+``, ``( )?`` and text slots.  Each slot and each repeated group carries
its texts (as hashes) with how many pages, and how many different ones, held
them; a text of the template is one that several different pages and nearly all
pages of the host hold there.

Wrappers are made per task from the pages it reads (a page that the wrapper
matches already costs one match), and wrappers of one host are merged by the
same alignment in groups of bounded size, so a host of any size is no one task's
work.  A page is then matched against its host's wrapper, whose slots show where
the main region is: texts of the template outside of it go, blocks inside of it
stay, fixed ones (the headings of a recipe) too.  A page that its wrapper does not
match is judged by its own tags and names alone.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

# ---- fixed values --------------------------------------------------------------
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
INLINE = ("a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var")
OPEN_END = ("p", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "option")     # their end tags may be left out
BOILERPLATE_TAGS = ("head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu")
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|banner|breadcrumb|breadcrumbs|comment|comments|commentlist|disqus|cookie|cookies|"
    r"consent|footer|menu|nav|navbar|navigation|newsletter|notice|notices|pagination|popup|promo|related|replies|share|sharing|sidebar|"
    r"skip|social|sponsor|sponsored|subscribe|toolbar|topbar|widget)(?:$|[\s_-])", re.I)
HEADER_NAMES = re.compile(r"(?:^|[\s_-])(?:header|masthead|branding|logo)(?:$|[\s_-])", re.I)
LANDMARKS = ("article", "main")
LANDMARK_NAMES = re.compile(r"(?:^|[\s_-])(?:teaser|teasers|preview)(?:$|[\s_-])", re.I)      # besides BOILERPLATE_NAMES
TOPIC_NAMES = re.compile(r"(?<!\S)(?:category|tag|has|with|no)-\S+", re.I)       # say what a landmark is about, not what it is
# ---------------------------------------------------------------------------------
LONGEST_SQUARE = 12         # tags of a repeated stretch at most
MERGED = 64                 # wrappers merged in one group
HELD = 20_000               # hosts whose wrappers a task holds
HELD_TEXTS = 300_000        # and texts of their slots
SEVERAL = 3                 # different pages that must hold a text of the template
NEARLY_ALL = 0.9            # and share of the host's pages
NEAR_COPIES = 0.75          # share of a host's text: beyond, its pages are copies of one another, not of a template
SLOT_TEXTS, GROUP_TEXTS = 8, 512    # texts that a slot and a repeated group carry, those of the most pages first, then the latest
BROADCAST_BYTES = 16 << 20  # of wrappers sent to every task; beyond, pages and wrappers are joined by host
TEXT = "#"
_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
REGION = 0.9                # share of the slots' text that the main region holds at least
SQUARE_CELLS = 1 << 16      # of a stretch without anchors that is still aligned cell by cell
_NAMES = re.compile(r"(?:(class|role)|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SQUARE = re.compile(rf"(.{{1,{LONGEST_SQUARE}}}?)\1+", re.S)


def tokens(page: str) -> list[tuple[str, str]]:
    """``(label, text)``: block tags (``<tag names>``, ``</tag>``; ids, which differ
    from page to page, stand as the text of a start tag) and texts (label ``#``, references decoded).  Raw elements, comments and inline tags
    leave nothing; a line break is white space."""
    out: list[tuple[str, str]] = []
    held: list[str] = []

    def flush():
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((TEXT, text))
            held.clear()

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            held.append(entities.unescape(page[at:end]))
        if not m:
            break
        at = m.end()
        close, name = m.group(1), (m.group(2) or "").lower()
        if not name or name in INLINE:
            continue
        if name in ("br", "hr", "wbr"):
            held.append(" " if name != "wbr" else "")
            continue
        if name in RAW and not close:
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            held.append(" ")
            continue
        if name in VOID:
            continue
        flush()
        if close:
            if name not in OPEN_END:
                out.append((f"</{name}>", ""))
        else:
            found = [(kind, next((x for x in t if x), "")) for kind, *t in _NAMES.findall(m.group(3) or "")]
            names, ids = (" ".join(x for kind, x in found if x and bool(kind) == k) for k in (True, False))
            whole = name in ("html", "body")
            out.append((f"<{name} {names}>" if names and not whole else f"<{name}>", "" if whole else ids))
    flush()
    return out


def tag_of(label: str) -> str:
    return label.strip("</>").split(" ", 1)[0]


def is_boilerplate(label: str, in_article: bool, ids: str = "") -> bool:
    """Whether an element holds no main text; an article's own header holds its title."""
    tag, _, names = label.strip("<>").partition(" ")
    names = f"{names} {ids}".strip()
    if tag in BOILERPLATE_TAGS or (names and tag not in LANDMARKS and BOILERPLATE_NAMES.search(names)):
        return True
    return not in_article and (tag == "header" or bool(names and tag not in LANDMARKS and HEADER_NAMES.search(names)))


def _ends(labels: list[str]) -> tuple[list[int], list[bool]]:
    """For each start tag where its element ends, and whether it surely is
    closed: by an end tag, on a page with as many end tags as start tags of the name."""
    ends, closed, stack = [len(labels)] * len(labels), [False] * len(labels), []
    more: dict[str, int] = {}
    for i, x in enumerate(labels):
        if x == TEXT or (t := tag_of(x)) in OPEN_END:
            continue
        more[t] = more.get(t, 0) + (1 if x[1] != "/" else -1)
        if x[1] != "/":
            stack.append((t, i))
        elif any(y == t for y, _ in stack):
            while True:
                y, k = stack.pop()
                ends[k] = i
                if y == t:
                    closed[k] = True
                    break
    return ends, [c and not more[tag_of(x)] for c, x in zip(closed, labels)]


def outside(page: list[tuple[str, str]]) -> list[bool]:
    """For each token whether it is in a boilerplate element.  An element that
    is never closed ends with one around it, or where an article begins.  A
    landmark may be one by its names (a teaser, a reader's comment), if the
    text beside all such landmarks is no less than the longest of them has."""
    labels = [x for x, _ in page]
    ends, closed = _ends(labels)
    out, stack, skip, at, named = [], [], 0, 0, []      # skip: place in the stack of the outermost boilerplate element, from 1; at: its token
    for i, x in enumerate(labels):
        if x != TEXT and x[1] != "/":
            if tag_of(x) in LANDMARKS:
                if skip and not closed[at]:
                    del stack[skip - 1:]
                    skip = 0
                names = TOPIC_NAMES.sub("", f"{x.strip('<>').partition(' ')[2]} {page[i][1]}")
                if not skip and (BOILERPLATE_NAMES.search(names) or LANDMARK_NAMES.search(names)):
                    named.append(i)
            if tag_of(x) not in OPEN_END:
                stack.append(tag_of(x))
                if not skip and is_boilerplate(x, "article" in stack, page[i][1]):
                    skip, at = len(stack), i
        elif x != TEXT and (t := tag_of(x)) in stack:
            while stack.pop() != t:
                pass
            if len(stack) < skip:
                skip = 0
        out.append(bool(skip))
    if named:
        length = [len(t) if x == TEXT and not o else 0 for (x, t), o in zip(page, out)]
        within = {i for k in named for i in range(k, ends[k])}
        if sum(length) - sum(length[i] for i in within) >= max(sum(length[k:ends[k]]) for k in named):
            out = [o or i in within for i, o in enumerate(out)]
    return out


# ---- wrappers: lists of labels, [TEXT, texts], ["+", list, texts], ["?", list]; texts: {hash: [pages, length, some different pages]} ----
def _key(item) -> str:
    return item if isinstance(item, str) else TEXT if item[0] == TEXT else item[0] + json.dumps([_key(x) for x in item[1]])


def _flat(item):
    """The content of an optional; anything else as it is."""
    return item[1] if not isinstance(item, str) and item[0] == "?" else [item]


def _hash(text: str) -> str:
    return xxhash.xxh64_hexdigest(text.encode("utf-8", "surrogatepass"))


def _seen(texts: list[str | None], ident: str) -> dict:
    """The texts of one page at one place; None is a text that counts nowhere."""
    return {_hash(t): [1, len(t), [ident]] for t in texts if t is not None}


def _joined(x: dict, y: dict, most: int, same_pages: bool = False) -> dict:
    """Texts of two sets of pages, or of two places on the same pages."""
    out = dict(x)
    for h, (pages, length, some) in y.items():
        if h in out:
            old = out.pop(h)        # the latest stand last
            pages = max(old[0], pages) if same_pages else old[0] + pages
            some = sorted({*old[2], *some})[:SEVERAL]
        out[h] = [pages, length, some]
    if len(out) > 2 * most:
        out = dict(sorted(reversed(out.items()), key=lambda e: -e[1][0])[most - 1::-1])
    return out


_CHARS: dict[str, str] = {TEXT: TEXT}


def _char(label: str) -> str:
    if label not in _CHARS:
        _CHARS[label] = chr(0x40000 + len(_CHARS) % 0xCFFFE)       # planes without characters of texts; more labels than any site has
    return _CHARS[label]


def encoded(labels: list[str]) -> str:
    return "".join(map(_char, labels))


def folded(page: list[tuple[str, str]], told: list[bool] | None = None, ident: str = "") -> list:
    """The wrapper of one page: stretches that follow themselves become repeated
    groups.  ``told`` is for each token whether it counts as a text of the page
    ``ident``."""
    labels, out, at = [x for x, _ in page], [], 0
    texts = [t if x == TEXT and (told is None or told[i]) else None for i, (x, t) in enumerate(page)]

    def single(start: int, end: int) -> list:
        return [[TEXT, _seen([texts[i]], ident)] if labels[i] == TEXT else labels[i] for i in range(start, end)]

    for m in _SQUARE.finditer(encoded(labels)):
        out += single(at, m.start())
        turn = labels[m.start():m.start() + len(m.group(1))]
        out.append(["+", [[TEXT, {}] if x == TEXT else x for x in turn], _seen(texts[m.start():m.end()], ident)])
        at = m.end()
    return out + single(at, len(page))


def _grouped(items: list, groups: list) -> list:
    """Stretches that are one turn of a repeated group of the other side, as such a group."""
    signs: dict[str, str] = {}

    def coded(keys) -> str:
        return "".join([signs.setdefault(k, chr(0x40000 + len(signs))) for k in keys])

    text = coded(map(_key, items))
    for want, g in {coded([_key(x) for x in g[1]]): g for g in groups}.items():
        if want not in text:
            continue
        out, at = [], 0
        while (start := text.find(want, at)) >= 0:
            out += items[at:start]
            texts: dict = {}
            at = start
            while text.startswith(want, at):
                for x in items[at:at + len(want)]:
                    if not isinstance(x, str):
                        texts = _joined(texts, x[-1] if x[0] != "?" else {}, GROUP_TEXTS, same_pages=True)
                at += len(want)
            out.append(["+", g[1], texts])
        items = out + items[at:]
        text = coded(map(_key, items))
    return items


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of the first, whose seconds rise."""
    tops, at, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        t = bisect_left(tops, j)
        back.append(at[t - 1] if t else -1)
        tops[t:t + 1], at[t:t + 1] = [j], [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Places of common items of two sequences, rising on both sides: equal
    ends first, then items that each side has once, then between those
    the same again.  A stretch without such items is aligned cell by cell if
    it is small; in a larger one only its equal ends are, so memory and time stay
    in proportion to the pages."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append((n, m))
        if i == n or j == m:
            continue
        once = []
        for side, lo, hi in ((a, i, n), (b, j, m)):
            count: dict = {}
            for k in range(lo, hi):
                count[side[k]] = -1 if side[k] in count else k
            once.append({x: k for x, k in count.items() if k >= 0})
        anchors = _rising([(k, once[1][x]) for x, k in once[0].items() if x in once[1]])
        if anchors:
            for (p, q), (r, t) in zip([(i - 1, j - 1), *anchors], [*anchors, (n, m)]):
                todo.append((p + 1, r, q + 1, t))
            out += anchors
        elif (n - i) * (m - j) <= SQUARE_CELLS:
            best = [[0] * (m - j + 1) for _ in range(n - i + 1)]        # longest common subsequence from p, q on
            for p in range(n - i - 1, -1, -1):
                for q in range(m - j - 1, -1, -1):
                    best[p][q] = best[p + 1][q + 1] + 1 if a[i + p] == b[j + q] else max(best[p + 1][q], best[p][q + 1])
            p = q = 0
            while p < n - i and q < m - j:
                if a[i + p] == b[j + q]:
                    out.append((i + p, j + q))
                    p, q = p + 1, q + 1
                elif best[p + 1][q] >= best[p][q + 1]:
                    p += 1
                else:
                    q += 1
    return sorted(out)


def merged(a: list, b: list) -> list:
    """A wrapper of what either wrapper matches: common items, and between
    them each side's stretch as an optional."""
    repeats = [[x for side_x in side for x in _flat(side_x) if not isinstance(x, str) and x[0] == "+"] for side in (a, b)]
    a, b = _grouped(a, repeats[1]), _grouped(b, repeats[0])
    ka, kb = ([json.dumps([_key(y) for y in _flat(x)]) for x in side] for side in (a, b))
    out, i, j = [], 0, 0
    for p, q in [*aligned(ka, kb), (len(a), len(b))]:
        for run in (a[i:p], b[j:q]):
            if run:
                out += _optional(run)
        if p < len(a):
            x, y = _flat(a[p]), _flat(b[q])
            both = [u if isinstance(u, str) else [TEXT, _joined(u[1], v[1], SLOT_TEXTS)] if u[0] == TEXT
                    else [*u[:2], _joined(u[2], v[2], GROUP_TEXTS)] for u, v in zip(x, y)]
            out += [["?", both]] if "?" in (a[p][0], b[q][0]) and not (isinstance(a[p], str) and isinstance(b[q], str)) else both
        i, j = p + 1, q + 1
    return out


def _optional(run: list) -> list:
    """A stretch as one optional; optionals in it stay as they are."""
    out, grows = [], False
    for x in run:
        if not isinstance(x, str) and x[0] == "?":
            out.append(x)
            grows = False
        elif grows:
            out[-1][1].append(x)
        else:
            out.append(["?", [x]])
            grows = True
    return out


class Matcher:
    """A wrapper as a regular expression over encoded tokens; each slot and each
    repeated group outside of groups is a group of its own."""

    def __init__(self, items: list):
        self.places: list[list] = []
        self.items = items
        self.regex = re.compile(self._pattern(items) + r"\Z", re.S)

    def _pattern(self, items: list) -> str:
        out = []
        for x in items:
            if isinstance(x, str):
                out.append(re.escape(_char(x)))
            elif x[0] == "?":       # never given back: matching takes linear time
                out.append(f"(?:{self._pattern(x[1])})?+")
            else:
                self.places.append(x)
                turn = "".join(re.escape(_char(_key(y))) for y in x[1]) if x[0] == "+" else ""
                out.append(f"(?P<t{len(self.places) - 1}>" + (f"(?:{turn})++)" if turn else f"{TEXT})"))
        return "".join(out)

    def match(self, labels: list[str]):
        return self.regex.match(encoded(labels))

    def spans(self, m):
        """``(place, from, to)`` of the slots and groups that a match went through."""
        return ((x, *m.span(f"t{k}")) for k, x in enumerate(self.places) if m.start(f"t{k}") >= 0)


class Learner:
    """The wrapper of pages and of wrappers seen so far: ``n`` pages, ``chars``
    code points of texts that count, ``size`` texts carried."""

    def __init__(self):
        self.items, self.n, self.chars, self.size, self.matcher = None, 0, 0, 0, None

    def page(self, page: list[tuple[str, str]]) -> None:
        labels = [x for x, _ in page]
        told = [x == TEXT and not out for x, out in zip(labels, outside(page))]
        texts = [t for (_, t), k in zip(page, told) if k]
        ident = _hash("\n".join(texts))       # copies that differ in boilerplate elements only are one page
        self.n += 1
        self.chars += sum(map(len, texts))
        if self.items is None:
            self.items = folded(page, told, ident)
        else:
            if self.matcher is None:
                self.matcher = Matcher(self.items)
            m = self.matcher.match(labels)
            if m is None:
                self.items, self.matcher = merged(self.items, folded(page, told, ident)), None
            else:
                for x, start, end in self.matcher.spans(m):
                    x[-1] = _joined(x[-1], _seen([page[i][1] if told[i] else None for i in range(start, end)], ident),
                                    SLOT_TEXTS if x[0] == TEXT else GROUP_TEXTS)
        self.size = sum(len(x[-1]) for x in _places(self.items))

    def wrapper(self, items: list, n: int, chars: int) -> None:
        self.items = items if self.items is None else merged(self.items, items)
        self.n, self.chars, self.matcher = self.n + n, self.chars + chars, None


def _places(items: list) -> list:
    """The slots and repeated groups."""
    return [y for x in items if not isinstance(x, str) for y in (_places(x[1]) if x[0] == "?" else [x])]


def judged(items: list, n: int, chars: int) -> list:
    """The wrapper with only the texts of the template left: those that several
    different pages and nearly all pages hold.  Where they are most of all text,
    the pages are near copies of one another and no text is the template's."""
    places = _places(items)
    for x in places:
        x[-1] = {h: e for h, e in x[-1].items() if len(e[2]) >= SEVERAL and e[0] >= NEARLY_ALL * n}
    if sum(e[0] * e[1] for x in places for e in x[-1].values()) > NEAR_COPIES * chars:
        for x in places:
            x[-1] = {}
    return items


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m.group(1).lower() if m else ""


def _landmarks(labels: list[str]) -> list[bool]:
    """For each token whether a landmark (article, main) encloses it."""
    depth, out = 0, []
    for x in labels:
        if x != TEXT and tag_of(x) in LANDMARKS:
            depth = max(0, depth + (1 if x[1] != "/" else -1))
        out.append(depth > 0)
    return out


def _region(labels: list[str], length: list[int]) -> range | None:
    """The smallest element that holds nearly all of the given lengths."""
    ends, _ = _ends(labels)
    sums = [0, *accumulate(length)]
    found = [range(i, ends[i]) for i, x in enumerate(labels) if x != TEXT and x[1] != "/" and tag_of(x) not in (*OPEN_END, *HEADINGS, "html", "body")
             and sums[ends[i]] - sums[i] >= REGION * sums[-1]]
    return min(found, key=len, default=None) if sums[-1] else None


def main_text(page: list[tuple[str, str]], matcher: Matcher | None) -> str:
    """The article's blocks, joined by one space.

    Texts of boilerplate elements, told by their tags and names, are out.  What
    is left by the host's judged wrapper, the texts of the template at their places,
    shows where the main region is: what the landmarks (article, main)
    enclose, if that is at least half of the slots' text, or else the smallest
    element with nearly all of it.  Inside the region every text stays, the
    template's too: a contract of main text drops no heading of a
    recipe.  Outside of it the template's texts go; slots stay, but
    where there are landmarks.  Without a region headings between slots stay."""
    labels = [x for x, _ in page]
    inner = [x == TEXT and not out for x, out in zip(labels, outside(page))]
    left = list(inner)
    if matcher is not None and (m := matcher.match(labels)):
        for x, start, end in matcher.spans(m):
            for i in range(start, end):
                if left[i] and x[-1] and _hash(page[i][1]) in x[-1]:
                    left[i] = False
    length = [len(t) if k else 0 for (_, t), k in zip(page, left)]
    marked = _landmarks(labels)
    if 2 * sum(n for n, k in zip(length, marked) if k) >= sum(length):
        left = [a and b for a, b in zip(inner, marked)]
    elif left != inner:
        region = _region(labels, length)
        slots = [i for i, k in enumerate(left) if k]
        for i, k in enumerate(inner):
            if k and not left[i]:
                left[i] = i in region if region is not None else slots[0] < i < slots[-1] and tag_of(labels[i - 1]) in HEADINGS
    return " ".join(t for (_, t), k in zip(page, left) if k)


# ---- Spark ---------------------------------------------------------------------
def _learn(batches):
    held: dict[str, Learner] = {}
    texts = 0

    def batch():
        rows = [(h, w.n, w.chars, json.dumps(w.items)) for h, w in held.items() if w.items is not None]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["host", "n", "chars", "wrapper"])
    for b in batches:
        for url, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if text and (host := host_of(url)):     # pages of no host have no template in common
                w = held.setdefault(host, Learner())
                texts -= w.size
                w.page(tokens(text))
                texts += w.size
            if len(held) > HELD or texts > HELD_TEXTS:
                yield batch()
                texts = 0
    yield batch()


def _merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    w = Learner()
    for text, n, chars in sorted(zip(*(table.column(x).to_pylist() for x in ("wrapper", "n", "chars")))):
        w.wrapper(json.loads(text), n, chars)
    return pa.table({"host": [key[0].as_py()], "n": pa.array([w.n], pa.int64()), "chars": pa.array([w.chars], pa.int64()), "wrapper": [json.dumps(w.items)]})


def _judge(batches):
    for b in batches:
        texts = [json.dumps(judged(json.loads(w), n, chars)) for n, chars, w in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(texts, pa.string())], names=["host", "n", "chars", "wrapper"])


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, n, chars, wrapper)``: one judged wrapper (JSON) for each host, its pages and their text's length."""
    schema = "host string, n long, chars long, wrapper string"
    now = c.stored(pages.select(F.col(url_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(_learn, schema), "wrappers")
    while (most := now.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        groups = -(-most // MERGED)
        now = c.stored(now.groupBy("host", F.pmod(F.xxhash64("wrapper", "n"), F.lit(groups)).alias("part")).applyInArrow(_merge, schema), "wrappers")
        if groups > 1 and now.groupBy("host").count().agg(F.max("count")).first()[0] >= most:
            break       # equal wrappers all in one part: any of them will do
    one = now.groupBy("host").agg(F.max_by(F.struct("n", "chars", "wrapper"), "n").alias("x")).select("host", "x.*")
    return one.mapInArrow(_judge, schema)


def _extract(batches):
    known: dict[str, Matcher] = {}
    for b in batches:
        out = []
        for text, wrapper in zip(*(b.column(k).to_pylist() for k in (2, 3))):
            if wrapper is not None and wrapper not in known:
                if len(known) > 2000:
                    known.clear()
                known[wrapper] = Matcher(json.loads(wrapper))
            out.append(main_text(tokens(text or ""), known.get(wrapper)))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())],
                                         names=["id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, ``text`` (empty if none) and ``n_chars``.

    A null html is empty; pages with a null or odd url have no host, so no
    wrapper, and their own tags and names decide.
    Repeated rows are pages of their own; a null id is kept; other columns
    are not read.  White space within a block (what block tags and line
    breaks part) becomes one space.
    """
    told = c.stored(wrappers(pages, url_col, html_col), "hosts")
    size = told.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host") + 16), F.lit(0))).first()[0]
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")),
                                    r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host.alias("host"))
    joined = rows.join(F.broadcast(told) if size <= BROADCAST_BYTES else told, "host", "left")
    out = joined.select("id", "url", "html", "wrapper").mapInArrow(_extract, "id long, url string, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
