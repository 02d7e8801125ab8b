"""Main text of web pages by wrappers inferred from pages of the same host.

A page is read into a stream of balanced groups: start tag, content, end tag, with
omitted end tags supplied and comments, scripts and styles left out. A wrapper is a
union-free regular expression over such streams: a sequence of groups, each of them
plain, optional (?) or repeated (+, *), and of texts. It begins as one page and
is aligned with one more page of the host at a time: runs of like groups in either
stream become a repeated group, as do groups whose labels come back again and again,
groups that only one stream has become optional. Texts that differ become slots; texts
that every page has at a place are the template's.

Then each group gets a role. Elements that are no part of an article by their kind
(``DROPPED``) are dropped, and so are lists of links outside of article and main. The
content is the article or main, or else the group that most of the slots' text leads
to. Names of class, id and role only break ties: a small group beside or within the
content is dropped if its name says so, one that holds the article or most of the text
never is. Template texts within the content are dropped if at least ``TEMPLATE_PAGES``
distinct pages have them, unless they are over half of its text: then the pages are
copies of one another. Roles are the same for all pages of a host.

Every page is read through its host's wrapper; groups that the wrapper does not
have take their role from their own tag and names, and a page in which the wrapper
finds no text is read through a wrapper of its own. Wrappers are fitted on all pages
of a host where they lie, and only wrappers move: each task has one for each host and
shape of page, these are merged by host and salt, then by host. Copies of a page weigh
more, but a template text takes ``TEMPLATE_PAGES`` pages that differ.
No step recurses, and alignment looks at up to ``BAND`` places of a label, so deep
nesting and long lists of unlike groups cost time in proportion to their length.

Character references are decoded, white space within a block becomes one space,
blocks are trimmed and joined in page order by line feeds. Null, empty and text-free
pages give an empty text. A page cut off mid-tag loses that tag, mid-reference keeps
its characters. Pages of null URL, or none with a host, share one wrapper. Other
columns pass through; ``text`` is replaced if there.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import small_batches, stored
from lexiloom.llm.url_rules import host_of

#: Parts that the wrappers of a host's tasks are dealt to, each merged by itself at first.
SALTS = 64
#: Wrappers that a task holds before it hands them on.
HELD = 2000
#: Distinct pages that must share a text at a place for it to be the template's.
TEMPLATE_PAGES = 5
#: Times that a label may come back within a group before all from its first to its last place is one repeated group.
RETURNS = 3
#: Places of a label that alignment considers for one group.
BAND = 32
#: Bytes of packed wrappers that a worker keeps unpacked.
KEPT_BYTES = 1 << 19
DROP, WAY, CONTENT = 0, 1, 2
# Names of HTML elements by how they nest or what they hold.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table select body html".split())
DROPPED = frozenset("head nav footer aside form button select dialog menu svg canvas object audio video iframe script style noscript template textarea title map math".split())
# Words of class, id, role and aria-label that name what is not the article, and words for containers, to which the word before gives the meaning.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu submenu sidebar widget widgets footer header masthead topbar breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription signup login search comment comments commentlist disqus respond reply replies related recommended recommendations share sharing social pagination pager toolbar toc copyright complementary contentinfo skip".split()
)
CONTAINER_WORDS = frozenset("area bar block box button buttons container form group holder icons inner item items link links list panel posts section slot thread unit wrap wrapper".split())
MAIN_NAMES = re.compile(r"(^|[\s_-])(article\w*|main|content|post|entry|story|body)($|[\s_-])")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|([^<]+)|(<)", re.S)
NAMED = re.compile(r"""(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


class Group:
    """A balanced group of a page: label (tag and names) and content, texts among it as strings."""

    __slots__ = ("inside", "label", "tag")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.inside = tag, label, []


def label_of(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    names = " ".join(re.sub(r"\d+", "", v.strip("\"'")).lower() for _, v in NAMED.findall(attributes))
    return f"{tag} {names}".strip()


def read_page(page: str) -> Group:
    """Balanced groups of a page."""
    root = Group("html", "html")
    stack, at, n = [root], 0, len(page)
    opened: Counter = Counter()

    def close(k: int) -> None:
        opened.subtract(g.tag for g in stack[k:])
        del stack[k:]

    while at < n:
        m = TOKEN.match(page, at)
        at = m.end()
        closing, tag, attributes, end, text, bare = m.groups()
        if text is not None or bare is not None:
            stack[-1].inside.append(html.unescape(text or bare))
            continue
        if tag is None or not end:
            continue
        tag = tag.lower()
        if closing:
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        if tag == "html":
            continue
        ends = CLOSED_BY.get(tag, ())
        if any(opened[x] for x in ends) or (tag in CLOSES_P and opened["p"]):
            for k in range(len(stack) - 1, 0, -1):
                open_ = stack[k].tag
                if open_ in ends or (open_ == "p" and tag in CLOSES_P):
                    close(k)
                    if open_ == "p" or tag not in ("tr",):
                        break
                elif open_ in SCOPES or (open_ in BLOCK and open_ != "p" and not ends):
                    break
        if tag == "body" and opened["head"]:
            close(1)
        group = Group(tag, label_of(tag, attributes))
        stack[-1].inside.append(group)
        if tag in RAW:
            ended = re.compile(rf"</{tag}[^>]*>", re.I).search(page, at)
            at = ended.end() if ended else n
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(group)
            opened[tag] += 1
    return root


# A wrapper is a nested list: [label, quantifier, inside, text, links, role, seen, common, few, places].
# Text and links count characters in all pages seen; ``seen`` counts the pages. A text has
# the label "#", in ``common`` those that all these pages have there (digest to length) and
# in ``few`` the least digests of the pages, up to TEMPLATE_PAGES. ``places`` are the places
# of each label inside, worked out when they are first asked for.
LABEL, QUANT, INSIDE, TEXT, LINKS, ROLE, SEEN, COMMON, FEW, PLACES = range(10)
_OPTIONAL = {"": "?", "?": "?", "+": "*", "*": "*"}
_REPEATED = {"": "+", "+": "+", "?": "*", "*": "*"}


def flat(task):
    """Run a generator that yields the generators whose results it waits for, without recursion."""
    stack, value = [task], None
    while stack:
        try:
            waits = stack[-1].send(value)
        except StopIteration as done:
            stack.pop()
            value = done.value
        else:
            stack.append(waits)
            value = None
    return value


def said_of(text: str) -> int:
    """Digest of a text, white space aside."""
    return xxhash.xxh64_intdigest(" ".join(text.split()))


def wrap(page: Group, digest: int = 0) -> list:
    """The wrapper that one page makes, runs of like groups folded."""
    few = (digest,)
    order, stack = [], [(page, False)]
    while stack:
        group, linked = stack.pop()
        linked = linked or group.tag == "a"
        order.append((group, linked))
        stack += [(x, linked) for x in group.inside if not isinstance(x, str)]
    made: dict[int, list] = {}
    for group, linked in reversed(order):
        inside, text, links = [], 0, 0
        for x in group.inside:
            if isinstance(x, str):
                if x.isspace() or not x:
                    continue
                size = len(x) - x.count(" ")
                item = ["#", "", [], size, size * linked, WAY, 1, {said_of(x): size}, few, None]
            else:
                item = made.pop(id(x))
            text, links = text + item[TEXT], links + item[LINKS]
            inside.append(item)
        if len(inside) > 1:
            inside = flat(fold(inside))
        made[id(group)] = [group.label, "", inside, text, links, WAY, 1, None, None, None]
    return made[id(page)]


def nodes_of(wrapper: list) -> list[list]:
    """Groups and texts in page order."""
    out, stack = [], [wrapper]
    while stack:
        out.append(item := stack.pop())
        stack += reversed(item[INSIDE])
    return out


def shape_of(nodes: list[list]) -> tuple:
    """What wrappers share if they differ in texts alone."""
    return tuple((x[LABEL], x[QUANT], len(x[INSIDE])) for x in nodes)


def add(nodes: list[list], more: list[list]) -> None:
    """Merge a wrapper of the same shape into one, node by node; both are given by their nodes and of different pages."""
    for a, b in zip(nodes, more, strict=True):
        a[TEXT] += b[TEXT]
        a[LINKS] += b[LINKS]
        a[SEEN] += b[SEEN]
        if a[COMMON] is not None:
            a[COMMON] = {k: n for k, n in a[COMMON].items() if k in b[COMMON]}
            if a[FEW] != b[FEW]:
                a[FEW] = least_of(a[FEW], b[FEW])


def least_of(a: tuple, b: tuple) -> tuple:
    return tuple(sorted({*a, *b})[:TEMPLATE_PAGES])


def fold(items: list):
    """Turn runs of one to three like groups in a row, and what lies between the places of a label that keeps coming back, into repeated groups."""
    if len({x[LABEL] for x in items}) == len(items):
        return items
    out = items
    for period in (1, 2, 3):
        items, out, i = out, [], 0
        names = [x[LABEL] for x in items]
        while i < len(items):
            j = i + period
            while j + period <= len(items) and names[j : j + period] == names[i : i + period]:
                j += period
            if j - i > period:
                for k in range(i, i + period):
                    one = items[k]
                    for again in range(k + period, j, period):
                        other = items[again]
                        one = merge_plain(one, other, True) if plain(one, other) else (yield merge(one, other, True))
                    out.append([one[LABEL], _REPEATED[one[QUANT]], *one[INSIDE:]])
                i = j
            else:
                out.append(items[i])
                i += 1
    places: dict[str, list[int]] = {}
    for k, x in enumerate(out):
        places.setdefault(x[LABEL], []).append(k)
    spans = sorted((at[0], at[-1] + 1) for at in places.values() if len(at) > RETURNS)
    if not spans:
        return out
    # Spans that overlap are one; each label in them is a group of the repeated one, optional in each turn.
    whole: list[list[int]] = []
    for a, b in spans:
        if whole and a < whole[-1][1]:
            whole[-1][1] = max(b, whole[-1][1])
        else:
            whole.append([a, b])
    folded, last = [], 0
    for a, b in whole:
        folded += out[last:a]
        held: dict[str, list] = {}
        for x in out[a:b]:
            held[x[LABEL]] = (yield merge(held[x[LABEL]], x, True)) if x[LABEL] in held else x
        folded += [[x[LABEL], "*", *x[INSIDE:]] for x in held.values()]
        last = b
    return folded + out[last:]


def _quant(a: str, b: str) -> str:
    if a == b:
        return a
    return "*" if "*" in a + b or a + b in ("?+", "+?") else "+" if "+" in a + b else "?"


def merge_texts(a: list, b: list, folded: bool) -> list:
    """Text for two texts: of the same pages if they are ``folded``, else of different ones."""
    if not folded:
        common = {k: n for k, n in a[COMMON].items() if k in b[COMMON]}
    elif a[SEEN] == b[SEEN]:
        common = a[COMMON] | b[COMMON]
    else:
        common = (a if a[SEEN] > b[SEEN] else b)[COMMON]
    seen = max(a[SEEN], b[SEEN]) if folded else a[SEEN] + b[SEEN]
    return ["#", _quant(a[QUANT], b[QUANT]), [], a[TEXT] + b[TEXT], a[LINKS] + b[LINKS], WAY, seen, common, a[FEW] if a[FEW] == b[FEW] else least_of(a[FEW], b[FEW]), None]


def plain(a: list, b: list) -> bool:
    """Whether two like groups hold one text each, or nothing: there is nothing to align."""
    x, y = a[INSIDE], b[INSIDE]
    return len(x) == len(y) and (not x or len(x) == 1 and x[0][LABEL] == y[0][LABEL] == "#")


def merge_plain(a: list, b: list, folded: bool) -> list:
    """``merge`` for two groups that are ``plain``, or two texts."""
    if a[LABEL] == "#":
        return merge_texts(a, b, folded)
    inside = [merge_texts(x, y, folded) for x, y in zip(a[INSIDE], b[INSIDE], strict=True)]
    return [a[LABEL], _quant(a[QUANT], b[QUANT]), inside, a[TEXT] + b[TEXT], a[LINKS] + b[LINKS], WAY, max(a[SEEN], b[SEEN]) if folded else a[SEEN] + b[SEEN], None, None, None]


def merge(a: list, b: list, folded: bool):
    """Wrapper for two like groups: of the same pages if they are ``folded``, else of different ones."""
    if plain(a, b):
        return merge_plain(a, b, folded)
    inside = yield align(a[INSIDE], b[INSIDE], folded)
    return [a[LABEL], _quant(a[QUANT], b[QUANT]), inside, a[TEXT] + b[TEXT], a[LINKS] + b[LINKS], WAY, max(a[SEEN], b[SEEN]) if folded else a[SEEN] + b[SEEN], None, None, None]


def pairs(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of labels: the longest rising chain of like places, ``BAND`` of them for each group."""
    places: dict[str, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x[LABEL], []).append(j)
    nth: Counter = Counter()
    ends: list[int] = []  # ends[k]: least place in b at which a chain of k + 1 ends
    chains: list[tuple] = []  # and that chain
    for i, x in enumerate(a):
        at = places.get(x[LABEL])
        if at is None:
            continue
        k = nth[x[LABEL]]
        nth[x[LABEL]] += 1
        for j in reversed(at[max(0, k - BAND // 2) : k + BAND // 2]):
            n = bisect_left(ends, j)
            chain = (i, j, chains[n - 1] if n else None)
            if n == len(ends):
                ends.append(j)
                chains.append(chain)
            elif j < ends[n]:
                ends[n], chains[n] = j, chain
    out, chain = [], chains[-1] if chains else None
    while chain is not None:
        out.append(chain[:2])
        chain = chain[2]
    return out[::-1]


def align(a: list, b: list, folded: bool):
    """Align two sequences of groups by their labels; what only one has becomes optional."""
    if not a and not b:
        return []
    optional = lambda x: [x[LABEL], _OPTIONAL[x[QUANT]], *x[INSIDE:]]
    out, i, j = [], 0, 0
    same = len(a) == len(b) and all(x[LABEL] == y[LABEL] for x, y in zip(a, b, strict=True))
    for m, n in [*(((k, k) for k in range(len(a))) if same else pairs(a, b)), (len(a), len(b))]:
        out += [optional(x) for x in a[i:m]]
        out += [optional(x) for x in b[j:n]]
        if m < len(a):
            out.append(merge_plain(a[m], b[n], folded) if plain(a[m], b[n]) else (yield merge(a[m], b[n], folded)))
        i, j = m + 1, n + 1
    return (yield fold(out))


def merged(a: list, b: list) -> list:
    """Wrapper of two wrappers' pages."""
    return flat(merge(a, b, False))


def walk(wrapper: list) -> list[tuple[list, bool]]:
    """Groups and texts in page order, each with whether it lies within an article or main."""
    out, stack = [], [(wrapper, False)]
    while stack:
        item, within = stack.pop()
        within = within or item[LABEL].partition(" ")[0] in ("article", "main")
        out.append((item, within))
        stack += [(x, within) for x in reversed(item[INSIDE])]
    return out


def by_tag(label: str, within: bool) -> bool:
    """Whether the kind of element says that it is no part of the article; a header within the article is."""
    tag = label.partition(" ")[0]
    return tag in DROPPED or (tag == "header" and not within)


def by_name(label: str) -> bool:
    """Whether a name says so: a word for what is not the article, last in a compound or before words for containers."""
    tag, _, names = label.partition(" ")
    if tag in ("html", "body", "article", "main", "header", "h1", "h2", "#"):
        return False
    for name in names.split():
        words = [w for w in re.split(r"[_-]+", name) if w]
        while len(words) > 1 and words[-1] in CONTAINER_WORDS:
            words.pop()
        if words and words[-1] in ASIDE_WORDS:
            return True
    return False


def assign(wrapper: list) -> list:
    """Give each group of a finished wrapper its role, and leave it the template texts that are to be dropped."""
    items = walk(wrapper)
    lists = ("ul", "ol", "dl", "table", "div", "section")

    def slots(x: list) -> int:
        """Characters of a text that are not the template's."""
        return x[TEXT] - (sum(x[COMMON].values()) * x[SEEN] if len(x[FEW]) >= TEMPLATE_PAGES else 0)

    def count() -> dict[int, tuple[int, int, int, bool]]:
        """Text, text in slots and link text that each group holds, and whether an article or main is in it; what is dropped counts nothing."""
        sums: dict[int, tuple[int, int, int, bool]] = {}
        for x, _ in reversed(items):
            if x[ROLE] == DROP:
                sums[id(x)] = (0, 0, 0, False)
            elif x[LABEL] == "#":
                sums[id(x)] = (x[TEXT], max(slots(x), 0), x[LINKS], False)
            else:
                own = [sums[id(y)] for y in x[INSIDE]]
                holds = x[LABEL].partition(" ")[0] in ("article", "main") or any(o[3] for o in own)
                sums[id(x)] = (sum(o[0] for o in own), sum(o[1] for o in own), sum(o[2] for o in own), holds)
        return sums

    for x, within in items:
        if by_tag(x[LABEL], within):
            x[ROLE] = DROP
    sums = count()
    # Names break ties: they don't count for a group with the article or most of the text around it.
    stack = [(wrapper, sums[id(wrapper)][0], False)]
    while stack:
        x, around, within = stack.pop()
        if x[ROLE] == DROP or x[LABEL] == "#":
            continue
        text, _, links, holds = sums[id(x)]
        tag = x[LABEL].partition(" ")[0]
        if tag in ("article", "main"):
            around, within = text, True
        elif not holds and (by_name(x[LABEL]) and 2 * text <= around or tag in lists and not within and text and links > 0.6 * text):
            x[ROLE] = DROP
            continue
        stack += [(y, around, within) for y in x[INSIDE]]
    sums = count()

    def outermost(is_main) -> list[list]:
        found, stack = [], [wrapper]
        while stack:
            x = stack.pop()
            if x[LABEL] == "#" or x[ROLE] == DROP:
                continue
            if is_main(x[LABEL]) and sums[id(x)][0]:
                found.append(x)
            else:
                stack += reversed(x[INSIDE])
        return found

    contents: list[list] = []
    for test in (lambda s: s.partition(" ")[0] == "article", lambda s: s.partition(" ")[0] == "main" or re.search(r"(^| )main( |$)", s.partition(" ")[2])):
        if marked := outermost(test):
            most = max(sums[id(x)][0] for x in marked)
            contents = [x for x in marked if sums[id(x)][0] == most or x[QUANT] in ("+", "*")]
            break
    else:
        best = wrapper
        while True:
            groups = [x for x in best[INSIDE] if x[LABEL] != "#" and x[ROLE] != DROP]
            inner = max(groups, key=lambda x: sums[id(x)][1] * (1.5 if MAIN_NAMES.search(x[LABEL].partition(" ")[2]) else 1), default=None)
            if inner is None or inner[QUANT] in ("+", "*") or sums[id(inner)][1] < 0.6 * sums[id(best)][1] or inner[LABEL].partition(" ")[0] not in ("html", "body", "div", "section", "table", "tbody", "tr", "td", "center"):
                break
            best = inner
        contents = [best]
    for x in contents:
        x[ROLE] = CONTENT
    copies = sum(sums[id(x)][1] for x in contents) < 0.5 * sum(sums[id(x)][0] for x in contents)
    for x, _ in items:
        if x[LABEL] == "#" and (copies or len(x[FEW]) < TEMPLATE_PAGES):
            x[COMMON] = {}
    return wrapper


def infer(pages: list[str]) -> list:
    """Wrapper of a host's pages, aligned one after another."""
    return assign(reduce(merged, (wrap(read_page(p), xxhash.xxh64_intdigest(p)) for p in pages or [""])))


def extract(page: Group, wrapper: list) -> str:
    """Text of a page's content groups, read through a wrapper."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        if said := " ".join("".join(line).split()):
            blocks.append(said)
        line.clear()

    def entered(group: Group, own: list | None, content: bool, within: bool) -> list | None:
        """What is open while a group is read: its rest, its role, and where its wrapper's labels stand; None if it is dropped."""
        within = within or group.tag in ("article", "main")
        if own[ROLE] == DROP if own is not None else by_tag(group.label, within) or by_name(group.label):
            return None
        if own is None:
            places = {}
        elif (places := own[PLACES]) is None:
            places = own[PLACES] = {}
            for k, item in enumerate(own[INSIDE]):
                places.setdefault(item[LABEL], []).append(k)
        if group.tag in BLOCK:
            end()
        return [iter(group.inside), content or (own is not None and own[ROLE] == CONTENT), within, own, places, 0, group.tag in BLOCK]

    stack = [entered(page, wrapper, False, False)]
    while stack and stack[-1] is not None:
        rest, content, within, own, places, at, block = top = stack[-1]
        x = next(rest, None)
        if x is None:
            if block:
                end()
            stack.pop()
            continue
        near = places.get("#" if isinstance(x, str) else x.label)
        hit = None
        if near is not None:
            k = near[min(bisect_left(near, at), len(near) - 1)]
            top[5], hit = max(k, at) if isinstance(x, str) else k, own[INSIDE][k]
        if isinstance(x, str):
            if content and not (hit is not None and hit[COMMON] and said_of(x) in hit[COMMON]):
                line.append(x)
        elif x.tag == "br":
            line.append(" ")
        elif x.tag not in VOID and (below := entered(x, hit, content, within)) is not None:
            stack.append(below)
    end()
    return "\n".join(blocks)


def main_text(page: str | None, wrapper: list | None) -> str:
    """Main text of one page; without a wrapper, or if it finds none, through the page's own."""
    if not page:
        return ""
    tree = read_page(page)
    found = extract(tree, wrapper) if wrapper is not None else ""
    return found or extract(tree, assign(wrap(tree)))


def _packed(wrapper: list) -> bytes:
    """A wrapper's groups in page order with their depths, as packed JSON."""
    rows, stack = [], [(0, wrapper)]
    while stack:
        depth, (label, quant, inside, text, links, role, seen, common, few, _) = stack.pop()
        rows.append([depth, label, quant, text, links, role, seen, None if common is None else list(common.items()), few])
        stack += [(depth + 1, x) for x in reversed(inside)]
    return zlib.compress(json.dumps(rows, separators=(",", ":")).encode())


def _unpacked(data: bytes) -> list:
    path: list[list] = []
    for depth, label, quant, text, links, role, seen, common, few in json.loads(zlib.decompress(data)):
        item = [label, quant, [], text, links, role, seen, None if common is None else {k: n for k, n in common}, few and tuple(few), None]
        del path[depth:]
        if path:
            path[-1][INSIDE].append(item)
        path.append(item)
    return path[0]


_wrappers: dict[bytes, list] = {}


def _known(data: bytes | None) -> list | None:
    """The wrapper of a host, unpacked once by each worker while it has room."""
    if data is None:
        return None
    if data not in _wrappers:
        if sum(map(len, _wrappers)) + len(data) > KEPT_BYTES:
            _wrappers.clear()
        _wrappers[data] = _unpacked(data)
    return _wrappers[data]


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, wrapper) for each host with pages; wrappers are packed JSON."""
    named = pages.select(host_of(F.col(url)).alias("host"), F.col(page).alias("page")).filter(F.col("page").isNotNull() & (F.col("page") != ""))

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Wrappers of the hosts of a task's pages, a few thousand pages' shapes at a time."""
        held: dict[tuple[str, tuple], list[list]] = {}

        def handed_on() -> pd.DataFrame:
            by_host: dict[str, list] = {}
            for (host, _), nodes in held.items():
                by_host[host] = merged(by_host[host], nodes[0]) if host in by_host else nodes[0]
            held.clear()
            return pd.DataFrame({"host": list(by_host), "wrapper": [_packed(w) for w in by_host.values()]})

        for batch in batches:
            for host, said in zip(batch["host"], batch["page"], strict=True):
                nodes = nodes_of(wrap(read_page(said), xxhash.xxh64_intdigest(said)))
                key = (host, shape_of(nodes))
                if key in held:
                    add(held[key], nodes)
                else:
                    held[key] = nodes
                    if len(held) >= HELD:
                        yield handed_on()
        if held:
            yield handed_on()

    def together(rows: pd.DataFrame, last: bool) -> pd.DataFrame:
        each = (_unpacked(w) for w in sorted(rows["wrapper"]))
        wrapper = reduce(merged, each)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [_packed(assign(wrapper) if last else wrapper)]})

    partial = named.mapInPandas(fitted, "host string, wrapper binary").withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    salted = partial.groupBy("host", "salt").applyInPandas(lambda rows: together(rows, False), "host string, wrapper binary")
    return salted.groupBy("host").applyInPandas(lambda rows: together(rows, True), "host string, wrapper binary")


def extract_pages(pages: DataFrame, url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of every page."""
    small_batches(pages.sparkSession)
    fitted = stored(wrappers(pages, url, page), "wrappers").withColumnRenamed("host", "_host")

    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, packed in batches:
            yield pd.Series([main_text(h, _known(w)) for h, w in zip(htmls, packed, strict=True)], dtype=object)

    rows = pages.select(F.struct(*pages.columns).alias("row"), host_of(F.col(url)).alias("host"), F.col(page).alias("page"))
    said = rows.join(fitted, F.col("host") == F.col("_host"), "left").select("row", F.pandas_udf(read, "string")(F.col("page"), F.col("wrapper")).alias("said"))
    return said.select(*(F.col(f"row.`{c}`").alias(c) for c in pages.columns if c != text), F.col("said").alias(text))
