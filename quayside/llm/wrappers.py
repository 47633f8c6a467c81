"""HTML extraction by union-free regular expressions inferred for each host.

A page becomes a stream of block tags (with their classes) and text slots. Runs
of equal parts fold to repeated groups. Streams of one host are aligned one after
the other: what both have stays, what only one has becomes an optional group, a
part that the other repeats becomes a repeated group, and texts are slots. The
expression that is left is the host's wrapper. Each page's stream is matched with
it, which gives every block its slot. A text that stands in one slot on TEMPLATE_SHARE
of the host's pages that have the slot, and on TEMPLATE_PAGES at least, is the
host's, not the page's, and goes; pages with the same blocks count once. A heading
goes only with all that stands beside it. All other blocks stay, in an article element or not.

Distinct streams are counted before they meet, and a host with many is folded in
groups of GROUP_FORMS, level by level, so that no task gathers all pages of a host.
A page that does not match its wrapper has its places (paths of elements) for slots.

Null html, and pages without text at the main place, give an empty text. Pages
without a usable url form one host. A line break and every block element end a
block. Nothing but menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments is left out.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_right
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import text_of
from quayside.session import cut_lineage

GROUP_FORMS = 64
# Parts of at most so many tokens are folded when they repeat.
LONGEST_PART = 8
# A text is the host's own if it stands in its slot on this share of the pages that have the slot,
# on this share of all pages of the host, and on so many.
TEMPLATE_SHARE = 0.9
TEMPLATE_HOST = 0.5
TEMPLATE_PAGES = 3

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")

RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img".split()
)
# Elements that close an open paragraph.
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
OUT = {"nav", "header", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "head", "object", "canvas", "map"} | RAW
OUT_WORDS = set(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement adsense banner promo sponsor sponsored "
    "cookie cookies consent gdpr notice notices alert comment comments disqus reply replies share sharing social related recommended breadcrumb "
    "breadcrumbs newsletter subscribe subscription popup modal overlay login signup search searchbox pagination pager skip copyright toolbar".split()
)
# Words that name parts of a page and may stand beside those in a class, and comments, which may well be longer than the article.
PLAIN_WORDS = set(
    "site page main global top bottom left right upper lower box block container wrapper wrap inner outer list area section bar row col column "
    "button buttons link links widget widgets content contents item items post posts article articles story stories news text title body panel "
    "primary secondary small large sticky fixed mobile desktop js nav form thread feed group".split()
)
COMMENT_WORDS = set("comment comments disqus reply replies".split())
# Cells of an alignment, in bits, that are held at once.
ALIGN_BITS = 1 << 28
# Followers of an item that are kept once they are found; more are looked up each time.
NEAR = 64
UNKNOWN = (-1,)
# Tokens of a stream whose states are found again together, and states that are held at once.
STRETCH = 256
HELD_STATES = 1 << 20
HEADING = re.compile(r"h[1-6]$")


def outside_words(names: str) -> set[str]:
    """Words of classes that say that an element is no part of the article.

    A class counts only if all its words name parts of pages: ``ad-box`` does, ``with-sidebar`` and ``share-prices`` do not.
    """
    found: set[str] = set()
    for name in names.lower().split():
        words = WORDS.findall(name)
        if all(w in OUT_WORDS or w in PLAIN_WORDS for w in words):
            found.update(w for w in words if w in OUT_WORDS)
    return found


@lru_cache(1 << 12)
def _element(name: str, rest: str) -> tuple[str, bool, frozenset[str], bool]:
    """The mark of an element, whether it holds the article, what its classes say against it, and whether it is left out."""
    given = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(rest)}
    classes = sorted(set(WORDS.findall(" ".join(given.get(k, "") for k in ("class", "id", "role", "itemprop")).lower())))
    central = name in ("article", "main") or "articlebody" in classes
    against = frozenset(outside_words(" ".join(given.get(k, "") for k in ("class", "id", "role"))))
    out = name in OUT or not COMMENT_WORDS.isdisjoint(against) or "hidden" in given or given.get("aria-hidden") == "true"
    return ".".join([name, *classes]), central, against, out


class Page:
    """Blocks of a page as (place, text), their places in its stream, and that stream of block tags and slots.

    A place is the path of block elements with their classes. Blocks in menus and
    the like are left out; in an article's own header only headings are kept. Classes alone
    do not take out an element that holds most of the text of a page without an article, but for reader comments.
    """

    def __init__(self, page: str):
        self.blocks: list[tuple[tuple[str, ...], str]] = []
        self.at: list[int] = []
        self.stream: list[str] = []
        # Open elements: name, mark (block elements only), whether left out, whether in an article, and
        # the numbers of the elements around that their classes speak against.
        stack: list[tuple[str, str | None, bool, bool, tuple[int, ...]]] = []
        held: list[str] = []
        doubted: list[tuple[int, ...]] = []
        doubts = 0

        def flush() -> None:
            text = SPACE.sub(" ", entities.unescape("".join(held))).strip()
            held.clear()
            if text:
                out = bool(stack) and stack[-1][2]
                if not self.stream or self.stream[-1] != "#":
                    self.stream.append("#")
                if not out:
                    self.blocks.append((tuple(s[1] for s in stack if s[1]), text))
                    self.at.append(len(self.stream) - 1)
                    doubted.append(stack[-1][4] if stack else ())

        def close(name: str) -> None:
            while stack:
                gone = stack.pop()
                if gone[1]:
                    self.stream.append("/" + gone[1])
                if gone[0] == name:
                    return

        at, size = 0, len(page)
        while at < size and (m := TOKEN.match(page, at)):
            at = m.end()
            text, name = m["text"], m["name"]
            if text is not None or m["cdata"] is not None:
                held.append(text if text is not None else m["cdata"])
                continue
            if name is None:
                continue
            name = name.lower()
            if m["end"]:
                if name in INLINE or not any(s[0] == name for s in stack):
                    if name == "p":
                        flush()
                    continue
                flush()
                close(name)
                continue
            if name in RAW:
                done = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
                at = done.end() if done else size
                continue
            if name in INLINE:
                continue
            flush()
            if name in VOID:
                continue
            if name in CLOSES_P and any(s[0] == "p" for s in stack):
                close("p")
            elif name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                close(name)
            mark, central, against, out = _element(name, m["rest"])
            parent_out, in_article, around = stack[-1][2:] if stack else (False, False, ())
            if name in ("html", "body", "article", "main") or (in_article and (name == "header" or HEADING.match(name))):
                # Classes of these tell of the page's layout, not of its parts.
                out = parent_out and not (in_article and stack[-1][0] == "header" and HEADING.match(name))
                if in_article and name == "header":
                    out = True
            else:
                out = out or parent_out
                if against and not out:
                    doubts += 1
                    around = (*around, doubts)
            stack.append((name, mark, out, in_article or central, around))
            self.stream.append(mark)
        flush()
        self._judge(doubted)

    def _judge(self, doubted: list[tuple[int, ...]]) -> None:
        """Leave out what stands in elements that their classes speak against, unless such an element holds
        most of the text and no article or main element outside it has any."""
        sizes: Counter = Counter()
        main: Counter = Counter()
        for (place, text), around in zip(self.blocks, doubted):
            for number in {0, *around}:
                sizes[number] += len(text)
                main[number] += any(map(_is_main, place))
        gone = {n for around in doubted for n in around if 2 * sizes[n] <= sizes[0] or main[n] < main[0]}
        keep = [gone.isdisjoint(around) for around in doubted]
        self.blocks = [b for b, ok in zip(self.blocks, keep) if ok]
        self.at = [a for a, ok in zip(self.at, keep) if ok]


def _is_main(mark: str) -> bool:
    name, *classes = mark.split(".")
    return name in ("article", "main") or "articlebody" in classes


def fold(stream: list) -> list:
    """Runs of equal neighbouring parts as one repeated group, ``["+", part]``."""
    for size in range(1, LONGEST_PART + 1):
        out: list = []
        i = 0
        while i < len(stream):
            part = stream[i : i + size]
            j = i + size
            while len(part) == size and stream[j : j + size] == part:
                j += size
            if j > i + size:
                out.append(["+", part])
                i = j
            else:
                out.append(stream[i])
                i += 1
        stream = out
    return stream


def _repeats_of(one: list) -> list[list]:
    return [x[1] for x in one if isinstance(x, list) and x[0] == "+"]


def _as_repeat(stream: list, parts: list[list]) -> list:
    """Single occurrences of parts that the other stream repeats, as repeated groups."""
    by_first: dict[str, list] = {}
    for part in parts:
        known = by_first.setdefault(json.dumps(part[0]), [])
        if part not in known:
            known.append(part)
    if not by_first:
        return stream
    out, i = [], 0
    while i < len(stream):
        part = next((p for p in by_first.get(json.dumps(stream[i]), ()) if stream[i : i + len(p)] == p), None)
        out.append(stream[i] if part is None else ["+", part])
        i += 1 if part is None else len(part)
    return out


def _rows(one: list, two: list):
    """Bit vectors after each item of ``one``: bit j is 0 where a longest common sequence grows with item j of ``two``."""
    places: dict = {}
    for j, x in enumerate(two):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(two)) - 1
    row = full
    for x in one:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
        yield row


def _lengths(row: int, m: int) -> np.ndarray:
    """Lengths of the longest common sequence with each beginning of the other side."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(m // 8 + 1, "little"), dtype=np.uint8), bitorder="little")[:m]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_items(one: list, two: list) -> list[tuple[int, int]]:
    """Index pairs of a longest common sequence.

    A whole row of the usual table is one number, so tens of thousands of items take a second. Tables of
    over ALIGN_BITS are halved where a longest sequence passes, which needs two rows only.
    """
    n, m = len(one), len(two)
    if not n or not m:
        return []
    if n * m > ALIGN_BITS and n > 1:
        middle = n // 2
        for ahead in _rows(one[:middle], two):
            pass
        for behind in _rows(one[middle:][::-1], two[::-1]):
            pass
        at = int((_lengths(ahead, m) + _lengths(behind, m)[::-1]).argmax())
        later = [(i + middle, j + at) for i, j in common_items(one[middle:], two[at:])]
        return common_items(one[:middle], two[:at]) + later
    rows = list(_rows(one, two))
    pairs, i, j = [], n, m
    while i and j:
        if rows[i - 1] >> j - 1 & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> j - 1 & 1:
            j -= 1
            pairs.append((i, j))
    return pairs[::-1]


def align(one: list, two: list) -> list:
    """The expression that both match: common items, and what only one has as optional groups."""
    one, two = _as_repeat(one, _repeats_of(two)), _as_repeat(two, _repeats_of(one))
    if one == two:
        return one
    bare = lambda x: x[1] if isinstance(x, list) and x[0] == "?" else [x]
    n, m = len(one), len(two)
    pairs = common_items(*([json.dumps(bare(x)) for x in side] for side in (one, two)))
    out: list = []

    def optional(items: list) -> None:
        """What is optional already stays as it is; the rest becomes so, run by run."""
        run: list = []
        for item in [*items, None]:
            if item is None or isinstance(item, list) and item[0] == "?":
                out.extend([["?", run]] if run else [])
                out.extend([item] if item else [])
                run = []
            else:
                run.append(item)

    i = j = 0
    for to_i, to_j in [*pairs, (n, m)]:
        optional(one[i:to_i])
        optional(two[j:to_j])
        if to_i < n:
            both = any(isinstance(x, list) and x[0] == "?" for x in (one[to_i], two[to_j]))
            out.append(["?", bare(one[to_i])] if both else one[to_i])
        i, j = to_i + 1, to_j + 1
    return out


def shown(wrapper: list) -> str:
    """A wrapper as an expression: ``<tag>``, ``#`` for a text, ``(...)+`` and ``(...)?``."""
    parts = []
    for item in wrapper:
        if isinstance(item, list):
            parts.append(f"({shown(item[1])}){item[0]}")
        else:
            parts.append(item if item == "#" else f"<{item}>")
    return "".join(parts)


class Sequence:
    """Items that stand one after the other in a wrapper: where each token may begin one, and what may be left out."""

    def __init__(self, parent: Sequence | None, index: int):
        # The item of the parent that this sequence is, and whether it repeats.
        self.parent, self.index, self.repeats = parent, index, False
        # For each token: the items that may begin with it, in order, and the states that they begin with.
        self.places: dict[str, tuple[list[int], list[int]]] = {}
        # For each item the first one from there on that must not be left out, or the number of items.
        self.stops: list[int] = []


class Matcher:
    """The automaton of a wrapper: its items by number, and which may follow which.

    What may follow is read off the sequence that an item stands in, so that the automaton grows with the
    wrapper also where many optional parts stand side by side.
    """

    def __init__(self, wrapper: list):
        self.items: list[str] = [""]
        self.home: list[tuple[Sequence, int]] = []
        root = Sequence(None, -1)
        self.home.append((root, -1))
        self._add(root, wrapper)
        # For each state and token the states that follow, once they are found; None where they are many.
        self.near: list[dict[str, tuple[int, ...] | None]] = [{} for _ in self.items]

    def _add(self, own: Sequence, items: list) -> list[int]:
        """Number the items of a sequence; the states that it may begin with."""
        first: list[int] = []
        empty, left_out = True, []
        for index, item in enumerate(items):
            if isinstance(item, list):
                part = Sequence(own, index)
                part.repeats = item[0] == "+"
                begins = self._add(part, item[1])
                left_out.append(item[0] == "?" or part.stops[0] == len(item[1]))
            else:
                self.items.append(item)
                self.home.append((own, index))
                begins = [len(self.items) - 1]
                left_out.append(False)
            for state in begins:
                indexes, states = own.places.setdefault(self.items[state], ([], []))
                indexes.append(index)
                states.append(state)
            first = first + begins if empty else first
            empty = empty and left_out[-1]
        own.stops = [len(items)] * (len(items) + 1)
        for index in range(len(items) - 1, -1, -1):
            own.stops[index] = own.stops[index + 1] if left_out[index] else index
        return first

    def _after(self, state: int):
        """Stretches of items, each of one sequence, of which one may follow a state: the sequence, the item before and the last."""
        own, index = self.home[state]
        while True:
            stop = own.stops[index + 1]
            yield own, index, stop
            if stop < len(own.stops) - 1:
                return
            if own.repeats:
                yield own, -1, own.stops[0]
            if own.parent is None:
                return
            own, index = own.parent, own.index

    def _may_end(self, state: int) -> bool:
        own, index = self.home[state]
        while own is not None:
            if own.stops[index + 1] < len(own.stops) - 1:
                return False
            own, index = own.parent, own.index
        return True

    def _step(self, now: dict[int, int], token: str) -> dict[int, int]:
        """The states after one more token, each with the first state that leads to it."""
        then: dict[int, int] = {}
        # How far back the items of a stretch have been looked at: side by side all end at one item.
        seen: dict[tuple[int, int], int] = {}
        for at in now:
            near = self.near[at].get(token, UNKNOWN)
            if near is not None and near is not UNKNOWN:
                for to in near:
                    then.setdefault(to, at)
                continue
            found: list[int] | None = [] if near is UNKNOWN else None
            for own, before, last in self._after(at):
                if token not in own.places:
                    continue
                indexes, states = own.places[token]
                lo, hi = bisect_right(indexes, before), bisect_right(indexes, last)
                if found is not None:
                    if hi - lo + len(found) > NEAR:
                        found = self.near[at][token] = None
                    else:
                        found += states[lo:hi]
                key = (id(own), last)
                hi = min(hi, seen.get(key, hi))
                for k in range(lo, hi):
                    then.setdefault(states[k], at)
                seen[key] = min(lo, seen.get(key, lo))
            if found is not None:
                self.near[at][token] = tuple(found)
        return then

    def match(self, stream: list[str]) -> list[int] | None:
        """The wrapper's item for each of the stream's, or None if they do not match."""
        now = {0: 0}
        # The states before each stretch of the stream, and those within it while there is room; else they are found again.
        marks: list[dict[int, int]] = []
        steps: list[list[dict[int, int]] | None] = []
        room = HELD_STATES
        for i, token in enumerate(stream):
            if i % STRETCH == 0:
                marks.append(now)
                steps.append([])
            now = self._step(now, token)
            if not now:
                return None
            steps[-1].append(now)
            room -= len(now)
            if room < 0:
                steps[:-1] = [None] * (len(steps) - 1)
                room = HELD_STATES - sum(map(len, steps[-1]))
        at = min((x for x in now if self._may_end(x)), default=None)
        if at is None:
            return None
        path = []
        for k in range(len(marks) - 1, -1, -1):
            back = steps[k]
            if back is None:
                back, now = [], marks[k]
                for token in stream[k * STRETCH : (k + 1) * STRETCH]:
                    now = self._step(now, token)
                    back.append(now)
            for step in reversed(back):
                path.append(at)
                at = step[at]
        return path[::-1]


def slots(page: Page, matcher: Matcher | None) -> list[str]:
    """The slot of each block."""
    path = matcher.match(page.stream) if matcher else None
    return [str(path[i]) if path else ">".join(place) for (place, _), i in zip(page.blocks, page.at)]


def _texts(page: Page, matcher: Matcher | None) -> list[str]:
    """For each block its slot, and the hash of all text that stands there, as line breaks do not end a slot."""
    whole: dict[int, str] = {}
    for (_, text), i in zip(page.blocks, page.at):
        whole[i] = f"{whole[i]}\n{text}" if i in whole else text
    return [f"{slot} {_digest(whole[i])}" for slot, i in zip(slots(page, matcher), page.at)]


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()


def text_of_page(page: Page, texts: list[str], template: frozenset[str]) -> str:
    """The blocks of the page that are not the host's."""
    own = [t not in template for t in texts]
    heading = [bool(place) and HEADING.match(place[-1].split(".")[0]) is not None for place, _ in page.blocks]
    # A heading stays with what is beside it.
    beside = {place[:k] for (place, _), o, h in zip(page.blocks, own, heading) if o and not h for k in range(len(place) + 1)}
    kept = [o or (h and place[:-1] in beside and len(place) > 1) for (place, _), o, h in zip(page.blocks, own, heading)]
    return "\n".join(text for (_, text), k in zip(page.blocks, kept) if k)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper, pages`` from ``host, html``: one expression for each host."""

    def forms(frames):
        held: Counter = Counter()
        for frame in frames:
            for host, value in zip(frame["host"], frame["html"]):
                held[host, json.dumps(fold(Page(text_of(value)).stream))] += 1
            if len(held) > 20_000:
                yield table(held)
                held = Counter()
        if held:
            yield table(held)

    def table(held):
        return pd.DataFrame([(host, form, n) for (host, form), n in held.items()], columns=["host", "wrapper", "pages"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["pages", "wrapper"], ascending=[False, True])
        whole = None
        for form in map(json.loads, frame["wrapper"]):
            whole = form if whole is None else align(whole, form)
        return pd.DataFrame([(frame["host"].iat[0], json.dumps(whole), int(frame["pages"].sum()))], columns=["host", "wrapper", "pages"])

    schema = "host string, wrapper string, pages long"
    found = pages.select("host", "html").mapInPandas(forms, schema)
    while True:
        found = cut_lineage(found.groupBy("host", "wrapper").agg(F.sum("pages").alias("pages")), "forms")
        sizes = found.groupBy("host").agg(F.count("*").alias("_n"))
        most = sizes.agg(F.max("_n")).first()[0] or 0
        if most <= 1:
            return found
        dealt = found.join(sizes, "host").withColumn(
            "_group", F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("_n") / F.lit(GROUP_FORMS)).cast("long"))
        )
        found = dealt.drop("_n").groupBy("host", "_group").applyInPandas(lambda f: merge(f.drop(columns="_group")), schema)


def _matchers():
    """Wrappers by host, each made ready once in a task."""
    held: dict[str, Matcher] = {}

    def of(host: str, wrapper) -> Matcher | None:
        if not isinstance(wrapper, str):
            return None
        if host not in held:
            if len(held) >= 1000:
                held.clear()
            held[host] = Matcher(json.loads(wrapper))
        return held[host]

    return of


def infer_templates(pages: DataFrame) -> DataFrame:
    """``host, template`` from ``host, html, wrapper``: slots with a text that is the host's own."""

    def texts(frames):
        matcher = _matchers()
        for frame in frames:
            rows = []
            for host, value, wrapper in zip(frame["host"], frame["html"], frame["wrapper"]):
                page = Page(text_of(value))
                found = _texts(page, matcher(host, wrapper))
                # An empty text stands for the slot, an empty slot for the page.
                every = sorted(set(found) | {t.rsplit(" ", 1)[0] + " " for t in found} | {" "})
                rows.append((host, _digest("\n".join(found)), every))
            yield pd.DataFrame(rows, columns=["host", "page", "texts"])

    found = pages.mapInPandas(texts, "host string, page string, texts array<string>").dropDuplicates(["host", "page"])
    counted = found.select("host", F.explode("texts").alias("t")).groupBy("host", "t").agg(F.count("*").alias("n"))
    counted = cut_lineage(counted.where(F.col("n") >= TEMPLATE_PAGES), "slots")
    slot = F.regexp_extract("t", r"(?s)^(.*) [0-9a-f]*$", 1)
    whole = counted.where("t LIKE '% '").select("host", slot.alias("slot"), F.col("n").alias("of"))
    every = whole.where("slot = ''").select("host", F.col("of").alias("pages"))
    const = counted.where("t NOT LIKE '% '").withColumn("slot", slot).join(whole, ["host", "slot"]).join(every, "host")
    const = const.where((F.col("n") >= F.lit(TEMPLATE_SHARE) * F.col("of")) & (F.col("n") >= F.lit(TEMPLATE_HOST) * F.col("pages")))
    # A host has few texts that half of its pages have.
    return const.groupBy("host").agg(F.collect_list("t").alias("template"))


def extract(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page."""
    given = df.select(F.col(page_id).cast("string").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://([^/?#:]+)", 1), F.lit("")))
    given = given.withColumn("host", host)
    wrappers = cut_lineage(infer_wrappers(given).where(F.col("pages") >= TEMPLATE_PAGES), "wrappers")
    templates = cut_lineage(infer_templates(given.join(wrappers, "host").select("host", "html", "wrapper")), "templates")
    # Written, so that Spark sees how small it is and need not deal all pages by host.
    known = cut_lineage(wrappers.join(templates, "host").select("host", "wrapper", "template"), "known")

    def cut(frames):
        matcher = _matchers()
        for frame in frames:
            texts = []
            for host, value, wrapper, template in zip(frame["host"], frame["html"], frame["wrapper"], frame["template"]):
                page = Page(text_of(value))
                own = frozenset(template) if template is not None else frozenset()
                # Without template texts the slots do not matter.
                texts.append(text_of_page(page, _texts(page, matcher(host, wrapper)) if own else [""] * len(page.blocks), own))
            out = frame[["page_id", "url"]].copy()
            out["text"], out["n_chars"] = texts, [len(t) for t in texts]
            yield out

    joined = given.join(known, "host", "left").select("page_id", "url", "host", "html", "wrapper", "template")
    found = joined.mapInPandas(cut, "page_id string, url string, text string, n_chars long")
    return found.withColumn("page_id", F.col("page_id").cast(df.schema[page_id].dataType))
