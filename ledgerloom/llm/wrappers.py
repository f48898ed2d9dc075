"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of tokens: opening tags with their class, closing tags and text. The stream is
folded: elements that repeat next to each other become one repeated group. Streams of the same host
are then aligned one after the other; where they differ, the stretches become optional groups, and a
repeated group takes in single occurrences. Text is a slot. What comes out is a regular expression with
repeats and options but no alternatives, that describes all pages of the host: the wrapper.

Each page is then matched against the wrapper of its host, which tells the slot of every text. Over all
pages of a host a slot gathers characters, linked characters and how often its text is the same. A slot
outside repeated groups whose text is constant over the host's pages is template; of the others, tags
and class words tell the article from what stands beside it.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_map, record_batch
from ledgerloom.session import materialise

#: Names of the HTML standard, and words that sites use for parts beside the article.
HIDDEN = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
CLOSED_BY = {"p": {"p", "div", "ul", "ol", "dl", "table", "section", "article", "aside", "nav", "header", "footer", "form", "h1", "h2", "h3",
                   "h4", "h5", "h6", "blockquote", "pre", "figure", "main", "hr"},
             "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
             "option": {"option"}}
BESIDE_TAGS = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset"}
BESIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
                "consent", "notice", "notices", "alert", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
                "comment", "comments", "discussion", "replies", "respond", "share", "sharing", "social", "related", "recommended",
                "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal", "overlay", "footer", "header", "masthead",
                "widget", "toolbar", "pagination", "pager", "tags", "disclaimer"}
#: Class words of parts that hold pieces marked as articles of their own, and words that may follow them in a class.
BESIDE_LISTS = {"comment", "comments", "discussion", "replies", "respond", "related", "recommended"}
LIST_WORDS = {"list", "area", "section", "container", "wrapper", "wrap", "box", "thread", "block", "items", "feed"}
#: First words of classes that say what a page has or lacks, not what an element is.
STATES = {"has", "no", "not", "with", "without", "is", "hide", "show", "js"}
BESIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
MAIN_TAGS = {"article", "main"}
BLOCK_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "blockquote", "pre", "figcaption"}

SLOT = "#"
#: Elements nested deeper count as parts of the one at this depth, as browsers do it.
DEPTH = 512
#: Longest repeated element, in tokens, that folding looks for.
LONGEST_UNIT = 24
#: Without a marked article: the smallest element that holds this share of the host's text.
MAIN_SHARE = 0.6
#: A slot is template if this share of its pages has one text, on so many pages and this share of the host's.
CONSTANT_SHARE, CONSTANT_PAGES, PRESENT_SHARE = 0.9, 3, 0.5
#: Different texts of a slot that are counted; more of them lower all counts.
COUNTED_TEXTS = 8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(HIDDEN) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_DIGITS_AND_SIGNS = re.compile(r"[^a-z]+")


def label_of(name: str, attributes: str) -> str:
    """A tag's name with its class, id and role values; letters only, the words of a value joined by `-`."""
    if "=" not in attributes:
        return name
    values = set()
    for m in _ATTRIBUTE.finditer(attributes):
        for value in (m.group(2) or m.group(3) or m.group(4) or "").lower().split():
            words = _DIGITS_AND_SIGNS.sub("-", value).strip("-")
            if words:
                values.add(f"@{m.group(1)[0].lower()}{words}")
    return name + "".join(sorted(values)) if values else name


def read_page(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(token, path, text, linked): structure tokens with text empty, and text tokens `#`.

    Inline tags are left out, but words on either side of `br` stay apart. Ends that HTML lets out are
    put in. A path lists the labels of the open elements.
    """
    stack: list[tuple[str, str]] = []  # name, path
    opened: Counter = Counter()
    path, text, links, at = "", [], 0, 0

    def flush() -> Iterator[tuple[str, str, str, bool]]:
        nonlocal text
        if text:
            words = " ".join(entities.unescape("".join(text)).split())
            text = []
            if words:
                yield SLOT, path, words, links > 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        name = m.group(3)
        if name is None:
            continue
        name, closing = name.lower(), bool(m.group(2))
        if name in INLINE:
            if name == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        if name in VOID:
            text.append(" ")
            continue
        yield from flush()
        if closing:
            if opened[name]:
                while stack:
                    top, _ = stack.pop()
                    opened[top] -= 1
                    path = stack[-1][1] if stack else ""
                    yield f"/{top}", path, "", False
                    if top == name:
                        break
            continue
        while stack and name in CLOSED_BY.get(stack[-1][0], ()):
            top, _ = stack.pop()
            opened[top] -= 1
            path = stack[-1][1] if stack else ""
            yield f"/{top}", path, "", False
        label = label_of(name, m.group(4))
        if len(stack) < DEPTH:
            path = f"{path}/{label}"
        stack.append((name, path))
        opened[name] += 1
        yield label, path, "", False
    if at < len(page):
        text.append(page[at:])
    yield from flush()
    while stack:  # a page that was cut off ends here
        top, _ = stack.pop()
        path = stack[-1][1] if stack else ""
        yield f"/{top}", path, "", False


def fold(tokens: list) -> list:
    """The sequence with neighbouring equal elements as ('+', unit)."""
    out: list = []
    for token in tokens:
        out.append(token)
        changed = isinstance(token, str) and token.startswith("/") or isinstance(token, tuple)
        while changed:
            changed = False
            for size in range(1, min(LONGEST_UNIT, len(out) - 1) + 1):
                unit = out[-size:]
                head = unit[0]
                if size == 1 and not isinstance(head, tuple) or isinstance(head, str) and (head == SLOT or head.startswith("/")):
                    continue
                group = ("+", tuple(unit))
                before = out[-size - 1]
                if before == group or size == 1 and isinstance(head, tuple) and before == head:
                    del out[-size:]
                    changed = True
                elif out[-2 * size : -size] == unit and len(out) >= 2 * size:
                    del out[-2 * size :]
                    out.append(unit[0] if size == 1 and unit[0][0] == "+" else group)
                    changed = True
                if changed:
                    break
    return out


def align(left: list, right: list) -> list:
    """A sequence that describes both: equal parts stay, others become optional or repeated groups."""
    if left == right:
        return left
    out: list = []
    for kind, a, b, c, d in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        x, y = left[a:b], right[c:d]
        if kind == "equal":
            out += x
            continue
        merged = _repeated(x, y) or _repeated(y, x)
        if merged:
            out += merged
            continue
        for part in (x, y):
            if part:
                # what is optional already stays so by itself
                out += part if all(isinstance(p, tuple) and p[0] == "?" for p in part) else [("?", tuple(part))]
    return fold(_merge_options(out))


def _repeated(x: list, y: list) -> list | None:
    """[repeat] if x is a repeated group and y one occurrence of its unit."""
    if len(x) == 1 and isinstance(x[0], tuple) and x[0][0] == "+" and tuple(y) == x[0][1]:
        return x
    return None


def _merge_options(sequence: list) -> list:
    """Neighbouring equal options as one."""
    out: list = []
    for item in sequence:
        if not (out and isinstance(item, tuple) and item[0] == "?" and out[-1] == item):
            out.append(item)
    return out


def beside(path: str) -> bool:
    """Whether a path leads through an element beside the article.

    What holds the article is beside it only if a whole class, id or role says so: a page that has a
    sidebar is none. Elsewhere one word of a value is enough.
    """
    labels = [label.split("@") for label in path.split("/")[1:]]
    main = max((k for k, (name, *_) in enumerate(labels) if name in MAIN_TAGS), default=-1)
    within = False
    for k, (name, *values) in enumerate(labels):
        holds = k < main
        if not holds and (name in BESIDE_TAGS or name == "header" and not within):
            return True
        if name not in MAIN_TAGS | {"body", "html"}:
            for value in values:
                words = value[1:].split("-")
                if value[0] == "r":
                    found = value[1:] in BESIDE_ROLES
                elif words[0] in STATES:
                    found = False
                elif holds:
                    found = words[-1] in BESIDE_WORDS or words[0] in BESIDE_LISTS and words[-1] in LIST_WORDS
                else:
                    found = not BESIDE_WORDS.isdisjoint(words)
                if found:
                    return True
        within = within or name in MAIN_TAGS
    return False


class Matcher:
    """Finds the slot of every text of a page: its number among the `#` of the expression."""

    def __init__(self, expression: list) -> None:
        self.code: list[tuple] = []  # (token, slot), (None, first choice, second choice)
        self.repeated: list[bool] = []  # per slot
        self._compile(expression, False)

    def _compile(self, sequence: list, repeated: bool) -> None:
        for item in sequence:
            if isinstance(item, str):
                self.code.append((item, len(self.repeated) if item == SLOT else -1))
                if item == SLOT:
                    self.repeated.append(repeated)
                continue
            kind, unit = item
            first = len(self.code)
            if kind == "?":
                self.code.append(())
            self._compile(unit, repeated or kind == "+")
            if kind == "?":
                self.code[first] = (None, first + 1, len(self.code))
            else:
                self.code.append((None, first, len(self.code) + 1))

    def slots(self, tokens: list[str]) -> list[int] | None:
        """Slot of each text token in turn, or None if the expression does not describe the page."""
        code, last, size = self.code, len(self.code), len(tokens)
        seen: set[tuple[int, int]] = set()
        trail: list[int] = []
        untried = [(0, 0, 0)]
        while untried:
            place, at, kept = untried.pop()
            del trail[kept:]
            while place < last:
                step = code[place]
                if step[0] is None:
                    if (place, at) in seen:
                        break
                    seen.add((place, at))
                    untried.append((step[2], at, len(trail)))
                    place = step[1]
                elif at < size and tokens[at] == step[0]:
                    if step[1] >= 0:
                        trail.append(step[1])
                    at += 1
                    place += 1
                else:
                    break
            else:
                if at == size:
                    return trail
        return None

    def texts(self, page: str) -> list[tuple[str, str, bool]]:
        """(slot with path, text, linked) of a page's texts; slot -1 if the wrapper does not describe it."""
        read = list(read_page(page))
        found = [(path, text, linked) for _, path, text, linked in read if text]
        slots = self.slots([token for token, *_ in read])
        return [(f"{n}{path}", text, linked) for n, (path, text, linked) in zip(slots or [-1] * len(found), found)]


def path_of(slot: str) -> str:
    return "".join(slot.partition("/")[1:])


def _container(path: str) -> str:
    """The element that holds a text's block: the parent of a block element, else the element itself."""
    parent, _, label = path.rpartition("/")
    return parent if label.split("@")[0] in BLOCK_TAGS else path


def _bounded(texts: dict[str, int]) -> dict[str, int]:
    """Counts of at most COUNTED_TEXTS texts; each is too low by no more than the others' number."""
    while len(texts) > COUNTED_TEXTS:
        least = min(texts.values())
        texts = {t: n - least for t, n in texts.items() if n > least}
    return texts


class SlotCounts:
    """Per slot with path of a host: pages, characters, linked characters, counts of equal texts, repeated."""

    def __init__(self, slots: dict[str, list] | None = None, pages: int = 0) -> None:
        self.slots, self.pages = slots or {}, pages

    def add(self, slots: dict[str, list], pages: int) -> None:
        self.pages += pages
        for slot, counts in slots.items():
            own = self.slots.setdefault(slot, [0, 0, 0, {}, counts[4]])
            for k in range(3):
                own[k] += counts[k]
            for text, n in counts[3].items():
                own[3][text] = own[3].get(text, 0) + n
            own[3] = _bounded(own[3])

    def show(self, page: str, matcher: Matcher) -> None:
        slots: dict[str, list] = {}
        texts: dict[str, xxhash.xxh3_64] = {}
        for slot, text, linked in matcher.texts(page):
            n = int(slot.partition("/")[0])
            own = slots.setdefault(slot, [1, 0, 0, {}, n < 0 or matcher.repeated[n]])
            own[1] += len(text)
            own[2] += len(text) * linked
            texts.setdefault(slot, xxhash.xxh3_64()).update(text.encode("utf-8", "replace") + b"\0")
        for slot, digest in texts.items():
            slots[slot][3] = {digest.hexdigest(): 1}
        self.add(slots, 1)

    def constant(self, slot: str) -> bool:
        pages, _, _, texts, _ = self.slots[slot]
        return pages >= CONSTANT_PAGES and max(texts.values(), default=0) >= CONSTANT_SHARE * pages

    def main(self) -> tuple[list[str], list[str]]:
        """`main_slots` without template: slots outside repeated groups whose text is constant over the host's pages.

        A constant block (a heading, a paragraph) whose container also holds varying text is part of the
        article, as a section's name is; a container that says the same on all pages is template. A title
        (h1) may be constant and stays. Where nothing varies, as in copies of one page, nothing tells
        template from content.
        """
        constant = {x for x, s in self.slots.items() if not s[4] and s[0] >= PRESENT_SHARE * self.pages and self.constant(x)}
        varying = {_container(path_of(x)) for x in self.slots if x not in constant and not self.constant(x)}

        def kept(slot: str) -> bool:
            path = path_of(slot)
            tag = path.rpartition("/")[2].split("@")[0]
            return tag == "h1" or tag in BLOCK_TAGS and _container(path) in varying

        template = {x for x in constant if not kept(x)}
        marked, other = main_slots({x: s for x, s in self.slots.items() if x not in template})
        if template and all(map(self.constant, marked + other)):
            return main_slots(self.slots)
        return marked, other


def main_slots(slots: dict[str, list]) -> tuple[list[str], list[str]]:
    """Slots of the main text: in marked articles; and, for pages without one, elsewhere."""
    own = {x: s for x, s in slots.items() if not beside(path_of(x))}
    marked = [x for x in own if any(label.split("@")[0] in MAIN_TAGS for label in path_of(x).split("/"))]
    rest = {x: s for x, s in own.items() if x not in set(marked)}
    # menus without a telling name are mostly links
    text = {x: s[1] - s[2] for x, s in rest.items() if 2 * s[2] < s[1]}
    total = sum(text.values())
    mass: dict[str, int] = {}
    for x, n in text.items():
        labels = path_of(x).split("/")
        for k in range(1, len(labels) + (labels[-1].split("@")[0] not in BLOCK_TAGS)):
            prefix = "/".join(labels[:k])
            mass[prefix] = mass.get(prefix, 0) + n
    holders = [p for p, n in mass.items() if n >= MAIN_SHARE * total]
    deepest = max(holders, key=lambda p: (p.count("/"), p), default=None)
    others = [x for x in text if deepest is not None and f"{path_of(x)}/".startswith(f"{deepest}/")]
    return sorted(marked), sorted(others)


class HostWrapper:
    """A wrapper that grows by the pages it is shown."""

    def __init__(self, expression: list | None = None, pages: int = 0) -> None:
        self.expression, self.pages = expression, pages

    def add(self, expression: list, pages: int) -> None:
        self.expression = expression if self.expression is None else align(self.expression, expression)
        self.pages += pages

    def show(self, page: str, known: set) -> None:
        expression = fold([token for token, *_ in read_page(page)])
        name = tuple(expression)
        if name in known:  # the wrapper describes this page already
            self.pages += 1
            return
        known.add(name)
        self.add(expression, 1)


def _frozen(x):
    return (x[0], tuple(map(_frozen, x[1]))) if isinstance(x, list) else x


def parsed(expression: str) -> list:
    return list(map(_frozen, json.loads(expression)))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, expression (JSON) and pages of every host.

    Tasks align their own pages of a host; the partial wrappers, one per task and host, are then
    aligned in order, so a host with a third of all pages is no larger there than another.
    """
    columns = "host string, task int, expression string, pages long"

    def rows(found: dict[str, HostWrapper], task: int) -> pa.RecordBatch:
        return record_batch(
            host=(list(found), pa.string()),
            task=([task] * len(found), pa.int32()),
            expression=([json.dumps(w.expression) for w in found.values()], pa.string()),
            pages=([w.pages for w in found.values()], pa.int64()),
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found: dict[str, HostWrapper] = {}
        known: dict[str, set] = {}
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                if page:
                    found.setdefault(host, HostWrapper()).show(page, known.setdefault(host, set()))
            if len(found) > 5000:
                yield rows(found, TaskContext.get().partitionId())
                found, known = {}, {}
        yield rows(found, TaskContext.get().partitionId())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, wrapper = None, HostWrapper()

        def out() -> pa.RecordBatch:
            return record_batch(
                host=([host], pa.string()), expression=([json.dumps(wrapper.expression)], pa.string()), pages=([wrapper.pages], pa.int64())
            )

        for batch in batches:
            for row in batch.to_pylist():
                if wrapper.pages and row["host"] != host:
                    yield out()
                    wrapper = HostWrapper()
                host = row["host"]
                wrapper.add(parsed(row["expression"]), row["pages"])
        if wrapper.pages:
            yield out()

    parts = arrow_map(pages.select("host", "html"), partial, columns)
    # partial wrappers of a host in the same order after a lost task
    ordered = parts.repartition("host").sortWithinPartitions("host", "task", "expression")
    return arrow_map(ordered, whole, "host string, expression string, pages long")


def choose_slots(matched: DataFrame) -> DataFrame:
    """host, marked and other (main slots) from pages (host, html, expression).

    Tasks count the slots of their own pages of a host; the counts of a host are then added up.
    """
    texts = pa.list_(pa.string())

    def rows(found: dict[str, SlotCounts], task: int) -> pa.RecordBatch:
        return record_batch(
            host=(list(found), pa.string()),
            task=([task] * len(found), pa.int32()),
            slots=([json.dumps(c.slots) for c in found.values()], pa.string()),
            pages=([c.pages for c in found.values()], pa.int64()),
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found: dict[str, SlotCounts] = {}
        matchers = Matchers()
        for batch in batches:
            for host, page, expression in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "expression"))):
                if page:
                    found.setdefault(host, SlotCounts()).show(page, matchers.of(host, expression))
            if len(found) > 5000:
                yield rows(found, TaskContext.get().partitionId())
                found = {}
        yield rows(found, TaskContext.get().partitionId())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, counts = None, SlotCounts()

        def out() -> pa.RecordBatch:
            marked, other = counts.main()
            return record_batch(host=([host], pa.string()), marked=([marked], texts), other=([other], texts))

        for batch in batches:
            for row in batch.to_pylist():
                if counts.pages and row["host"] != host:
                    yield out()
                    counts = SlotCounts()
                host = row["host"]
                counts.add(json.loads(row["slots"]), row["pages"])
        if counts.pages:
            yield out()

    parts = arrow_map(matched.select("host", "html", "expression"), partial, "host string, task int, slots string, pages long")
    ordered = parts.repartition("host").sortWithinPartitions("host", "task", "slots")
    return arrow_map(ordered, whole, "host string, marked array<string>, other array<string>")


class Matchers:
    """Matchers of the hosts met last."""

    def __init__(self) -> None:
        self.known: dict[str, Matcher] = {}

    def of(self, host: str, expression: str | None) -> Matcher:
        if host not in self.known:
            if len(self.known) > 5000:
                self.known.clear()
            self.known[host] = Matcher(parsed(expression or "[]"))
        return self.known[host]


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of (page_id, url, html).

    Each page is matched against its host's wrapper. The text is that of the main slots: those in the
    marked article, or in a page without one, in the element that holds most of the host's text; slots
    whose text is constant over the host's pages are left out, unless no main slot of the host varies.
    A null or empty page, and one without main
    text, gives the empty text. A null url or one without a host counts as the host "". Repeated rows
    give a row each; other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    source = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), host.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    # a written table's size tells Spark whether it may be broadcast
    wrappers = materialise(infer_wrappers(source), "wrappers").select("host", "expression")
    chosen = materialise(choose_slots(source.join(wrappers, "host", "left")), "slots")
    wrappers = materialise(wrappers.join(chosen, "host"), "main-slots")
    kind = pages.schema["page_id"].dataType.simpleString()
    names = ("host", "html", "expression", "marked", "other")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, tuple[frozenset, frozenset]] = {}
        matchers = Matchers()
        for batch in batches:
            texts = []
            for name, page, expression, *chosen in zip(*(batch.column(c).to_pylist() for c in names)):
                if name not in sets:
                    if len(sets) > 5000:
                        sets.clear()
                    sets[name] = tuple(frozenset(x or ()) for x in chosen)
                marked, other = sets[name]
                found = matchers.of(name, expression).texts(page) if page else []
                main = [t for x, t, _ in found if x in marked] or [t for x, t, _ in found if x in other]
                texts.append(" ".join(main))
            yield record_batch(
                page_id=(batch.column("page_id"), None), url=(batch.column("url"), None), text=(texts, pa.string()), n_chars=(list(map(len, texts)), pa.int64())
            )

    joined = source.join(wrappers, "host", "left").select("page_id", "url", *names)
    return arrow_map(joined, extract, f"page_id {kind}, url string, text string, n_chars long")
