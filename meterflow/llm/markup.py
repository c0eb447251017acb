"""A forgiving HTML reader that gives containers, their text blocks and paths.

``parse`` reads a page once, with one pattern for tags, comments and raw-text
elements, and keeps the elements that can hold an article as a tree. It closes what
HTML closes by itself (``p``, ``li``, table cells), ignores end tags without a start,
and treats the end of a cut-off page as the end of all open elements.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

#: Elements whose start or end ends a text block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Elements that are never part of an article.
DROPPED = frozenset(
    "nav footer aside form menu button select option textarea input label fieldset dialog iframe object embed applet "
    "noscript template svg canvas audio video map head".split()
)
#: Words of class, id or role that mark page furniture.
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|"
    r"overlay|sidebar\w*|side|widget\w*|rail|menu\w*|nav\w*|breadcrumbs?|toolbar|pagination|pager|header|masthead|footer|"
    r"comments?|commentlist|comment-\w+|disqus\w*|replies|reply|respond|discussion|share|sharing|social|related|"
    r"recommend\w*|newsletter|subscribe|signup|login|search\w*|form|skip|copyright|legal|complementary|navigation|"
    r"contentinfo)(?=$|[\s_-])",
    re.I,
)
#: Classes that only say that furniture is or isn't near, as in ``has-sidebar``.
ABOUT = re.compile(r"(?:^|(?<=\s))(?:has|with|no|without|show|hide)[_-][^\s]*", re.I)
#: Ids that mark reader comments and the like inside an article too; others there name its own sections.
COMMENTS = re.compile(r"(?:comments?|commentlist|comment-?\d+|comments?-(?:section|area|list)|disqus\w*|replies|respond)\Z", re.I)
#: Words of class or id that mark an advert among the words of a line.
INLINE_ADS = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*)(?=$|[\s_-])", re.I)
#: What a head holds; any other element ends it.
OF_HEAD = frozenset("head title meta link style script base noscript template".split())
#: Elements that an article names by an id of its own.
WORDING = frozenset("h1 h2 h3 h4 h5 h6 p section".split())
#: Furniture words that name the heading when they stand inside an article.
HEADING = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?=$|[\s_-])", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags that end an open element of these kinds.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
#: What an implied end does not reach beyond.
FENCES = frozenset("ul ol dl table tr body article section div main td th".split())
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(script|style|textarea|title|xmp|iframe|noembed|noframes|plaintext)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    # quotes count only behind an equals sign; nothing is taken back, so broken tags cost no search
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACE = re.compile(r"\s+")


class Element:
    """A block element: its path, text blocks in page order, and what scoring needs."""

    __slots__ = ("name", "step", "key", "parent", "dropped", "first", "last", "score")

    def __init__(self, name, step, parent, dropped, first):
        self.name, self.step, self.parent, self.dropped = name, step, parent, dropped
        self.key = hash((parent.key if parent else 0, step))
        self.first, self.last, self.score = first, None, 0.0

    @property
    def path(self) -> str:
        steps, element = [], self
        while element is not None:
            steps.append(element.step)
            element = element.parent
        return "/".join(reversed(steps))


def on_path(page: Page, path: str | None) -> list[Element]:
    """The kept elements whose path is ``path``; keys of paths are compared, so deep pages stay cheap."""
    key = 0
    for step in (path or "").split("/"):
        key = hash((key, step))
    return [e for e in page.elements if e.key == key and not e.dropped]


class Page:
    """Elements in page order, and text blocks as (text, dropped, characters in links)."""

    def __init__(self):
        self.elements: list[Element] = []
        self.blocks: list[tuple[str, bool, int, Element]] = []


def generalised(name: str, attributes: dict[str, str]) -> str:
    """``tag.class`` with classes sorted and digits replaced, so that numbered copies agree."""
    classes = sorted({re.sub(r"\d+", "#", c.lower()).replace("/", "_") for c in attributes.get("class", "").split()})
    return ".".join([name, *classes])


def parse(html: str | None) -> Page:
    """The tree of block elements of a page and the text blocks in page order."""
    page = Page()
    root = Element("html", "html", None, False, 0)
    page.elements.append(root)
    stack: list[Element] = [root]
    text: list[str] = []
    state = {"link": 0, "linked": 0, "hide": 0}  # hide: open inline elements of an advert
    standing: Counter[str] = Counter()  # open elements by name, so that a stray end tag costs no search

    def flush():
        if text:
            joined = SPACE.sub(" ", entities.unescape("".join(text))).strip()
            if joined:
                top = stack[-1]
                page.blocks.append((joined, top.dropped, min(len(joined), state["linked"]), top))
            text.clear()
        state["linked"] = state["hide"] = 0

    def close(upto: int):
        flush()
        while len(stack) > upto:
            element = stack.pop()
            element.last = len(page.blocks)
            standing[element.name] -= 1

    source, at = html or "", 0
    for m in TOKEN.finditer(source):
        if m.start() > at and not state["hide"]:
            part = source[at : m.start()]
            text.append(part)
            if state["link"]:
                state["linked"] += len(part)
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if m[2]:  # an end tag
            if name == "a":
                state["link"] = 0
            elif name in ("span", "ins"):
                state["hide"] = max(0, state["hide"] - 1)
            elif name in BLOCKS or name in DROPPED or standing[name]:
                if not standing[name]:
                    flush()
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == name:
                        close(i)
                        break
            continue
        if standing["head"] and name not in OF_HEAD:
            close(next(i for i, e in enumerate(stack) if e.name == "head"))
        if name == "a":
            state["link"] = 1
            continue
        if name in VOID and name not in ("hr",):
            text.append(" ")
            continue
        raw = m[4] or ""
        attributes = {}
        if "=" in raw:
            for a in ATTRIBUTE.finditer(raw):
                attributes.setdefault(a[1].lower(), entities.unescape(a[2] or a[3] or a[4] or ""))
        if name in ("span", "ins"):
            ad = not state["hide"] and any(INLINE_ADS.search(v) for k, v in attributes.items() if k != "role")
            state["hide"] += state["hide"] > 0 or ad
            continue
        marks = {k: ABOUT.sub("", v) for k, v in attributes.items()}
        marked = any(FURNITURE.search(v) for v in marks.values())
        if marked and (standing["article"] or standing["main"]):
            if name in WORDING and not (name == "section" and COMMENTS.match(marks.get("id", "").strip())):
                marks.pop("id", None)
            marked = any(FURNITURE.search(HEADING.sub("", v)) for v in marks.values())
        if name not in BLOCKS and name not in DROPPED and not (marked and name == "center"):
            continue
        flush()
        state["link"] = 0
        if name == "hr":
            continue
        if name in ("html", "body") and (name == "html" or standing["body"]):
            continue
        if name in BLOCKS and stack[-1].name == "p":
            close(len(stack) - 1)
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in CLOSES.get(name, ()):
                close(i)
                break
            if stack[i].name in FENCES:
                break
        parent = stack[-1]
        # body may carry theme classes; a header inside an article holds its heading
        furniture = (marked and name not in ("body", "main")) or name in DROPPED
        if name == "header" and not furniture:
            furniture = not (standing["article"] or standing["main"])
        element = Element(name, generalised(name, attributes), parent, parent.dropped or furniture, len(page.blocks))
        if not source.startswith("/", m.end() - 2) or name in ("p", "div"):
            stack.append(element)
            standing[name] += 1
            page.elements.append(element)
    if at < len(source) and not state["hide"]:
        text.append(source[at:])
    close(0)
    return page


#: Elements that can be the container of an article.
CONTAINERS = frozenset("html body main article section div td center".split())


def score(page: Page) -> None:
    """Score the containers: a block's text counts for the nearest container, less for each one above it.

    An ``article`` or ``main`` gets the text inside it undiminished, so that none of its parts outscores it.
    """
    for text, dropped, linked, owner in page.blocks:
        plain = len(text) - linked
        if dropped or plain <= 0:
            continue
        element, share, inside = owner, 1.0, False
        while element is not None and share > 1e-6:
            if element.name in ("article", "main") and not inside:
                element.score += plain
                share, inside = 0.25, True
            elif element.name in CONTAINERS:
                element.score += share * plain
                share *= 0.5
            element = element.parent


def best_container(page: Page) -> Element | None:
    """The container with the highest score; the first of equal ones; none without text."""
    found = max(page.elements, key=lambda e: e.score if e.name in CONTAINERS and not e.dropped else 0.0)
    return found if found.score > 0 else None


def text_of(page: Page, containers: list[Element]) -> str:
    """The kept blocks of these containers, in page order, each once."""
    keep = sorted({i for c in containers for i in range(c.first, c.last)})
    return "\n\n".join(page.blocks[i][0] for i in keep if not page.blocks[i][1])
