"""Main text of web pages, by ratios of tag paths.

Every text of a page has a path of block tags from the root. Its length and punctuation, without
what stands in links, are summed for each path and divided by the path's number of texts; both
ratios are fused. A path is smoothed with the others in the same container, so a heading or a
short paragraph among long ones passes, and a lone box does not. Containers whose smoothed ratio
comes near the best one's are content. An article is content as a whole, however its blocks are
boxed; without one, the element that holds what was chosen is, lifted as far as little is added.

Class words mark what is not the article. They do not mark a container that holds the article, or
most of the page's text, so marks count only once the whole page has been read. Inside an article
they mark boxes only: those named for what they are, and others whose ratio is low. Ids there are
often made from headings, so parts of them say nothing.

Elements and paths are numbers with pointers to what is around them, which always has a lower
number; whatever is summed or handed down takes one pass, so deep pages cost no more than flat ones.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from sightlake.llm.frames import over_texts

#: Elements by what HTML says of them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var".split())
_NEVER = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video map nav "
    "footer aside form button select textarea input label fieldset menu dialog".split())
_MAIN = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOXES = frozenset("div section ul ol dl table details blockquote figure center tr td".split())
#: Words in a class, id or role that mark what is not the article.
_WORDS = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|"
    r"sidebar|side|widget|footer|header|masthead|comments?|respond|reply|replies|disqus|cookies?|"
    r"consent|notice|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|"
    r"related|recommend\w*|pagination|pager|toolbar|search|skip|hidden)")
_NAMED = re.compile(_WORDS)
_MARKED = re.compile(rf"(?:^|[^a-z]){_WORDS}(?:$|[^a-z])")
#: What only says that a page has such parts, and words of what readers or others add,
#: which may be most of a page's text and have articles of their own.
_LAYOUT = re.compile(r"(?:^|(?<=\s))(?:has|with|no|without)[-_][\w-]*")
_OTHERS = re.compile(
    r"(?:^|[^a-z])(?:comments?|respond|reply|replies|disqus|related|recommend\w*)(?:$|[^a-z])")
#: An open element that a start tag ends, and what shields it.
_ENDS = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 "
        "h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option", "optgroup"]),
}
_SHIELDS = frozenset("ul ol dl table article section div blockquote body html td th".split())
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？；：、]")
NEAR_BEST = 0.2
MAIN_WEIGHT = 20.0
#: Of an article's ratio, what is low for a box in it. Of a container's text, what lifting it may add.
LOW, LIFT = 0.5, 0.5

NOT_NAMED, IN_PART, BY_ID, BY_CLASS = range(4)


def _naming(about: dict[str, str]) -> tuple[int, bool]:
    """How class, id and role name an element that is not content, and whether others' words do."""
    held = about.get("class", ""), about.get("role", ""), about.get("id", "")
    classes, roles, name = (_LAYOUT.sub(" ", x.lower()) for x in held)
    words = f"{classes} {name} {roles}"
    if not _MARKED.search(words):
        return NOT_NAMED, False
    others = bool(_OTHERS.search(words))
    if any(_NAMED.fullmatch(w) for w in (*classes.split(), *roles.split())):
        return BY_CLASS, others
    if _NAMED.fullmatch(name.strip()):
        return BY_CLASS if others else BY_ID, others
    return IN_PART, others


class _Blocks(HTMLParser):
    """Elements and blocks of a page in order. Number 0 is the page itself, and the empty path."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: By element: tag, number of the one around it, whether it is never content, what names it.
        self.tag, self.above, self.out = [""], [-1], [False]
        self.naming: list[int] = [NOT_NAMED]
        self.others: set[int] = set()
        #: By path: that of the container, and the tag; and numbers of paths.
        self.path, self.path_above, self.path_main = [0], [-1], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.open = [0]
        self.count: dict[str, int] = {}
        #: Places of open elements that a start tag may end, or that shield others from it.
        self.edges: list[int] = []
        self.raw: list[tuple[int, int, list[tuple[str, int, bool]]]] = []
        self.text: list[tuple[str, int, bool]] = []

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def _end_block(self) -> None:
        if self.text:
            own = self.open[-1]
            self.raw.append((self.path[own], own, self.text))
        self.text = []

    def _pop(self, place: int) -> None:
        gone = [self.tag[n] for n in self.open[place:]]
        if any(tag not in _INLINE for tag in gone):
            self._end_block()
        for tag in gone:
            self.count[tag] -= 1
        del self.open[place:]
        while self.edges and self.edges[-1] >= place:
            self.edges.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append((" ", self.open[-1], False))
        if tag not in _INLINE and tag != "br":
            for place in reversed(self.edges):
                other = self.tag[self.open[place]]
                if tag in _ENDS.get(other, ()):
                    self._pop(place)
                    break
                if other in _SHIELDS:
                    break
            self._end_block()
        if tag in _VOID:
            return
        about, around = {k: v or "" for k, v in attrs}, self.open[-1]
        own = len(self.tag)
        self.tag.append(tag)
        self.above.append(around)
        self.out.append(self.out[around] or tag in _NEVER or "hidden" in about
                        or "display:none" in about.get("style", "").replace(" ", ""))
        named, others = (NOT_NAMED, False) if tag in ("html", "body", *_MAIN) else _naming(about)
        self.naming.append(named)
        if others:
            self.others.add(own)
        path = self.path[around]
        if tag not in _INLINE:
            key = path, tag
            path = self.paths.setdefault(key, len(self.path_above))
            if path == len(self.path_above):
                self.path_above.append(key[0])
                self.path_main.append(self.path_main[key[0]] or tag in _MAIN)
        self.path.append(path)
        if tag in _ENDS or tag in _SHIELDS:
            self.edges.append(len(self.open))
        self.open.append(own)
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_endtag(self, tag):
        if not self.count.get(tag):
            return
        for place in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[place]] == tag:
                self._pop(place)
                return

    def handle_data(self, data):
        if not self.out[self.open[-1]]:
            self.text.append((data, self.open[-1], self.count.get("a", 0) > 0))

    def finish(self) -> None:
        self.close()
        self._end_block()


class _Tree:
    """What a page's elements hold, and which of them are not content."""

    def __init__(self, page: _Blocks):
        self.page, n = page, len(page.tag)
        self.size, self.marks, self.texts = [0] * n, [0] * n, [0] * n
        self.headed = [tag in _HEADINGS for tag in page.tag]
        for _, own, pieces in page.raw:
            self.texts[own] += any(data.strip() for data, _, _ in pieces)
            for data, element, linked in pieces:
                if not linked:
                    self.size[element] += len(data.strip())
                    self.marks[element] += len(_PUNCTUATION.findall(data))
        for i in range(n - 1, 0, -1):
            up = page.above[i]
            self.size[up] += self.size[i]
            self.marks[up] += self.marks[i]
            self.texts[up] += self.texts[i]
            self.headed[up] = self.headed[up] or self.headed[i]

    def _ratio(self, size: int, marks: int, texts: int) -> float:
        return size / texts * (1 + marks / texts) if texts > 0 else 0.0

    def _low(self, box: int, article: int) -> bool:
        own = self._ratio(self.size[box], self.marks[box], self.texts[box])
        rest = self._ratio(self.size[article] - self.size[box], self.marks[article] - self.marks[box],
                           self.texts[article] - self.texts[box])
        return own < LOW * rest

    def gone(self) -> list[bool]:
        """By element, whether it is not content, for what it is or for what is around it."""
        page, size, n = self.page, self.size, len(self.page.tag)
        article, marked, foreign = [0] * n, [False] * n, [False] * n
        for i in range(1, n):
            up, tag = page.above[i], page.tag[i]
            article[i] = i if tag in _MAIN else article[up]
            named = page.naming[i]
            if article[up]:
                marked[i] = named != NOT_NAMED and tag in _BOXES and (
                    named == BY_CLASS or self._low(i, article[up]))
            else:
                marked[i] = named != NOT_NAMED
            foreign[i] = foreign[up] or marked[i] and i in page.others
        inside = [False] * n
        for i in range(1, n):
            inside[i] = inside[page.above[i]] or marked[i]
        whole = size[0]
        plain = sum(len(data.strip()) for _, _, pieces in page.raw for data, element, linked in pieces
                    if not linked and not inside[element])
        freed = [marked[i] and i not in page.others and 2 * size[i] > whole for i in range(n)]
        # Articles in no marked element, if there are any, are what the page is about.
        articles = [i for i in range(n) if page.tag[i] in _MAIN and size[i] and not foreign[i]]
        best = max(articles, default=None, key=lambda i: (not inside[i], size[i]))
        # A box with an article beside a longer plain text is a box.
        holds = [page.tag[i] in _MAIN and 2 * size[i] > whole for i in range(n)]
        if best is not None and size[best] > plain:
            holds[best] = True
        for i in range(n - 1, 0, -1):
            holds[page.above[i]] = holds[page.above[i]] or holds[i]
        result = [False] * n
        for i in range(1, n):
            # What holds the article is not marked, but for what is inside the article itself.
            free = freed[i] or holds[i] and not article[page.above[i]]
            # An article's own header, with its heading, is part of it.
            header = page.tag[i] == "header" and not (article[i] and self.headed[i])
            result[i] = result[page.above[i]] or page.out[i] or header or marked[i] and not free
        return result


def content_paths(page: _Blocks, blocks: list[tuple[int, int, str, int]]) -> list[bool]:
    """By path, whether its smoothed ratio makes it, or a container around it, content."""
    n = len(page.path_above)
    sums = [[0.0, 0.0, 0] for _ in range(n)]
    for path, _, text, linked in blocks:
        own, length = sums[path], max(0, len(text) - linked)
        own[0] += length
        own[1] += len(_PUNCTUATION.findall(text)) * length / len(text)
        own[2] += 1
    held = [[0.0, 0] for _ in range(n)]
    for path, (length, marks, texts) in enumerate(sums):
        if texts:
            weight = MAIN_WEIGHT if page.path_main[path] else 1.0
            container = held[max(0, page.path_above[path])]
            container[0] += weight * length * (1 + marks / texts)
            container[1] += texts
    smoothed = [total / texts if texts else 0.0 for total, texts in held]
    best = max(smoothed)
    content = [ratio > 0 and ratio >= NEAR_BEST * best for ratio in smoothed]
    # An article is content as a whole, however its blocks are boxed.
    reached = content[:]
    for path in range(n - 1, 0, -1):
        if reached[path] and page.path_main[path]:
            reached[page.path_above[path]] = reached[page.path_above[path]] or (
                page.path_main[page.path_above[path]])
            content[path] = True
    for path in range(1, n):
        content[path] = content[path] or content[page.path_above[path]]
    return [content[max(0, up)] for up in page.path_above]


def _lifted(page: _Blocks, blocks: list[tuple[int, int, str, int]], chosen: list[bool]) -> list[bool]:
    """What was chosen, with the other blocks of the least element that holds most of it.

    The element is lifted while those around it add little, and little of that in links. The body
    itself gives the headings and paragraphs that stand in it directly.
    """
    n = len(page.tag)
    picked, plain, linked_size = [0] * n, [0] * n, [0] * n
    for (_, own, text, linked), use in zip(blocks, chosen, strict=True):
        picked[own] += len(text) - linked if use else 0
        plain[own] += len(text) - linked
        linked_size[own] += linked
    for held in (picked, plain, linked_size):
        for i in range(n - 1, 0, -1):
            held[page.above[i]] += held[i]
    heart = 0
    for i in range(1, n):  # the deepest box with nearly all of what was chosen
        if page.above[i] == heart and page.tag[i] not in _HEADINGS and page.tag[i] != "p" and (
                page.tag[i] not in _INLINE) and 5 * picked[i] >= 4 * picked[0] > 0:
            heart = i
    core = heart
    while page.tag[heart] not in ("", "html", "body"):
        up = page.above[heart]
        more, links = plain[up] - plain[heart], linked_size[up] - linked_size[heart]
        if page.tag[up] in ("", "html", "body") or more > LIFT * plain[heart] or links > more:
            break
        heart = up
    within, inner = [False] * n, [False] * n
    if page.tag[heart] not in ("", "html", "body"):
        within[heart] = inner[core] = True
    for i in range(1, n):
        within[i] = within[i] or within[page.above[i]]
        inner[i] = inner[i] or inner[page.above[i]]
    first = next((k for k, (_, own, _, _) in enumerate(blocks) if inner[own]), len(blocks))
    said = _HEADINGS | {"p", "pre", "blockquote"}

    def added(k: int, own: int) -> bool:
        if within[own]:  # what was lifted to: all that leads in, afterwards what is no mere box
            return inner[own] or k < first or page.tag[own] in said
        return page.tag[own] in said and page.tag[page.above[own]] in ("", "html", "body")

    return [use or 2 * linked <= len(text) and added(k, own)
            for k, ((_, own, text, linked), use) in enumerate(zip(blocks, chosen, strict=True))]


def main_text(html: str) -> str:
    """The blocks that are content, one to a line, white space in each made single blanks."""
    page = _Blocks()
    page.feed(html)
    page.finish()
    gone = _Tree(page).gone()
    blocks = []
    for path, own, pieces in page.raw:
        left = [(data, linked) for data, element, linked in pieces if not gone[element]]
        text = " ".join("".join(data for data, _ in left).split())
        if text:
            blocks.append((path, own, text, min(len(text), sum(len(d) for d, linked in left if linked))))
    if not blocks:
        return ""
    on_path = content_paths(page, blocks)
    chosen = [on_path[path] for path, *_ in blocks]
    in_main = [page.path_main[path] for path, *_ in blocks]
    if not any(chosen):  # nothing but links: an article of links is one
        chosen = in_main
    elif not any(a and b for a, b in zip(chosen, in_main, strict=True)):
        chosen = _lifted(page, blocks, chosen)
    return "\n".join(text for (_, _, text, _), use in zip(blocks, chosen, strict=True) if use)


def extract(df: DataFrame, column: str = "html", text: str = "text",
            n_chars: str = "n_chars") -> DataFrame:
    """df with each page's main text and its number of code points.

    Pages are read whole and on their own: nothing is shuffled, repeated rows give the same text
    each. A null or empty page, and one with nothing but marked parts or links outside an article,
    has an empty text; a page without tags is its own text. Broken markup is read as browsers do: a
    tag left open ends with what is around it, a broken section is a comment. A page takes time in
    proportion to its length, however deep it is.
    """
    def rows(pages: list[bytes]) -> list[tuple]:
        found = [main_text(p.decode("utf-8", "replace")) for p in pages]
        return [(t, len(t)) for t in found]

    return over_texts(df, column, f"`{text}` string, `{n_chars}` long", rows)
