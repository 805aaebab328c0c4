"""Main text of web pages by scoring the tree.

A page is read into a tree of elements (unclosed and stray tags are tolerated). Subtrees that can't be
article text are cut: scripts, styles, forms, menus, headers, footers, sidebars, notices, adverts, reader
comments, hidden parts - by element, role, or the words of class and id. Of a class or id its whole, first or last
word counts, and none if it tells a state (has-footer). An element that is named so but holds the page's main part is
no such part (``spared``). Then every block with text passes
points to its ancestors: one, one for each comma, and one for each 100 characters up to three, times one
minus its link density; the parent gets them whole, the grandparent half, higher ones a third of that by
level. A container's own score is discounted by its own link density. The best container is kept, and those of
its siblings that score a fifth of it or are plain sentences; a heading before it too, and behind it lists, tables and
sections with few links, and the headings before these.

Kept text: character references decoded, white space within a block turned into one space and trimmed, blocks
in page order joined by an empty line. Nothing else is dropped or cut.

Null or empty pages, and pages without text, give an empty text. Pages without a scoring block give their
``article``, ``main`` or ``body``. Repeated rows give repeated rows; an empty table none; extra columns are
not read. Work and memory are linear in the page's length, also for deep trees; nothing recurses.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.frames import arrow_map

#: A comment, declaration, or tag. Quoted values end at the next tag at the latest, so a match never
#: looks further than that and reading stays linear.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\bhidden\b")

# Fixed lists: element names of HTML, and words that tell what a part of a page is.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math canvas".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key ends an open element of the values, up to the nearest of its limits.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
        "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"})}
CUT = frozenset("nav footer aside form button select option input label fieldset dialog menu object audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
#: Words of class or id that cut an element whatever else it is called.
NEVER = frozenset("ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promotion nav "
                  "navbar navigation menu menus breadcrumb breadcrumbs comment comments disqus replies respond footer share sharing "
                  "social cookie cookies consent gdpr newsletter subscribe subscription signup login popup modal overlay related "
                  "recommended pagination pager toolbar masthead".split())
#: Words that do so unless a word of MAY stands beside them.
UNLIKELY = frozenset("sidebar side header banner notice notices alert warning widget widgets hidden tools meta tags rail aside "
                     "skip print outbrain taboola".split())
MAY = frozenset("article articles content main body post entry story text page blog hentry prose column wrapper container".split())
#: First words of classes that tell a state of the page, not what the element is.
STATE = frozenset("has have no not with without is show hide hides".split())
POSITIVE = frozenset("article content main post entry story text body hentry prose".split())
CONTENT = frozenset("article content main post entry story".split())
BASE = {"article": 25.0, "main": 15.0, "div": 5.0, "section": 3.0, "blockquote": 3.0, "td": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0,
        "dl": -3.0, "li": -3.0, "table": -3.0, "body": 0.0, "html": -5.0}
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
SENTENCE = re.compile(r"[.!?…](?:\s|$)")


def words_of(value: str) -> list[str]:
    return [w.lower() for w in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])", value) if w]


class Tree:
    """A page's elements in page order: a parent comes before its children."""

    def __init__(self, page: str) -> None:
        self.tag, self.parent, self.cut, self.bonus = ["#page"], [-1], [False], [0.0]
        #: Elements that class or id cut, unless they are spared: whether a whole class or id does.
        self.named: dict[int, bool] = {}
        #: (element, text) in page order, for text that is not cut.
        self.texts: list[tuple[int, str]] = []
        open_, at, n = [0], 0, len(page)
        self.open = {"#page": 1}
        while at < n:
            m = TOKEN.search(page, at)
            if m is None:
                self.add(open_[-1], page[at:])
                break
            if m.start() > at:
                self.add(open_[-1], page[at:m.start()])
            at = m.end()
            name = m["name"]
            if name is None:
                continue
            name = name.lower()
            if m["close"]:
                self.close(open_, name)
                continue
            if name == "br":
                self.add(open_[-1], " ")
                continue
            if name in BLOCK and self.open.get("p"):
                self.close(open_, "p")
            if name in ENDS:
                self.implied(open_, *ENDS[name])
            node = self.start(open_[-1], name, m["rest"])
            if name in VOID:
                continue
            if name in RAW and not m[0].endswith("/>"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
                continue
            open_.append(node)
            self.open[name] = self.open.get(name, 0) + 1
        if self.named:
            self.drop()

    def drop(self) -> None:
        """Cuts the named elements that are not spared, with all in them."""
        n = len(self.tag)
        inside, size = [False] * n, [0] * n
        for i in range(1, n):
            inside[i] = self.tag[i] in ("p", "pre", "blockquote") or inside[self.parent[i]]
        for node, text in self.texts:
            if inside[node]:
                size[node] += len(" ".join(text.split()))
        marks = {t: {next((i for i in range(1, n) if self.tag[i] == t and not self.cut[i]), 0)} - {0} for t in ("main", "article", "h1")}
        holds = [[i in marks[t] for i in range(n)] for t in marks]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            size[p] += size[i]
            for h in holds:
                h[p] = h[p] or h[i]
        for i in range(1, n):
            self.cut[i] = self.cut[i] or self.cut[self.parent[i]] or i in self.named and not self.spared(
                self.named[i], 2 * size[i] > size[0], *(h[i] for h in holds))
        self.texts = [(node, text) for node, text in self.texts if not self.cut[node]]

    @staticmethod
    def spared(whole: bool, most: bool, main: bool, article: bool, h1: bool) -> bool:
        """Whether a named element is the main part after all: by the page's first main, article and h1, and whether
        it has most of the paragraphs' text. Readers' comments may have that too, so a whole name takes a heading."""
        return main or (most and h1 if whole else most or article or h1)

    def add(self, node: int, text: str) -> None:
        if not self.cut[node]:
            self.texts.append((node, unescape(text) if "&" in text else text))

    def start(self, parent: int, name: str, rest: str) -> int:
        cut, bonus = self.cut[parent], 0.0
        if not cut:
            cut = name in CUT or name == "header" and not (self.open.get("article") or self.open.get("main"))
            if rest and not cut:
                cut, bonus, named = self.judged(name, rest)
                if named is not None:
                    self.named[len(self.tag)] = named
        self.tag.append(name)
        self.parent.append(parent)
        self.cut.append(cut)
        self.bonus.append(bonus)
        return len(self.tag) - 1

    @staticmethod
    def judged(name: str, rest: str) -> tuple[bool, float, bool | None]:
        """Whether an element's attributes cut it, what they add to its score, and whether class or id name it as a
        part to cut (None: no): with a whole class or id, or with a part of one."""
        found: set[str] = set()
        ends: set[str] = set()
        whole = plain = False
        for a in ATTRIBUTE.finditer(rest):
            key = (a[1] or "hidden").lower()
            value = a[2] or a[3] or a[4] or ""
            if key in ("class", "id"):
                for token in value.split():
                    words = words_of(token)
                    if not words or len(words) > 1 and words[0] in STATE:
                        continue
                    found.update(words)
                    ends.update((words[0], words[-1]))
                    whole = whole or len(words) == 1 and words[0] in NEVER
                    plain = plain or len(words) == 1 and words[0] in CONTENT
            elif key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                return name not in ("html", "body"), 0.0, None
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return name not in ("html", "body"), 0.0, None
        if name in ("html", "body", "main", "article") or not found:
            return False, 0.0, None
        # Beside a plain name of content (id="content") a part of a name tells nothing.
        cut = whole or bool(ends & NEVER) and not plain or bool(ends & UNLIKELY) and not found & MAY
        return False, 25.0 if found & POSITIVE else 0.0, whole if cut else None

    def close(self, open_: list[int], name: str) -> None:
        """Ends the nearest open element of that name with all in it; a stray end tag does nothing."""
        if not self.open.get(name):
            return
        # An inline element does not end blocks that were opened within it.
        if name not in BLOCK:
            for k in range(len(open_) - 1, 0, -1):
                tag = self.tag[open_[k]]
                if tag == name:
                    break
                if tag in BLOCK:
                    return
        while True:
            tag = self.tag[open_.pop()]
            self.open[tag] -= 1
            if tag == name:
                return

    def implied(self, open_: list[int], which: set[str], limits: set[str]) -> None:
        for k in range(len(open_) - 1, 0, -1):
            tag = self.tag[open_[k]]
            if tag in which:
                while len(open_) > k:
                    self.open[self.tag[open_.pop()]] -= 1
                return
            if tag in limits:
                return


def extract(page: str) -> str:
    """The main text of a page."""
    if not page:
        return ""
    tree = Tree(page)
    n = len(tree.tag)
    block, link = [0] * n, [False] * n
    for i in range(1, n):
        p = tree.parent[i]
        block[i] = i if tree.tag[i] in BLOCK else block[p]
        link[i] = tree.tag[i] == "a" or link[p]
    # Length, linked length and commas of each block's own text; then of whole subtrees.
    own, linked, commas, sentence = [0] * n, [0] * n, [0] * n, [False] * n
    for node, text in tree.texts:
        b, size = block[node], len(" ".join(text.split()))
        if not size:
            continue
        own[b] += size
        linked[b] += size * link[node]
        commas[b] += text.count(",") + text.count("、") + text.count("，")
        sentence[b] = sentence[b] or SENTENCE.search(text) is not None
    score, container = [0.0] * n, [False] * n
    for b in range(n):
        if not own[b]:
            continue
        points = (1 + commas[b] + min(own[b] // 100, 3)) * (1 - linked[b] / own[b]) if own[b] >= 25 else 0.1 * (1 - linked[b] / own[b])
        # A paragraph's points go to its ancestors; a container's own text counts for itself.
        up = tree.parent[b] if tree.tag[b] in ("p", "pre", "li", "td", "th", "dd", "dt", "figcaption") or tree.tag[b] in HEADING else b
        share, level = 1.0, 0
        while up > 0 and level < 6:
            if tree.tag[up] in BLOCK:
                score[up] += points * share
                container[up] = True
                level += 1
                share = 0.5 if level == 1 else 1 / (3 * level)
            up = tree.parent[up]
    total, total_linked = own[:], linked[:]
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        total[p] += total[i]
        total_linked[p] += total_linked[i]
    best, top = -1, float("-inf")
    final = [0.0] * n
    for i in range(1, n):
        if container[i]:
            final[i] = (score[i] + BASE.get(tree.tag[i], 0.0) + tree.bonus[i]) * (1 - total_linked[i] / total[i] if total[i] else 1)
            if final[i] > top:
                best, top = i, final[i]
    if best < 0:
        best = next((i for t in ("article", "main", "body") for i in range(1, n) if tree.tag[i] == t and not tree.cut[i]), 0)
    chosen = {best}
    if best > 0:
        heads: list[int] = []  # behind the best container, with nothing chosen behind them yet
        for i in range(tree.parent[best] + 1, n):
            if tree.parent[i] != tree.parent[best] or i == best or tree.cut[i] or not total[i]:
                continue
            density = total_linked[i] / total[i]
            if container[i] and final[i] >= max(10.0, 0.2 * top):
                chosen.add(i)
            elif tree.tag[i] in HEADING and i < best and density < 0.25:
                chosen.add(i)
            elif tree.tag[i] in ("p", "pre", "blockquote") and (density < 0.25 if total[i] > 80 else density == 0 and sentence[i]):
                chosen.add(i)
            elif i > best and tree.tag[i] in HEADING and density < 0.25:
                heads.append(i)
            elif i > best and tree.tag[i] in ("ul", "ol", "dl", "table", "section", "figure") and density < 0.25:
                chosen.add(i)
            elif i > best:
                heads = []
            if i > best and i in chosen:
                chosen.update(heads)
                heads = []
    keep = [False] * n
    keep[0] = 0 in chosen
    for i in range(1, n):
        keep[i] = i in chosen or keep[tree.parent[i]]
    # Blocks: stretches of text without a block's begin or end between them.
    out: list[str] = []
    parts: list[str] = []
    before, count = -1, 0
    for node, text in tree.texts:
        if not keep[node]:
            continue
        if block[node] != before or _parted(tree, block, count, node, before):
            out.append(" ".join("".join(parts).split()))
            parts, before = [], block[node]
        parts.append(text)
        count = node
    out.append(" ".join("".join(parts).split()))
    return "\n\n".join(x for x in out if x)


def _parted(tree: Tree, block: list[int], last: int, node: int, own: int) -> bool:
    """Whether a block lies between two texts of one block: some element made since then is a block of its own."""
    for i in range(last + 1, node + 1):
        if tree.tag[i] in BLOCK and i != own:
            return True
    return False


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [extract(page or "") for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points) of each page."""
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    out = arrow_map(rows, _run, f"page_id {kind}, url string, text string, n_chars long")
    return out.withColumnRenamed("page_id", id_col).withColumnRenamed("url", url_col)
