"""Main text of HTML pages by tag-path ratios.

A page is read into text nodes, each with its root-to-leaf tag path (tag names,
with the class and id words that name page furniture). Per path the text
length, the punctuation and the number of nodes are summed; their ratios (text
per node, punctuation per node) are smoothed over the nodes in page order with
a Gaussian window and fused by product, and a path is kept when its fused ratio
reaches the page's standard deviation. Two priors join the fusion: a path inside
furniture (menus, headers, footers, asides, forms, scripts, notices, adverts,
comments) weighs nothing; and where a page marks an article, the paths inside
and outside it are weighed against each other by the square of their odds, the
sums of squared fused ratios inside (counted MARK times) and outside. The
threshold then holds for all paths. So teasers marked as articles lose to a long
story beside them, a marked story to nothing but a much larger text, and where
all text outside furniture is marked nothing stands against it: it is kept whole,
also a very short one beside a long footer. Titles, lists, quotes and tables, short by
nature, go with the text they stand in: a heading whose next text is kept is kept, and so
is what stands in the same container between kept nodes, or beside them if it is no link.
Kept nodes are joined to blocks.

Class, id and role name furniture by whole words; a name that also says ``with``, ``has``,
``no`` or the like speaks of a layout, not of furniture. A container that is furniture by
name or is a form, yet holds most of the page's paragraph text and its title or its
articles (a form: more such text than labels), is the page's frame and no furniture.
Reading takes linear time in the page, whatever is left open.

The reader accepts broken markup: unclosed paragraphs, missing end tags, a page
cut off anywhere. Rows are independent, so pages stream through each task.

Defined cases: null and empty html give an empty text; white space inside a
block becomes one space; blocks are joined by one newline; ``br`` is white
space; plain text without tags is one block; repeated rows each give a row; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names of the HTML standard by their part on a page.
HIDDEN = frozenset("script style noscript template svg math head title iframe object canvas audio video map datalist".split())
FURNITURE = frozenset("nav footer aside form button select textarea dialog menu input label fieldset".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td
tfoot th thead tr ul option""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "html", "body"}
ARTICLE = frozenset(("article", "main"))
#: Elements that text flows through: they belong to the container around them.
FLOW = frozenset("h1 h2 h3 h4 h5 h6 p li ul ol dl dt dd blockquote pre table caption tbody thead tfoot tr td th figure figcaption hgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words by which a name speaks of a layout or a subject that has, or lacks, such a part.
LAYOUT = re.compile(r"(?:^|[_-])(?:with|without|has|no|and|or|of|the|for|in|on|hide|show)(?:$|[_-])", re.I)
#: Words of class, id and role that name furniture.
NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|popup|modal|overlay|"
                   r"cookies?|consent|gdpr|notice|notification|alert|nav(?:bar|igation)?|menu|breadcrumbs?|pager|pagination|"
                   r"side-?bar|aside|widget|related|recommended|share|sharing|social|footer|masthead|top-?bar|toolbar|search|"
                   r"login|signup|subscribe|newsletter|comments?|discussion|replies|reply|disqus|complementary|contentinfo|"
                   r"navigation|site-?header|page-?header)(?:$|[\s_-])", re.I)
#: Outside an article, also these.
HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
RAW_END = {t: re.compile(rf"</{t}\s*[^>]*>|\Z", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noscript", "xmp")}
PUNCTUATION = ".,;:!?…。，！？؟"
#: Gaussian smoothing over neighbouring nodes; standard deviations that keep a path.
RADIUS, THRESHOLD = 1, 1.0
#: How often the text of marked articles counts against the other text.
MARK = 4.0


def _decoded(piece: str) -> str:
    """Character references resolved; the usual lone ``&amp;`` without a scan."""
    if "&" not in piece:
        return piece
    if "&" not in piece.replace("&amp;", ""):
        return piece.replace("&amp;", "&")
    return entities.unescape(piece)


def _hidden(attributes: list[tuple[str, str]]) -> bool:
    return any(name == "hidden" or name == "aria-hidden" and value == "true"
               or name == "style" and re.search(r"display\s*:\s*none", value) for name, value in attributes)


def _named(attributes: list[tuple[str, str]], in_article: bool) -> bool:
    return any((NAMED.search(word) or not in_article and HEADER.search(word)) and not LAYOUT.search(word)
               for name, value in attributes if name in ("class", "id", "role") for word in value.split())


class _Frames:
    """Containers that are furniture by name, and forms: what stands in them decides."""

    def __init__(self):
        self.over, self.form, self.stats = [], [], []  # paragraph text, label text, titles, articles

    def add(self, over: int, form: bool) -> int:
        self.over.append(over)
        self.form.append(form)
        self.stats.append([0, 0, 0, 0])
        return len(self.over) - 1

    def judged(self, page: list[int]) -> list[bool]:
        """Whether text in each container is furniture; ``page`` has the figures outside them."""
        for i in range(len(self.over) - 1, -1, -1):  # a container comes before those in it
            to = self.stats[self.over[i]] if self.over[i] >= 0 else page
            for j, v in enumerate(self.stats[i]):
                to[j] += v
        out = []
        for i, (text, labels, titles, articles) in enumerate(self.stats):
            frame = 2 * text > page[0] and (titles or articles and articles == page[3] or self.form[i] and text > labels)
            out.append(not frame or self.over[i] >= 0 and out[self.over[i]])
        return out


def text_nodes(page: str) -> list[tuple]:
    """(path number, furniture, in article, block number, text, container, tag, link) of each
    text node; container is the nearest element that text doesn't flow through, tag the
    nearest one that it does (or none), link whether the text is in one."""
    # tag, furniture, in article, path, frame, container, flow tag, link, nearest block's place
    stack: list[tuple] = []
    places: dict[str, list[int]] = {}  # of open elements, by tag
    paths: dict[tuple[int, str], int] = {}
    frames, outside = _Frames(), [0, 0, 0, 0]
    out, block, at, elements = [], 0, 0, 0
    bottom = ("", False, False, 0, -1, 0, "", False, -1)

    def cut(i: int) -> None:
        for over in stack[i:]:
            places[over[0]].pop()
        del stack[i:]

    def place(*tags: str) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def text(piece: str) -> None:
        tag, furniture, article, path, frame, container, flow, link, _ = stack[-1] if stack else bottom
        if not piece or furniture is None:
            return
        piece = _decoded(piece)
        out.append((path, furniture, article, block, piece, container, flow, link, frame))
        if not furniture or frame >= 0 and tag in ("label", "option", "button"):
            stats = frames.stats[frame] if frame >= 0 else outside
            stats[1 if furniture else 0] += len(piece.strip()) if furniture or flow == "p" else 0

    while (opening := page.find("<", at)) >= 0:
        m = TAG.match(page, opening)
        if not m:  # a lone "<" is text
            text(page[at:opening + 1])
            at = opening + 1
            continue
        text(page[at:opening])
        at = m.end()
        if m.group().startswith("<![CDATA["):
            continue
        if not m.group(2):
            continue
        tag = m.group(2).lower()
        if tag in BLOCK:
            block += 1
        elif tag == "br":
            text(" ")
        nearest = stack[-1][8] if stack else -1
        if m.group(1):  # an end tag closes the nearest open element of its name
            i = place(tag)
            if i >= 0 and (tag in BLOCK or i > nearest):  # inline ends don't reach out of their block
                cut(i)
            continue
        if tag in BLOCK and tag != "html" and stack and stack[-1][0] == "head":
            cut(len(stack) - 1)  # content ends a head that was never closed
            nearest = stack[-1][8] if stack else -1
        if tag in CLOSES_P and nearest >= 0 and stack[nearest][0] == "p":
            cut(nearest)  # a block start ends an open paragraph and what is open inside it
        if tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            same = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            ends = {"li": ("ul", "ol", "menu"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
                    "dd": ("dl",), "dt": ("dl",), "option": ("select",)}[tag]
            if (i := place(*same)) > place(*ends):
                cut(i)
        if tag in RAW_END and not m.group(3).rstrip().endswith("/"):
            at = RAW_END[tag].search(page, at).end()
            continue
        if tag in VOID or m.group(3).rstrip().endswith("/"):
            continue
        _, furniture, in_article, path, frame, container, flow, link, nearest = stack[-1] if stack else bottom
        in_article = in_article or tag in ARTICLE or 'role="main"' in m.group(3)
        if furniture is not None:
            if tag in HIDDEN:
                furniture = None
            elif tag in FURNITURE - {"form"} or tag == "header" and not in_article:
                furniture = True
            elif not furniture and tag not in ("html", "body", *ARTICLE):
                attributes = [(n.lower(), v.strip("\"'")) for n, v in ATTRIBUTE.findall(m.group(3))]
                if _hidden(attributes):
                    furniture = True
                elif tag == "form" or _named(attributes, in_article):
                    frame = frames.add(frame, tag == "form")
        if furniture is False:
            stats = frames.stats[frame] if frame >= 0 else outside
            stats[2] += tag in ("h1", "main")
            stats[3] += tag == "article"
        elements += 1
        if tag in FLOW:
            flow = tag if tag != "p" or not flow else flow
        elif tag in BLOCK:
            container, flow = 0 if tag in ("html", "body") else elements, ""
        path = paths.setdefault((path, tag), len(paths) + 1)
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, furniture, in_article, path, frame, container, flow, link or tag == "a",
                      len(stack) if tag in BLOCK else nearest))
    text(page[at:])
    bad = frames.judged(outside)
    return [(path, bool(furniture) or frame >= 0 and bad[frame], *rest) for path, furniture, *rest, frame in out]


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The main text of one page."""
    nodes = [n for n in text_nodes(page or "") if n[4]]
    marked = any(article and not furniture and text.strip() for _, furniture, article, _, text, *_ in nodes)
    sums: dict[tuple, list[int]] = {}
    order = []
    for path, furniture, article, _, text, *_ in nodes:
        if length := len(" ".join(text.split())):
            key = path, furniture, article
            order.append(key)
            p = sums.setdefault(key, [0, 0, 0])
            p[0] += length
            p[1] += sum(map(text.count, PUNCTUATION))
            p[2] += 1
    # per path: text per node fused with punctuation per node; furniture weighs nothing
    ratio = {k: 0.0 if k[1] else math.sqrt(length / n * (1 + marks / n)) for k, (length, marks, n) in sums.items()}
    kernel = [math.exp(-d * d / 2) for d in range(-RADIUS, RADIUS + 1)]
    smooth: dict[tuple, list[float]] = {}
    for i, key in enumerate(order):
        near = [(kernel[d + RADIUS], ratio[order[i + d]]) for d in range(-RADIUS, RADIUS + 1) if 0 <= i + d < len(order)]
        smooth.setdefault(key, []).append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    fused = {k: math.sqrt(ratio[k] * sum(v) / len(v)) for k, v in smooth.items()}
    # what a marked article and the text outside it weigh against each other
    inside, outside = (sum(fused[k] ** 2 * n for k, (_, _, n) in sums.items() if k[2] == side) for side in (True, False))
    odds = (MARK * (1 + inside) / (1 + outside)) ** 2 if marked else 1.0
    weight = {True: odds, False: 1 / odds}
    # the deviation is taken with the weaker side weighed down, the stronger as it is
    values = [fused[k] * min(1.0, weight[k[2]]) for k in order if not k[1]]
    mean = sum(values) / max(1, len(values))
    cut = threshold * math.sqrt(sum((v - mean) ** 2 for v in values) / max(1, len(values)))
    kept = {k for k, v in fused.items() if v > 0 and v * weight[k[2]] >= cut}
    chosen = _with_neighbours(nodes, [n[:3] in kept for n in nodes])
    blocks: list[tuple[int, list[str]]] = []
    for (_, furniture, _, block, text, *_), choice in zip(nodes, chosen):
        if text.strip() and not choice or not text.strip() and furniture:
            continue
        if not blocks or blocks[-1][0] != block:
            blocks.append((block, []))
        blocks[-1][1].append(text)
    lines = (" ".join("".join(b).split()) for _, b in blocks)
    return "\n".join(line for line in lines if line)


def _with_neighbours(nodes: list[tuple], chosen: list[bool]) -> list[bool]:
    """``chosen``, with the titles, lists, quotes and tables that belong to chosen text."""
    first, last, out = {}, {}, list(chosen)
    for i, (n, choice) in enumerate(zip(nodes, chosen)):
        if choice and n[4].strip():
            first.setdefault(n[5], i)
            last[n[5]] = i
    for i, (_, furniture, _, _, text, container, flow, link) in enumerate(nodes):
        if not furniture and flow and text.strip() and container in first:
            # beside the text counts in a container of the page, not in the page itself
            out[i] = out[i] or first[container] < i < last[container] or container > 0 and flow != "p" and not link
    follows = False  # whether the next text is kept
    for i in range(len(nodes) - 1, -1, -1):
        if nodes[i][4].strip() and not nodes[i][1]:
            out[i] = out[i] or follows and nodes[i][6] in HEADINGS and not nodes[i][7]
            follows = out[i]
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text, n_chars for every row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).cast("string").alias("_html"))

    def run(batches):
        for b in batches:
            texts = [main_text(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=[id_col, url_col, "text", "n_chars"])

    types = [rows.schema[c].dataType.simpleString() for c in ("_id", "_url")]
    return rows.mapInArrow(run, f"`{id_col}` {types[0]}, `{url_col}` {types[1]}, text string, n_chars bigint")
