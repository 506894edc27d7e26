"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. Text of menus, page headers and
footers, sidebars, adverts, forms, scripts and the like becomes no line; what lies
around the stripped places, and around the page's article if it marks one, becomes
empty lines. The text lengths of every few neighbouring lines are summed. Text begins
where these sums surge from nothing and ends where they dive to nothing; of the spans
found so, the one that carries most text is the main text, with all its lines, together
with the spans of the same parent element, from which only stripped elements part it.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm.words import map_rows

BLOCK_LINES = 3  # lines whose lengths are summed

# Fixed values of HTML: elements that never have content, elements that start a line,
# elements whose content is no page text, elements for getting about rather than reading.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|canvas|select"
CHROME = frozenset("nav footer aside form button dialog menu label input fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
CHROME_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|"
    r"consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|nav|navbar|"
    r"navigation|menu|breadcrumbs?|sidebar|side|aside|widgets?|footer|foot|masthead|topbar|toolbar|header|comments?|"
    r"commentlist|disqus|replies|reply|respond|discussion|related|recommend(?:ed|ations)?|share|sharing|social|"
    r"pagination|pager|search|form|skip|copyright|tags?)(?=$|[\s_\d-])",
    re.I,
)
LAYOUT_NAMES = re.compile(r"(?:^|(?<=\s))(?:with|without|no|has|not|hide|show)[_-]\S*", re.I)  # of a page, not of its part
COMMENT_NAMES = re.compile(r"(?:^|\s)(?:comment(?:[_-]\S*)?|comments|commentlist|disqus\S*|reply|replies|respond|discussion)(?=$|\s)", re.I)
CONTAINERS = frozenset(("article", "main"))
HOLDERS = frozenset("article body center details div html main section table".split())  # elements that hold blocks
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*/>|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|itemprop|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_IMPLIED = {"p": BLOCKS, "li": frozenset(("li",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")),
            "tr": frozenset(("tr",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd"))}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "") for m in _ATTRIBUTE.finditer(text)}


def _is_chrome(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of the text; ``inside`` an article a header is its own."""
    if name in CHROME or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    a = _attributes(attributes)
    if name in CONTAINERS:
        return _is_comment(a)
    if _is_hidden(a) or a.get("itemprop", "").lower() == "comment":
        return True
    return _is_named_chrome(a)


def _is_hidden(a: dict[str, str]) -> bool:
    """By role, attribute or style, which say it for certain."""
    if a.get("role", "").lower() in CHROME_ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return True
    return re.search(r"display\s*:\s*none", a.get("style", ""), re.I) is not None


def _is_named_chrome(a: dict[str, str]) -> bool:
    return any(CHROME_NAMES.search(LAYOUT_NAMES.sub("", a[x])) for x in ("class", "id") if x in a)


def _is_comment(a: dict[str, str]) -> bool:
    return a.get("itemprop", "").lower() == "comment" or any(COMMENT_NAMES.search(a[x]) for x in ("class", "id") if x in a)


def lines_of(page: str) -> list[str]:
    """Lines of a page in order, with empty ones where text was stripped or an article ends."""
    return placed_lines(page)[0]


def placed_lines(page: str) -> tuple[list[str], list[int]]:
    """Lines of a page, and for each the element that holds its block (-1 for empty lines, 0 for the page).

    An element is not stripped for its class or id if it holds most of the page's text, or
    the only article. Text outside of articles counts if its main text is longer than theirs.
    """
    spared: set[int] = set()
    while True:
        articles, outside, has_main, stripped, total = _pass(page, spared)
        more = {n for n, (size, article) in stripped.items() if 2 * size > total or (article and not any(articles[0]))}
        if not more:
            break
        spared |= more
    if not any(articles[0]):
        return outside
    if not has_main and sum(map(len, _main_lines(*outside))) > sum(map(len, articles[0])):
        return outside
    return articles


def _pass(page: str, spared: set[int]):
    """(articles, outside, whether a main has text, size and article of elements stripped by name, size of all text)."""
    gap = [""] * BLOCK_LINES
    outside: list[str] = []
    articles: list[str] = []
    outside_in: list[int] = []
    articles_in: list[int] = []
    stack: list[tuple[str, bool, bool]] = []  # name, chrome, container
    numbers: list[int] = []  # of the elements in the stack
    count = 0
    chrome = container = mains = total = 0
    named = 0  # the outermost stripped element, if its class or id is the reason
    has_main = False
    stripped: dict[int, list] = {}
    now: list[str] = []

    def flush():
        if now:
            text = " ".join("".join(now).split())
            now.clear()
            if text:
                (articles if container else outside).append(text)
                # a paragraph, heading or list item is a block of the element around it
                at = next((x for (n, _, _), x in zip(reversed(stack), reversed(numbers)) if n in HOLDERS), 0)
                (articles_in if container else outside_in).append(at)

    def leave(n: int):
        nonlocal chrome, container, mains, named
        while len(stack) > n:
            name, was_chrome, was_container = stack.pop()
            mains -= name == "main"
            numbers.pop()
            chrome -= was_chrome
            named = named if chrome else 0
            if was_container:
                flush()
                container -= 1
                if not container:
                    articles.extend(gap)
                    articles_in.extend([-1] * BLOCK_LINES)
            if was_chrome and not chrome and not container:
                flush()
                outside.extend(gap)
                outside_in.extend([-1] * BLOCK_LINES)

    for m in _TOKEN.finditer(page):
        token = m[0]
        if token[0] != "<" or token == "<":
            size = len(token.strip())
            total += size
            has_main = has_main or (size > 0 and not chrome and mains > 0)
            if named:
                stripped[named][0] += size
            if not chrome:
                now.append(unescape(token) if "&" in token else token)
            continue
        if m[3] is None:
            continue  # comment, raw element, declaration
        name = m[3].lower()
        if name in BLOCKS:
            if not chrome:
                flush()
        elif name == "br" and not chrome:
            now.append(" ")
        if m[2]:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == name:
                    if not chrome:
                        flush() if name in BLOCKS else None
                    leave(n)
                    break
            continue
        if name in VOID or m[4].endswith("/"):
            continue
        if stack and stack[-1][0] in _IMPLIED and name in _IMPLIED[stack[-1][0]]:
            leave(len(stack) - 1)
        is_container = name in CONTAINERS or (not chrome and "role" in m[4] and _attributes(m[4]).get("role", "").lower() in CONTAINERS)
        is_chrome = _is_chrome(name, m[4], container > 0) and count + 1 not in spared
        if is_chrome and not chrome and name not in CHROME and name != "header" and name not in CONTAINERS:
            a = _attributes(m[4])
            if _is_named_chrome(a) and not _is_comment(a) and not _is_hidden(a):
                named = count + 1
                stripped[named] = [0, False]
        if is_container and named and not is_chrome:
            stripped[named][1] = True
        if is_chrome and not chrome:
            flush()
            if not container:
                outside.extend(gap)
                outside_in.extend([-1] * BLOCK_LINES)
        if is_container:
            flush()
            if chrome and name == "main":  # a menu or notice that was never closed
                stack[:] = [(x, False, c) for x, _, c in stack]
                chrome = named = 0
        stack.append((name, is_chrome, is_container))
        mains += name == "main"
        count += 1
        numbers.append(count)
        chrome += is_chrome
        container += is_container
    flush()
    return (articles, articles_in), (outside, outside_in), has_main, stripped, total


def spans_of(lengths: list[int], width: int = BLOCK_LINES) -> list[tuple[int, int]]:
    """(first, end) of every span between a surge and a dive of the sums over ``width`` lines."""
    n = len(lengths)
    sums = [sum(lengths[i : i + width]) for i in range(n)]
    out, start = [], None
    for i in range(n):
        if start is None and lengths[i] and sums[i]:
            start = i
        if start is not None and not sums[i]:
            out.append((start, i))
            start = None
    if start is not None:
        out.append((start, n))
    return out


def main_text(page: str | None) -> str:
    """Main text of a page: its lines in order, joined by line ends; empty if there is none."""
    return "\n".join(_main_lines(*placed_lines(page or "")))


def _main_lines(lines: list[str], places: list[int]) -> list[str]:
    lengths = [len(x) for x in lines]
    found = spans_of(lengths)
    if not found:
        return []
    low, high = max(found, key=lambda s: (sum(lengths[s[0] : s[1]]), -s[0]))
    weight: dict[int, int] = {}
    for i in range(low, high):
        if lengths[i]:
            weight[places[i]] = weight.get(places[i], 0) + lengths[i]
    parent = max(weight, key=weight.get)  # the element that holds most of the best span
    kept = [s for s in found if s == (low, high) or any(places[i] == parent for i in range(*s))]
    return [x for s in kept for x in lines[s[0] : s[1]] if x]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page; a missing or empty html has an empty text."""

    def run(rows):
        for page_id, url, html in rows:
            text = main_text(html)
            yield page_id, url, text, len(text)

    typed = pages.select(*(pages[c].cast(t).alias(c) for c, t in (("page_id", "long"), ("url", "string"), ("html", "string"))))
    return map_rows(typed, run, "page_id long, url string, text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
