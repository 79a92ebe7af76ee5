"""Main text of HTML pages by equivalence-class template deduction (operator 4).

The tokens of a page are its tags and its blocks of text, told apart by the elements they stand in. Over the
pages of a host every token has an occurrence vector: how often it occurs on each page. Tokens with
one vector form a class. Classes that most pages have, and whose tokens keep one order, are the template;
they nest in each other's gaps. What the template does not explain, the slots, is the pages' own text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import fresh, written
from oreflow.llm.urls import host_of

# A host's template is deduced from so many pages on; a class counts if this share of them has it.
PAGES, SHARE = 8, 0.5

# Elements without an end tag, elements that do not break a block, and elements whose text
# is not part of an article, also by names that classes, ids and roles give them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
ASIDE = frozenset(
    "aside button canvas dialog footer form frameset head header iframe input menu nav noscript object "
    "option script select style svg template textarea title".split()
)
MAIN = frozenset(["article", "main"])
# Elements that hold a whole page or article, which no name sets aside.
WHOLE = MAIN | {"html", "body"}
# Elements whose start ends a paragraph that is still open, and headings.
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end an open one of their kind, as their end tags may be left out.
UNCLOSED = frozenset("p li dt dd tr td th option".split())
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|complementary|contentinfo|consent|cookies?|disqus|"
    r"footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|paywall|popup|promo\w*|"
    r"recommended|related|replies|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widgets?)"
    r"(?:$|[\s_-])",
    re.I,
)
# Names of what readers write, which may be most of an article's text.
READERS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|replies)(?:$|[\s_-])", re.I)

# A comment, a script or style with its text, a tag, a tag with a quote left open, a declaration, text.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>?"
    r"|<[!?][^>]*>|[^<]+|<",
    re.S | re.I,
)
# Paths of more letters than this, of elements nested without end, are cut to a hash.
LONG_PATH = 500
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)


class _Element:
    """An element of a page: where it stands, what it is by its tag and names, and how much text it holds."""

    __slots__ = ("chars", "inside", "name", "names", "parent", "path", "state", "weak")

    def __init__(self, name: str, names: str, path: str, parent: _Element | None):
        self.name, self.names, self.path, self.parent, self.chars = name, names, path, parent, 0
        self.weak = name == "form" or (name not in WHOLE and bool(names and ASIDE_NAMES.search(names)))
        self.inside = name in MAIN or (parent is not None and parent.inside)
        self.state = 2 if name in ASIDE and not self.weak else 0  # 2 is set aside, 1 all but headings
        if name == "header" and parent is not None and parent.inside:
            self.state = 1


def _parsed(html: str) -> tuple[list[tuple[str, str, _Element | None]], list[_Element]]:
    """The page's tokens with the element each stands in, and its elements in order."""
    stack: list[_Element] = []
    elements: list[_Element] = []
    tokens: list[tuple[str, str, _Element | None]] = []
    block: list[str] = []

    def flush():
        text = " ".join(entities.unescape("".join(block)).split())
        block.clear()
        if text:
            tokens.append((stack[-1].path if stack else "", text, stack[-1] if stack else None))

    for token in _TOKEN.finditer(html):
        piece, name = token[0], token[3] or token[6]
        if name is None:
            if piece[0] != "<" or piece == "<":
                block.append(piece)
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br":
                block.append(" ")
            continue
        flush()
        if token[2] or token[5]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == name:
                    tokens.append((f"{stack[k].path}>", "", None))
                    del stack[k:]
                    break
            continue
        rest = token[4] or token[7] or ""
        if stack and ((name in UNCLOSED and stack[-1].name == name) or (name in ENDS_P and stack[-1].name == "p")):
            stack.pop()
        names = " ".join(a or b or c for _, a, b, c in _NAMES.findall(rest))
        path = f"{stack[-1].path if stack else ''}/{name}" + (f"[{names}]" if names else "")
        if len(path) > LONG_PATH:
            path = f"/{xxhash.xxh64_hexdigest(path.encode('utf-8', 'surrogatepass'))}"
        tokens.append((path, "", None))
        if name not in VOID and not rest.endswith("/"):
            stack.append(_Element(name, names, path, stack[-1] if stack else None))
            elements.append(stack[-1])
    flush()
    return tokens, elements


def _set_aside(tokens: list, elements: list[_Element]) -> None:
    """Decide for every element whether its text is set aside.

    Tags decide for themselves. A name, or a form, does not set aside what holds the page's article, the outermost
    article or main element with the most text; nor what holds over half of the article's text, or of the page's
    if it has no article. What readers write has to hold nearly all of it.
    """
    total = 0
    for _, text, element in tokens:
        if text and element is not None:
            element.chars += len(text)
    for element in reversed(elements):
        if element.state < 2:
            if element.parent is None:
                total += element.chars
            else:
                element.parent.chars += element.chars
    # parents come before their children
    hidden: set[int] = set()
    article = None
    for element in elements:
        if element.state == 2 or id(element.parent) in hidden:
            hidden.add(id(element))
        elif element.name in MAIN and not (element.parent is not None and element.parent.inside):
            if article is None or element.chars > article.chars:
                article = element
    holders, above = set(), article
    while above is not None:
        holders.add(id(above))
        above = above.parent
    within = {id(article)} if article is not None else set()
    for element in elements:
        parent = element.parent
        if parent is not None and id(parent) in within:
            within.add(id(element))
        if element.weak and id(element) not in holders:
            whole = total if article is None else article.chars if id(element) in within else 0
            most = 19 * whole <= 20 * element.chars if READERS.search(element.names) else whole < 2 * element.chars
            if not (whole and most):
                element.state = 2
        if parent is not None:
            element.state = max(element.state, parent.state)
        if element.state == 1 and element.name in HEADINGS:
            element.state = 0


def page_tokens(html: str | None) -> Iterator[tuple[str, str, bool | None]]:
    """The page's tokens in order: (role, "", None) for a tag, (role, text, main) for a block of text.

    A role names the elements a token stands in. ``main`` tells whether a block stands in an article, and in
    nothing that is set aside; without an article or main element anywhere it is None, if not set aside.
    Character references are decoded, white space in a block is one space, empty blocks are left out.
    """
    tokens, elements = _parsed(html or "")
    _set_aside(tokens, elements)
    for role, text, element in tokens:
        if not text or element is None:
            yield role, text, None
        else:
            yield role, text, False if element.state else (True if element.inside else None)


def _hash(role: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{role}\n{text}".encode("utf-8", "surrogatepass"), 1) >> 2


COUNTED = (
    "host string, token long, role string, block boolean, pages long, times long, vector decimal(38,0), "
    "first double, last double, blocks long, chars long"
)


def count_tokens(pages: DataFrame) -> DataFrame:
    """For every token of a host: pages that have it, occurrences, a hash of its occurrence vector, mean places,
    its blocks and characters in articles, and the characters of all articles of its pages.

    The vector's hash is a sum over the pages, so each task sums what it has before anything is shuffled.
    Rows need ``host`` and ``html``. The token 0 stands for the page itself, with the blocks of its article.
    """

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[tuple[str, int], list] = {}
            for host, html in zip(batch["host"], batch["html"], strict=True):
                html = html if isinstance(html, str) else ""
                page = xxhash.xxh64_intdigest(html.encode("utf-8", "surrogatepass"))
                whole = ["", False, 1, 0.0, 0.0, 0, 0]
                here: dict[int, list] = {0: whole}
                for place, (role, text, main) in enumerate(page_tokens(html)):
                    seen = here.setdefault(_hash(role, text), [role, bool(text), 0, place, place, 0, 0])
                    seen[2] += 1
                    seen[4] = place
                    if main:
                        for row in (seen, whole):
                            row[5] += 1
                            row[6] += len(text)
                for token, (role, is_block, times, first, last, blocks, chars) in here.items():
                    mark = xxhash.xxh64_intdigest(f"{page}:{times}".encode())
                    row = found.setdefault((host, token), [role, is_block, 0, 0, 0, 0.0, 0.0, 0, 0])
                    for k, value in enumerate((1, times, mark, first, last, blocks, chars), 2):
                        row[k] += value
            rows = [(host, token, *row) for (host, token), row in found.items()]
            names = ["host", "token", "role", "block", "pages", "times", "vector", "first", "last", "blocks", "chars"]
            yield pd.DataFrame(rows, columns=names).assign(vector=lambda f: f["vector"].map(Decimal))

    sums = [F.sum(c).alias(c) for c in ("pages", "times", "blocks", "chars")]
    sums.append(F.sum("vector").cast("decimal(38,0)").alias("vector"))
    means = [(F.sum(c) / F.sum("pages")).alias(c) for c in ("first", "last")]
    rows = pages.select("host", "html").mapInPandas(of, COUNTED)
    return rows.groupBy("host", "token").agg(F.min("role").alias("role"), F.max("block").alias("block"), *sums, *means)


TEMPLATE = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("pages", T.LongType()),
        T.StructField("class", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("parent", T.LongType()),
        T.StructField("slot", T.LongType()),
        T.StructField("token", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("block", T.BooleanType()),
        T.StructField("root", T.BooleanType()),
        T.StructField("once", T.BooleanType()),
        T.StructField("constant", T.BooleanType()),
    ]
)


def _nest(frame: pd.DataFrame) -> pd.DataFrame:
    """One host's template from its frequent tokens: its classes, in order and nested.

    ``once`` marks tokens that bound slots, ``constant`` the classes whose blocks are not the pages' own.
    """
    n = int(frame["host_pages"].iloc[0])
    page = frame[frame["token"] == 0]
    classes = []
    for (vector, pages, times), some in frame[frame["token"] != 0].groupby(["vector", "pages", "times"], sort=True):
        some = some.sort_values(["first", "last", "token"])
        once = int(times) == int(pages)
        # tokens that come once a page keep one order if each is over before the next begins, on average
        if len(some) >= 2 and (not once or (some["last"] <= some["first"].shift(-1, fill_value=float("inf"))).all()):
            classes.append((some, once, bool(len(page)) and vector == page["vector"].iloc[0]))
        elif pages > SHARE * n:
            # nothing but its number confirms a block alone, so more than the share is wanted
            classes.extend((some[some["token"] == token], False, False) for token in some.loc[some["block"], "token"])
    classes.sort(key=lambda c: (-int(c[0]["pages"].iloc[0]), float(c[0]["first"].iloc[0]), int(c[0]["token"].iloc[0])))
    # classes go from the smallest on, as long as they leave the articles half of their blocks or characters
    constant, blocks, chars = set(), 0, 0
    for k in sorted(range(len(classes)), key=lambda k: (int(classes[k][0]["chars"].sum()), k)):
        blocks += int(classes[k][0]["blocks"].sum())
        chars += int(classes[k][0]["chars"].sum())
        if 2 * blocks <= page["blocks"].sum() or 2 * chars <= page["chars"].sum():
            constant.add(k)
    rows = []
    for k, (some, once, root) in enumerate(classes):
        low, high, parent, slot, width = some["first"].min(), some["last"].max(), -1, -1, float("inf")
        for j, (other, other_once, _) in enumerate(classes):
            if j != k and other_once:
                ends, starts = other["last"].tolist()[:-1], other["first"].tolist()[1:]
                for s, (a, b) in enumerate(zip(ends, starts, strict=True)):
                    if a <= low and high <= b and b - a < width:
                        parent, slot, width = j, s, b - a
        for place, (token, role, block) in enumerate(zip(some["token"], some["role"], some["block"], strict=True)):
            rows.append((frame["host"].iloc[0], n, k, len(some), place, parent, slot, token, role, block, root, once, k in constant))
    return pd.DataFrame(rows, columns=TEMPLATE.fieldNames())


def different(pages: DataFrame) -> DataFrame:
    """The different pages of each host, blank ones left out. Tasks drop their own copies before the shuffle."""
    digest = "host string, html string, digest binary"

    def firsts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()  # 16 bytes a page of the task
        for batch in batches:
            if "digest" not in batch:
                batch = batch[[isinstance(page, str) and not page.isspace() and page != "" for page in batch["html"]]]
                pairs = zip(batch["host"], batch["html"], strict=True)
                batch = batch.assign(
                    digest=[xxhash.xxh128_digest(f"{host}\n{page}".encode("utf-8", "surrogatepass")) for host, page in pairs]
                )
            new = []
            for mark in map(bytes, batch["digest"]):
                new.append(mark not in seen)
                seen.add(mark)
            yield batch[new]

    once = pages.select("host", "html").mapInPandas(firsts, digest).repartition("digest")
    return once.mapInPandas(firsts, digest).select("host", "html")


def deduce(pages: DataFrame) -> DataFrame:
    """The templates of all hosts: a row for each token of each class, with the class's parent and slot there.

    Only tokens that at least ``SHARE`` of a host's pages have reach a host's group, so its size depends on the
    length of a page, not on the number of pages. Copies of a page count once, blank pages not at all. Hosts
    with fewer than ``PAGES`` different pages have no template.
    """
    counts = written(count_tokens(different(pages)), "tokens")
    hosts = counts.filter("token = 0").select(F.col("host").alias("h"), F.col("pages").alias("host_pages"))
    often = counts.join(hosts.filter(F.col("host_pages") >= PAGES), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    often = often.filter(F.col("pages") >= SHARE * F.col("host_pages"))
    return often.groupBy("host").applyInPandas(_nest, TEMPLATE)


class Known:
    """Sets of the templates that a task has met last, by their arrays."""

    def __init__(self, most: int = 256):
        self.most, self.sets = most, {}

    def set_of(self, tokens) -> frozenset[int]:
        if tokens is None:
            return frozenset()
        key = np.asarray(tokens, np.int64).tobytes()
        if key not in self.sets:
            if len(self.sets) >= self.most:
                self.sets.clear()
            self.sets[key] = frozenset(np.frombuffer(key, np.int64).tolist())
        return self.sets[key]


def page_blocks(html: str, constant: frozenset[int], bounds: frozenset[int]) -> list[tuple[int, str, bool | None, bool]]:
    """The page's blocks in order: the slot they stand in, their text, ``main``, and whether they are the page's own.

    A slot is named by the token of a class before it, 0 before all.
    """
    out, slot = [], 0
    for role, text, main in page_tokens(html):
        token = _hash(role, text) if constant or bounds else 0
        if token in bounds:
            slot = token
        if text:
            out.append((slot, text, main, token not in constant))
    return out


def count_slots(rows: DataFrame) -> DataFrame:
    """Of rows ``host``, ``html``, ``constant``, ``bounds``: the characters of own text in each slot, in articles and
    outside, not set aside. The slot -1 has the number of pages that have any in an article, and of all."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Known()
        for batch in batches:
            found: dict[tuple[str, int], list[int]] = {}
            for host, html, *sets in zip(batch["host"], batch["html"], batch["constant"], batch["bounds"], strict=True):
                blocks = page_blocks(html if isinstance(html, str) else "", *map(known.set_of, sets))
                own = [block for block in blocks if block[3] and block[2] is not False]
                counts = [(-1, int(any(main for _, _, main, _ in own)), 1)] if own else []
                counts += [(slot, len(text) if main else 0, 0 if main else len(text)) for slot, text, main, _ in own]
                for slot, inside, outside in counts:
                    row = found.setdefault((host, slot), [0, 0])
                    row[0] += inside
                    row[1] += outside
            yield pd.DataFrame([(*key, *row) for key, row in found.items()], columns=["host", "slot", "inside", "outside"])

    found = rows.mapInPandas(of, "host string, slot long, inside long, outside long")
    return found.groupBy("host", "slot").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


# Containers that are whole pages.
PAGE_PATHS = ("", "/html", "/html/body", "/body")


def _container(role: Column) -> Column:
    """The path of the element that text after a tag stands in: its own, or its parent's after an end tag."""
    return F.when(F.endswith(role, F.lit(">")), F.regexp_replace(role, "/(?:[^/\\[]|\\[[^\\]]*\\])*>$", "")).otherwise(role)


def main_blocks(blocks: list[tuple[int, str, bool | None, bool]], slots: frozenset[int] | None) -> list[str]:
    """The texts of a page's article, from ``page_blocks``; ``slots`` are the host's slots of articles, if known.

    Own blocks of those slots that are not set aside are the article. If most pages of the host have none, so
    that ``slots`` is empty, elements that are named an article count only where they hold most of the own text.
    Otherwise the page's own elements decide, and an article of constant blocks alone is kept.
    """
    if slots is not None:
        own = [block for block in blocks if block[3] and block[2] is not False]
        if slots:
            found = [text for slot, text, _, _ in own if slot in slots]
        else:
            inside, total = (sum(len(b[1]) for b in some) for some in ([b for b in own if b[2]], own))
            found = [text for _, text, main, _ in own if main or 2 * inside < total]
        if found:
            return found
    wanted = True if any(main for _, _, main, _ in blocks) else None
    some = [(text, own) for _, text, main, own in blocks if main is wanted]
    return [text for text, own in some if own] or [text for text, _ in some]


def extract_text(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """Add the page's main text: its article's blocks, joined by a line feed, without the host's template.

    Blocks of the template's classes are not the page's own and go, unless the article would lose all or most of
    its blocks. The others stand in slots between the classes' tokens. Article and main elements choose
    the host's slots; where most pages have none, the element does in which the slot with most of the text stands.
    In these all stays but what is set aside (menus, headers, footers, sidebars, notices, adverts, forms,
    comments, scripts, styles). On a host without a template the page's own
    elements decide; on a page without an article or main element, all that is not set aside. A null
    or empty page, and one without such a block, has the empty text. Repeated rows are judged alike;
    a column ``out`` is replaced.
    """
    host, known = fresh(pages, "host"), fresh(pages, "template")
    rows = pages.withColumn(host, host_of(F.col(url)))
    slim = rows.select(F.col(host).alias("host"), F.col(html).cast("string").alias("html"))
    tokens = lambda which: F.array_sort(F.collect_set(F.when(F.expr(which), F.col("token"))))
    found = written(deduce(slim), "template")
    template = found.groupBy(F.col("host").alias("h"))
    template = template.agg(tokens("block AND constant").alias("constant"), tokens("once").alias("bounds"))
    template = written(template, "templates")
    slots = count_slots(slim.join(template, F.col("host") == F.col("h")).select("host", "html", "constant", "bounds"))
    pick = F.when(F.expr("slot >= 0 AND inside > 0 AND inside >= outside"), F.col("slot"))
    named = F.max(F.expr(f"slot = -1 AND inside >= {SHARE} * outside"))
    around = found.filter("once").groupBy(F.col("host").alias("b"), F.col("token").alias("slot"))
    around = around.agg(_container(F.min("role")).alias("container"))
    slots = slots.join(around, (F.col("host") == F.col("b")) & (slots["slot"] == around["slot"]), "left").drop(around["slot"], "b")
    most = F.max(F.when(F.expr("slot >= 0"), F.struct("outside", "container"))).alias("most")
    total = F.sum(F.expr("if(slot >= 0, outside, 0)")).alias("total")
    places = F.collect_set(F.when(F.expr("slot >= 0"), F.struct("slot", "container"))).alias("places")
    slots = slots.groupBy(F.col("host").alias("s")).agg(
        named.alias("named"), F.array_sort(F.collect_set(pick)).alias("slots"), most, total, places
    )
    # without articles: the slots in the element that holds the slot with most of the text, unless it holds the page
    inside = lambda p: (p["container"] == F.col("most.container")) | F.startswith(
        p["container"], F.concat("most.container", F.lit("/"))
    )
    beside = F.array_sort(F.transform(F.filter("places", inside), lambda p: p["slot"]))
    clear = F.expr("2 * most.outside > total") & ~F.col("most.container").isin(*PAGE_PATHS)
    none = F.array().cast("array<long>")
    slots = slots.select("s", F.when(F.col("named"), F.col("slots")).when(clear, beside).otherwise(none).alias("slots"))
    template = template.join(slots, F.col("h") == F.col("s"), "left")
    template = written(template.select("h", F.struct("constant", "bounds", "slots").alias(known)), "slots")

    @F.pandas_udf("string")
    def main_text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        sets = Known()
        for batch in batches:
            out = []
            for page, constant, bounds, slots in zip(*batch, strict=True):
                blocks = page_blocks(page if isinstance(page, str) else "", sets.set_of(constant), sets.set_of(bounds))
                out.append("\n".join(main_blocks(blocks, None if slots is None else sets.set_of(slots))))
            yield pd.Series(out, dtype=object)

    rows = rows.join(template, F.col(host) == F.col("h"), "left").drop("h")
    of = [F.col(known)[c] for c in ("constant", "bounds", "slots")]
    return rows.withColumn(out, main_text(F.col(html).cast("string"), *of)).drop(host, known)
