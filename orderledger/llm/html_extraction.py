"""Main text of web pages by site style trees.

The trees of a host's pages are merged: nodes that have the same path of styles (tag, classes and
id) are one node of the host's style tree. Two entropies say how much a node tells about a page.
Its presentation: over the sequences of child styles that its pages show there; its content: over
the texts right below it. Both are taken to the base of the number of pages, so that a branch that
is the same on every page has importance 0 and one that differs on each has 1. A branch whose most
important node stays below the threshold is template and goes, on each page of the host. A single
page tells nothing: for hosts with one page, and pages without a URL, the mean importance of the
branch on the hosts that have several decides.

No number of pages switches this on or off. A branch that some pages of a host lack has to make up
for it: what is added to its importance falls with the share of pages that have it and with their
number. Inside articles a second sign is asked for: that nearly all articles of its kind have the
branch, by the lower end of the confidence interval of their share.

Two things no entropy can tell. What a style says about itself (`nav`, `footer`, an advert's class
and so on) settles it for its whole branch, as menus and comments may differ on each page. And a
page's `article` or `main`, where it holds enough of the words, is its content however many pages
repeat it: branches in it that are template go, but not most of it.

The merged statistics are rows by host and node, aggregated before the shuffle, and so are the
importances that nodes hand up to their ancestors: no row holds more than one node. Pages of a host
that have the same paths share a name. What is joined to a page are those of its own paths that are
template, by host and name; names are dealt by the pages' bytes, so a host with a third of all pages
is read by many tasks.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from operator import attrgetter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups, written

#: Branches below this importance are template.
THRESHOLD = 0.3
#: A branch on n of N pages has DOUBT * (1 - n / N) / sqrt(n) added to its importance.
DOUBT = 0.75
#: Inside an article the share of its pages that have the branch is at least this much, by the lower
#: end of the Wilson interval of 95 %: 16 of 16 pages are enough, and 2 of 2 are not.
ARTICLE_SHARE, Z2 = 0.8, 1.96**2
#: Pages of a host that have the same paths are dealt to this many names.
SALTS = 64
#: A node of the style tree meets the pages that have it in this many tasks' keys.
PATH_SALTS = 8
#: An article that would lose more than all but this share of its words stays whole, and articles
#: with less than this share of a page's words are not all of its content.
LEAST_SHARE = 0.25
#: Nodes deeper than this count as children of the node at this depth.
MOST_DEPTH = 256

# How HTML names things.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp noframes noembed iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
SKIPPED = frozenset(
    "head script style template noscript iframe object embed svg math canvas audio video "
    "nav footer aside form button select textarea input dialog menu title".split()
)
MAIN = frozenset(["article", "main"])
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Of these nothing is ever shown as text.
UNSEEN = frozenset(
    "head script style template noscript iframe object embed svg math canvas audio video "
    "select textarea input title".split()
)
#: Words in classes and ids that speak of something other than the main text.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar side widget footer masthead topbar "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login share "
    "sharing social related recommended comment comments reply replies disqus pagination pager "
    "toolbar copyright legal skip".split()
)
#: Their names speak of the page's layout, and inside an article of what a part is about.
PAGE = frozenset("html body main article".split())
PARTS = frozenset("section h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<tag>/?[a-zA-Z][^\s/>]*)"
    r"|<[!?/][^>]*>?",
    re.DOTALL,
)
ATTRIBUTES = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.DOTALL
)


def _boilerplate(names: str) -> bool:
    """Whether a class or id is made of such words only: `cookie-notice`, not `side-effects`."""
    return any(
        BOILERPLATE.issuperset(filter(None, re.split("[_-]", name)))
        for name in names.lower().split()
        if name.strip("_-")
    )


class Node:
    """An element: its style, parent, and children in order, texts among them.

    `skipped` is told of the top of a branch only; `main` of all nodes in an article.
    """

    __slots__ = ("tag", "style", "parent", "children", "depth", "path", "skipped", "main")

    def __init__(self, tag: str, names: str, role: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.style = f"{tag}.{'.'.join(sorted(names.split()))}" if names else tag
        self.depth = 0 if parent is None else parent.depth + 1
        above = parent.path if parent is not None else ""
        self.path = above if self.depth > MOST_DEPTH else f"{above}/{self.style}"
        inside = parent is not None and parent.main
        told = names and tag not in PAGE and not (inside and tag in PARTS)
        self.skipped = tag in SKIPPED or role in ROLES or bool(told and _boilerplate(names))
        # An article's header may hold its title.
        if (tag == "header" or (told and "header" in names.lower().split())) and not inside:
            self.skipped = True
        self.main = tag in MAIN or role == "main" or (parent is not None and parent.main)


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), next(filter(None, values), ""))
    return found


def parse(page: str) -> Node:
    """The tree of a page, as lenient as browsers in what pages commonly get wrong.

    An element that ends closes what is open inside; a paragraph ends where a block begins, a list
    item where the next one does; an end tag without a start is passed over. From a tag whose quotes
    do not close on, quotes mean nothing and tags end at the next `>`; where there is none, the rest
    is text. The time is linear in the page whatever it holds.
    """
    root = node = Node("", "", "", None)
    #: The open elements of each tag, the innermost last.
    open_tags: dict[str, list[Node]] = {}
    at, size, quotes = 0, len(page), True

    def close(until: Node) -> None:
        nonlocal node
        while node is not until:
            open_tags[node.tag].pop()
            node = node.parent

    def innermost(tags: frozenset) -> Node:
        return max((open_tags[tag][-1] for tag in tags if open_tags.get(tag)), key=depth, default=root)

    def close_like(tags: frozenset, stops: frozenset) -> None:
        found = innermost(tags)
        if found is not root and found.depth > innermost(stops).depth:
            close(found.parent)

    while at < size:
        token = TOKEN.search(page, at)
        text = page[at : token.start() if token else size]
        if text:
            node.children.append(text)
        if token is None:
            break
        at = token.end()
        name = token["tag"]
        if name is None:
            continue
        told = ATTRIBUTES.match(page, at) if quotes else None
        if told is None:
            quotes = False
            end = page.find(">", at)
            if end < 0:
                node.children.append(page[token.start() :])
                break
            written_attributes, at = page[at:end], end + 1
        else:
            written_attributes, at = told[1], told.end()
        if name[0] == "/":
            tag = name[1:].lower()
            if open_tags.get(tag):
                close(open_tags[tag][-1].parent)
            continue
        tag = name.lower()
        attributes = _attributes(written_attributes) if written_attributes.strip(" /") else {}
        if tag in CLOSES_P and open_tags.get("p"):
            close_like(P, HOLDS_P)
        for same, stops in LIKE.items():
            if tag in same:
                close_like(same, stops)
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
        child = Node(tag, names, attributes.get("role", "").lower(), node)
        node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            child.children.append(page[at : end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID:
            node = child
            open_tags.setdefault(tag, []).append(child)
    return root


depth = attrgetter("depth")
#: Paragraphs, and elements whose content ends no paragraph outside of them.
P, HOLDS_P = frozenset(["p"]), frozenset(["button", "td", "th", "li"])
#: Elements that end where another of their kind begins, unless one of the second is between.
LIKE = {
    frozenset(["li"]): frozenset(["ul", "ol", "menu"]),
    frozenset(["dt", "dd"]): frozenset(["dl"]),
    frozenset(["td", "th"]): frozenset(["tr", "table"]),
    frozenset(["tr"]): frozenset(["table", "tbody", "thead", "tfoot"]),
    frozenset(["option"]): frozenset(["select"]),
}


def elements(root: Node) -> Iterator[Node]:
    """All elements in page order, the root first."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(child for child in reversed(node.children) if isinstance(child, Node))


def _seen(root: Node) -> Iterator[Node]:
    """The elements outside of skipped branches, and the tops of these."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        if not node.skipped:
            stack.extend(child for child in reversed(node.children) if isinstance(child, Node))


def _blocks(root: Node, template: frozenset | set = frozenset()) -> list[tuple[str, bool]]:
    """The blocks of text that are left, and whether each is of an `article` or `main`.

    Inside of these an inline element is part of a sentence and is never template by itself.
    """
    blocks: list[tuple[str, bool]] = []
    words: list[str] = []
    main = root.main

    def end_block() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            blocks.append((text, main))

    stack: list = [(root, root.main)]
    while stack:
        item, inside = stack.pop()
        if inside != main:
            end_block()
            main = inside
        if item is None:
            end_block()
        elif isinstance(item, str):
            words.append(html.unescape(item))
        elif item.skipped or (
            not (inside and item.tag in INLINE) and _path_key(item.path) in template
        ):
            if item.tag not in INLINE:
                end_block()
        else:
            block = item.tag not in INLINE and item.tag != "br"
            if item.tag == "br":
                words.append(" ")
            if block:
                end_block()
                stack.append((None, inside))
            for child in reversed(item.children):
                stack.append((child, child.main if isinstance(child, Node) else inside))
    end_block()
    return blocks


def _size(blocks: list[tuple[str, bool]]) -> int:
    return sum(len(text.split()) for text, _ in blocks)


def _main_blocks(
    root: Node, template: frozenset | set = frozenset()
) -> list[tuple[str, bool]]:
    """The blocks of the articles that hold enough of the page's words, or else all that are left.

    Without those that are template, but for articles of which these would leave less than
    LEAST_SHARE of the words: they are copies and stay whole.
    """
    blocks = _blocks(root, template)
    main = [block for block in blocks if block[1]]
    if template:
        whole = [block for block in _blocks(root) if block[1]]
        if _size(main) < LEAST_SHARE * _size(whole):
            main = whole
    rest = [block for block in blocks if not block[1]]
    return main if main and _size(main) >= LEAST_SHARE * _size(main + rest) else blocks


def main_text(root: Node, template: frozenset | set = frozenset()) -> str:
    """The blocks of the page's main branches, without those that are template.

    If nothing is left of a page, no branch of it counts as template, and if still nothing is, the
    largest of its skipped branches that can be seen is the page.
    """
    blocks = _main_blocks(root, template) or _main_blocks(root)
    if not blocks:
        branches = [node for node in _seen(root) if node.skipped and node.tag not in UNSEEN]
        for every in (False, True):
            for branch in branches:
                for node in elements(branch) if every else [branch]:
                    node.skipped = node.tag in UNSEEN
            blocks = blocks or max(map(_main_blocks, branches), key=_size, default=[])
    return " ".join(text for text, _ in blocks)


def site_of(url, page: str) -> str:
    """The host, or a name that only copies of the page share, which begins with a space."""
    return host_of(url) or f" {xxhash.xxh3_64_hexdigest(page)}"


def host_of(url) -> str:
    """Lower case, without port; empty without a URL."""
    found = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _path_key(path: str) -> int:
    return xxhash.xxh3_64_intdigest(path) - (1 << 63)


def _path_keys(root: Node) -> set[int]:
    return {_path_key(path) for path in {node.path for node in elements(root)}}


def node_features(page: str) -> dict[int, tuple[tuple, int | None, int, int]]:
    """For each path of a page: its ancestors' keys, that of the article that it is in or is (None
    outside of articles), and hashes of its child styles and its texts."""
    styles: dict[int, list] = {}
    texts: dict[int, list] = {}
    above: dict[int, tuple] = {}
    article: dict[int, int | None] = {}
    for node in elements(parse(page)):
        key = _path_key(node.path)
        if key not in above:
            parent = _path_key(node.parent.path) if node.parent else key
            above[key] = (*above[parent], parent) if parent != key else ()
            inside = article[parent] if parent != key else None
            article[key] = key if inside is None and node.main else inside
        styles.setdefault(key, []).extend(
            child.style for child in node.children if isinstance(child, Node)
        )
        texts.setdefault(key, []).extend(
            " ".join(child.split()) for child in node.children if isinstance(child, str)
        )
    return {
        key: (
            above[key],
            article[key],
            _path_key("\x00".join(styles[key])),
            _path_key("\x00".join(filter(None, texts[key]))) if any(texts[key]) else 0,
        )
        for key in styles
    }


def _page_name(page: str, paths: Iterable[int]) -> int:
    """A name that pages with the same paths share, dealt to SALTS names by the page's bytes."""
    salt = xxhash.xxh3_64_intdigest(page) % SALTS
    return _path_key(f"{salt} {sorted(paths)}")


#: Kinds of feature rows. `variant` is a hash of the child styles, of the texts, the key of an
#: ancestor, the name of a page that has the path, or the key of its article.
STYLES, TEXTS, ABOVE, NAMES, ARTICLE = range(5)


def _feature_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (host, path, kind, variant), added up over a group of pages."""
    for urls, pages in text_groups(batches):
        counts: dict[tuple, int] = {}
        for url, page in zip(urls.to_pylist(), pages):
            if not page:
                continue
            host = site_of(url, page)
            features = node_features(page)
            name = _page_name(page, features)
            for key, (above, article, style, text) in features.items():
                variants = [(STYLES, style), (TEXTS, text), (NAMES, name)]
                if article is not None:
                    variants.append((ARTICLE, article))
                for kind, variant in variants + [(ABOVE, ancestor) for ancestor in above]:
                    row = (host, key, kind, variant)
                    counts[row] = counts.get(row, 0) + 1
        hosts, keys, kinds, variants = zip(*counts) if counts else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.string()),
                pa.array(keys, pa.int64()),
                pa.array(kinds, pa.int8()),
                pa.array(variants, pa.int64()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["host", "path", "kind", "variant", "pages"],
        )


def node_variants(pages: DataFrame) -> DataFrame:
    """host, path, kind, variant and the number n of pages that show it."""
    return (
        pages.select("url", "html")
        .mapInArrow(
            _feature_rows, "host string, path bigint, kind tinyint, variant bigint, pages bigint"
        )
        .groupBy("host", "path", "kind", "variant")
        .agg(F.sum("pages").alias("n"))
    )


def importances(variants: DataFrame) -> DataFrame:
    """host, path, pages and importance (0 to 1) of every node of the merged trees by itself.

    The importance of a node is the larger of its two entropies; a node without text has its
    presentation only.
    """
    silent = (F.col("kind") == TEXTS) & (F.col("variant") == 0)
    shown = variants.filter(F.col("kind").isin(STYLES, TEXTS))
    entropies = shown.groupBy("host", "path", "kind").agg(
        F.sum("n").alias("pages"),
        F.sum(F.when(~silent, F.col("n"))).alias("m"),
        F.sum(F.when(~silent, F.col("n") * F.log2("n"))).alias("weighted"),
    )
    entropy = F.log2("m") - F.col("weighted") / F.col("m")
    own = F.when(F.col("m") > 1, entropy / F.log2("m")).when(F.col("m") == 1, 1.0).otherwise(0.0)
    return entropies.groupBy("host", "path").agg(
        F.max("pages").alias("pages"), F.max(own).alias("importance")
    )


def style_trees(pages: DataFrame) -> DataFrame:
    """host, path, pages and importance (0 to 1) of every node of the merged trees by itself."""
    return importances(node_variants(pages))


def branches(variants: DataFrame) -> DataFrame:
    """host, path, pages, importance and article of every branch: that of its most important node.

    Each node's importance goes to its ancestors, MOST_DEPTH at most, as rows of their own. `article`
    is the key of the article around a branch, or that it is; NULL outside of articles.
    """
    own = importances(variants)
    above = variants.filter(F.col("kind") == ABOVE).select(
        "host", "path", F.col("variant").alias("ancestor")
    )
    below = above.join(own.select("host", "path", "importance"), ["host", "path"]).select(
        "host", F.col("ancestor").alias("path"), "importance"
    )
    inside = variants.filter(F.col("kind") == ARTICLE).select(
        "host", "path", F.col("variant").alias("article")
    )
    return (
        own.unionByName(below, allowMissingColumns=True)
        .unionByName(inside, allowMissingColumns=True)
        .groupBy("host", "path")
        .agg(*(F.max(name).alias(name) for name in ("pages", "importance", "article")))
    )


def _dealt(few: DataFrame) -> DataFrame:
    """The rows once for each salt."""
    return few.withColumn("salt", F.explode(F.expr(f"sequence(0, {PATH_SALTS - 1})")))


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(PATH_SALTS)).cast("int").alias("salt")


def template_paths(variants: DataFrame) -> DataFrame:
    """host and path of the branches that are template, once each.

    The pages that could have a branch are those of its article's path, or else of the host.
    """
    found = written(branches(variants), "branches")
    real = ~F.col("host").startswith(" ")
    root = F.lit(_path_key("/"))
    whole = _dealt(
        found.filter(real & ((F.col("path") == root) | (F.col("path") == F.col("article")))).select(
            "host", F.col("path").alias("around"), F.col("pages").alias("of")
        )
    )
    low = found.filter(real & (F.col("importance") < THRESHOLD) & (F.col("pages") >= 2))
    low = low.withColumn("around", F.coalesce("article", root)).withColumn("salt", _salt("path"))
    # A page may have the branch in another of its articles, so n may pass the article's pages.
    of = F.greatest("of", "pages")
    share = F.col("pages") / of
    doubt = DOUBT * (1 - share) / F.sqrt("pages")
    spread = F.sqrt(Z2 * share * (1 - share) / of + (Z2 / (2 * of)) ** 2)
    least_share = (share + Z2 / (2 * of) - spread) / (1 + Z2 / of)
    several = (
        low.join(whole, ["host", "around", "salt"])
        .filter(F.col("importance") + doubt < THRESHOLD)
        .filter(F.col("article").isNull() | (least_share >= ARTICLE_SHARE))
        .select("host", "path")
    )
    # One more host on which the branch is important stands for those not seen.
    pool = (
        found.filter(real & (F.col("pages") >= 2) & F.col("article").isNull())
        .groupBy("path")
        .agg(((F.sum("importance") + 1) / (F.count("*") + 1)).alias("importance"))
        .filter(F.col("importance") < THRESHOLD)
    )
    outside = found.filter(F.col("article").isNull())
    once = outside.filter(real & (F.col("pages") == 1)).select("host", "path", _salt("path"))
    alone = whole.filter((F.col("around") == root) & (F.col("of") == 1)).select("host", "salt")
    single = once.join(alone, ["host", "salt"]).select("host", "path")
    lone = single.unionByName(outside.filter(~real).select("host", "path"))
    pooled = (
        lone.select("*", _salt("host"))
        .join(_dealt(pool.select("path")), ["path", "salt"])
        .select("host", "path")
    )
    return several.unionByName(pooled)


def page_templates(pages: DataFrame) -> DataFrame:
    """host, page name and `template`, the page's own paths that are template, where it has any."""
    variants = written(node_variants(pages), "style_variants")
    named = variants.filter(F.col("kind") == NAMES).select(
        "host", "path", F.col("variant").alias("name"), _salt("variant")
    )
    return (
        named.join(_dealt(template_paths(variants)), ["host", "path", "salt"])
        .groupBy("host", "name")
        .agg(F.collect_list("path").alias("template"))
    )


def _namer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each page's host and name; rows without a page have a name by their id and no host."""
    for batch in batches:
        hosts, names = [], []
        for row, url, page in zip(*map(batch.column, ["id", "url", "html"])):
            page = page.as_py()
            hosts.append(site_of(url.as_py(), page) if page else "")
            names.append(
                _page_name(page, _path_keys(parse(page))) if page else _path_key(str(row))
            )
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(hosts, pa.string()), pa.array(names, pa.int64())],
            names=["id", "url", "html", "host", "name"],
        )


def _extractor(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        templates = batch.column("template").to_pylist()
        texts = [
            main_text(parse(page.as_py() or ""), frozenset(template or ()))
            for page, template in zip(batch.column("html"), templates)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["id", "url", "text"],
        )


def extract_text(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Id, url and `text` (empty if none) of every row.

    A NULL or empty page has no text. A page without a URL belongs to no host's tree; for it, and for
    the page of a host with one, the trees of all hosts with several pages tell. Repeated rows and
    NULL ids are rows like others; other columns are left out; an empty table gives an empty one.
    """
    pages = df.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    kind = pages.schema["id"].dataType.simpleString()
    named = pages.mapInArrow(
        _namer, f"id {kind}, url string, html string, host string, name bigint"
    )
    templates = written(page_templates(pages), "templates")
    joined = named.join(templates, ["host", "name"], "left").select("id", "url", "html", "template")
    return joined.mapInArrow(_extractor, f"id {kind}, url string, text string").withColumnRenamed(
        "id", id_col
    )
