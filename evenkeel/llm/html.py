"""Main text of web pages by template deduction: equivalence classes of tags and words over the pages of a host.

The tokens of a page are its structural tags and its words, told apart by the path of tags above them. Over all pages of
a host a token has an occurrence vector, kept as its number of pages and occurrences and a sum of hashes of (page, count),
which Spark adds up in parts, so a host of any size is a few rows per task. A first count over all pages finds the words
that stand on enough of them; only these have a vector. Tokens with one vector form a class; a class is valid if it has
several tokens and stands on most pages, and holds on a page where its tokens stand in one order. The class that stands
once on every page is the outermost; a class of fewer pages that stands once on each is nested in the slot between two
of its tokens.
The slot that holds the text is the deepest token of a valid class that covers most of the host's running text. What a
page has in it outside the words of the template, without nested menus, forms, notices and comments, is extracted.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import settle, written

#: Share of a host's pages that a template token stands on, and of its text that the main slot covers, at least.
SUPPORT, COVER = 0.6, 0.8
#: Class words count for nothing on a tag with more than this share of the page's running text.
MOST = 0.5
#: Tokens of a valid class at least.
SIZE = 3
#: Pages that a word of the template stands on at least. A word of the text stands exactly once on each of n pages with a
#: probability of 1/e^n at most: 1e-13 here, so that none is expected among 10^12 words of all hosts.
WORD_PAGES = 30
#: Words that a task counts before it hands the counts on, and pages of a host in a part of which rare words are left out.
HELD, PART_PAGES = 300_000, 8
#: Slack of counts that are compared with a share, for the rounding of that.
CLOSE = 1e-6
#: Hosts whose templates are sent to every executor at most (some 40 bytes each); beyond, they are joined by a shuffle.
HOSTS = 200_000

#: Bits of the summed hashes that are kept, so that sums of sums neither overflow nor depend on how pages are dealt.
_VECTOR = (1 << 40) - 1
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre section select summary"
    " table tbody td tfoot th thead title tr ul".split()
)
_NO_TEXT = frozenset(
    "head title nav aside footer form fieldset menu dialog select option button iframe object canvas video audio map".split()
)
#: Tags that hold a block or a part of one, and so are no slot for an article.
_PARTS = frozenset(
    "address blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup legend li ol p pre summary tbody td tfoot"
    " th thead tr ul".split()
)
#: Tags that no class word speaks against.
_WHOLE = frozenset(("html", "body", "main", "article"))
_RAW = "script|style|noscript|template|svg|math|textarea|xmp"
#: Words in a class or id that name what is not the article, and words that may stand beside them in a compound.
_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comentario comentarios comment commentaire commentaires"
    " comments consent cookie cookies disclaimer kommentar kommentare reactie reacties responses"
    " footer gdpr header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo"
    " promotion related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription"
    " toolbar topbar widget".split()
)
_BESIDE = frozenset(
    "area article articles author bar block blog body bottom box btn button buttons card col column container content"
    " copyright count date dialog entry fixed form global google group header heading headline icon icons inner item"
    " items js label leaderboard left legal link links list lower main meta news notification now outer overlay page"
    " panel post posts primary right row secondary section site slot small sticky stories teaser text this thread"
    " title to top trail unit upper user view widget widgets wrap wrapper"
    .split()
)
#: Attributes as the standard reads them: a quote opens a value only right after the equals sign.
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+)?+)*+)>",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: A new one of these ends an open one of the same group.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Node:
    """An open structural tag: its path, whether its text counts, whether its class words speak against it, what is above it."""

    __slots__ = ("name", "path", "text", "named", "up")

    def __init__(self, name: str, path: str, text: bool, named: bool, up: Node | None):
        self.name, self.path, self.text, self.named, self.up = name, path, text, named, up


def _speaks_against(token: str) -> bool:
    """Whether a class or id names what is not the article: its words all do, or say only where or how it is laid out."""
    parts = [w for w in re.split(r"[^a-z]+", token) if len(w) > 1]
    return any(w in _NAMES for w in parts) and all(w in _NAMES or w in _BESIDE for w in parts)


def _opened(name: str, attrs: str, up: Node) -> Node:
    label, noise, named = name, name in _NO_TEXT, False
    if name == "header":
        at = up
        while at and at.name != "article":
            at = at.up
        noise = at is None
    if attrs:
        values = [a or b or c for _, a, b, c in _NAMED.findall(attrs)]
        words = {w for v in values for w in re.split(r"[^a-z]+", v.lower()) if w}
        if words & _NAMES and name not in _WHOLE:
            named = any(_speaks_against(t) for v in values for t in v.lower().split())
        if words:
            label += "." + ".".join(sorted(words))
    return Node(name, f"{up.path}>{label}", up.text and not noise, named, up)


def _judge(nodes: list[Node], blocks: list[tuple[Node, str, int, int]]) -> None:
    """Take out the text of tags by their class words, but for those that hold most of the page's running text."""
    if not any(n.named for n in nodes):
        return
    held: dict[int, int] = defaultdict(int)
    whole = 0
    for n, text, linked, _ in blocks:
        size = max(0, len(text) - linked) if n.text else 0
        whole += size
        while size and n.up is not None:
            if n.named:
                held[id(n)] += size
            n = n.up
    for n in nodes:
        noise = n.named and held[id(n)] <= MOST * whole
        n.text = n.text and n.up.text and not noise


def parse(html: str) -> tuple[list[Node], list[tuple[Node, str, int, int]]]:
    """All structural tags of a page in order, and its blocks of text: where, what, how much of it is in links, and after
    how many tags."""
    root = Node("", "", True, False, None)
    at, nodes, blocks = root, [], []
    held: list[str] = []
    linked, link, last = 0, 0, 0

    def close() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(held)).split())
        if text:
            blocks.append((at, text, linked, len(nodes)))
        held.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        held.append(raw)
        if link:
            linked += len(raw)

    for found in _TAG.finditer(html):
        if found.start() > last:
            add(html[last : found.start()])
        last = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name not in _BLOCK:
            if name == "a":
                link = 0 if found["end"] else 1
            elif name in ("br", "hr", "img", "wbr"):
                held.append(" " if name != "wbr" else "")
            elif name in _NO_TEXT and not found["end"] and name not in _VOID:
                close()
                at = _opened(name, found["attrs"], at)
                nodes.append(at)
            elif name in _NO_TEXT:
                close()
                at = _ended(at, name)
            continue
        close()
        link = 0
        if found["end"]:
            at = _ended(at, name)
            continue
        if at.name == "p":
            at = at.up
        elif at.name in _ENDS.get(name, ()):
            while at.name in _ENDS[name]:
                at = at.up
        at = _opened(name, found["attrs"], at)
        nodes.append(at)
    add(html[last:])
    close()
    _judge(nodes, blocks)
    return nodes, blocks


def _ended(at: Node, name: str) -> Node:
    """The place after an end tag; one that closes nothing is passed over."""
    open_tag = at
    while open_tag.up is not None and open_tag.name != name:
        open_tag = open_tag.up
    return open_tag.up if open_tag.up is not None else at


def path_key(path: str) -> int:
    return xxhash.xxh64_intdigest(path, 0) - (1 << 63)


def stream(nodes: list[Node], blocks: list[tuple[Node, str, int, int]], words: dict[int, set[str]]) -> list[tuple[int, int, int]]:
    """The tags of a page and those words that are in ``words`` under the key of their path, in order: key, block and place
    in it; -1 for tags."""
    out, done = [], 0
    for b, (n, text, _, opened) in enumerate(blocks):
        out += [(path_key(node.path), -1, -1) for node in nodes[done:opened]]
        done = opened
        listed = words and words.get(path_key(n.path))
        if listed:
            above = n.path + " "
            out += [(path_key(above + word), b, i) for i, word in enumerate(text.split()) if word in listed]
    return out + [(path_key(node.path), -1, -1) for node in nodes[done:]]


def by_path(words: list[dict] | None) -> dict[int, set[str]]:
    """The words of a host as ``repeated_words`` lists them, by the key of their path."""
    out: dict[int, set[str]] = {}
    for w in words or ():
        out.setdefault(w["at"], set()).add(w["word"])
    return out


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def repeated_words(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``of_host, words``: the words that stand on at least ``support`` of a host's pages, each with the key of its path.

    Others may be among them: ``tag_vectors`` counts each exactly. Every page of a host is read here. A task hands its
    counts on part by part; of a part with ``PART_PAGES`` of a host it leaves out the words on less than ``support`` of
    these. A word is listed if it may stand on enough pages: those it was counted on, and ``support`` of the pages of the
    parts that left it out.
    """
    hosts = pages.groupBy(F.col("host").alias("of_host")).agg(F.count(F.lit(1)).alias("all"))
    hosts = settle(hosts.where(F.col("all") >= WORD_PAGES))
    if hosts.limit(HOSTS + 1).count() <= HOSTS:
        hosts = F.broadcast(hosts)
    shown = pages.join(hosts, F.col("host") == F.col("of_host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], dict[str, int]] = {}
        read: dict[str, int] = defaultdict(int)

        def rows() -> pa.RecordBatch:
            part = {h: n if n >= PART_PAGES else 0 for h, n in read.items()}
            flat = [(h, None, None, 0, n) for h, n in part.items()]
            for (h, at), counts in found.items():
                flat += [(h, at, word, n, part[h]) for word, n in counts.items() if n >= support * part[h] - CLOSE]
            columns = [[row[i] for row in flat] for i in range(5)]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            names = ["of_host", "at", "word", "pages", "part"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
                here: dict[str, set[str]] = {}
                for n, text, *_ in parse(html.as_py() or "")[1]:
                    here.setdefault(n.path, set()).update(text.split())
                for path, words in here.items():
                    counts = found.setdefault((host, path_key(path)), {})
                    for word in words:
                        counts[word] = counts.get(word, 0) + 1
                read[host] += 1
            if sum(map(len, found.values())) >= HELD:
                yield rows()
                found.clear()
                read.clear()
        yield rows()

    counted = shown.select("host", "html").mapInArrow(run, "of_host string, at bigint, word string, pages bigint, part bigint")
    counted = written(counted.groupBy("of_host", "at", "word").agg(F.sum("pages").alias("pages"), F.sum("part").alias("part")), "words")
    parts = counted.where("word IS NULL").select(F.col("of_host").alias("_host"), F.col("part").alias("parts"))
    whole = hosts.join(parts, F.col("of_host") == F.col("_host"))
    counted = counted.where("word IS NOT NULL").join(whole.drop("of_host"), F.col("of_host") == F.col("_host"))
    counted = counted.where(F.col("pages") + support * (F.col("parts") - F.col("part")) >= support * F.col("all") - CLOSE)
    return counted.groupBy("of_host").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))


def _by_host(pages: DataFrame, known: DataFrame) -> DataFrame:
    """``pages`` beside the row of their host in ``known``, which names it ``of_host``, or nulls."""
    if known.limit(HOSTS + 1).count() <= HOSTS:
        known = F.broadcast(known)
    return pages.join(known, F.col("host") == F.col("of_host"), "left")


def tag_vectors(pages: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """``host, path, pages, times, vector, depth, chars, place``: occurrence vector of each token, the running text in it.

    ``chars`` counts text that is not in links and not under tags that never hold the article, ``place`` adds up the
    places of the token in its pages. The whole host has the path 0, with its number of pages; words, of which those in
    ``words`` count, have the depth -2.
    """
    if words is None:
        pages = pages.withColumn("words", F.lit(None).cast("array<struct<at: bigint, word: string>>"))
    else:
        pages = _by_host(pages, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, int], list[int]] = {}
            of_host: dict[str, dict[int, set[str]]] = {}
            for page, host, html, listed in zip(*(batch.column(i) for i in range(4))):
                host, page = host.as_py(), repr(page.as_py())
                if host not in of_host:
                    of_host[host] = by_path(listed.as_py())
                nodes, blocks = parse(html.as_py() or "")
                times, depth, chars, place = defaultdict(int), {}, defaultdict(int), defaultdict(int)
                keys: dict[str, int] = {}
                for n in nodes:
                    k = keys.setdefault(n.path, path_key(n.path)) if n.path not in keys else keys[n.path]
                    depth[k] = n.path.count(">") if n.text and n.name not in _PARTS else -1
                for i, (k, _, _) in enumerate(stream(nodes, blocks, of_host[host])):
                    times[k] += 1
                    place[k] += i
                    depth.setdefault(k, -2)
                whole = 0
                for n, text, linked, _ in blocks:
                    size = max(0, len(text) - linked) if n.text else 0
                    whole += size
                    while size and n.up is not None:
                        chars[keys[n.path]] += size
                        n = n.up
                times[0], depth[0], chars[0] = 1, 0, whole
                for k, t in times.items():
                    row = sums.setdefault((host, k), [0, 0, 0, depth[k], 0, 0])
                    row[0] += 1
                    row[1] += t
                    row[2] = (row[2] + xxhash.xxh64_intdigest(f"{page}|{t}", 1)) & _VECTOR
                    row[3] = max(row[3], depth[k])
                    row[4] += chars[k]
                    row[5] += place[k]
            names = [h for h, _ in sums]
            columns = [pa.array([k for _, k in sums], pa.int64())]
            columns += [pa.array([r[i] for r in sums.values()], pa.int64()) for i in range(6)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *columns],
                ["host", "path", "pages", "times", "vector", "depth", "chars", "place"],
            )

    schema = "host string, path bigint, pages bigint, times bigint, vector bigint, depth bigint, chars bigint, place bigint"
    return pages.select("page", "host", "html", "words").mapInArrow(run, schema).groupBy("host", "path").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.sum("vector").bitwiseAND(F.lit(_VECTOR)).alias("vector"),
        F.max("depth").alias("depth"), F.sum("chars").alias("chars"), F.sum("place").alias("place"),
    )


def templates(vectors: DataFrame, support: float = SUPPORT, cover: float = COVER, size: int = SIZE) -> DataFrame:
    """``host, main, classes``: the path of the slot that holds a host's article, null without one, and its classes.

    Tokens with one vector are one class; valid classes have ``size`` tokens and stand on most pages of the host. Among the
    tokens of valid classes that stand once on each of their pages the main one is the deepest that covers most of the
    host's text; of several at one depth the one with more text, then the smaller path. ``classes`` are those with words,
    and the one that stands once on every page: whether it is this, whether it stands once, its tokens in order, its words.
    """
    whole = vectors.where("path = 0").select("host", F.col("pages").alias("all"), F.col("chars").alias("text"))
    tokens = vectors.where("path != 0").join(whole, "host").where(F.col("pages") >= support * F.col("all"))
    slot = F.col("depth") >= 0
    is_word = (F.col("depth") == -2) & (F.col("pages") >= WORD_PAGES)
    classes = tokens.where(is_word | (F.col("depth") > -2)).groupBy("host", "pages", "times", "vector").agg(
        F.any_value("all").alias("all"), F.any_value("text").alias("text"), F.count(F.lit(1)).alias("size"),
        F.max(F.when(
            slot & (F.col("chars") >= cover * F.col("text")), F.struct("depth", "chars", (-F.col("path")).alias("back"))
        )).alias("best"),
        F.sort_array(F.collect_list(F.struct("place", "path"))).getField("path").alias("tokens"),
        F.sort_array(F.collect_list(F.when(is_word, F.col("path")))).alias("words"),
    )
    once = F.col("times") == F.col("pages")
    outer = once & (F.col("pages") == F.col("all"))
    valid = classes.where(F.col("size") >= size).withColumn("outer", outer).withColumn("once", once)
    found = valid.groupBy("host").agg(
        F.max(F.when(once & (F.col("text") > 0), F.col("best"))).alias("best"),
        F.sort_array(F.collect_list(F.when(
            outer | (F.size("words") > 0), F.struct("outer", "once", "tokens", "words")
        )), False).alias("classes"),
    )
    held = F.exists("classes", lambda c: F.size(c["words"]) > 0)
    none = F.lit(None).cast(dict(found.dtypes)["classes"])
    found = found.select("host", (-F.col("best.back")).alias("main"), F.when(held, F.col("classes")).otherwise(none).alias("classes"))
    return found.where("main IS NOT NULL OR classes IS NOT NULL")


def _rising(ranks: list[int]) -> list[int]:
    """Indices of a longest rising run of ``ranks``."""
    ends, at, before = [], [], []
    for i, r in enumerate(ranks):
        j = bisect_left(ends, r)
        before.append(at[j - 1] if j else -1)
        ends[j : j + 1], at[j : j + 1] = [r], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def template_words(tokens: list[tuple[int, int, int]], classes: list[dict]) -> set[tuple[int, int]]:
    """Block and place of a page's words that are its template's, of ``tokens`` as ``stream`` gives them.

    Of a class that stands once, the tokens count that stand in its order; one of fewer pages must also stand in one slot,
    with no token of the outermost class between its own. A class that is repeated must be, token by token, in order.
    """
    out, outer = set(), []
    for c in classes:
        rank = {k: i for i, k in enumerate(c["tokens"])}
        at = [i for i, (k, _, _) in enumerate(tokens) if k in rank]
        seen = [rank[tokens[i][0]] for i in at]
        if c["once"]:
            at = [at[i] for i in _rising(seen)]
        elif seen != list(range(len(rank))) * (len(seen) // len(rank)):
            continue
        if c["outer"]:
            outer = at
        elif c["once"] and at and bisect_left(outer, at[0]) != bisect_left(outer, at[-1]):
            continue
        words = set(c["words"])
        out.update(tokens[i][1:] for i in at if tokens[i][0] in words)
    return out


def _article_around(node: Node) -> Node:
    """The article tag that the slot stands in, where there is one: its heading may stand outside the slot."""
    at = node
    while at is not None and at.name != "article":
        at = at.up
    return at if at is not None and at.text else node


def page_text(
    html: str, main: int | None, classes: list[dict] | None = None, words: dict[int, set[str]] | None = None
) -> str:
    """The blocks of one page in its main slot; where it has none, in its article or main tag, or in the whole page.

    ``words`` are those of its host by path, among them the words of ``classes``.
    Words of the template are left out, unless a page has no others: its text is then what its copies share.
    """
    nodes, blocks = parse(html)
    gone = set()
    if classes:
        gone = template_words(stream(nodes, blocks, words or {}), classes)
    wanted = [n for n in nodes if main is not None and n.text and path_key(n.path) == main]
    wanted = [_article_around(n) for n in wanted]
    if not wanted:
        for name in ("article", "main"):
            wanted = wanted or [n for n in nodes if n.name == name and n.text]
    keep, out, rest = set(map(id, wanted)), [], []
    for b, (n, text, _, _) in enumerate(blocks):
        if not n.text:
            continue
        up = n
        while up is not None and id(up) not in keep:
            up = up.up
        if up is not None or not wanted:
            out.append(text)
            if gone:
                rest.append(" ".join(word for i, word in enumerate(text.split()) if (b, i) not in gone))
    return "\n".join(filter(None, rest)) or "\n".join(out)


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", support: float = SUPPORT,
    cover: float = COVER,
) -> DataFrame:
    """``page_id, url, text`` per row of ``pages``, in which blocks are joined by a line break.

    Null and empty pages have an empty text. Pages without a url, or with one that names no host, share one host; a
    host with a single page has what stands on it once as its template. Rows with the same id are pages of their own, a
    null id or url stays null. Unclosed tags end where their parent does, an unclosed comment or script with the page. Other
    columns, whatever their names, are not read. An empty table gives no rows.
    """
    wanted = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _host(F.col(url_col)).alias("host")
    )
    words = settle(repeated_words(wanted, support))
    known = settle(templates(settle(tag_vectors(wanted, words)), support, cover)).withColumnRenamed("host", "of_host")
    known = known.join(words, "of_host", "left")
    placed = _by_host(wanted, known).select("page", "url", "html", "host", "main", "classes", "words")
    kind = dict(placed.dtypes)["page"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_host, texts = {}, []
            for html, host, main, classes, words in zip(*(batch.column(c) for c in ("html", "host", "main", "classes", "words"))):
                if host.as_py() not in of_host:
                    of_host[host.as_py()] = classes.as_py(), by_path(words.as_py())
                texts.append(page_text(html.as_py() or "", main.as_py(), *of_host[host.as_py()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return placed.mapInArrow(run, f"page_id {kind}, url string, text string")
