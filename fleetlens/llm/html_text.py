"""Main text of web pages by consensus host paths.

Each page's containers are scored by the text they hold; a container is known by a hash of its path of tags and classes,
with digits and item numbers generalised. Spark adds up the scores per host, so the path that wins is the one the host's
pages agree on, and every page is read again with the winning path (or, where it lacks it, with its own best container).
An article may lie in several containers (a lead beside the body, a second part): containers of the winner's level whose
own text is more than links and isn't the same on all of a host's pages go along with it.

Elements whose class or id speaks of menus, adverts or comments are not dropped outright: they are one level deeper than
what is around them, and text votes for containers of its own level only. The outermost level wins unless it holds little
beside a deeper one, so a wrapper called has-sidebar keeps its article, and a long list of comments does not beat one.
"""

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import cut, slices

#: Elements without content, elements whose text is no text, and elements that are no part of an article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math xmp noframes noembed".split())
ASIDE = set("nav footer aside button select dialog menu object audio video canvas map head datalist".split())
#: Those of them that stand within a line, and elements of forms, which may hold a whole page.
INLINE = set("button select object audio video canvas map datalist".split())
FORMS = {"form", "fieldset"}
BLOCK = set("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Words that together name an article's own head, and class and id words of what is no part of an article.
HEADS = set("header head heading".split())
ARTICLE = set("post entry article story content page".split())
UNWANTED = set("ad ads advert adverts advertisement banner sponsor sponsored promo promotion comment comments disqus respond reply replies sidebar aside widget menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer foot bottom cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login share sharing social related recommended recommendations pagination pager toolbar skip tags".split())
#: Roles that are no part of an article.
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: p ends at the start of these; li, dt, dd, option, tr, td and th end at their own kind.
ENDS_P = BLOCK - {"html", "body", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"} | {"form", "nav", "aside", "footer", "menu"}
HOLDS_P = {"div", "td", "th", "table", "button", "article", "section", "main", "li"}
OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HOLDS_OWN = {"ul", "ol", "dl", "table", "select"}
#: Blocks that are no containers of an article.
INNER = set("p h1 h2 h3 h4 h5 h6 li ul ol blockquote pre table tbody tr td th dl dt dd figure figcaption header".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
#: A title or header inside an article belongs to it.
_HOLDERS = {"article", "main"}
#: A level's best container stands for the page if it has this share of the best score of any level.
ENOUGH = 0.2
#: Where a container stands on one page only, nothing shows that it is the same everywhere; its own text must be so long.
PROSE = 80


class Node:
    """An open element: the hash of its path, its level (unwanted elements around it), whether it is out of the article for
    sure, in a link, in a first heading; up is the element around it, box the nearest container, holder the nearest article
    or main element."""

    __slots__ = ("box", "h1", "holder", "inside", "level", "link", "name", "path", "skip", "tag", "up")

    def __init__(self, tag: str, name: str, up: "Node | None", skip: bool, soft: bool):
        self.tag, self.name, self.up, self.skip, self.inside = tag, name + "!" * soft, up, skip, False
        self.path = xxhash.xxh64_intdigest(self.name, up.path) if up else 0
        self.level = up.level + soft if up else 0
        self.link = bool(up and up.link) or tag == "a"
        self.h1 = bool(up and up.h1) or tag == "h1"
        self.holder = self if tag in _HOLDERS else up.holder if up else None
        self.box = self if up is None or tag in BLOCK and tag not in INNER else up.box


def generalised(tag: str, attrs: dict[str, str]) -> str:
    """tag.class.class without digits, so that post-17 and post-18 are one."""
    names = sorted({_DIGITS.sub("", x.lower()) for x in attrs.get("class", "").split()} - {""})
    return ".".join([tag, *names])


def own_head(attrs: dict[str, str]) -> bool:
    """Whether a class says that this is an article's head, such as post-header; then it holds no word that is unwanted otherwise."""
    for name in attrs.get("class", "").lower().split():
        words = set(_WORD.findall(name))
        if words & HEADS and words & ARTICLE - {"page"}:
            return not words & UNWANTED - HEADS
    return False


def out_for_sure(tag: str, attrs: dict[str, str], inside: bool, in_p: bool) -> bool:
    if tag in ASIDE or tag == "label" and not in_p or tag == "header" and not inside and not own_head(attrs) or "hidden" in attrs:
        return True
    return attrs.get("role", "").lower() in ROLES or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()


def unwanted(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element is a form's, or its class or id has a word of what is no part of an article."""
    if tag in ("html", "body", "article", "main"):
        return False
    if tag in FORMS:
        return True
    if own_head(attrs):
        return False
    return any(not UNWANTED.isdisjoint(_WORD.findall(attrs.get(k, "").lower())) for k in ("class", "id"))


def parts(tag: str) -> bool:
    """Whether an element begins and ends a block of text."""
    return tag in BLOCK or tag in FORMS or tag in ASIDE and tag not in INLINE


def parse(page: str) -> list[tuple[str, Node, int]]:
    """Texts of a page in order, each with its element and block number, without markup and what is out for sure. Takes
    time in proportion to the page, however deep its elements are."""
    stack, open_ = [Node("", "", None, False, False)], {}
    events, at, block, n = [], 0, 0, len(page)

    def text(raw: str) -> None:
        if raw and not stack[-1].skip:
            events.append((entities.unescape(raw) if "&" in raw else raw, stack[-1], block))

    def close(k: int) -> None:
        for x in stack[k:]:
            open_[x.tag] -= 1
        del stack[k:]

    def ends(kinds: set[str], holders: set[str]) -> None:
        if not any(open_.get(t) for t in kinds):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in kinds:
                close(k)
                return
            if stack[k].tag in holders:
                return

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            text(m["cdata"])
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if tag == "p" and not open_.get("p"):
                block += 1
            if open_.get(tag):
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
            if parts(tag):
                block += 1
            continue
        attrs = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(m["attrs"])} if m["attrs"].strip(" /") else {}
        if tag in ENDS_P:
            ends({"p"}, HOLDS_P)
        if tag in OWN_KIND:
            ends(OWN_KIND[tag], HOLDS_OWN)
        if parts(tag):
            block += 1
        if tag in VOID:
            if tag == "br":
                text(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        inside = any(open_.get(t) for t in _HOLDERS)
        skip = stack[-1].skip or out_for_sure(tag, attrs, inside, bool(open_.get("p")))
        stack.append(Node(tag, generalised(tag, attrs), stack[-1], skip, unwanted(tag, attrs)))
        open_[tag] = open_.get(tag, 0) + 1
    return events


def containers(events) -> dict[tuple[int, int], tuple[int, int, int]]:
    """By (level, path) of a container what it holds directly: a score, which is its letters, those of links against them,
    three times as much within article and main elements; the letters alone; and a hash of the words."""
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, node, _ in events:
        words = text.strip()
        if words and node.box.level == node.level:
            key, size = (node.level, node.box.path), -len(words) if node.link else len(words)
            score, own, known = out.get(key, (0, 0, 0))
            out[key] = score + size * (3 if node.holder else 1), own + size, xxhash.xxh64_intdigest(words, known)
    return out


def best_of(scores: dict[tuple[int, int], tuple[int, int, int]]) -> tuple[int, int] | None:
    """The outermost level whose best container holds enough, and that container; the smallest path among equals. None if
    no container holds more than links."""
    best: dict[int, tuple[int, int]] = {}
    for (level, path), (score, *_) in scores.items():
        if score > 0:
            best[level] = min(best.get(level, (-score, path)), (-score, path))
    if not best:
        return None
    top = max(-s for s, _ in best.values())
    level = min(k for k, (s, _) in best.items() if -s >= ENOUGH * top)
    return level, best[level][1]


def below(events, path: int) -> None:
    """Sets inside on the elements with that path and all below them."""
    known: set[int] = set()
    for _, node, _ in events:
        chain = []
        while node is not None and id(node) not in known:
            chain.append(node)
            node = node.up
        inside = bool(node and node.inside)
        for x in reversed(chain):
            inside = inside or x.path == path
            x.inside = inside
            known.add(id(x))


def main_text(events, winner: tuple[int, int] | None, head: int | None = None, along: frozenset[int] = frozenset()) -> str:
    """The blocks below a container or in the article or main element around it, and those directly in containers of the
    paths `along`, in page order, white space squeezed, one line each, without what is unwanted there. If there is no
    first heading, that of the path `head` before it comes first. Without a winner, all of the outermost level."""
    if winner is not None:
        level, path = winner
        below(events, path)
        around = {id(e[1].holder) for e in events if e[1].inside and e[1].level == level and e[1].holder}
        own = [e for e in events if e[1].level == level and (e[1].inside or id(e[1].holder) in around or e[1].box.level == level and e[1].box.path in along)]
        if head is not None and own and not any(e[1].h1 for e in own):
            first = own[0][2]
            own = [e for e in events if e[1].h1 and e[2] <= first and _heading(e[1]) == head and not e[1].inside] + own
    else:
        outer = min((e[1].level for e in events), default=0)
        own = [e for e in events if e[1].level == outer]
    lines, now, last = [], [], None
    for text, _, block in own:
        if block != last and now:
            lines.append(" ".join("".join(now).split()))
            now = []
        now.append(text)
        last = block
    lines.append(" ".join("".join(now).split()))
    return "\n".join(x for x in lines if x)


def _heading(node: Node) -> int:
    """The path of the h1 around an element."""
    while node.tag != "h1":
        node = node.up
    return node.path


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def headings(events) -> dict[int, str]:
    """By path the text of wanted first headings."""
    out: dict[int, str] = {}
    for text, node, _ in events:
        if node.h1 and not node.level and not node.link:
            path = _heading(node)
            out[path] = out.get(path, "") + text
    return out


_VOTES = "host string, level int, path long, score long, pages long, own long, w0 long, w1 long"


def _votes(batches):
    """Scores of containers with their own letters, and first headings (level -1); w0 and w1 are the least and the largest
    hash of the words, which are one where all pages have the same."""
    names, kinds = ["host", "level", "path", "score", "pages", "own", "w0", "w1"], [pa.string(), pa.int32(), *[pa.int64()] * 6]
    for batch in batches:
        total: dict[tuple, list] = {}

        def add(key: tuple, score: int, own: int, words: int) -> None:
            entry = total.setdefault(key, [0, 0, 0, words, words])  # noqa: B023
            entry[:] = entry[0] + score, entry[1] + 1, entry[2] + own, min(entry[3], words), max(entry[4], words)

        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            events = parse(page.as_py() or "")
            for key, (score, size, words) in containers(events).items():
                if size > 0:
                    add((host, *key), score, size, signed(words))
            for path, words in headings(events).items():
                if words.strip():
                    add((host, -1, path), 0, 0, signed(xxhash.xxh64_intdigest(" ".join(words.split()))))
        rows = [(h, level, signed(path), *v) for (h, level, path), v in total.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _extract(batches):
    for batch in slices(batches, 256):
        texts, used, sets = [], [], {}
        for page, level, path, head, paths in zip(batch.column(2), *(batch.column(k).to_pylist() for k in (3, 4, 5, 6)), strict=True):
            events = parse(page.as_py() or "")
            scores = containers(events)
            winner = None if level is None else (level, path % (1 << 64))
            if winner in scores:
                key = tuple(paths or ())
                along = sets[key] = sets.get(key) or frozenset(p % (1 << 64) for p in key)
            else:
                winner = best_of(scores)
                along = frozenset(p for (k, p), (_, size, _) in scores.items() if winner and k == winner[0] and size >= PROSE)
            texts.append(main_text(events, winner, None if head is None else head % (1 << 64), along))
            used.append(None if winner is None else f"{winner[1]:016x}")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(used, pa.string())], ["page_id", "url", "text", "path"])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))


#: Winning paths are broadcast up to so many bytes; beyond, they are joined in slices of each host's pages.
BROADCAST_BYTES, SLICES = 16 << 20, 32


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, level, path, head, along): of each host the outermost level whose best container has enough of the score of
    all levels' best, the path with that level's largest sum of scores (the smallest among equals), the path of the first
    heading on most pages that isn't the same on all of them, and the paths of that level's other containers with text of
    their own that differs between pages, or that stands on one page and is long."""
    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_votes, _VOTES)
    sums = [F.sum(c).alias(c) for c in ("score", "pages", "own")]
    summed = cut(votes.groupBy("host", "level", "path").agg(*sums, F.min("w0").alias("w0"), F.max("w1").alias("w1")))
    levels = summed.where("level >= 0 and score > 0").groupBy("host", "level").agg(F.min_by("path", F.struct(-F.col("score"), "path")).alias("path"), F.max("score").alias("score"))
    enough = levels.withColumn("top", F.max("score").over(Window.partitionBy("host"))).where(F.col("score") >= ENOUGH * F.col("top"))  # a row per level
    bodies = enough.groupBy("host").agg(F.min("level").alias("level"), F.min_by("path", "level").alias("path"))
    differ = F.expr("w0 <> w1 or pages = 1")
    heads = summed.where(differ & F.expr("level = -1")).groupBy("host").agg(F.min_by("path", F.struct(-F.col("pages"), "path")).alias("head"))
    others = summed.where(differ & F.expr(f"level >= 0 and own > 0 and (pages > 1 or own >= {PROSE})")).groupBy("host", "level").agg(F.sort_array(F.collect_list("path")).alias("along"))  # generalised paths of one host
    return bodies.join(heads, "host", "left").join(others, ["host", "level"], "left").select("host", "level", "path", "head", "along")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and path (a hash of the path of the container read; null on a page without text).

    A null or empty page gives an empty text; a page without a host votes with others of that kind; repeated rows give
    equal rows; null ids stay; a page of any length and depth is read whole; an empty table gives no rows; other columns
    are not read; ties are settled by the smaller path. Pages are never shuffled when the winners are few enough to
    broadcast.
    """
    winners = cut(winning_paths(pages))
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    if (winners.agg(F.sum(F.length("host") + 64 + 8 * F.coalesce(F.size("along"), F.lit(0)))).first()[0] or 0) <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(winners), "host", "left")
    else:
        sliced = winners.select("*", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
        joined = rows.withColumn("slice", F.pmod(F.xxhash64("page_id", "url"), F.lit(SLICES)).cast("int")).join(sliced, ["host", "slice"], "left")
    return joined.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "level", "path", "head", "along").mapInArrow(_extract, "page_id long, url string, text string, path string")


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")
