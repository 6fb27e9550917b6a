"""Main text of web pages by consensus of a host's pages.

First every page's containers are scored by the text of their own blocks, and the generalised path of tags and classes
of the best one, or of the article around it, is a vote. Votes are counted per host in Spark and the winning path is
extracted from all pages of the host; a page that lacks it falls back to its own best container. Containers that stand
before the winning one in the same parent, as a title's and a lead's may, are voted on as well: what most pages of the
host have there, with texts that differ from page to page, belongs to the article, and what repeats is the site's frame.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import table, written

# Fixed values of HTML: elements without content, without readable text, and those that break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
HIDDEN = frozenset("script style template noscript iframe svg math object canvas audio video head title textarea select option button form input label fieldset nav aside footer menu dialog noembed noframes xmp".split())
BLOCK = frozenset("address article blockquote body center dd details dir div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside footer".split())
CONTAINER = frozenset("article main section div td body".split())
#: Elements that an opening tag of the same set ends, as an HTML parser does for a missing end tag.
ENDS_P = BLOCK - {"li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Words of a class, id or role that mark what is not the article.
BOILERPLATE = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notification overlay pagination paywall popup promo promoted promotion recommended related replies reply respond rail share sharing sidebar sidenav signup site-header skip social sponsor sponsored subscribe subscription teaser toolbar toc topbar widget widgets complementary contentinfo search dialog alert".split())
#: Those of them that name what others wrote or what other pages say: an article in them is such an item, and they may hold
#: more text than the article.
SERIES = frozenset("ad ads adv advert adverts advertisement advertising comment comments commentlist disqus promo promoted promotion recommended related replies reply respond sponsor sponsored teaser".split())
# Words that name a box behind one of those words and leave its meaning, as in ad-slot or share-tools.
NEUTRAL = frozenset("area article articles author bar block body bottom box button buttons center col column container content count desktop div entry facebook fb feed first footer form global google group head header holder icon icons inner item items js large left link links list main medium message meta mobile outer panel placeholder policy post posts primary region right row secondary section site slot small stories story strip text thread title tool tools top trail twitter unit wp wrap wrapper zone".split())
#: Words before one of those words that turn it into what a page has or hasn't.
ABOUT = frozenset("has have hide hides is no non not show shows with without".split())
_INVISIBLE = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

#: Fixed value: how deep browsers nest elements; what stands deeper is put beside its neighbours.
DEPTH = 512
_START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z]|/)")
_NAME = r"<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)"
#: A tag by HTML's rules: a quote counts only at the start of a value, and only if it is closed; elsewhere it is a character.
_TAG = re.compile(_NAME + r"""((?:[ \t\n\f\r/]++|[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^ \t\n\f\r>]++|(?=["'>])))?+)*+)>""")
#: A tag that ends at the first >, quoted or not.
_SHORT_TAG = re.compile(_NAME + r"([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^ \t\n\f\r/=]+)(?:[ \t\n\f\r]*=[ \t\n\f\r]*(?:"([^"]*)"|'([^']*)'|([^ \t\n\f\r]*)))?""")
_ASKED = frozenset("class id role hidden aria-hidden style".split())
_SPLIT = re.compile(r"[^a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
#: What a script's end depends on: <!-- with a <script in it takes the next </script> for its own, until -->.
_SCRIPT_TOKEN = re.compile(r"<!--|-->|<script(?=[\s/>])|" + _RAW_END["script"].pattern, re.I)


class _Block:
    """One text block: its text, the part in links, and the containers that it lies in."""

    __slots__ = ("parts", "linked", "path")

    def __init__(self, path: tuple[int, ...]):
        self.parts: list[str] = []
        self.linked = 0
        self.path = path

    def text(self) -> str:
        return " ".join(html_lib.unescape("".join(self.parts)).split())


def _tags(page: str):
    """A function that gives the next tag from a place on: start, end, slash, name, attributes; name None: a comment; None: no more.

    A tag that isn't closed by the page's end ends at its first >, and so do all after it, so that no page is read more
    than a few times. Without a > it is text, as is what follows.
    """
    last, short = page.rfind(">") + 1, False

    def after(at: int):
        nonlocal short
        m = _START.search(page, at)
        if not m:
            return None
        start = m.start()
        if m[0] == "<!--":
            end = page.find("-->", start + 2)  # its own dashes may be those of -->
            return start, len(page) if end < 0 else end + 3, "", None, ""
        if start >= last:
            return None
        if m[0][-1] in "!?/":  # a doctype and the like
            return start, page.index(">", start) + 1, "", None, ""
        tag = None if short else _TAG.match(page, start, last)
        if not tag:
            short, tag = True, _SHORT_TAG.match(page, start, last)
        return start, tag.end(), tag[1], tag[2].lower(), tag[3]

    return after


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where the raw text of an element that opened before `at` is over, its end tag included; else the page's end."""
    if tag != "script":
        m = _RAW_END[tag].search(page, at)
        return m.end() if m else len(page)
    comment = inner = False
    while m := _SCRIPT_TOKEN.search(page, at):
        at = m.end()
        if m[0] == "<!--":
            comment, at = True, at - 2  # its dashes may be those of -->
        elif m[0] == "-->":
            comment = inner = False
        elif m[0][1] != "/":
            inner = comment
        elif inner:
            inner = False
        else:
            return at
    return len(page)


def blocks_of(page: str) -> tuple[list[_Block], dict[int, str]]:
    """The page's text blocks in order, and the generalised path of each container by its number.

    An element marked as boilerplate by its class, id or role is shown after all if it holds most of the page's text
    outside links; one of SERIES only if nothing else is left.
    """
    blocks, paths, marked, total, said = _parse(page, frozenset())
    most = {k: series for k, (n, series) in enumerate(marked) if 2 * n > total}
    shown = frozenset(k for k, series in most.items() if not series)
    if shown:
        blocks, paths, _, _, said = _parse(page, shown)
    if not said and len(most) > len(shown):
        blocks, paths, *_ = _parse(page, frozenset(most))
    return blocks, paths


def _parse(page: str, shown: frozenset[int]) -> tuple[list[_Block], dict[int, str], list[list[int]], int, int]:
    """Blocks and paths, and in characters outside links: what each marked element holds (with whether it is one of
    SERIES), what the page holds, and what of it is not hidden. Marked elements are numbered; those of shown don't hide.
    """
    blocks: list[_Block] = []
    paths: dict[int, str] = {}
    marked: list[list[int]] = []
    total = said = 0
    # One entry an open element: tag, whether it hides its text for good, its containers, its generalised path, the
    # marked elements that it lies in, and those of them that hide it.
    stack: list[tuple[str, bool, tuple[int, ...], str, tuple[int, ...], tuple[int, ...]]] = [("", False, (), "", (), ())]
    current: _Block | None = None
    open_ = Counter()  # open elements by tag
    following = _tags(page)
    at = links = 0

    def say(text: str) -> None:
        nonlocal current, total, said
        _, hidden, inside, _, marks, hiding = stack[-1]
        if hidden or not text:
            return
        if not links:
            n = len(text.strip())
            total += n
            for k in marks:
                marked[k][0] += n
            said += 0 if hiding else n
        if hiding:
            return
        if current is None:
            if text.isspace():
                return
            current = _Block(inside)
            blocks.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    def close(to: int) -> None:
        nonlocal links, current
        for tag, *_ in stack[to:]:
            open_[tag] -= 1
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCK:
                current = None
        del stack[to:]

    while found := following(at):
        start, end, slash, tag, attributes = found
        say(page[at:start])
        at = end
        if tag is None:
            continue
        if slash:
            if open_[tag]:
                close(max(i for i, e in enumerate(stack) if e[0] == tag))
            if tag in BLOCK:
                current = None
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCK:
            current = None
        if tag in VOID:
            continue
        if tag in ENDS_P and open_["p"]:
            close(max(i for i, e in enumerate(stack) if e[0] == "p"))
        elif tag in SIBLING and any(open_[x] for x in SIBLING[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ("ul", "ol", "dl", "table", "select"):
                    break
                if stack[i][0] in SIBLING[tag]:
                    close(i)
                    break
        if len(stack) > DEPTH:
            close(len(stack) - 1)
        _, hidden, inside, path, marks, hiding = stack[-1]
        kind, classes = _marks(attributes)
        path = "" if tag == "html" else f"{path}>{tag}{classes}"
        main = tag in ("body", "html", "main") or (tag == "article" and kind != 2)
        hidden = hidden or tag in HIDDEN or (not main and kind is None) or (tag == "header" and not (open_["article"] or open_["main"]))
        if kind and not main:
            marks = (*marks, len(marked))
            hiding = hiding if len(marked) in shown else (*hiding, len(marked))
            marked.append([0, kind == 2])
        elif hiding and tag in ("article", "main"):  # an article is none of the sidebar that a wrapper is called after
            hiding = tuple(k for k in hiding if marked[k][1] and tag == "article")
        if tag in CONTAINER and not hidden and not hiding:
            paths[len(paths)] = path
            inside = (*inside, len(paths) - 1)
        stack.append((tag, hidden, inside, path, marks, hiding))
        open_[tag] += 1
        links += tag == "a"
        if attributes.endswith("/") and tag not in BLOCK:
            close(len(stack) - 1)
        elif tag in RAW:  # only its own end tag counts
            at = _raw_end(page, tag, at)
            close(len(stack) - 1)
    say(page[at:])
    return blocks, paths, marked, total, said


@lru_cache(20_000)
def _kind(name: str) -> int:
    """What a whole class, id or role says: 0 nothing, 1 boilerplate, 2 boilerplate of SERIES.

    The last word that isn't NEUTRAL is what the name names (a story-ad is an ad, search-engines are engines), unless a word
    of ABOUT stands before it. Single letters and digits don't count.
    """
    if name in BOILERPLATE:
        return 2 if name in SERIES else 1
    parts = [w for w in _SPLIT.split(name) if len(w) > 1]
    while parts and parts[-1] in NEUTRAL and parts[-1] not in BOILERPLATE:
        parts.pop()
    if not parts or parts[-1] not in BOILERPLATE or (len(parts) > 1 and parts[-2] in ABOUT):
        return 0
    return 2 if SERIES.intersection(parts) else 1


def _marks(attributes: str) -> tuple[int | None, str]:
    """The greatest _kind of class, id and role (None: hidden), and the generalised classes for the path: digits become one #, as does >."""
    if "=" not in attributes and "hidden" not in attributes.lower():
        return 0, ""
    kind = 0
    classes: list[str] = []
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name not in _ASKED:
            continue
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _INVISIBLE.search(value)):
            return None, ""
        if name == "class":
            classes += sorted({re.sub(r"[>]|\d+", "#", c) for c in value.split()})
        if name not in ("aria-hidden", "style"):
            kind = max(kind, *map(_kind, value.split()), 0)
    return kind, "".join(f".{c}" for c in classes)


def best_path(blocks: list[_Block], paths: dict[int, str]) -> tuple[str, float] | None:
    """Path and score of the container whose own blocks hold most text outside links, widened to the article around it.

    A block counts whole for its nearest container and half for the next, so that a wrapper wins only if the text is
    spread over several containers. Of equal scores the outer container wins. The score stays that of the winner.
    """
    score: dict[int, float] = {}
    for b in blocks:
        for far, c in enumerate(reversed(b.path[-2:])):
            score[c] = score.get(c, 0.0) + _worth(b) / (1 + far)
    if not score:
        return None
    best = min(score, key=lambda c: (-score[c], c))
    return (paths[_article_of(best, blocks, paths)], score[best]) if score[best] > 0 else None


def _worth(b: _Block) -> int:
    return max(0, sum(map(len, b.parts)) - 2 * b.linked)


def _article_of(best: int, blocks: list[_Block], paths: dict[int, str]) -> int:
    """The nearest article or main that the container is or lies in.

    Without one, the nearest container around it with blocks that stand directly in it, as a title and a lead do, and
    aren't mostly links. What stands in other containers beside the best one is taken for the frame of the site.
    """
    chain = next(b.path for b in blocks if best in b.path)
    around = chain[: chain.index(best) + 1][::-1]
    for c in around:
        if paths[c].rpartition(">")[2].partition(".")[0] in ("article", "main"):
            return c
    direct = {b.path[-1] for b in blocks if b.path and _worth(b)}
    return next((c for c in around[1:] if c in direct), best)


def _beside(chosen: set[int], blocks: list[_Block]) -> dict[int, list[_Block]]:
    """Containers that stand before a chosen one in the same parent, with their blocks."""
    parents = {}
    for b in blocks:
        for k, c in enumerate(b.path):
            if c in chosen:
                parents[b.path[k - 1] if k else None] = max(c, parents.get(b.path[k - 1] if k else None, c))
    out: dict[int, list[_Block]] = {}
    for b in blocks:
        if chosen.isdisjoint(b.path):
            for k, c in enumerate(b.path):
                if c < parents.get(b.path[k - 1] if k else None, -1):
                    out.setdefault(c, []).append(b)
    return out


def vote(page: str) -> tuple[str, float, dict[str, str]] | None:
    """A page's vote: path and score of its article, and the text of each container before it in the same parent, by path.

    Such containers count only for an article that no element of that name encloses, and if they aren't mostly links.
    """
    blocks, paths = blocks_of(page)
    best = best_path(blocks, paths)
    if not best:
        return None
    if best[0].rpartition(">")[2].partition(".")[0] in ("article", "main"):
        return *best, {}
    chosen = {c for c, p in paths.items() if p == best[0]}
    found = {paths[c]: "\n".join(b.text() for b in own) for c, own in _beside(chosen, blocks).items() if sum(map(_worth, own)) > 0}
    return *best, found


def extract(page: str, path: str | None, beside: list[str] | None = None) -> str:
    """Text of the containers with that path; without any, of the page's best container; else of the whole page.

    beside: paths of containers that belong to the article where they stand before one with `path` in the same parent.
    """
    blocks, paths = blocks_of(page)
    chosen = {c for c, p in paths.items() if p == path}
    if chosen and beside:
        chosen |= {c for c in _beside(chosen, blocks) if paths[c] in beside}
    if not chosen and (own := best_path(blocks, paths)):
        chosen = {c for c, p in paths.items() if p == own[0]}
    texts = (b.text() for b in blocks if not chosen or not chosen.isdisjoint(b.path))
    return "\n".join(t for t in texts if t)


def host_of(url: Column) -> Column:
    """Host of a URL in lower case without port; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, beside: the path with most votes of each host's pages; of equal ones the highest summed score, then by name.

    beside: paths of containers before it that at least half of its voters have, two or more, with mostly different texts.
    Votes are summed before the shuffle, so a host with a third of all pages is a few rows a task; texts go by their hash.
    Pages without a container with text don't vote.
    """
    names = ["host", "path", "before", "said", "votes", "score"]

    def votes(batches):
        for b in batches:
            out: dict[tuple[str, str], list[float]] = {}
            before = []
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                if page and (best := vote(page)):
                    v = out.setdefault((host, best[0]), [0, 0.0])
                    v[0] += 1
                    v[1] += best[1]
                    before += [(host, best[0], path, xxhash.xxh3_64_intdigest(text) - (1 << 63), 1, 0.0) for path, text in best[2].items()]
            rows = [(*k, None, None, int(v[0]), float(v[1])) for k, v in out.items()] + before
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    counted = written(pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(votes, "host string, path string, before string, said long, votes long, score double"))
    total = counted.where("before is null").groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.round(F.sum("score"), 3).alias("score"))
    best = total.groupBy("host").agg(F.max_by(F.struct("path", "votes"), F.struct("votes", "score", "path")).alias("b")).select("host", "b.*")
    found = counted.where("before is not null").groupBy("host", "path", "before").agg(F.sum("votes").alias("pages"), F.approx_count_distinct("said").alias("texts"))
    found = found.where("pages > 1 and 2 * texts > pages").join(best, ["host", "path"]).where("2 * pages >= votes")
    beside = found.groupBy("host").agg(F.sort_array(F.collect_list("before")).alias("beside"))  # each on half of the voters
    return best.drop("votes").join(beside, "host", "left")


def main_text(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of pages with the article's text: blocks joined by line ends; null html gives an empty text.

    The winning paths are a written table, a row a host: Spark broadcasts it below its threshold and otherwise shuffles
    both sides, where it can split a large host. A kept column called `text` gives way.
    """
    keep = [k for k in keep if k != "text"]
    best = written(host_paths(pages)).select(F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("beside").alias("__beside"))
    rows = pages.select(*dict.fromkeys(["html", *keep]), host_of(F.col("url")).alias("__of")).join(best, F.col("__of") == F.col("__host"), "left")
    schema = StructType([*pages.select(*keep).schema, StructField("text", StringType())])

    def texts(batches):
        for b in batches:
            got = [extract(p, path, beside) if p else "" for p, path, beside in zip(b.column("html").to_pylist(), b.column("__path").to_pylist(), b.column("__beside").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(got, pa.string())], [*keep, "text"])

    return rows.select(*dict.fromkeys(["html", *keep]), "__path", "__beside").mapInArrow(texts, schema)


def op4_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    out = main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
