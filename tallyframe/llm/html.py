"""Main text of web pages by equivalence-class template deduction over pages of one host."""

from __future__ import annotations

import html as entities
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyframe.llm.common import grouped, without
from tallyframe.session import small_table

#: Pages and bytes of one template; a host with more is cut into blocks that deduce theirs separately.
BLOCK_PAGES, BLOCK_BYTES = 256, 8 << 20
#: Hosts of more than one block that are broadcast; more are joined by shuffle, with the same rows.
LARGE_HOSTS = 100_000
#: Pages of more copies than this are extracted once and joined to their rows; at most so many pages, those of most copies.
COPIES, COPIED_PAGES = 64, 10_000
#: Rows of one page in a part of that join, and text that one batch gives back, in bytes.
COPY_ROWS, OUT_BYTES = 1_000, 4 << 20
#: Distinct pages from which on a template is deduced, and tokens a class needs.
LEAST_PAGES, LEAST_TOKENS = 3, 3

# Element names of the HTML standard and names in common use for parts that are not the main text.
RAW = "script style noscript template textarea title iframe".split()
RAW_IF_CLOSED = "svg object select button canvas".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
INLINE = "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var label math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover".split()
OTHER_PARTS = "nav footer aside form dialog menu head".split()
OTHER_NAMES = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar widget footer header masthead comment comments respond "
    "disqus replies related recommended share sharing social newsletter subscribe subscription login signup search pagination pager toolbar skip"
).split()
OTHER_ROLES = "navigation banner contentinfo complementary search alert dialog menu menubar".split()
MAIN = "article main".split()
#: First words of names such as ``comment-list`` that name another part inside articles too.
PREFIXES = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr breadcrumb breadcrumbs comment comments "
    "respond disqus replies related recommended share sharing social newsletter subscribe subscription pagination pager"
).split()
#: Beginnings of names that tell a state of the page and name no part of it.
FLAGS = ("no-", "not-", "without-", "has-", "with-", "is-")

_TOKEN = regex.compile(
    rf"(?si)<!--.*?(?:-->|$)|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|$)"
    rf"|<(?P<closed>{'|'.join(RAW_IF_CLOSED)})(?=[\s/>])[^>]*(?<!/)>(?:(?!<(?P=closed)[\s/>]).)*?</(?P=closed)\s*>"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>|</[^>]*>|[^<]+|<"
)
_ATTR = regex.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = regex.compile(r"[a-z]+")
_P_ENDS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
_SAME_ENDS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}


@dataclass
class Piece:
    """A block of text: its place among the page's tokens and what surrounds it."""

    at: int
    text: str
    other: bool  # inside a part that is not main text
    main: bool  # inside an article or main element


class Paths:
    """Numbers of element paths: equal for equal names and attributes below equal paths, on all pages that share the object."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}

    def under(self, path: int, element: str) -> int:
        return self.known.setdefault((path, element), len(self.known) + 1)


def _names(attrs: str) -> tuple[str, bool, bool, bool]:
    """A short form of class and id, and whether a word of them, the first word of a name, or a whole name stands for a part that is not
    main text."""
    short, loose, first, whole = [], False, False, False
    for kind, *values in _ATTR.findall(attrs):
        kind = kind.lower()
        if kind not in ("class", "id", "role"):
            continue
        value = next((v for v in values if v), "").lower()
        short.append(kind[0] + "=" + "-".join(_WORD.findall(value)))
        listed = OTHER_ROLES if kind == "role" else OTHER_NAMES
        for name in value.split():
            words = _WORD.findall(name)
            whole = whole or name in listed
            if kind != "role" and not name.startswith(FLAGS):
                loose = loose or any(w in listed for w in words)
                first = first or (len(words) > 1 and words[0] in PREFIXES and name.startswith(words[0]))
    return "".join(f"[{s}]" for s in sorted(short)), loose, first, whole


class _Named:
    """Elements whose names stand for other parts: each with the next such element around it, and how sure its name is."""

    WORD, SURE = 0, 1

    def __init__(self):
        self.around: list[int] = []
        self.sure: list[int] = []

    def add(self, around: int, sure: int) -> int:
        self.around.append(around)
        self.sure.append(sure)
        return len(self.around) - 1

    def up(self, elements: Iterable[int]) -> set[int]:
        """The elements and all around them; -1 is none."""
        found: set[int] = set()
        for e in elements:
            while e >= 0 and e not in found:
                found.add(e)
                e = self.around[e]
        return found

    def free(self, spared: set[int]) -> list[bool]:
        """For each element, whether it and all around it are spared; one more for none at all."""
        free = [False] * len(self.around) + [True]
        for e, a in enumerate(self.around):
            free[e] = e in spared and free[a]
        return free


def _spared(named: _Named, pieces: list[Piece], inner: list[int], outer: list[int]) -> set[int]:
    """Named elements that are no other parts after all, as else the page would lose its text.

    ``inner`` and ``outer``: the innermost named element around each piece, and the one around its innermost article. Where articles hold text, elements
    around them are other parts only for a sure name and if text is left elsewhere in articles. Where none does, names of which only some
    word is listed give way if they would take more text than they leave, and all names if nothing is left and the page shows no article.
    """
    own = [(p, i, o) for p, i, o in zip(pieces, inner, outer) if p.main and not p.other]
    if own:
        spared = {e for e in named.up(o for _, _, o in own) if named.sure[e] == _Named.WORD}
        for more in ([o for _, _, o in own], [i for _, i, _ in own]):
            free = named.free(spared)
            if not any(free[i] for _, i, _ in own):
                spared |= named.up(more)
        return spared
    rest = [(p, i) for p, i in zip(pieces, inner) if not p.other]
    free, sure = named.free(set()), named.free({e for e, s in enumerate(named.sure) if s == _Named.WORD})
    left, loose = sum(len(p.text) for p, i in rest if free[i]), sum(len(p.text) for p, i in rest if sure[i] and not free[i])
    if loose > left:
        return {e for e, s in enumerate(named.sure) if s == _Named.WORD}
    return set() if left or any(p.main for p in pieces) else named.up(i for _, i in rest)


def parse(page: str | None, paths: Paths | None = None) -> tuple[list[int], list[Piece]]:
    """Tokens of the page (each block-level tag as the number of its path, so that a tag has a role; its end is negative) and its blocks of text.

    Inline tags are no tokens and join the text around them; ``br`` and block-level tags end a block. Ends left out by the author
    are filled in as browsers do for paragraphs, list items and table cells; unknown ends are skipped. Memory grows with the page, however
    deep its elements lie in each other.

    An element outside articles is another part if a word of its class, id or role is on the list; inside them the whole name must be, or the
    first word of a name such as ``comment-list``. Article and main elements themselves are never. Names never leave a page without text, see
    :func:`_spared`.
    """
    paths = paths or Paths()
    tokens: list[int] = []
    pieces: list[Piece] = []
    inner: list[int] = []
    outer: list[int] = []
    named = _Named()
    # name, path, in another part by its tag, innermost named element, the one around the innermost article, in main
    stack: list[tuple[str, int, bool, int, int, bool]] = [("", 0, False, -1, -1, False)]
    open_: Counter[str] = Counter()
    held: list[str] = []

    def flush():
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                _, _, other, element, beyond, main = stack[-1]
                inner.append(element)
                outer.append(beyond)
                pieces.append(Piece(len(tokens), text, other, main))

    def pop():
        name, path, *_ = stack.pop()
        open_[name] -= 1
        tokens.append(-path)

    for m in _TOKEN.finditer(page or ""):
        name = m["name"]
        if name is None:
            part = m.group()
            if part[0] != "<" or part == "<":
                held.append(part)
            continue
        name = name.lower()
        if name in INLINE:
            continue
        flush()
        if name in VOID:
            continue
        if m["close"]:
            if open_[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in _P_ENDS:
            while stack[-1][0] == "p":
                pop()
        elif name in _SAME_ENDS:
            alike = ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
            if any(open_[a] for a in alike):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in _SAME_ENDS[name] or stack[k][0] in MAIN:
                        break
                    if stack[k][0] in alike:
                        while len(stack) > k:
                            pop()
                        break
        elif name == "body":
            while open_["head"]:
                pop()
        _, path, other, element, beyond, main = stack[-1]
        short, by_word, by_first, by_name = _names(m["attrs"])
        if name in MAIN:
            beyond = element
        elif name not in ("html", "body"):
            sure = by_name or by_first
            if (sure and not (by_name and name == "header")) if main else (by_word or sure):
                element = named.add(element, _Named.SURE if sure else _Named.WORD)
        part = name in OTHER_PARTS or (name == "header" and not main)
        path = paths.under(path, name + short)
        stack.append((name, path, other or part, element, beyond, main or name in MAIN))
        open_[name] += 1
        tokens.append(path)
    flush()
    free = named.free(_spared(named, pieces, inner, outer))
    for p, element in zip(pieces, inner):
        p.other = p.other or not free[element]
    return tokens, pieces


def _classes(pages: list[list]) -> list[list]:
    """Valid equivalence classes: tokens with one occurrence vector over the pages, on most pages, in one order.

    A class is valid if on every page its tokens come as repetitions of the same sequence.
    """
    vectors: dict = {}
    for i, tokens in enumerate(pages):
        for token, n in Counter(tokens).items():
            vectors.setdefault(token, np.zeros(len(pages), np.int32))[i] = n
    alike: dict[bytes, list] = {}
    for token, vector in vectors.items():
        if 2 * np.count_nonzero(vector) > len(pages):
            alike.setdefault(vector.tobytes(), []).append(token)
    valid = []
    for members in alike.values():
        if len(members) < LEAST_TOKENS:
            continue
        wanted, order = set(members), None
        for tokens in pages:
            own = [t for t in tokens if t in wanted]
            order = own[: len(members)] if order is None and own else order
            if own and (len(set(order)) != len(members) or own != order * (len(own) // len(members))):
                break
        else:
            valid.append(order)
    return valid


def _nested(pages: list[list], classes: list[list]) -> list[list]:
    """The template: the largest class that occurs once on its pages, and the classes that lie in one of its slots each.

    A class that spreads over several slots of those already taken is left out.
    """
    taken: list[list] = []
    for members in sorted(classes, key=lambda c: (-sum(c[0] in set(p) for p in pages), -len(c))):
        if taken:
            inside, outer = set(members), set(taken[0])
            slots = set()
            for tokens in pages:
                last = None
                for t in tokens:
                    if t in outer:
                        last = t
                    elif t in inside:
                        slots.add(last)
            if len(slots) > 1:
                continue
        taken.append(members)
    return taken


def extract_group(htmls: list[str | None]) -> list[str]:
    """Main texts of pages of one host."""
    paths = Paths()
    parsed = {h: parse(h, paths) for h in dict.fromkeys(htmls)}
    distinct = list(parsed.values())
    template: list[list[int]] = []
    if len(distinct) >= LEAST_PAGES:
        tokens = [t for t, _ in distinct]
        template = _nested(tokens, _classes(tokens))
    fixed = {t for members in template for t in members}
    seen: Counter[tuple[int, str]] = Counter()
    pages_with = Counter(t for tokens, _ in distinct for t in fixed.intersection(tokens))
    pages_with[0] = len(distinct)  # before the first token of the template

    def slots(page: tuple[list[int], list[Piece]]) -> list[int]:
        """The slot of each block of text: the last template token before it."""
        tokens, pieces = page
        out, k, last = [], 0, 0
        for p in pieces:
            while k < p.at:
                last = tokens[k] if tokens[k] in fixed else last
                k += 1
            out.append(last)
        return out

    placed = [list(zip(slots(page), page[1])) for page in distinct]
    for page in placed:
        seen.update({(s, p.text) for s, p in page})

    def constant(s: int, text: str) -> bool:
        """Whether the text is part of the template: it stands in this slot on every page that has the slot."""
        return pages_with[s] >= LEAST_PAGES and seen[s, text] == pages_with[s]

    # Where article and main elements hold own text of most pages, the slot is content with all its text.
    own = Counter(s for page in placed for s in {s for s, p in page if p.main and not p.other and not constant(s, p.text)})
    content = {s for s, n in own.items() if 2 * n >= pages_with[s]}
    left = [[(s, p) for s, p in page if not p.other and not (constant(s, p.text) and not (p.main and s in content))] for page in placed]
    if not any(left):  # pages that differ in other parts only: nothing tells template from text
        left = [[(s, p) for s, p in page if not p.other] for page in placed]
    # Article and main elements are a hint for which slots are content. A template does not follow it where on most pages they hold
    # the lesser part of the text left (such as cards that link to other pages).
    hinted = [page for page in left if any(p.main for _, p in page)]
    agreeing = sum(2 * sum(len(p.text) for _, p in page if p.main) >= sum(len(p.text) for _, p in page) for page in hinted)
    follow = len(distinct) < LEAST_PAGES or 2 * agreeing >= len(hinted)

    def text_of(page: list[tuple[int, Piece]]) -> str:
        if follow and any(p.main for _, p in page):
            return " ".join(p.text for _, p in page if p.main)
        return " ".join(p.text for _, p in page)

    texts = {h: text_of(page) for h, page in zip(parsed, left)}
    return [texts[h] for h in htmls]


def host_of(url) -> F.Column:
    """Host of a URL in lower case; null or odd URLs give ""."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _bare_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by host, block and page, with the html of a page on its first row only, so that copies hold no memory."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        fresh = np.ones(batch.num_rows, bool)
        fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in keys])
        fresh[0] = last != tuple(c[0] for c in keys)
        last = tuple(c[-1] for c in keys)
        html_ = batch.column(4)
        if not fresh.all():
            html_ = pc.if_else(pa.array(fresh), html_, pa.scalar(None, html_.type))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], html_], names=batch.schema.names)


def extract(df: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add ``text string``, the main text of each page; a column named ``text`` is replaced. ``keep`` names the columns to pass
    through (default: all).

    Pages of a host, in blocks of bounded size that a hash of the page deals out, give a template: classes of tags with equal
    occurrence vectors, valid and nested. Text that stands in a slot on every page with that slot (three at least) is part of the
    template, unless no page of the block has other text, or it lies in an article or main element and the slot holds text of
    their own on at least half of the pages with it. On pages with text left in article or main elements
    the main text is that, unless on most such pages of the block the elements hold less than half of the text left; on
    others it is all text left, of whatever length. Blocks of text inside
    menus, page headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles are left out. Character references are decoded,
    white space inside a block becomes one space, blocks are joined by one space in page order.

    Null or empty pages give an empty text. A host with fewer than three distinct pages has no template; its pages are all
    slots. Copies of a page count once in a template and in the number of blocks, and all get its text; pages of many copies are
    extracted once and joined to their rows. A null url is a host of its own. No rows give no rows.
    """
    kept = without(df if keep is None else df.select(*keep), ["text"])
    html_ = F.coalesce(df[html], F.lit(""))
    rows = df.select(
        host_of(df[url]).alias("__host"), F.unhex(F.sha2(html_, 256)).alias("__page"), F.struct(*[df[c] for c in kept]).alias("__row"), html_.alias("__html")
    )
    # One count serves both lists: hosts of more than one block, by distinct pages, and pages of many copies.
    pages = rows.groupBy("__host", "__page").agg(F.count("*").alias("n"), F.max(F.octet_length("__html")).cast("long").alias("bytes"))
    # However large the pages are, blocks hold so many on average that a block of too few for a template is all but impossible.
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_PAGES), F.least(F.ceil(F.sum("bytes") / BLOCK_BYTES), F.floor(F.count("*") / (8 * LEAST_PAGES))))
    large = pages.groupBy("__host").agg(blocks.alias("blocks"), F.sum("n").alias("n")).where("blocks > 1").select("__host", F.lit(None).cast("binary").alias("__page"), "blocks", "n")
    copied = pages.where(F.col("n") > COPIES).orderBy(F.desc("n"), "__host", "__page").limit(COPIED_PAGES)
    copied = copied.select("__host", "__page", F.ceil(F.col("n") / COPY_ROWS).alias("blocks"), "n")
    found = large.limit(LARGE_HOSTS + 1).union(copied).collect()
    hosts, copies = [r for r in found if r["__page"] is None], [r for r in found if r["__page"] is not None]
    large = large.select("__host", "blocks")
    if len(hosts) <= LARGE_HOSTS:  # counted just now, so the broadcast is bounded and pages are shuffled once only
        large = F.broadcast(small_table(df.sparkSession, [(r["__host"], r["blocks"]) for r in hosts], large.schema))
    own = StructType([rows.schema["__row"], *StructType.fromDDL("text string")])

    def dealt(some: DataFrame) -> DataFrame:
        number = F.conv(F.substring(F.hex("__page"), 1, 15), 16, 10).cast("long")
        return some.join(large, "__host", "left").select(
            "__host", F.coalesce(F.pmod(number, F.col("blocks")), F.lit(0)).cast("int").alias("__block"), "__page", "__row", "__html"
        )

    def extracted(placed: DataFrame, schema: StructType, beside: tuple[int, ...], of_rows: bool) -> DataFrame:
        """Texts of the rows (or of the pages without a row), beside columns ``beside``."""
        arrow = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for columns in grouped(_bare_copies(batches), 2):
                page_of = np.cumsum(columns[4].is_valid().to_numpy(zero_copy_only=False)) - 1
                texts = extract_group(columns[4].drop_null().to_pylist())
                wanted = np.flatnonzero(columns[3].is_valid().to_numpy(zero_copy_only=False) == of_rows)
                sizes = np.cumsum([len(texts[page_of[i]]) for i in wanted], dtype=np.int64) // OUT_BYTES
                for part in np.split(wanted, np.flatnonzero(np.diff(sizes)) + 1):
                    if len(part):
                        kept_ = [columns[i].take(pa.array(part)).cast(arrow.field(n).type) for n, i in enumerate(beside)]
                        yield pa.RecordBatch.from_arrays([*kept_, pa.array([texts[page_of[i]] for i in part], pa.string())], schema=arrow)

        return placed.repartition("__host", "__block").sortWithinPartitions("__host", "__block", "__page").mapInArrow(run, schema)

    if not copies:
        return extracted(dealt(rows), own, (3,), True).select("__row.*", "text")
    names = StructType(rows.schema.fields[:2])
    keys = ["__host", "__page"]
    copied = F.broadcast(small_table(df.sparkSession, [(r["__host"], r["__page"], r["blocks"]) for r in copies], StructType([*names, *StructType.fromDDL("parts long")])))
    once = rows.join(copied, keys, "left_semi").groupBy(*keys).agg(F.first("__html").alias("__html"))
    once = once.select(*keys, F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), "__html")
    placed = dealt(rows.join(copied, keys, "left_anti").unionByName(once))
    single = extracted(placed, own, (3,), True)
    # The blocks that hold copied pages are read once more for the texts of these.
    theirs = F.broadcast(dealt(copied.select(*keys, F.lit(None).alias("__row"), F.lit(None).alias("__html"))).select("__host", "__block").distinct())
    texts = extracted(placed.join(theirs, ["__host", "__block"], "left_semi"), StructType([*names, *StructType.fromDDL("text string")]), (0, 2), False)
    texts = texts.join(copied, keys).withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    spread = rows.drop("__html").join(copied, keys).withColumn("__part", F.pmod(F.xxhash64("__row"), F.col("parts"))).drop("parts")
    many = spread.hint("merge").join(texts, [*keys, "__part"]).select("__row", "text")
    return single.unionByName(many).select("__row.*", "text")
