"""Main text of web pages: flat text blocks judged by a decision tree over their own and their neighbours' features.

Python only cuts a page into flat blocks (one pass over its tags).  Features, the tree and the joining
are column expressions, so no row leaves its page and nothing is shuffled.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import barrier, small_batches

# Element names of HTML and the class, id and role words that name parts of a page.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary
table tbody td tfoot th thead tr ul""".split())
SPACE_TAGS = frozenset("br wbr img input".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: content up to the end tag is no text and holds no tags
RAW_TAGS = frozenset("script style title textarea xmp".split())
#: content is dropped, but may hold tags
DROPPED_TAGS = frozenset("head noscript template svg iframe object canvas audio video select button datalist".split())
SIDE_TAGS = frozenset("nav footer aside dialog menu form".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu".split())
SIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion
nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice popup
modal overlay subscribe subscription newsletter signup login share sharing social related recommended comment comments
disqus reply replies respond pagination pager toolbar copyright disclaimer""".split())
#: these name a side part only without a word of MAIN_WORDS beside them (article-header holds the title)
WEAK_WORDS = frozenset("header banner widget search legal top bottom".split())
MAIN_WORDS = frozenset("article post entry content main story text body title".split())
NEGATIONS = frozenset("has no not with without".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in RAW_TAGS}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: where a block lies: in a side part, nowhere special, in the article
SIDE, PLAIN, MAIN = -1, 0, 1
BLOCK_TYPE = pa.list_(pa.struct([("text", pa.string()), ("words", pa.int64()), ("link_words", pa.int64()),
                                 ("region", pa.int64()), ("heading", pa.int64())]))


def _region(tag: str, attrs: str, region: int) -> int:
    """Region of an element inside ``region``; ``main`` and ``article`` leave what they contain in the article
    unless they lie in a side part.  Of elements inside a line of text only hidden ones are side parts."""
    if attrs:
        words: list[str] = []
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(
                    r"display\s*:\s*none", value):
                return SIDE
            if tag not in BLOCK_TAGS:
                continue
            if name == "role" and value.lower() in SIDE_ROLES:
                return SIDE
            if name == "role" and value.lower() in ("main", "article"):
                return MAIN if region != SIDE or value.lower() == "main" else SIDE
            if name in ("class", "id"):
                words += [w.lower() for w in _NAME.findall(value)]
        if tag not in ("html", "body", "main"):
            named = {w for i, w in enumerate(words) if not (i and words[i - 1] in NEGATIONS)}
            if named & SIDE_WORDS or named & WEAK_WORDS and not named & MAIN_WORDS:
                return SIDE
            if named & MAIN_WORDS and region == PLAIN and tag in ("div", "section", "td"):
                return MAIN
    if tag == "main":
        return MAIN
    if tag in SIDE_TAGS or tag == "header" and region != MAIN:
        return SIDE
    return MAIN if tag == "article" and region != SIDE else region


def flat_blocks(page: str) -> list[dict]:
    """Text blocks of a page in order: ``text, words, link_words, region, heading``.

    A block ends where a block-level element or a part of another region starts or ends.  White space is one
    space, character references are decoded, markup, comments, scripts and styles are gone.  Unclosed
    elements end with the element around them, end tags without a start are ignored.
    """
    out: list[dict] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # element, region and dropping outside it
    opened: Counter = Counter()
    region, dropping, in_link, link_words, heading = PLAIN, False, False, 0, 0

    def flush():
        nonlocal text, link_words
        if text:
            words = "".join(text).split()
            if words:
                out.append({"text": " ".join(words), "words": len(words), "link_words": min(link_words, len(words)),
                            "region": region, "heading": heading})
            text, link_words = [], 0

    def say(raw: str):
        nonlocal link_words
        if raw and not dropping:
            raw = _html.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if in_link:
                link_words += len(raw.split())

    def close(upto: int):
        nonlocal region, dropping
        while len(stack) > upto:
            name, region, dropping = stack.pop()
            opened[name] -= 1

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            # an unfinished tag at the end of a cut page is no text
            say(re.sub(r"<[a-zA-Z/!][^<>]*\Z", "", page[at:]))
            break
        say(page[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        end, tag, attrs = bool(m.group(1)), m.group(2).lower(), m.group(3)
        if tag in RAW_TAGS:
            if not end:
                stop = _RAW_END[tag].search(page, at)
                at = stop.end() if stop else n
            continue
        if tag == "a":
            in_link = not end
        block = tag in BLOCK_TAGS
        if tag in SPACE_TAGS and not dropping:
            text.append(" ")
        if end:
            if block:
                flush()
            if opened[tag] > 0:
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                if stack[i][1] != region:
                    flush()
                close(i)
            if block:
                heading = 0
            continue
        if block:
            flush()
            if stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th")):
                close(len(stack) - 1)
            heading = int(len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())
        inside = _region(tag, attrs, region)
        if tag not in VOID_TAGS and (block or inside != region or tag in DROPPED_TAGS):
            if block and inside != region:
                flush()
            stack.append((tag, region, dropping))
            opened[tag] += 1
            # what is hidden within a line is dropped and does not end its block
            dropping = dropping or tag in DROPPED_TAGS or not block and inside != region
            region = inside if block else region
    flush()
    return out


# The small labelled table: one page a line, its blocks in order as region, words, words in links and label.
# Regions: s side part, p nowhere special, a article, h heading nowhere special, t heading in the article.
# Label 1: main text.  Hand-made for this module: portal, blog, news, forum and table layouts.
LABELLED = """
s4/4:0 s3/3:0 t3/0:1 a15/0:1 a3/0:1 a40/6:1 a9/0:1 s30/1:0 s62/0:0 s45/3:0 s8/1:0
p3/0:0 s6/6:0 t12/0:1 a80/0:1 a8/8:0 a11/11:0 a7/7:0 a55/3:1 s40/0:0 p12/2:0
p1/1:0 p1/1:0 p2/2:0 p3/3:0 h8/0:1 p60/0:1 p45/2:1 p5/0:1 p90/4:1 p33/0:1 p2/2:0 p3/3:0 p6/3:0
p2/2:0 p3/3:0 h5/0:1 p24/0:1 p3/0:1 p38/1:1 p4/0:1 p70/0:1 p4/4:0 p3/3:0 p5/2:0 p7/0:0
p4/4:0 p6/6:0 p5/5:0 h4/4:0 p9/9:0 p7/7:0 p8/8:0 p3/3:0 p4/2:0
p2/0:0 p3/2:0 p1/1:0 h9/0:1 p31/0:1 p52/0:1 p14/0:1 p47/5:1 p3/3:0 p2/2:0 p4/4:0 p3/0:0
s20/0:0 p5/5:0 p2/2:0 h6/0:1 p140/3:1 p75/0:1 p6/0:1 p82/2:1 s12/12:0 s33/0:0 p2/2:0
s1/1:0 a500/0:1 a3/0:1 a12/12:0 a9/9:0 a14/14:0 a300/20:1 s2/1:0 s70/0:0 s110/0:0
p26/0:0 s3/3:0 t6/0:1 a28/0:1 a33/2:1 p20/0:0 p41/5:0 p30/0:0 s9/2:0
p18/0:0 s2/2:0 a20/0:1 a4/0:1 a6/1:1 t4/0:1 a90/3:1 p15/1:0 p80/2:0
p300/0:1 p200/0:1
p12/0:1
h3/0:1 p25/0:1
p20/1:1 p35/0:1 p2/0:1 p28/0:1
t5/0:1 a40/10:1 a30/8:1 a12/4:1 a60/20:1 a2/0:1
t2/0:1 a50/0:1 a3/0:1
s3/3:0 t2/0:1 a1/0:1
a2/0:1
t1/0:1
a30/12:1 a45/9:1 a7/7:0 a6/6:0 a8/8:0 a9/9:0 s4/4:0
t4/1:1 a80/20:1 a25/10:1 a5/2:1 s9/9:0
s2/2:0 t6/6:1 a50/2:1 a70/15:1 a33/0:1
s5/5:0 t7/7:1 a90/30:1 a4/1:1 a18/6:1
t9/0:1 a35/0:1 a10/10:0 a12/12:0
t2/0:1 a30/0:1 a1/0:1 s5/5:0 s4/4:0
a18/0:1 a2/0:1 s1/1:0 s1/1:0
s1/1:0 s6/6:0 t1/0:1 a2/0:1 s3/3:0
a20/0:1 a10/10:0 a2/0:1
s3/3:0 a1/0:1
t3/0:1 a2/0:1 s4/4:0
s5/1:0 s1/1:0 s1/1:0 s12/0:0 s1/1:0 s8/0:0 t4/0:1 a30/0:1 s40/0:0 s1/1:0 s6/6:0
a25/0:1 a1/1:1 a40/0:1 s15/2:0 s1/1:0 s30/0:0 s1/1:0 s2/2:0
"""
FEATURES = ("words", "link_density", "prev_words", "prev_density", "next_words", "next_density", "region", "outside",
            "heading")


def features(blocks: str = "blocks") -> Callable[[Column, Column], dict[str, Column]]:
    """Features of block ``b`` at position ``i`` of the array column: its own, its neighbours' (0 beyond the
    ends) and where it lies (``outside``: not in the article of a page that has one)."""
    density = lambda b: b["link_words"] / F.greatest(b["words"], F.lit(1))
    has_article = F.exists(blocks, lambda b: b["region"] == MAIN)

    def of(b: Column, i: Column) -> dict[str, Column]:
        before, after = F.get(blocks, i - 1), F.get(blocks, i + 1)
        near = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
        return {"words": near(b["words"]), "link_density": near(density(b)),
                "prev_words": near(before["words"]), "prev_density": near(density(before)),
                "next_words": near(after["words"]), "next_density": near(density(after)),
                "region": near(b["region"]), "outside": near((has_article & (b["region"] != MAIN)).cast("int")),
                "heading": near(b["heading"])}

    return of


def labelled_blocks(spark: SparkSession) -> DataFrame:
    """The small labelled table with its features, a row per block."""
    lie = {"s": (SIDE, 0), "p": (PLAIN, 0), "a": (MAIN, 0), "h": (PLAIN, 1), "t": (MAIN, 1)}
    pages = []
    for line in LABELLED.strip().splitlines():
        blocks = []
        for where, words, links, label in re.findall(r"(\w)(\d+)/(\d+):(\d)", line):
            blocks.append((int(words), int(links), *lie[where], float(label)))
        pages.append((blocks,))
    df = spark.createDataFrame(
        pages, "blocks array<struct<words:long,link_words:long,region:long,heading:long,label:double>>").coalesce(1)
    of = features()
    rows = F.transform("blocks", lambda b, i: F.struct(*[v.alias(k) for k, v in of(b, i).items()], b["label"].alias("label")))
    return df.select(F.explode(rows).alias("r")).select("r.*")


def train_tree(labelled: DataFrame, depth: int = 6) -> str:
    """Fit the decision tree on the labelled table; the rules as Spark prints them."""
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(labelled)
    return DecisionTreeClassifier(maxDepth=depth, maxBins=256, minInstancesPerNode=3, seed=7).fit(data).toDebugString


def tree_expression(rules: str, values: dict[str, Column]) -> Column:
    """The printed rules as one nested condition: true for main text."""
    lines = [ln.strip() for ln in rules.splitlines() if re.match(r"\s*(If|Else|Predict)", ln)]

    def node(i: int) -> tuple[Column, int]:
        if lines[i].startswith("Predict"):
            return F.lit(float(lines[i].split(":")[1]) > 0.5), i + 1
        number, bound = re.search(r"feature (\d+) <= ([-\d.Ee]+)", lines[i]).groups()
        low, i = node(i + 1)
        high, i = node(i + 1)  # lines[i] is the Else of the same feature
        return F.when(values[FEATURES[int(number)]] <= float(bound), low).otherwise(high), i

    return node(0)[0]


def page_blocks(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` and ``blocks``: the flat text blocks of every page, whole, in page order."""
    small_batches(pages.sparkSession, 256)
    narrow = pages.select(*keep, F.coalesce(F.col(html), F.lit("")).alias("__html"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([flat_blocks(x) for x in batch.column(len(keep)).to_pylist()], BLOCK_TYPE)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], made], [*keep, "blocks"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(cut, f"{fields}, blocks array<struct<text:string,words:long,link_words:long,"
                                  "region:long,heading:long>>")


def extract_text(pages: DataFrame, rules: str | None = None, html: str = "html",
                 keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: ``keep`` columns, ``text`` (main blocks joined by line feeds) and ``n_chars``.

    ``rules`` are those of ``train_tree``; without them the tree is fitted on the table of this module.
    Null, empty and text-free pages give an empty text; repeated pages are rows of their own; nulls in
    ``keep`` stay; other columns are not read, whatever their names; an empty table gives no rows; long
    pages are read whole, a page at a time.
    """
    if rules is None:
        rules = train_tree(labelled_blocks(pages.sparkSession))
    of = features()
    blocks = page_blocks(pages, html, keep)
    kept = F.filter("blocks", lambda b, i: tree_expression(rules, of(b, i)))
    made = barrier(blocks, text=F.array_join(F.transform(kept, lambda b: b["text"]), "\n"))
    return made.select(*keep, "text", F.length("text").cast("long").alias("n_chars"))
