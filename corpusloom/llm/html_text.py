"""Main text of web pages: flat text blocks, judged by a decision tree.

A page is cut into blocks at block-level tags. Each block has its number of words, its
link density, the same for its neighbours, and what the markup around it says (inside
an article; inside a menu, footer, form, advert, comment list and so on). A decision
tree trained on a small table of labelled pages decides which blocks are main text.
Scripts, styles, comments and page heads never become text. What stands in a script,
style, title, textarea or iframe is not markup: only its own end tag is looked for. Names
(class, id, role) count on every element that holds text: paragraphs, list items and rows
too, and an element inside a line that is named as advert, notice, comment or the like is
left out of the line. Cutting
a page is a small helper that Spark maps over Arrow batches; features, tree and joining are
expressions.

Defined results: null or empty html gives an empty text; a page cut off inside a tag
loses that tag only; an unclosed element reaches to the end of what holds it, an element
that never holds text and has no end tag in the rest of the page to the next block, and an
unclosed script or style to the end of the page; repeated rows are judged one by one. Only page_id, url and html are read, so other columns cannot
clash.
"""

import re
from collections import Counter
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.labelled_pages import PAGES

# Elements that end a block, that never hold text, that frame a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot "
    "thead tr ul".split()
)
SILENT_TAGS = frozenset(
    "script style noscript template title textarea select button svg iframe object canvas head math audio video".split()
)
# Silent elements whose content is not markup, the two of them that swallow the
# rest of a page, elements without content, what may stand in a head, and where blocks may
# stand in a drawing or formula.
RAW_TAGS = frozenset("script style title textarea iframe".split())
CODE_TAGS = frozenset("script style".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_TAGS = SILENT_TAGS | frozenset("base basefont bgsound html link meta noframes".split())
FOREIGN_TAGS = frozenset("svg math".split())
INNER_TAGS = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
FRAME_TAGS = frozenset("nav aside footer form menu dialog fieldset".split())
# Class, id and role names, or the last words of them.
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notification pagination popup promo promoted related replies reply respond share sharing sidebar signup social "
    "sponsor sponsored subscribe tags toolbar widget".split()
)
# Words after which a name still says the same, words that turn it into a
# state of the page, frames that hold articles of their own, elements that are never frame
# because of a name, and those whose names say nothing.
PART_WORDS = frozenset(
    "area bar block body box button buttons container form group icon icons inner item items link links list menu "
    "panel posts slot text toggle widget widgets wrap wrapper".split()
)
STATE_WORDS = frozenset("has hidden hide is no non not show with without".split())
FIRM_TAGS = frozenset("nav aside footer menu dialog".split())
FIRM_WORDS = frozenset(
    "comment comments promo promoted related replies reply respond sponsor sponsored".split()
)
# Names by which an element inside a line is no part of its text; elements
# that end when a like one begins, what they end, and what holds them.
INLINE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner comment comments consent cookie cookies gdpr newsletter "
    "notice promo promoted share sharing social sponsor sponsored subscribe".split()
)
LOOSE_TAGS = {
    "p": ({"p"}, set()),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
}
MAIN_TAGS = frozenset("article main".split())
PAGE_TAGS = frozenset("html body".split())
CONTENT_WORDS = frozenset("article content entry main post story text".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_SIZE = re.compile(r"[0-9][0-9a-z]*")
_WORD = re.compile(r"[a-z]+")

BLOCK = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("words", T.IntegerType()),
        T.StructField("linked", T.IntegerType()),
        T.StructField("article", T.IntegerType()),
        T.StructField("frame", T.IntegerType()),
        T.StructField("heading", T.IntegerType()),
    ]
)


@lru_cache(512)
def end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE)


def frame_word(words: list[str]) -> str:
    """The word by which a name marks page frame: the last one, without words for parts."""
    if STATE_WORDS.intersection(words):
        return ""
    for at in range(len(words) - 1, -1, -1):
        if words[at] in FRAME_WORDS:
            named_part = at < len(words) - 1
            return "" if named_part and CONTENT_WORDS.intersection(words[:at]) else words[at]
        if words[at] not in PART_WORDS:
            break
    return ""


def hints(tag: str, attributes: str) -> tuple[set[str], bool]:
    """What marks an element as page frame (its tag, words of its names), and whether it looks like main content."""
    marks = {tag} & FRAME_TAGS
    content = tag in MAIN_TAGS
    if tag in PAGE_TAGS or "=" not in attributes:
        return marks, content and not marks
    for found in _NAMES.finditer(attributes):
        for name in "".join(g or "" for g in found.groups()).lower().split():
            words = _WORD.findall(_SIZE.sub("", name))
            if mark := frame_word(words):
                marks.add(mark)
            elif not FRAME_WORDS.intersection(words):
                content |= bool(CONTENT_WORDS.intersection(words))
    return marks, content and (not marks or tag in MAIN_TAGS)


def framed(tag: str, marks: set[str], in_article: bool, in_frame: int) -> int:
    """0 if an element stands outside of any page frame, 1 in one that an article ends, 2 in a firm one."""
    if tag in MAIN_TAGS:
        # Comments and teasers are often articles too, and say so; so are those inside an article.
        firm = in_frame == 2 or (in_frame and (in_article or marks & FIRM_WORDS))
        return 2 if firm else 0
    # A header belongs to the article it stands in, and to the page otherwise.
    marks = marks - {"header"} if in_article else marks | ({tag} & {"header"})
    if not marks:
        return in_frame
    return max(in_frame, 2 if marks & (FIRM_TAGS | FIRM_WORDS) else 1)


class Silence:
    """An open element that never holds text, and the elements open inside it."""

    def __init__(self, tag: str, loose: bool):
        self.tag, self.loose = tag, loose
        self.inner = [tag]
        self.counts = Counter(self.inner)

    def ends(self, tag: str, ending: str, attributes: str, outside: Counter) -> bool:
        """Take in a tag; whether the element ends at it."""
        breaks = tag in BLOCK_TAGS or tag in ("td", "th")
        if ending:
            if not self.counts[tag]:
                # The end of something that holds the element.
                return outside[tag] > 0 or (self.loose and breaks)
            while self.inner:
                last = self.inner.pop()
                self.counts[last] -= 1
                if last == tag:
                    break
            return not self.inner
        if self.tag == "head":
            if len(self.inner) == 1 and tag not in HEAD_TAGS or tag == "body":
                return True
        elif breaks and tag not in ("hr", "legend"):
            if self.loose or self.tag == "select":
                return True
            if self.tag in FOREIGN_TAGS and not any(self.counts[t] for t in INNER_TAGS):
                return True
        if tag == self.tag and tag in ("button", "select"):
            self.inner.clear()
            self.counts.clear()
        if tag not in VOID_TAGS and not attributes.rstrip().endswith("/"):
            self.inner.append(tag)
            self.counts[tag] += 1
        return False


def blocks(html: str) -> list[tuple]:
    """(text, words, linked words, in article, in frame, heading) of each block in order."""
    out: list[tuple] = []
    pieces: list[str] = []
    # Open block elements as (tag, in article, in frame).
    opened: list[tuple[str, bool, int]] = [("", False, 0)]
    standing: Counter = Counter()
    linked = 0
    heading = link = False
    silent: Silence | None = None
    # Elements open outside of silent ones, and where the last end tag of a silent kind is.
    outside: Counter = Counter()
    last_ends: dict[str, int] = {}

    def add(raw: str):
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if link:
                linked += len(text.split())

    def close():
        nonlocal linked
        words = "".join(pieces).split()
        pieces.clear()
        if words:
            _, article, frame = opened[-1]
            out.append((" ".join(words), len(words), min(linked, len(words)), int(article), int(frame > 0), int(heading)))
        linked = 0

    def drop(place: int):
        for tag, _, _ in opened[place:]:
            standing[tag] -= 1
        del opened[place:]

    def drop_like(tag: str):
        """End what ends where this block element begins: an open paragraph, and an element
        of the same list, table row or entry that has no end tag."""
        if opened[-1][0] == "p":
            drop(len(opened) - 1)
        like, holders = LOOSE_TAGS.get(tag, (set(), set()))
        if any(standing[t] > 0 for t in like):
            for place in range(len(opened) - 1, 0, -1):
                if opened[place][0] in like:
                    drop(place)
                    break
                if opened[place][0] in holders:
                    break

    def closed(tag: str) -> bool:
        """Whether an end tag of this kind follows."""
        if tag not in last_ends:
            last_ends[tag] = max((m.start() for m in end_of(tag).finditer(html)), default=-1)
        return last_ends[tag] >= at

    at = 0
    while found := _TAG.search(html, at):
        if not silent:
            add(html[at : found.start()])
        at = found.end()
        ending, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW_TAGS and not ending and not attributes.rstrip().endswith("/"):
            if closed(tag):
                at = end_of(tag).search(html, at).end()
                continue
            if tag in CODE_TAGS:
                at = len(html)
                break
        if silent:
            if not silent.ends(tag, ending, attributes, outside):
                continue
            silent = None
        if tag in SILENT_TAGS and not ending:
            if tag in BLOCK_TAGS:
                close()
            if not attributes.rstrip().endswith("/"):
                silent = Silence(tag, not closed(tag))
            continue
        inline = not ending and tag not in BLOCK_TAGS and tag not in VOID_TAGS and "=" in attributes
        if inline and INLINE_WORDS.intersection(hints(tag, attributes)[0]):
            # An advert, notice or comment inside a line: its text is left out.
            pieces.append(" ")
            silent = Silence(tag, not closed(tag))
            continue
        if ending:
            outside[tag] -= outside[tag] > 0
        elif tag not in VOID_TAGS:
            outside[tag] += 1
        if tag == "a":
            link = not ending
        elif tag in ("br", "td", "th", "wbr"):
            pieces.append(" ")
        elif tag in BLOCK_TAGS:
            close()
            link = False
            heading = not ending and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            if ending:
                if standing[tag] > 0:
                    drop(next(i for i in range(len(opened) - 1, 0, -1) if opened[i][0] == tag))
            elif tag != "hr":
                drop_like(tag)
                marks, content = hints(tag, attributes)
                _, in_article, in_frame = opened[-1]
                content &= tag not in LOOSE_TAGS
                opened.append((tag, in_article or content, framed(tag, marks, in_article, in_frame)))
                standing[tag] += 1
    if not silent:
        add(html[at:])
    close()
    return out


def cut(pages: DataFrame) -> DataFrame:
    """page_id, url and the blocks of every page."""
    kind = pa.list_(
        pa.struct([(f.name, pa.string() if f.name == "text" else pa.int32()) for f in BLOCK.fields])
    )
    names = BLOCK.fieldNames()

    def cut_up(batches):
        for batch in batches:
            found = [[dict(zip(names, b, strict=True)) for b in blocks(x.as_py() or "")] for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, kind)], ["page_id", "url", "blocks"]
            )

    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    schema = T.StructType([*source.schema.fields[:2], T.StructField("blocks", T.ArrayType(BLOCK))])
    return source.mapInArrow(cut_up, schema)


def features(found: Column, block: Column, at: Column, any_article: Column) -> list[Column]:
    """Numbers that the tree decides on, of a block and its neighbours; `any_article`
    tells of the whole page whether a block of it is in an article."""

    def density(b):
        return F.coalesce(b["linked"] / b["words"], F.lit(0.0))

    before, after = F.get(found, at - 1), F.get(found, at + 1)
    near = [F.coalesce(b["words"], F.lit(0)).cast("double") for b in (block, before, after)]
    flags = [block[k].cast("double") for k in ("article", "frame", "heading")]
    return [*near, density(block), density(before), density(after), *flags, any_article]


def with_article(found: DataFrame) -> DataFrame:
    """Cut pages with `any_article`, worked out once for each page."""
    return found.withColumn("any_article", F.exists("blocks", lambda b: b["article"] == 1).cast("double"))


def labelled(spark) -> DataFrame:
    """Blocks of the labelled pages, with features and a label."""
    rows = [(n, "", html, main) for n, (html, main) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, main array<string>")
    found = with_article(cut(pages)).join(pages.select("page_id", "main"), "page_id")
    own = found.select(
        "main",
        F.explode(
            F.transform("blocks", lambda b, i: F.struct(b["text"].alias("text"), F.array(*features(F.col("blocks"), b, i, F.col("any_article"))).alias("x")))
        ).alias("b"),
    )
    return own.select(
        array_to_vector("b.x").alias("features"), F.array_contains("main", F.col("b.text")).cast("double").alias("label")
    )


def trained(spark, depth: int = 6):
    """The root node of a decision tree for main text."""
    learner = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, maxBins=64, seed=1)
    return learner.fit(labelled(spark).coalesce(1))._call_java("rootNode")


def decision(node, x: list[Column]) -> Column:
    """The tree below a node as an expression over the features."""
    if "LeafNode" in node.getClass().getName():
        return F.lit(node.prediction() == 1.0)
    split = node.split()
    below = x[split.featureIndex()] <= split.threshold()
    return F.when(below, decision(node.leftChild(), x)).otherwise(decision(node.rightChild(), x))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of `pages`."""
    root = trained(pages.sparkSession)
    found = with_article(cut(pages))
    kept = F.filter("blocks", lambda b, i: decision(root, features(F.col("blocks"), b, i, F.col("any_article"))))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    joined = found.select("page_id", "url", text.alias("text"))
    return joined.withColumn("n_chars", F.length("text").cast("long"))
