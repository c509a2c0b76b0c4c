"""Questions and links from a table of web pages.

Python is used for one thing only: to cut the text blocks and their option texts out of the HTML.
Which blocks are questions, of what type and category, and which pages to follow is decided by
Spark expressions and joins afterwards.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom import lexicons
from surveyloom.functions import options as opt
from surveyloom.functions import predicates as pred
from surveyloom.functions import rules
from surveyloom.functions.text import strip_numbering
from surveyloom.operators.firstwins import first_wins, limit_links
from surveyloom.operators.markup import Reader
from surveyloom.session import stored

BLOCKS = "page_id bigint, url string, source_name string, site string, pos int, raw_text string, raw_options array<string>"
#: Bounds of a question's length in characters, unless the caller names others.
MIN_CHARS, MAX_CHARS = 8, 500

# Elements whose text is not shown.
HIDDEN = {"script", "style", "template"}

# Block, question and option elements per layout, each as (tag, class or None).
LAYOUTS = {
    "wjx": {"block": ("div", "field"), "question": ("div", "field-label"),
            "options": [("div", {"ui-radio", "ui-checkbox"})], "select": True},
    "wenjuan": {"block": ("div", "question"), "question": ("div", "question-title"),
                "options": [("label", None)], "select": False},
    "jotform": {"block": ("li", "form-line"), "question": ("label", "form-label"),
                "options": [("label", {"form-radio-item-label", "form-checkbox-item-label"})], "select": True},
}
GENERIC_TAGS = {"div", "p", "li", "h3", "h4", "label"}
GENERIC_SKIPPED = {"nav", "header", "footer", "script", "style"}
# Entries of a list that ask to choose one.
PLACEHOLDERS = ("请选择", "Please Select")


class Outline:
    """The elements of a page in order, read in one pass with a stack of those that are open.

    An element is a number. ``after`` is the number of the first element that is not inside it; ``span`` its part of
    the texts (each stripped, those in hidden elements apart). So what lies inside an element is a range, its text is
    a range of pieces, and how long that is follows from running lengths without putting it together.
    """

    def __init__(self, page: str, skipped: set[str] = frozenset()):
        self.tags: list[str] = []
        self.classes: list[frozenset[str]] = []
        self.parents: list[int] = []
        self.after: list[int] = []
        self.level: list[int] = []  # hidden elements around it
        self.span: list[tuple[int, int]] = []
        self.pieces: list[list[str]] = [[]]
        self.lengths: list[list[int]] = [[0]]
        self.places: dict[str, list[int]] = {}
        self._open: list[int] = []
        self._names: Counter[str] = Counter()
        self._hidden = 0
        skip, within = None, Counter()  # the skipped element that is open, and what was opened inside it
        for kind, value, attributes in Reader(page):
            if skip is not None:
                if kind == "start":
                    within[value] += 1
                elif kind == "end" and within[value]:
                    within[value] -= 1
                elif kind == "end" and (value == skip or self._names[value]):
                    self._close_to(value if value != skip else None)
                    skip = None
            elif kind == "text":
                if piece := value.strip():
                    self.pieces[self._hidden].append(piece)
                    self.lengths[self._hidden].append(self.lengths[self._hidden][-1] + len(piece))
            elif kind == "end":
                self._close_to(value if self._names[value] else None)
            elif value not in skipped:
                self._add(value, attributes, kind == "start")
            elif kind == "start":
                skip, within = value, Counter()
        while self._open:
            self._close()

    def _add(self, tag: str, attributes: dict[str, str], opened: bool) -> None:
        number = len(self.tags)
        self.places.setdefault(tag, []).append(number)
        self.tags.append(tag)
        self.classes.append(frozenset(attributes.get("class", "").split()))
        self.parents.append(self._open[-1] if self._open else -1)
        self.after.append(number + 1)
        if opened and tag in HIDDEN:
            self._hidden += 1
            if self._hidden == len(self.pieces):
                self.pieces.append([])
                self.lengths.append([0])
        self.level.append(self._hidden)
        self.span.append((len(self.pieces[self._hidden]),) * 2)
        if opened:
            self._open.append(number)
            self._names[tag] += 1

    def _close_to(self, tag: str | None) -> None:
        """Close the open elements up to the last one named ``tag``."""
        while tag is not None and self._close() != tag:
            pass

    def _close(self) -> str:
        number = self._open.pop()
        tag = self.tags[number]
        self._names[tag] -= 1
        self.after[number] = len(self.tags)
        self.span[number] = (self.span[number][0], len(self.pieces[self.level[number]]))
        self._hidden -= tag in HIDDEN
        return tag

    def size(self, number: int) -> int:
        """Characters of the element's text."""
        first, last = self.span[number]
        lengths = self.lengths[self.level[number]]
        return lengths[last] - lengths[first]

    def text(self, number: int) -> str:
        """Shown text, each piece stripped, joined without a gap."""
        first, last = self.span[number]
        return "".join(self.pieces[self.level[number]][first:last])

    def inside(self, number: int, places: list[int]) -> list[int]:
        """Those of the elements ``places`` that lie inside an element; -1 is the page."""
        if number < 0:
            return places
        return places[bisect_left(places, number + 1) : bisect_left(places, self.after[number])]

    def first_inside(self, number: int, places: list[int], most: int) -> list[int]:
        start = bisect_left(places, number + 1)
        end = len(self.tags) if number < 0 else self.after[number]
        return [p for p in places[start : start + most] if p < end]

    def matching(self, tag: str, classes: set[str] | None) -> list[int]:
        return [n for n in self.places.get(tag, []) if classes is None or self.classes[n] & classes]


def _layout_blocks(page: str, layout: dict) -> Iterator[tuple[str, list[str]]]:
    outline = Outline(page)
    questions = outline.matching(layout["question"][0], {layout["question"][1]})
    answers = sorted({n for tag, classes in layout["options"] for n in outline.matching(tag, classes)})
    lists = outline.places.get("select", []) if layout["select"] else []
    for block in outline.matching(layout["block"][0], {layout["block"][1]}):
        question = outline.first_inside(block, questions, 1)
        if not question:
            continue
        found = [outline.text(n) for n in outline.inside(block, answers)]
        for select in outline.first_inside(block, lists, 1):
            found += [t for n in outline.inside(select, outline.places.get("option", [])) if (t := outline.text(n)) not in PLACEHOLDERS]
        yield outline.text(question[0]), [t for t in found if t]


def _generic_blocks(page: str, min_chars: int, max_chars: int) -> Iterator[tuple[str, list[str]]]:
    limit = lexicons.CRAWL_OPTION_LIMIT
    outline = Outline(page, GENERIC_SKIPPED)
    short: dict[int, list[str]] = {}  # the first labels of a parent
    short_text = lambda numbers: [outline.text(n) if outline.size(n) < 100 else "" for n in numbers]
    for node, tag in enumerate(outline.tags):
        # Blocks outside these bounds are never questions; dropping them here keeps nested blocks
        # from sending the text of a page once per level.
        if tag not in GENERIC_TAGS or not min_chars <= outline.size(node) <= max_chars:
            continue
        text, parent = outline.text(node), outline.parents[node]
        if parent not in short:
            short[parent] = short_text(outline.first_inside(parent, outline.places.get("label", []), limit))
        found, after = [], outline.after[node]
        if after < len(outline.tags) and outline.parents[after] == parent and outline.tags[after] in ("ul", "ol"):
            found += short_text(outline.first_inside(after, outline.places.get("li", []), limit))
        found += [t for t in short[parent] if t != text]
        yield text, [t for t in found if t]


def _cut_blocks(min_chars: int, max_chars: int):
    """Blocks of pages. A page that cannot be read gives one row with an error, and none of its blocks."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page in batch.itertuples(index=False):
                layout, named = LAYOUTS.get(page.site), (page.page_id, page.url, page.source_name, page.site)
                try:
                    blocks = _layout_blocks(page.html or "", layout) if layout else _generic_blocks(page.html or "", min_chars, max_chars)
                    rows += [(*named, pos, text, found, None) for pos, (text, found) in enumerate(blocks)]
                except Exception as error:  # noqa: BLE001  one page must not end the job
                    rows.append((*named, None, None, None, f"{type(error).__name__}: {error}"[:500]))
            columns = ["page_id", "url", "source_name", "site", "pos", "raw_text", "raw_options", "error"]
            yield pd.DataFrame(rows, columns=columns).astype({"pos": "Int32"})

    return work


def parsed_pages(pages: DataFrame, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Candidate blocks of every page, and (page_id, error) rows of pages that cannot be read."""
    named = pages if "source_name" in pages.columns else pages.withColumn("source_name", F.col("url"))
    needed = named.select("page_id", "url", "source_name", rules.site_layout(F.col("url")).alias("site"), "html")
    return needed.mapInPandas(_cut_blocks(min_chars, max_chars), BLOCKS + ", error string")


def text_blocks(pages: DataFrame, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Candidate blocks of every page: (page_id, url, source_name, site, pos, raw_text, raw_options)."""
    return parsed_pages(pages, min_chars, max_chars).where("error is null").drop("error")


def page_errors(parsed: DataFrame) -> DataFrame:
    """(page_id, error) of the pages that could not be read."""
    return parsed.where("error is not null").select("page_id", "error")


def page_questions(
    blocks: DataFrame, markers: list[str] | None = None, keywords: list[str] | None = None,
    min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS,
) -> DataFrame:
    """On-topic questions of the blocks, with the crawled-question columns. Texts may still repeat."""
    generic = F.col("site") == "generic"
    numbered = F.col("site").isin("wjx", "wenjuan")
    cleaned = blocks.withColumn("text", F.when(numbered, strip_numbering("raw_text")).otherwise(F.col("raw_text")))
    asked = cleaned.filter(pred.is_on_topic(F.col("text"), markers, keywords, min_chars, max_chars))
    bare, inline = opt.inline_options(F.col("text"))
    pulled = asked.withColumns(
        {
            "question_text": F.when(generic, bare).otherwise(F.col("text")),
            "found": F.when(generic, F.coalesce(inline, F.col("raw_options"))).otherwise(F.col("raw_options")),
        }
    ).withColumn("options", opt.join_crawled_options(F.col("found")))
    name = F.lit(None).cast("string")
    for site, shown in lexicons.SITE_SOURCE_NAMES.items():
        name = F.when(F.col("site") == site, shown).otherwise(name)
    return pulled.select(
        "page_id", "url", "pos", "question_text",
        F.coalesce("options", F.lit("")).alias("options_text"),
        rules.type_from_option_text(F.col("options"), F.col("question_text")).alias("question_type"),
        rules.category_by_groups(F.col("question_text")).alias("category"),
        F.when((F.col("site") == "wenjuan") | F.col("question_text").rlike(r"[一-鿿]"), "zh")
        .otherwise("en").alias("language"),
        F.col("url").alias("source_url"),
        F.coalesce(name, F.col("source_name")).alias("source_name"),
    )


def distinct_questions(questions: DataFrame) -> DataFrame:
    """First occurrence of each question text, by page and position."""
    spot = questions.withColumn("_spot", F.struct("page_id", "pos"))
    return first_wins(spot, ["question_text"], "_spot").drop("_spot")


@F.pandas_udf(T.StringType())
def absolute_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """Resolve links against the page they stand on; NULL for a link that is no url."""
    def resolve(b: str, h: str) -> str | None:
        try:
            return urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([resolve(b, h) for b, h in zip(base, href)])


def page_links(pages: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """(page_seq, link_pos, url): absolute links that match one of the patterns."""
    patterns = lexicons.SURVEY_LINK_PATTERNS if patterns is None else patterns
    href = F.lit(r"""(?is)<a\s[^>]*?\bhref\s*=\s*["']([^"']*)["']""")
    raw = pages.select(
        F.col("page_id").alias("page_seq"), F.col("url").alias("base"),
        F.posexplode(F.regexp_extract_all("html", href, 1)).alias("link_pos", "href"),
    )
    full = raw.withColumn("url", absolute_url("base", F.replace("href", F.lit("&amp;"), F.lit("&"))))
    return full.filter(F.col("url").rlike("|".join(f"(?:{p})" for p in patterns))).select("page_seq", "link_pos", "url")


def sublinks(pages: DataFrame, patterns: list[str] | None = None, per_page: int = lexicons.LINKS_PER_PAGE) -> DataFrame:
    """Links to follow: each once, where it stands first, and at most ``per_page`` per page."""
    return limit_links(page_links(pages, patterns), per_page)


def pages_with_questions(questions: DataFrame) -> DataFrame:
    return questions.groupBy("page_id").agg(F.count("*").alias("questions"))


def page_outcomes(
    seeds: DataFrame, questions: DataFrame, links: DataFrame, fetched: DataFrame, errors: DataFrame | None = None,
) -> DataFrame:
    """Outcome per seed page.

    ``direct``: it has questions itself. ``sublinks``: it has none, but pages it links to have.
    ``empty``: neither. ``failed``: it has no html, or is one of ``errors`` (page_id), which could not be read.
    ``questions`` are those of all fetched pages, ``fetched`` (page_id, url) the pages that links can be resolved to.
    """
    counts = pages_with_questions(questions)
    base = seeds.select("page_id", F.col("html").isNull().alias("missing"))
    if errors is not None:
        broken = errors.select("page_id").distinct().withColumn("broken", F.lit(True))
        base = base.join(broken, "page_id", "left").select("page_id", (F.col("missing") | F.coalesce("broken", F.lit(False))).alias("missing"))
    base = base.join(counts, "page_id", "left")
    need = base.filter(~F.col("missing") & F.col("questions").isNull()).select("page_id")
    reached = (
        links.join(need.withColumnRenamed("page_id", "page_seq"), "page_seq", "left_semi")
        .join(fetched.select(F.col("page_id").alias("target"), "url"), "url")
        .join(counts.withColumnRenamed("page_id", "target").withColumnRenamed("questions", "found"), "target")
        .groupBy(F.col("page_seq").alias("page_id"))
        .agg(F.count("*").alias("links_used"), F.sum("found").alias("found"))
    )
    outcome = (
        F.when(F.col("missing"), "failed").when(F.col("questions").isNotNull(), "direct")
        .when(F.col("found").isNotNull(), "sublinks").otherwise("empty")
    )
    return base.join(reached, "page_id", "left").select(
        "page_id", outcome.alias("outcome"), F.coalesce("links_used", F.lit(0)).alias("links_used"),
        F.coalesce("questions", "found", F.lit(0)).alias("questions"),
    )


def crawl_counters(outcomes: DataFrame) -> DataFrame:
    """The counters of a crawl, in one row."""
    return outcomes.agg(
        F.count_if(F.col("outcome") == "direct").alias("direct_success"),
        F.count_if(F.col("outcome").isin("sublinks", "empty")).alias("need_sublinks"),
        F.coalesce(F.sum("links_used"), F.lit(0)).alias("sublinks_success"),
        F.count_if(F.col("outcome") == "failed").alias("total_failed"),
        F.coalesce(F.sum("questions"), F.lit(0)).alias("total_questions"),
    )


def pages_without_questions(seeds: DataFrame, questions: DataFrame) -> DataFrame:
    """Seed pages that were fetched but have no question: only their links are followed."""
    return seeds.filter(F.col("html").isNotNull()).join(questions.select("page_id").distinct(), "page_id", "left_anti")


def followed_questions(seeds: DataFrame, questions: DataFrame, links: DataFrame, fetched: DataFrame) -> DataFrame:
    """All questions of a crawl: those of seed pages that have any, and for the other seed pages
    those of the pages they link to, under the seed's source name. Whether a page has questions is
    decided before texts are de-duplicated, so the result does not depend on the order of the pages."""
    direct = questions.join(seeds.select("page_id"), "page_id", "left_semi")
    name = F.col("source_name") if "source_name" in seeds.columns else F.col("url")
    origin = pages_without_questions(seeds, questions).select(
        F.col("page_id").alias("page_seq"), name.alias("_seed_name")
    )
    targets = links.join(origin, "page_seq").join(fetched.select("page_id", "url"), "url").select("page_id", "_seed_name")
    # A page that is a seed with questions of its own is already in ``direct``.
    through = questions.join(seeds.select("page_id"), "page_id", "left_anti").join(
        first_wins(targets, ["page_id"], "_seed_name"), "page_id"
    )
    known = F.col("source_name").isin(*lexicons.SITE_SOURCE_NAMES.values())
    renamed = through.withColumn("source_name", F.when(known, F.col("source_name")).otherwise(F.col("_seed_name")))
    return distinct_questions(direct.unionByName(renamed.drop("_seed_name")))


def crawl(
    pages: DataFrame, seeds: DataFrame, patterns: list[str] | None = None,
    markers: list[str] | None = None, keywords: list[str] | None = None,
    min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS, per_page: int = lexicons.LINKS_PER_PAGE,
) -> dict[str, DataFrame]:
    """Questions, outcomes, counters and errors (page_id, error) of a whole crawl over already fetched ``pages``.

    ``seeds`` has (url, source_name), and (list, seq) if it comes from ``seed_pages``: of several seeds
    with one url the first counts, else the one with the first name. Pages are read in two steps, first the seeds,
    then the pages that the seeds without questions link to; no other page is parsed. What a step finds is written
    once, since several results read it and parsing is the expensive part.
    """
    order = "_order" if {"list", "seq"} <= set(seeds.columns) else "source_name"
    seeds = seeds.withColumn("_order", F.struct("list", "seq")) if order == "_order" else seeds
    first = first_wins(seeds, ["url"], order).drop("_order", "list", "seq")
    start = pages.drop("source_name").join(first, "url")

    def read(some: DataFrame) -> DataFrame:
        return stored(parsed_pages(some, min_chars, max_chars), "crawl-parsed")

    def asked(parsed: DataFrame) -> DataFrame:
        return page_questions(parsed.where("error is null").drop("error"), markers, keywords, min_chars, max_chars)

    opened = read(pages.join(first.select("url"), "url", "left_semi"))
    direct = stored(asked(opened), "crawl-direct")
    waiting = pages_without_questions(start, direct).join(page_errors(opened), "page_id", "left_anti")
    links = stored(sublinks(waiting, patterns, per_page), "crawl-links")
    beyond = pages.join(links.select("url").distinct(), "url", "left_semi").join(start.select("page_id"), "page_id", "left_anti")
    followed = read(beyond)
    found = stored(direct.unionByName(asked(followed)), "crawl")
    outcomes = page_outcomes(start, found, links, pages, page_errors(opened))
    return {
        "questions": followed_questions(start, found, links, pages),
        "outcomes": outcomes,
        "counters": crawl_counters(outcomes),
        "errors": page_errors(opened.unionByName(followed)),
    }
