"""Pages to articles: reading order, block kinds, contents pages, page ranges, bodies, authors and catalogue entries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punji.functions.text import clean_author, plausible_author, repair_telugu, strip_space, toc_score
from punji.runtime import computed, once, short_list

BLOCKS = "array<struct<block_no:int,bbox:array<double>,type:string,text:string,alignment:string,reading_order:int>>"
PAGE_WIDTH = 600.0


def page_blocks(pages: DataFrame) -> DataFrame:
    """One row a block of ``pages`` (id, edition_id, page_number, blocks_json): its place and fields; each page once."""
    parsed = once(pages, "id").select("id", "edition_id", "page_number", F.posexplode(F.from_json("blocks_json", BLOCKS)).alias("at", "b"))
    return parsed.select(
        F.col("id").alias("page_id"), "edition_id", "page_number", "at", "b.block_no", "b.type", "b.text", "b.alignment",
        *(F.get("b.bbox", i).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))),
    )


def block_kind(x0: Column, x1: Column, text: Column, width: float = PAGE_WIDTH) -> Column:
    """heading if short and centred, right_subheading if short and far right, else paragraph."""
    clean = strip_space(text)
    short = (F.size(F.split(text, "\n")) <= 2) & (F.length(clean) < 60)
    centred = F.abs((x0 + x1) / 2 - width / 2) < 40
    right = (x0 > 0.55 * width) & (x1 > 0.75 * width)
    return F.when(centred & short, "heading").when(right & short, "right_subheading").otherwise("paragraph")


def reading_order(blocks: DataFrame, width: float = PAGE_WIDTH) -> DataFrame:
    """``blocks`` with ``order``, from 0 on each page: two columns if both sides hold two of four blocks, else by height."""
    left = ((F.col("x0") + F.col("x1")) / 2 < width / 2 - 25).cast("int")
    page = Window.partitionBy("page_id")
    counted = blocks.withColumn("__left", left).withColumn("__l", F.sum("__left").over(page)).withColumn("__n", F.count("*").over(page))
    two = (F.col("__n") >= 4) & (F.col("__l") >= 2) & (F.col("__n") - F.col("__l") >= 2)
    column = F.when(two, 1 - F.col("__left")).otherwise(0)
    return counted.withColumn("order", F.row_number().over(page.orderBy(column, "y0", "x0", "at")) - 1).drop("__left", "__l", "__n")


def drop_bands(blocks: DataFrame, height: float = 842.0, header: float = 0.12, footer: float = 0.92) -> DataFrame:
    """Without the blocks that lie wholly in the header or the footer band."""
    return blocks.where(~((F.col("y1") < header * height) | (F.col("y0") > footer * height)))


def page_ends(entries: DataFrame, total: str = "total_pages") -> DataFrame:
    """``entries`` (edition_id, position, start_page, total) with end_page: before the next start, at least the own."""
    later = F.lead("start_page").over(Window.partitionBy("edition_id").orderBy("position"))
    return entries.withColumn("end_page", F.when(later.isNotNull(), F.greatest(F.col("start_page"), later - 1)).otherwise(F.col(total)))


def clamp_pages(start: Column, end: Column, total: Column) -> tuple[Column, Column]:
    """Both within 1..total and the end not before the start."""
    first = F.greatest(F.lit(1), F.least(start, total))
    return first, F.greatest(first, F.least(end, total))


def blocks_of_articles(blocks: DataFrame, articles: DataFrame) -> DataFrame:
    """Blocks within each article's pages, as an equi-join: the page range is unfolded, so no interval join is needed."""
    spans = articles.where("start_page is not null and end_page >= start_page").select(F.col("id").alias("article_id"), "edition_id", F.explode(F.sequence("start_page", "end_page")).alias("page_number"))
    return spans.join(blocks, ["edition_id", "page_number"])


# Months as they stand in mastheads.
MONTHS = ("జనవరి", "ఫిబ్రవరి", "మార్చి", "ఏప్రిల్", "మే", "జూన్", "జూలై", "ఆగస్టు", "సెప్టెంబర్", "అక్టోబర్", "నవంబర్", "డిసెంబర్")
MASTHEAD = "మాసపత్రిక"  # what the title line of a page holds; each periodical has its own


def _noise_of(t: Column, masthead: str) -> Column:
    """``noise`` of a text without white space at its ends."""
    short = (t.startswith("సంచిక") & (F.length(t) < 20)) | (t.contains(masthead) & (F.length(t) < 40) & ~t.contains("\n"))
    dated = t.rlike(rf"(?U)^({'|'.join(MONTHS)})\s+\d{{4}}$")
    return F.when(t == "", True).when(t.startswith("సంపుటి"), F.length(t) < 20).otherwise(short | dated)


def noise(text: Column, masthead: str = MASTHEAD) -> Column:
    """Nothing at all, short lines of volume or number, short mastheads, and a month with its year."""
    return _noise_of(strip_space(text), masthead)


def without_leading_noise(text: Column, masthead: str = MASTHEAD) -> Column:
    """A block's text from its first line that isn't noise."""
    lines = F.split(strip_space(text), "\n")
    at = F.array_position(F.transform(F.transform(lines, strip_space), lambda x: _noise_of(x, masthead)), False)
    return F.when(at == 0, "").otherwise(strip_space(F.array_join(F.slice(lines, at.cast("int"), F.size(lines)), "\n")))


def with_block_body(blocks: DataFrame, masthead: str = MASTHEAD) -> DataFrame:
    """``blocks`` that aren't noise, with ``body``: what each adds to an article's body, repaired; null for nothing."""
    held = computed(blocks, __text=strip_space(F.coalesce("text", F.lit(""))))
    held = computed(held.where(~_noise_of(F.col("__text"), masthead)), __rest=without_leading_noise(F.col("__text"), masthead))
    rest = F.col("__rest")
    return held.withColumn("body", F.when((rest != "") & ~_noise_of(rest, masthead), repair_telugu(rest))).drop("__text", "__rest")


def article_bodies(blocks: DataFrame, articles: DataFrame) -> DataFrame:
    """(article_id, edition_id, body): the repaired texts of an article's blocks in page and block order.

    A block is repaired once, before it meets the articles whose pages hold it.
    """
    own = with_block_body(blocks.select("edition_id", "page_number", "at", "text")).where("body is not null")
    held = blocks_of_articles(own, articles)
    parts = F.array_sort(F.collect_list(F.struct("page_number", "at", "body")))
    return held.groupBy("article_id", "edition_id").agg(parts.alias("p")).select("article_id", "edition_id", F.array_join(F.col("p.body"), "\n\n").alias("body"))


def contents_pages(pages: DataFrame, least: int = 6, near: int = 2) -> DataFrame:
    """(edition_id, page_number, score) of the pages that look like a table of contents, close to the edition's best."""
    # scored first, so that no text is shuffled to drop pages delivered twice
    scored = pages.select("id", "edition_id", "page_number", toc_score(F.coalesce("full_text", F.lit(""))).alias("score")).where(F.col("score") >= least).dropDuplicates(["id"]).drop("id")
    best = F.max("score").over(Window.partitionBy("edition_id"))
    return scored.withColumn("best", best).where(F.col("score") >= F.col("best") - near).drop("best")


# What a contents line looks like is fixed by the entries it must yield: number, title and page in one line, parted by
# dots or a gap; number and title with the page below; number, title and page in three lines.
_NUMBER = r"(\d+)\s*[.،]?"
_INLINE = re.compile(_NUMBER + r"\s*(.+?)\s*(?:\.+|\s{2,})\s*(\d+)")
_TITLED = re.compile(_NUMBER + r"\s*(.+)")
_INDEX = re.compile(r"(\d{1,2})\s*[.،]?")
_PAGE = re.compile(r"\d{1,3}")
# Lines of a contents page that are no entry.
_NO_ENTRY = ("క్రమసంఖ్య", "విషయాలు", "పుట సంఖ్య", "ఈ సంచికలో", "విషయసూచిక")


def contents_entries(text: str) -> list[tuple[int, str, int]]:
    """(index, title, page) of the entries in a contents page, written in one, two or three lines."""
    lines = [x.strip() for x in (text or "").splitlines() if x.strip()]
    out: list[tuple[int, str, int]] = []
    tidy = lambda t: re.sub(r"\s+", " ", t).strip(" .…")
    k = 0
    while k < len(lines):
        one, two, three = (lines[k + d] if k + d < len(lines) else "" for d in range(3))
        used = 1
        skip = one.rstrip(" .") in _NO_ENTRY or one.startswith(("సంపుటి", "సంచిక")) or "మాసపత్రిక" in one or (len(one) < 40 and any(m in one for m in MONTHS))
        if not skip:
            if m := _INLINE.fullmatch(one):
                out.append((int(m[1]), tidy(m[2]), int(m[3])))
            elif (m := _TITLED.fullmatch(one)) and _PAGE.fullmatch(two) and tidy(m[2]):
                out.append((int(m[1]), tidy(m[2]), int(two)))
                used = 2
            elif (m := _INDEX.fullmatch(one)) and len(two) > 1 and not _PAGE.fullmatch(two) and not _INDEX.fullmatch(two) and _PAGE.fullmatch(three) and int(three) <= 200:
                out.append((int(m[1]), tidy(two), int(three)))
                used = 3
        k += used
    return out


def parse_contents(pages: DataFrame) -> DataFrame:
    """(edition_id, page_number, position, toc_index, title, start_page) of the entries on contents pages.

    The line parser consumes a varying number of lines, so it runs in Python, on the few pages that scored.
    """
    texts = pages.join(contents_pages(pages).select("edition_id", "page_number"), ["edition_id", "page_number"]).dropDuplicates(["id"]).select("edition_id", "page_number", "full_text")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(e, p, k, *entry) for e, p, t in zip(pdf["edition_id"], pdf["page_number"], pdf["full_text"], strict=True) for k, entry in enumerate(contents_entries(t))]
            yield pd.DataFrame(rows, columns=["edition_id", "page_number", "position", "toc_index", "title", "start_page"])

    return texts.mapInPandas(read, "edition_id string, page_number int, position int, toc_index int, title string, start_page int")


def trailing_authors(texts: DataFrame, body: Column, tail: int = 12) -> DataFrame:
    """(id, name, confidence): names behind a dash in a text's last lines, the best confidence of each name."""
    lines = F.filter(F.transform(F.split(F.coalesce(body, F.lit("")), "\n"), strip_space), lambda x: x != "")
    last = F.when(F.size(lines) > tail, F.slice(lines, -tail, tail)).otherwise(lines)
    marked = F.filter(last, lambda x: x.rlike(r"^[-–—]{1,2}\s*[^\n\-–—]{2,60}$"))
    named = texts.select("id", F.explode(marked).alias("line")).select("id", clean_author(F.col("line")).alias("name"))
    return named.where(plausible_author(F.col("name"))).groupBy("id", "name").agg(F.max(F.lit(0.85)).alias("confidence"))


def best_authors(*sources: DataFrame) -> DataFrame:
    """(id, name, source, confidence): each article's names once, from the most confident source, the earlier on ties."""
    both = sources[0].select("id", "name", "source", "confidence", F.lit(0).alias("__s"))
    for k, s in enumerate(sources[1:], 1):
        both = both.unionByName(s.select("id", "name", "source", "confidence", F.lit(k).alias("__s")))
    best = both.groupBy("id", "name").agg(F.max_by(F.struct("source", "confidence"), F.struct("confidence", (-F.col("__s")).alias("s"))).alias("b"))
    return best.select("id", "name", "b.source", "b.confidence")


def series_in_text(texts: DataFrame, series: DataFrame) -> DataFrame:
    """``texts`` (text, ...) with the longest series name each contains and the number beside it.

    ``series`` is a list written by hand (series_name, series_id); ties of length go to the smaller id.
    """
    # Expressions over a small array of names, so no row is multiplied by the list.
    names = short_list(series.where("series_name <> ''")).agg(F.array_sort(F.collect_list(F.struct((-F.length("series_name")).alias("l"), "series_id", "series_name"))).alias("names"))
    held = texts.join(F.broadcast(names)).withColumn("hit", F.get(F.filter("names", lambda n: F.col("text").contains(n["series_name"])), F.lit(0))).where("hit is not null")
    rest = strip_space(F.replace(F.col("text"), F.col("hit.series_name"), F.lit("")))
    number = F.coalesce(F.nullif(F.regexp_extract("text", r"(?:సంచిక|సంఖ్య|no\.?|#)\s*(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(rest, r"(\d+)\s*$", 1), F.lit("")))
    return held.select(*texts.columns, F.col("hit.series_name").alias("series_name"), number.try_cast("int").alias("number"))


def catalogue_ids(entries: DataFrame, order: list[str]) -> DataFrame:
    """``entries`` with ``entry_id``: the edition's id and a running number of four digits or more."""
    at = F.row_number().over(Window.partitionBy("edition_id").orderBy(*order))
    return entries.withColumn("entry_id", F.concat("edition_id", F.lit("-cat-"), F.format_string("%04d", at)))
