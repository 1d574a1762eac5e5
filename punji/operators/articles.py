"""Articles of an edition from its contents entries: spans, bodies, authors, series, flags and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punji.functions.text import clean_author, detect_series, plausible_author, slug, strip_space
from punji.operators import quality, segment
from punji.runtime import computed, short_list

CONTINUED = "ఇంకావుంది"  # Fixed value: the note under a part of a serial
_AUTHOR = "array<struct<name:string,source:string,confidence:double>>"


def _plausible(found: Column) -> Column:
    """Authors whose cleaned name can be one."""
    cleaned = F.transform(found, lambda a: F.struct(clean_author(a["name"]).alias("name"), a["source"].alias("source"), a["confidence"].alias("confidence")))
    return F.filter(cleaned, lambda a: plausible_author(a["name"]))


def byline_authors(blocks: Column, width: float = segment.PAGE_WIDTH) -> Column:
    """Authors among the first three right-hand blocks of an article (array of type, x0, text).

    Blocks typed as right-hand count; where there are none, short ones that begin far right.
    """
    typed = F.filter(blocks, lambda b: b["type"] == "right_subheading")
    text = lambda b: strip_space(F.coalesce(b["text"], F.lit("")))
    far = F.filter(blocks, lambda b: (b["x0"] > 0.55 * width) & (text(b) != "") & (F.length(text(b)) <= 50) & (F.size(F.split(text(b), "\n")) <= 2))
    first = F.slice(F.when(F.size(typed) > 0, typed).otherwise(far), 1, 3)
    return _plausible(F.transform(first, lambda b: F.struct(F.split(text(b), "\n")[0].alias("name"), F.lit("right_subheading").alias("source"), F.lit(0.75).alias("confidence"))))


def last_lines(body: Column, tail: int = 12) -> Column:
    """The last ``tail`` lines of a text that aren't empty, without white space at their ends."""
    lines = F.filter(F.transform(F.split(F.coalesce(body, F.lit("")), "\n"), strip_space), lambda x: x != "")
    return F.reverse(F.slice(F.reverse(lines), 1, tail))


def line_authors(last: Column, inline: int = 4) -> Column:
    """Authors behind a dash in the last lines of a text; in the very last, also behind a later dash of the line."""
    author = lambda name, sure: F.struct(name.alias("name"), F.lit("trailing_dash").alias("source"), F.lit(sure).alias("confidence"))
    whole = F.transform(F.filter(last, lambda x: x.rlike(r"^[-–—]{1,2}\s*[^\n\-–—]{2,60}$")), lambda x: author(x, 0.85))
    # Forms of address that may stand before a name behind a dash.
    behind = r"[-–—]{1,2}\s*((?:శ్రీమతి|శ్రీ|సా\.?|డా\.?|కుమారి)?\s*[\x{C01}-\x{C7F}A-Za-z. ]{2,40})\s*\.?\s*$"
    end = F.reverse(F.slice(F.reverse(last), 1, inline))
    late = F.transform(F.filter(end, lambda x: x.rlike(r"^[-–—]") & x.rlike(behind)), lambda x: author(F.regexp_extract(x, behind, 1), 0.8))
    return F.concat(_plausible(whole), _plausible(late))


def dash_authors(body: Column, tail: int = 12, inline: int = 4) -> Column:
    """``line_authors`` of a text."""
    return line_authors(last_lines(body, tail), inline)


def title_authors(title: Column) -> Column:
    """An author that a contents title names behind dots."""
    # Forms of address by which such a name is known.
    found = F.regexp_extract(strip_space(F.coalesce(title, F.lit(""))), r"(?:\.{2,}|…)\s*((?:శ్రీమతి|శ్రీ|డా\.?|సా\.?)[^.]{2,40})$", 1)
    one = F.array(F.struct(found.alias("name"), F.lit("toc_title").alias("source"), F.lit(0.7).alias("confidence")))
    return _plausible(F.when(found != "", one).otherwise(F.array().cast(_AUTHOR)))


def merged_authors(*sources: Column) -> Column:
    """Each name once, in the order of its first mention, from the most confident source, the earlier on ties."""

    def best(every: Column, name: Column) -> Column:
        mine = F.filter(every, lambda a: a["name"] == name)
        return F.filter(mine, lambda a: ~F.exists(mine, lambda b: b["confidence"] > a["confidence"]))[0]

    # the sources are a variable within, so that they are put together once
    together = F.array(F.concat(*sources) if len(sources) > 1 else sources[0])
    return F.transform(together, lambda every: F.transform(F.array_distinct(F.transform(every, lambda a: a["name"])), lambda name: best(every, name)))[0]


def author_confidence(authors: Column) -> Column:
    """The highest confidence of the authors, 1 where there are none."""
    return F.coalesce(F.array_max(F.transform(authors, lambda a: a["confidence"])), F.lit(1.0))


def normal_series(rows: DataFrame, aliases: DataFrame, title: str = "title", hint: str = "series") -> DataFrame:
    """``rows`` with ``series``: the name of the first alias (alias, series_name; a list written by hand) that the hint,
    or without one the title, contains; else the hint."""
    listed = short_list(aliases.where("alias <> ''")).agg(F.array_sort(F.collect_list(F.struct("alias", "series_name"))).alias("__aliases"))  # one row
    raw = F.coalesce(F.nullif(F.col(hint), F.lit("")), F.col(title), F.lit(""))
    named = F.get(F.filter("__aliases", lambda a: raw.contains(a["alias"])), F.lit(0))["series_name"]
    return rows.join(F.broadcast(listed)).withColumn("series", F.coalesce(named, F.col(hint))).drop("__aliases")


def edition_spans(entries: DataFrame, editions: DataFrame) -> DataFrame:
    """(edition_id, kind, position, title, series, toc_index, start_page, end_page) of every article an edition has.

    ``entries``: (edition_id, position, toc_index, title, start_page, series); ``editions``: (edition_id, title,
    total_pages). Contents entries make articles; pages before the first are front matter, pages after the last back
    matter; an edition without entries is one article. Pages are kept within the edition.
    """
    total = F.col("total_pages")
    placed = segment.page_ends(entries.join(editions.select("edition_id", "total_pages"), "edition_id"))
    start, end = segment.clamp_pages(F.col("start_page"), F.least(F.col("end_page"), total), total)
    first = placed.select("edition_id", F.lit("article").alias("kind"), "position", "title", "series", "toc_index", start.alias("start_page"), end.alias("end_page"))
    reach = placed.groupBy("edition_id", "total_pages").agg(F.min("start_page").alias("first"), F.max("end_page").alias("last"))

    def matter(rows, kind, position, title, index, a, b):
        return rows.select("edition_id", F.lit(kind).alias("kind"), F.lit(position).cast("long").alias("position"), title.alias("title"), F.lit(None).cast("string").alias("series"), F.lit(index).alias("toc_index"), a.cast("int").alias("start_page"), b.cast("int").alias("end_page"))

    front = matter(reach.where("first > 1"), "front_matter", -1, F.lit("Edition front matter"), 0, F.lit(1), F.col("first") - 1)
    back = matter(reach.where("last < total_pages"), "back_matter", 1 << 40, F.lit("Edition back matter"), 999, F.col("last") + 1, total)
    bare = editions.join(entries.select("edition_id").distinct(), "edition_id", "left_anti")
    full = matter(bare, "full_edition", 0, F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled")), 0, F.lit(1), total)
    return first.unionByName(front).unionByName(back).unionByName(full)


def build_articles(entries: DataFrame, blocks: DataFrame, editions: DataFrame, aliases: DataFrame, contents: DataFrame | None = None, flagged: DataFrame | None = None) -> DataFrame:
    """(edition_id, article_id, kind, position, title, start_page, end_page, series, toc_index, authors, author_sources,
    body, continuation_of, confidence, review_flags) of every article.

    ``entries``, ``editions`` as in edition_spans; ``blocks`` as page_blocks gives them; ``contents`` (edition_id,
    page_number): pages whose blocks belong to no article but front matter; ``flagged``: pages with a gap in their
    layout. Blocks meet articles by an equi-join on unfolded page numbers. An article without blocks has an empty
    body; back matter without a body is left out. Null texts are empty.
    """
    spans = edition_spans(entries, editions)
    key = ["edition_id", "kind", "position"]
    pages = spans.where("end_page >= start_page").select(*key, F.explode(F.sequence("start_page", "end_page")).alias("page_number"))
    marked = segment.with_block_body(blocks)  # each block once, before it meets articles
    for name, df in (("__contents", contents), ("__gap", flagged)):
        if df is None:
            marked = marked.withColumn(name, F.lit(False))
        else:
            marked = marked.join(df.select("edition_id", "page_number").distinct().withColumn(name, F.lit(True)), ["edition_id", "page_number"], "left").withColumn(name, F.coalesce(name, F.lit(False)))
    gaps = pages.join(flagged.select("edition_id", "page_number").distinct(), ["edition_id", "page_number"], "left_semi").select(*key).distinct().withColumn("gap", F.lit(True)) if flagged is not None else None
    held = pages.join(marked, ["edition_id", "page_number"]).where(~F.col("__contents") | (F.col("kind") == "front_matter"))
    gathered = held.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("page_number", "at", "type", "x0", "text", "body"))).alias("blocks"))
    rows = spans.join(gathered, key, "left")
    rows = rows.join(gaps, key, "left") if gaps is not None else rows.withColumn("gap", F.lit(None).cast("boolean"))
    rows = computed(rows, body=F.coalesce(F.array_join(F.col("blocks.body"), "\n\n"), F.lit("")))
    own = F.col("kind") == "article"
    none = F.array().cast(_AUTHOR)
    bylines = F.when(own, F.coalesce(byline_authors(F.col("blocks")), none)).otherwise(none)
    rows = computed(rows, __right=bylines, __lines=F.when(own, last_lines(F.col("body"))).otherwise(F.array().cast("array<string>")))
    rows = computed(rows, __every=F.concat("__right", line_authors(F.col("__lines")), F.when(own, title_authors(F.col("title"))).otherwise(none)))
    rows = normal_series(computed(rows, author_sources=merged_authors(F.col("__every"))), aliases)
    found = quality.review_flags(F.col("body"), gap=F.coalesce("gap", F.lit(False)), certainty=author_confidence(F.col("author_sources")))
    failed = F.array(F.lit("needs_review"), F.lit("toc_parse_failed"))
    rows = computed(rows, review_flags=F.when(own, found).when(F.col("kind") == "full_edition", failed).otherwise(F.array().cast("array<string>")))
    sure = F.when(own, quality.article_confidence(F.lit(0.9), F.col("review_flags"))).when(F.col("kind") == "front_matter", 0.85).when(F.col("kind") == "back_matter", 0.7).otherwise(0.3)
    name = F.when(own, slug(F.col("title"), F.coalesce("toc_index", F.lit(0)))).when(F.col("kind") == "front_matter", "00_front_matter").when(F.col("kind") == "back_matter", "99_back_matter").otherwise("00_full_edition")
    return rows.where(~((F.col("kind") == "back_matter") & (strip_space(F.col("body")) == ""))).select(
        "edition_id", name.alias("article_id"), "kind", "position", "title", "start_page", "end_page", F.when(own, F.col("series")).alias("series"), "toc_index",
        F.transform("author_sources", lambda a: a["name"]).alias("authors"), "author_sources", "body",
        F.when(own & F.col("body").contains(CONTINUED), "continued_marker").alias("continuation_of"), sure.alias("confidence"), "review_flags",
    )


def edition_entries(pages: DataFrame) -> DataFrame:
    """(edition_id, position, toc_index, title, start_page, series) of every edition, from its contents pages in page order."""
    parsed = segment.parse_contents(pages)
    at = F.row_number().over(Window.partitionBy("edition_id").orderBy("page_number", "position"))
    return parsed.withColumn("position", at.cast("long")).select("edition_id", "position", "toc_index", "title", "start_page", detect_series(F.col("title")).alias("series"))


def article_images(images: DataFrame, spans: DataFrame, page_images: DataFrame | None = None) -> DataFrame:
    """(edition_id, article_id, image columns) of ``images`` (edition_id, page_number, ...) within each article's pages.

    For articles that have none there, those of ``page_images``.
    """
    pages = spans.where("end_page >= start_page").select("edition_id", "article_id", F.explode(F.sequence("start_page", "end_page")).alias("page_number"))
    first = pages.join(images, ["edition_id", "page_number"])
    if page_images is None:
        return first
    rest = pages.join(first.select("edition_id", "article_id").distinct(), ["edition_id", "article_id"], "left_anti")
    return first.unionByName(rest.join(page_images, ["edition_id", "page_number"]), allowMissingColumns=True)
