"""Catalogue entries of articles: headings, series and authors, and what the layout of their first page adds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punji.functions.text import strip_space
from punji.operators.segment import catalogue_ids, series_in_text

_COLUMNS = ("edition_id", "article_id", "order", "step", "seq", "kind", "text", "page", "alignment", "source", "series_number")


def emit_catalog(articles: DataFrame, blocks: DataFrame, series: DataFrame) -> DataFrame:
    """(entry_id, edition_id, article_id, kind, text, page, alignment, source, series_number) of ``articles``.

    ``articles``: (edition_id, article_id, kind, order, title, start_page, end_page, series, authors array); ``order``
    is their place in the edition. ``blocks`` as page_blocks gives them; ``series``: (series_id, series_name), a list
    written by hand. An article gets its heading (front and back matter have none), its series and its authors; then,
    from the short blocks of its first page, right-hand names not yet entered (compared as whole texts, entered by
    their first line) and series named above the heading, or beside it if they aren't its own.
    """
    none = F.lit(None)

    def entries(rows, step, seq, kind, text, page, alignment, source, number=none):
        return rows.select("edition_id", "article_id", "order", F.lit(step).alias("step"), seq.cast("long").alias("seq"), F.lit(kind).alias("kind"), text.alias("text"), page.cast("int").alias("page"), alignment.alias("alignment"), source.alias("source"), number.cast("int").alias("series_number"))

    rows = articles.withColumn("title", strip_space(F.coalesce("title", F.lit("")))).withColumn("authors", F.coalesce("authors", F.array().cast("array<string>")))
    start, last = F.col("start_page"), F.coalesce(F.nullif("end_page", F.lit(0)), F.col("start_page"))
    heading = entries(rows.where("title <> '' and coalesce(kind, '') not in ('front_matter', 'back_matter')"), 0, F.lit(0), "heading", F.col("title"), start, F.lit("center"), F.lit("toc"))
    named = entries(rows.where("series <> ''"), 1, F.lit(0), "series", F.col("series"), start, F.lit("center"), F.lit("toc_or_alias"))
    tagged = entries(rows.select("*", F.posexplode("authors").alias("at", "author")), 2, F.col("at"), "author", F.col("author"), last, F.lit("right"), F.lit("autotag"))

    page = blocks.select("edition_id", F.col("page_number").alias("start_page"), "at", F.col("type").alias("block_type"), strip_space(F.coalesce("text", F.lit(""))).alias("block"), F.coalesce("alignment", F.lit("left")).alias("alignment"), F.col("y0").alias("y"))
    scan = rows.join(page, ["edition_id", "start_page"])
    head = (F.col("block_type") == "heading") | ((F.col("alignment") == "center") & (F.col("title") != "") & F.col("block").contains(F.substring("title", 1, 8)))
    own = Window.partitionBy("edition_id", "article_id", "order")
    scan = scan.withColumn("heading_y", F.min_by(F.col("y"), F.when(head, F.col("at"))).over(own)).where((F.col("block") != "") & (F.length("block") <= 80))

    right = scan.where(((F.col("block_type") == "right_subheading") | (F.col("alignment") == "right")) & ~F.array_contains("authors", F.col("block")) & (F.length("block") < 50))
    right = right.withColumn("line", strip_space(F.split("block", "\n")[0]))
    known = F.first("at").over(Window.partitionBy("edition_id", "article_id", "order", "line").orderBy("at"))
    right = right.withColumn("known", known).where(F.col("block").contains("\n") | (F.col("known") == F.col("at")))
    layout = entries(right, 3, F.col("at") * 2, "author", F.col("line"), start, F.lit("right"), F.lit("layout_right"))

    seen = series_in_text(scan.withColumnRenamed("block", "text"), series)
    above = F.coalesce(F.col("y") < F.col("heading_y") - 2, F.lit(False))
    fit = seen.withColumn("above", above).where((F.col("above") | F.col("alignment").isin("left", "center")) & ~F.col("series_name").eqNullSafe(F.col("series")))
    once = F.row_number().over(Window.partitionBy("edition_id", "article_id", "order", "series_name").orderBy("at"))
    fit = fit.withColumn("__n", once).where("__n = 1")
    matched = entries(fit, 3, F.col("at") * 2 + 1, "series", F.col("series_name"), start, F.col("alignment"), F.when(F.col("above"), "layout_above_heading").otherwise("layout_match"), F.col("number"))

    every = heading.unionByName(named).unionByName(tagged).unionByName(layout).unionByName(matched)
    return catalogue_ids(every, ["order", "article_id", "step", "seq"]).select("entry_id", "edition_id", "article_id", "kind", "text", "page", "alignment", "source", "series_number")
