"""The batch job: extract documents to articles, catalogue, quality and search tables, and the command line."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punji.archive import Archive
from punji.functions.text import edition_info, edition_label, volume_issue
from punji.operators import articles as A
from punji.operators import catalog, quality, segment
from punji.runtime import cut
from punji.sources import archive_io as io


def process_extracts(spark: SparkSession, source: str, out: str, series: DataFrame, aliases: DataFrame, year: str | None = None, force: bool = False, second: DataFrame | None = None) -> DataFrame:
    """Processes the extract documents below ``source`` into tables below ``out``; one summary row an edition, also written there.

    Editions that ``out`` holds already are skipped unless ``force``; ``year`` keeps those with that folder in their
    path. ``second``: (edition_id, page_number, other), another reading of pages to be held against.
    """
    extracts = io.read_extracts(spark, source)
    if year:
        extracts = extracts.where(F.col("pdf_path").contains(f"/{year}/"))
    extracts = cut(extracts.where("edition_id <> ''").dropDuplicates(["edition_id"]))
    try:
        done = spark.read.parquet(f"{out}/editions").select("edition_id").distinct()
    except Exception:  # noqa: BLE001  (nothing was processed yet)
        done = extracts.select("edition_id").limit(0)
    known = cut(done)
    fresh = extracts if force else extracts.join(known, "edition_id", "left_anti")

    pages = cut(io.extract_pages(fresh)).withColumn("id", F.concat_ws("-", "edition_id", "page_number"))
    blocks = io.extract_blocks(fresh)
    title, published, month = edition_info(F.col("pdf_path"))
    contents = segment.contents_pages(pages)
    volume, issue = volume_issue(F.col("full_text"))
    numbers = pages.join(contents, ["edition_id", "page_number"]).groupBy("edition_id").agg(F.min_by(volume, F.when(volume.isNotNull(), F.col("page_number"))).alias("volume"), F.min_by(issue, F.when(issue.isNotNull(), F.col("page_number"))).alias("issue"))
    total = F.coalesce(F.nullif("total_pages", F.lit(0)), F.size("pages"))
    layout = quality.page_layout(blocks)
    qa = quality.edition_quality(quality.page_quality(pages), layout)
    editions = cut(
        fresh.select("edition_id", title.alias("title"), "pdf_path", published.alias("publish_year"), month.alias("publish_month"), total.alias("total_pages"), F.current_timestamp().alias("created_at"))
        .join(numbers, "edition_id", "left").join(qa.select("edition_id", "flags", "latin_leftover_rate", "flagged_pages"), "edition_id", "left")
    )
    built = cut(A.build_articles(A.edition_entries(pages), blocks, editions, aliases, contents, layout.where("gap")))
    order = F.row_number().over(A.Window.partitionBy("edition_id").orderBy("toc_index", "article_id"))
    entries = cut(catalog.emit_catalog(built.withColumn("order", order), blocks, series))
    verified = quality.verified_editions(pages.join(second, ["edition_id", "page_number"]).select("edition_id", "page_number", F.col("full_text").alias("decoded"), "other")) if second is not None else None

    for name, df in (("editions", editions), ("pages", pages), ("articles", built), ("catalog_entries", entries)):
        io.write_table(df, f"{out}/{name}")
    if verified is not None:
        io.write_table(verified, f"{out}/verified")
    count = lambda df, name: df.groupBy("edition_id").agg(F.count("*").alias(name))
    review = built.groupBy("edition_id").agg(F.count_if(F.size("review_flags") > 0).alias("needs_review_articles"))
    summary = editions.select("edition_id", F.lit("ok").alias("status"), F.col("flags").alias("qa_flags")).join(count(built, "articles"), "edition_id", "left").join(count(entries, "catalog"), "edition_id", "left").join(review, "edition_id", "left")
    summary = summary.join(verified.select("edition_id", F.col("flags").alias("verify_flags")), "edition_id", "left") if verified is not None else summary.withColumn("verify_flags", F.lit(None).cast("array<string>"))
    skipped = extracts.join(known, "edition_id", "left_semi").select("edition_id", F.lit("skipped").alias("status"))
    summary = cut(summary if force else summary.unionByName(skipped, allowMissingColumns=True))
    io.write_summary(summary, out)
    return summary


def catalog_lines(hits: DataFrame) -> DataFrame:
    """One line of text a catalogue hit."""
    label = edition_label(F.col("edition_title"), F.col("publish_year"), F.col("publish_month"), F.col("edition_id"))
    return hits.select(F.concat(F.lit("["), F.col("kind"), F.lit("] "), F.col("text"), F.lit(" | "), label, F.coalesce(F.concat(F.lit(" | p. "), F.col("page").cast("string")), F.lit("")), F.coalesce(F.concat(F.lit(" | "), F.col("article_title")), F.lit(""))).alias("line"), "rank", "id").orderBy("rank", "id").select("line")


def article_lines(hits: DataFrame, verbose: bool = False) -> DataFrame:
    """One line of text an article hit, with its opening if ``verbose``."""
    label = edition_label(F.col("edition_title"), F.col("publish_year"), F.col("publish_month"), F.col("edition_id"))
    authors = F.coalesce(F.nullif(F.array_join(F.from_json("authors_json", "array<string>"), ", "), F.lit("")), F.lit("—"))
    line = F.concat(F.coalesce("title", F.lit("")), F.lit(" | "), authors, F.lit(" | "), label)
    return hits.select((F.concat(line, F.lit("\n    "), F.coalesce("opening", F.lit(""))) if verbose else line).alias("line"), "rank", "id").orderBy("rank", "id").select("line")


def main(arguments: list[str] | None = None) -> int:
    """``process`` reads extracts, ``search`` queries the tables of a folder."""
    parser = argparse.ArgumentParser(prog="punji")
    commands = parser.add_subparsers(dest="command", required=True)
    process = commands.add_parser("process")
    process.add_argument("source")
    process.add_argument("out")
    process.add_argument("--series", required=True, help="parquet table (series_id, series_name)")
    process.add_argument("--aliases", required=True, help="parquet table (alias, series_name)")
    process.add_argument("--year")
    process.add_argument("--force", action="store_true")
    process.add_argument("--second", help="parquet table (edition_id, page_number, other): another reading of the pages")
    find = commands.add_parser("search")
    find.add_argument("folder")
    find.add_argument("query", nargs="?", default="")
    find.add_argument("--mode", choices=("catalog", "fulltext", "both"), default="catalog")
    for option in ("--kind", "--author", "--title", "--series"):
        find.add_argument(option)
    find.add_argument("--exact", action="store_true")
    find.add_argument("--limit", "-l", type=int, default=15)
    find.add_argument("--verbose", "-v", action="store_true")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("punji").getOrCreate()
    if given.command == "process":
        read = spark.read.parquet
        process_extracts(spark, given.source, given.out, read(given.series), read(given.aliases), given.year, given.force, read(given.second) if given.second else None).orderBy("edition_id").show(truncate=False)
        return 0
    archive = Archive.open(spark, given.folder)
    filters = {"author": given.author, "title": given.title, "series": given.series}
    # a catalogue search without a query but with filters is a search by fields
    catalogue = given.mode != "fulltext" and bool(given.query.strip())
    by_fields = given.mode != "catalog" or (not given.query.strip() and any(filters.values()))
    shown = [catalog_lines(archive.search_catalog(given.query, given.kind, given.exact, limit=given.limit))] if catalogue else []
    if by_fields:
        shown.append(article_lines(archive.search_articles(given.query, exact=given.exact, limit=given.limit, **filters), given.verbose))
    for lines in shown:
        for row in lines.collect():  # at most ``limit`` rows
            print(row["line"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
