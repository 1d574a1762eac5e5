"""Reading page extracts and archive folders, writing text, JSON, Markdown and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punji.functions.text import edition_id_of
from punji.operators.catalog import emit_catalog

_BLOCK = "struct<block_no:int,bbox:array<double>,type:string,text:string,alignment:string,reading_order:int>"
_IMAGE = "struct<page_number:int,path:string,xref:int,width:int,height:int>"
EXTRACT = (
    "metadata map<string,string>, pdf_path string, total_pages int, detected_fonts array<string>, "
    f"pages array<struct<page_number:int,width:double,height:double,blocks:array<{_BLOCK}>,images:array<{_IMAGE}>>>, images array<{_IMAGE}>"
)
ARTICLE = (
    "id string, title string, start_page int, end_page int, series string, authors array<string>, body_unicode string, "
    "continuation_of string, toc_index int, confidence double, review_flags array<string>, kind string"
)


def find_pdfs(spark: SparkSession, folder: str, year: str | None = None) -> DataFrame:
    """(path, edition_id) of the PDFs below ``folder``: those in year folders if there are any, else all."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(folder).select("path")
    dated = files.where(F.col("path").rlike(r"/\d+/[^/]+$"))
    chosen = dated if not dated.isEmpty() else files
    if year:
        chosen = chosen.where(F.col("path").contains(f"/{year}/"))
    return chosen.select("path", edition_id_of(F.col("path")).alias("edition_id")).orderBy("path")


def read_extracts(spark: SparkSession, path: str) -> DataFrame:
    """One row an extract document, with its edition id; unreadable files give null columns, not a failure."""
    return spark.read.schema(EXTRACT).option("multiLine", True).option("recursiveFileLookup", "true").json(path).withColumn("edition_id", edition_id_of(F.coalesce("pdf_path", F.input_file_name())))


def extract_pages(extracts: DataFrame) -> DataFrame:
    """(edition_id, page_number, full_text, blocks) of every page, block texts in their order, one a line.

    A column ``arrived`` of the extracts is kept.
    """
    kept = [c for c in ("edition_id", "arrived") if c in extracts.columns]
    pages = extracts.select(*kept, F.explode("pages").alias("p"))
    text = F.array_join(F.filter(F.transform("p.blocks", lambda b: F.trim(b["text"])), lambda t: t != ""), "\n")
    return pages.select(*kept, F.col("p.page_number").alias("page_number"), text.alias("full_text"), F.col("p.blocks").alias("blocks"))


def extract_images(extracts: DataFrame) -> DataFrame:
    """Images of every page, each once on its page."""
    return extracts.select("edition_id", F.explode("images").alias("i")).select("edition_id", "i.*").dropDuplicates(["edition_id", "page_number", "xref"])


def read_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Article documents of an archive folder (edition/articles/*.json)."""
    return spark.read.schema(ARTICLE).option("multiLine", True).json(f"{folder}/*/articles/*.json").withColumn("edition_id", F.regexp_extract(F.input_file_name(), r"/([^/]+)/articles/[^/]*$", 1))


def tagged_text(kind: Column, text: Column) -> Column:
    """A block's text behind the mark of its kind."""
    return F.concat(F.when(kind == "heading", "[HEADING] ").when(kind == "right_subheading", "[RIGHT] ").otherwise(""), text)


_ENTRY = "id string, edition_id string, article_id string, kind string, text string, page int, alignment string, source string, series_number int"


def _edition_of(path: Column, depth: str) -> Column:
    return F.regexp_extract(path, rf"/([^/]+)/{depth}$", 1)


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue entries of an archive folder (edition/catalog.json)."""
    held = spark.read.schema(f"entries array<struct<{', '.join(c.replace(' ', ':') for c in _ENTRY.split(', '))}>>").option("multiLine", True).option("pathGlobFilter", "catalog.json").option("recursiveFileLookup", "true").json(folder)
    return held.withColumn("folder", _edition_of(F.input_file_name(), "catalog\\.json")).select("folder", F.explode("entries").alias("e")).select("e.*", "folder").withColumn("edition_id", F.coalesce("edition_id", "folder")).drop("folder")


def read_raw_extracts(spark: SparkSession, folder: str) -> DataFrame:
    """Extract documents kept in an archive folder (edition/raw_extract.json); the folder names the edition."""
    held = spark.read.schema(EXTRACT).option("multiLine", True).option("pathGlobFilter", "raw_extract.json").option("recursiveFileLookup", "true").json(folder)
    return held.withColumn("edition_id", _edition_of(F.input_file_name(), "raw_extract\\.json"))


def extract_blocks(extracts: DataFrame) -> DataFrame:
    """Blocks of extract documents in the form of page_blocks (edition_id, page_number, at, type, text, alignment, x0 to y1)."""
    pages = extracts.select("edition_id", F.explode("pages").alias("p")).select("edition_id", F.col("p.page_number").alias("page_number"), F.posexplode("p.blocks").alias("at", "b"))
    return pages.select(
        F.concat_ws("-", "edition_id", "page_number").alias("page_id"), "edition_id", "page_number", "at", "b.block_no", "b.type", "b.text", "b.alignment",
        *(F.get("b.bbox", i).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))),
    )


def archive_catalog(spark: SparkSession, folder: str, series: DataFrame) -> DataFrame:
    """The catalogue of an archive folder; for editions without catalog.json it is made from their articles and raw extract."""
    held = read_catalog(spark, folder)
    missing = read_articles(spark, folder).join(held.select("edition_id").distinct(), "edition_id", "left_anti")
    order = F.row_number().over(Window.partitionBy("edition_id").orderBy("article_id"))
    listed = missing.select("edition_id", F.col("id").alias("article_id"), "kind", "title", "start_page", "end_page", "series", "authors").withColumn("order", order)
    made = emit_catalog(listed, extract_blocks(read_raw_extracts(spark, folder)), series).withColumnRenamed("entry_id", "id")
    return held.unionByName(made)


def write_catalog(entries: DataFrame, path: str) -> None:
    """Catalogue entries as JSON below ``path``, a folder an edition."""
    entries.write.mode("overwrite").partitionBy("edition_id").json(f"{path}/catalog")


def write_summary(summary: DataFrame, path: str) -> None:
    """One line of JSON an edition: what a batch did."""
    summary.write.mode("overwrite").json(f"{path}/batch_summary")


def write_text(blocks: DataFrame, path: str) -> None:
    """One text file an edition folder: blocks (edition_id, page_number, at, type, text) in reading order."""
    lines = F.array_sort(F.collect_list(F.struct("page_number", "at", tagged_text(F.col("type"), F.col("text")).alias("t"))))
    joined = blocks.groupBy("edition_id", "page_number").agg(lines.alias("l")).select("edition_id", F.array_join(F.col("l.t"), "\n").alias("value"))
    joined.write.mode("overwrite").partitionBy("edition_id").text(path)


def markdown(title: Column, authors: Column, series: Column, body: Column) -> Column:
    """An article as Markdown with a YAML head; quotes are taken out of the head's values."""
    plain = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit(""))
    return F.concat(F.lit('---\ntitle: "'), plain(title), F.lit('"\nauthors: ['), F.array_join(F.transform(F.coalesce(authors, F.array().cast("array<string>")), lambda a: F.concat(F.lit('"'), plain(a), F.lit('"'))), ", "), F.lit(']\nseries: "'), plain(series), F.lit('"\n---\n\n# '), plain(title), F.lit("\n\n"), F.coalesce(body, F.lit("")), F.lit("\n"))


def write_archive(articles: DataFrame, path: str) -> None:
    """Articles as JSON and as Markdown below ``path``, a folder an edition."""
    articles.write.mode("overwrite").partitionBy("edition_id").json(f"{path}/articles")
    articles.select("edition_id", markdown(F.col("title"), F.from_json("authors_json", "array<string>"), F.col("series"), F.col("body")).alias("value")).write.mode("overwrite").partitionBy("edition_id").text(f"{path}/markdown")


def write_table(df: DataFrame, path: str, partition: str = "edition_id") -> None:
    """Replaces only the partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
