"""p6: lines that one source repeats over and over, found by PrefixSpan and removed.

Each page is the sequence of its lines' identifiers. Frequent single lines are counted first (distinct pages of the
source). Sequences are then cut down to frequent lines, equal ones counted together, and grown item by item: a pattern's
projection is where the rest of each sequence begins, its support the pages that contain it in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punji.runtime import cut, once

SHARE, LEAST = 0.10, 3  # of the source's pages, and pages at least
BROADCAST_ROWS = 100_000  # frequent lines that may be sent to every executor

_SPACE = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def normal_line(line: Column) -> Column:
    """Lower case, each run of digits of any script as 0, white space single and none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}+", "0"), _SPACE, " "))


def page_lines(pages: DataFrame) -> DataFrame:
    """(page_id, source, lines array<long>): the identifiers of each page's lines, null for empty ones, each page once."""
    lines = F.transform(F.split("full_text", "\n", -1), lambda x: F.nullif(normal_line(x), F.lit("")))
    return (
        pages.where("full_text is not null")
        .select(F.col("id").alias("page_id"), F.coalesce(F.split("edition_id", "-")[0], F.lit("")).alias("source"), F.transform(lines, lambda x: F.when(x.isNotNull(), F.xxhash64(x))).alias("lines"))
        .dropDuplicates(["page_id"])
    )


def frequent_lines(lines: DataFrame) -> DataFrame:
    """(source, line, pages, total): lines on at least SHARE of the source's pages and on LEAST or more.

    Distinct lines are exploded page by page and counted with map-side partial sums, so a source with a third of all
    pages is counted like any other.
    """
    totals = lines.groupBy("source").agg(F.count("*").alias("total"))
    counted = lines.select("source", F.explode(F.array_distinct(F.array_compact("lines"))).alias("line")).groupBy("source", "line").agg(F.count("*").alias("pages"))
    return counted.where(F.col("pages") >= LEAST).join(totals, "source").where(F.col("pages") >= SHARE * F.col("total") - 1e-9)


def frequent_patterns(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(source, pattern array<long>, pages): all frequent sequences of lines, gaps allowed, of any length."""
    sets = frequent.groupBy("source").agg(F.collect_set("line").alias("kept"), F.first("total").alias("total"))
    sequences = cut(
        lines.join(sets, "source")
        .select("source", "total", F.filter("lines", lambda x: x.isNotNull() & F.array_contains("kept", x)).alias("seq")).where("size(seq) > 0")
        .groupBy("source", "total", "seq").agg(F.count("*").alias("n"))
    )
    sequences = sequences.select("source", "total", "seq", "n", F.xxhash64("source", "seq").alias("sid"))
    grown = sequences.select("source", "total", "sid", "n", "seq", F.array().cast("array<bigint>").alias("pattern"), F.lit(0).alias("after"))
    out = None
    while True:  # a round for each line of the longest pattern
        rest = F.slice("seq", F.col("after") + 1, F.size("seq"))
        step = grown.select("source", "total", "sid", "n", "seq", "pattern", "after", F.explode(F.array_distinct(rest)).alias("item"))
        step = step.select(
            "source", "total", "sid", "n", "seq", F.concat("pattern", F.array("item")).alias("pattern"),
            (F.col("after") + F.array_position(F.slice("seq", F.col("after") + 1, F.size("seq")), F.col("item")).cast("int")).alias("after"),
        )
        support = step.groupBy("source", "total", "pattern").agg(F.sum("n").alias("pages")).where(F.col("pages") >= LEAST).where(F.col("pages") >= SHARE * F.col("total") - 1e-9)
        support = cut(support.select("source", "pattern", "pages"))
        if support.isEmpty():
            break
        out = support if out is None else out.unionByName(support)
        grown = cut(step.join(support.select("source", "pattern"), ["source", "pattern"], "left_semi"))
    return support if out is None else out


def _members(patterns: DataFrame) -> DataFrame:
    """(source, line) of the lines that stand in any of ``patterns``, sent to all executors where they are few."""
    members = cut(patterns.select("source", F.explode("pattern").alias("line")).distinct())
    return F.broadcast(members) if members.count() <= BROADCAST_ROWS else members


def standing_lines(pages: DataFrame) -> DataFrame:
    """(page_id, line_no): the lines of ``pages`` (id, edition_id, full_text) that occur in a frequent pattern.

    A page delivered twice counts once, null texts and empty lines are no case, an empty table gives no rows. Every
    line of a frequent pattern is frequent by itself, and single lines are patterns, so all occurrences are found.
    """
    lines = cut(page_lines(pages))
    members = _members(frequent_patterns(lines, cut(frequent_lines(lines))))
    rows = lines.select("page_id", "source", F.posexplode("lines").alias("at", "line")).where("line is not null")
    return rows.join(members, ["source", "line"], "left_semi").select("page_id", (F.col("at") + 1).alias("line_no"))


def standing_patterns(pages: DataFrame) -> DataFrame:
    """(source, pattern, length, pages): the frequent sequences of each source, their normal lines one below the other."""
    lines = cut(page_lines(pages))
    patterns = cut(frequent_patterns(lines, cut(frequent_lines(lines))))
    members = _members(patterns)
    text = F.explode(F.array_distinct(F.transform(F.split("full_text", "\n", -1), normal_line))).alias("text")
    written = pages.where("full_text is not null").select(text).where("text <> ''").select(F.xxhash64("text").alias("line"), "text").join(members.select("line").distinct(), "line", "left_semi").groupBy("line").agg(F.min("text").alias("text"))
    parts = patterns.select("source", "pattern", "pages", F.posexplode("pattern").alias("at", "line")).join(written, "line")
    whole = parts.groupBy("source", "pattern", "pages").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("p"))
    return whole.select("source", F.array_join("p.text", "\n").alias("pattern"), F.size("p").alias("length"), "pages")


_BLOCKS = "array<struct<block_no:int,bbox:array<double>,type:string,text:string,alignment:string,reading_order:int>>"


def without_standing_lines(pages: DataFrame) -> DataFrame:
    """(page_id, full_text, blocks_json) of each page, the standing lines taken out of both.

    Blocks left without a line are dropped; blocks_json that can't be read stays as it is.
    """
    lines = cut(page_lines(pages))
    sets = cut(_members(frequent_patterns(lines, cut(frequent_lines(lines)))).groupBy("source").agg(F.collect_set("line").alias("bad")))
    few = (sets.agg(F.sum(F.size("bad") + 1)).first()[0] or 0) <= BROADCAST_ROWS

    def kept(text: Column) -> Column:
        good = F.filter(F.split(text, "\n", -1), lambda x: ~F.coalesce(F.array_contains("bad", F.xxhash64(normal_line(x))), F.lit(False)))
        return F.array_join(good, "\n")

    base = once(pages, "id").withColumn("source", F.coalesce(F.split("edition_id", "-")[0], F.lit(""))).join(F.broadcast(sets) if few else sets, "source", "left")
    blocks = F.from_json("blocks_json", _BLOCKS)
    fixed = F.filter(F.transform(blocks, lambda b: b.withField("text", kept(b["text"]))), lambda b: b["text"] != "")
    return base.select(F.col("id").alias("page_id"), F.when(F.col("bad").isNull(), F.col("full_text")).otherwise(kept(F.col("full_text"))).alias("full_text"), F.when(F.col("bad").isNull() | blocks.isNull(), F.col("blocks_json")).otherwise(F.to_json(fixed)).alias("blocks_json"))
