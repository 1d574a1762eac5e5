"""Quality of decoded text: glyph counts by page, roll-up by edition, review flags, agreement with a second reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punji.functions.text import LATIN_LEFT, collapse_space, glyph_counts, has_split_virama, strip_space, telugu_mass, word_set

MAX_LATIN, MAX_SPLIT = 0.02, 0.005  # shares of an edition's characters


def page_quality(pages: DataFrame) -> DataFrame:
    """Glyph counts of every page, once; pages delivered twice are dropped when only the counts are left of them."""
    return pages.select("id", "edition_id", "page_number", *(c.alias(n) for n, c in glyph_counts(F.col("full_text")).items())).dropDuplicates(["id"])


def page_layout(blocks: DataFrame, height: float = 842.0, header: float = 0.12, footer: float = 0.92) -> DataFrame:
    """(page_id, edition_id, page_number, raw, dropped, kept, drop_rate, kept_ratio, gap) of the pages that have blocks.

    Raw are all blocks, dropped those in the header and footer bands, kept the others that hold text. There is a gap
    where of more than ten blocks less than three quarters of those outside the bands are kept.
    """
    band = (F.col("y1") < header * height) | (F.col("y0") > footer * height)
    full = strip_space(F.coalesce("text", F.lit(""))) != ""
    counted = blocks.groupBy("page_id", "edition_id", "page_number").agg(F.count("*").alias("raw"), F.count_if(band).alias("dropped"), F.count_if(~band & full).alias("kept"))
    ratio = F.col("kept") / F.greatest(F.col("raw") - F.col("dropped"), F.lit(1))
    return counted.withColumn("drop_rate", F.round(1 - F.col("kept") / F.col("raw"), 4)).withColumn("kept_ratio", F.round(ratio, 4)).withColumn("gap", (ratio < 0.75) & (F.col("raw") > 10))


def flags(**conditions: Column) -> Column:
    """The names of the conditions that hold, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in conditions.items())))


def with_review(found: Column) -> Column:
    """``found`` and needs_review behind it, if there is any; without repeats."""
    return F.array_distinct(F.when(F.size(found) > 0, F.concat(found, F.array(F.lit("needs_review")))).otherwise(found))


def edition_quality(quality: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """Sums, rates, pages with a gap in their layout, and flags of each edition, from ``page_quality`` and ``page_layout``."""
    names = ("char_count", "latin_leftover_count", "split_matra_count", "orphan_matra_count")
    total = quality.groupBy("edition_id").agg(F.count("*").alias("pages"), *(F.sum(n).alias(n) for n in names))
    if layout is not None:
        gaps = layout.where("gap").groupBy("edition_id").agg(F.array_sort(F.collect_list("page_number")).alias("flagged_pages"))
        total = total.join(gaps, "edition_id", "left")
    else:
        total = total.withColumn("flagged_pages", F.lit(None).cast("array<int>"))
    total = total.withColumn("flagged_pages", F.coalesce("flagged_pages", F.array().cast("array<int>")))
    rate = lambda n: F.when(F.col("char_count") > 0, F.col(n) / F.col("char_count")).otherwise(F.lit(0.0))
    found = flags(unmapped_glyph=rate("latin_leftover_count") > MAX_LATIN, glyph_split_matra=rate("split_matra_count") > MAX_SPLIT, layout_gap=F.size("flagged_pages") > 0)
    return total.withColumn("latin_leftover_rate", F.round(rate("latin_leftover_count"), 6)).withColumn("flags", with_review(found))


def leftover_samples(pages: DataFrame, most: int = 20) -> DataFrame:
    """(edition_id, sample, n): the commonest leftover characters of each edition, ties by code point."""
    chars = pages.select("id", "edition_id", F.explode(F.regexp_extract_all("full_text", F.lit(LATIN_LEFT), F.lit(0))).alias("sample"))
    once = chars.groupBy("id", "edition_id", "sample").agg(F.count("*").alias("n"))
    # a page delivered k times counts its characters k times
    times = pages.groupBy("id").agg(F.count("*").alias("k")).where("k > 1")
    counted = once.join(times, "id", "left").groupBy("edition_id", "sample").agg(F.sum((F.col("n") / F.coalesce("k", F.lit(1))).cast("long")).alias("n"))
    best = counted.groupBy("edition_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "sample"))), 1, most).alias("best"))
    return best.select("edition_id", F.explode("best").alias("b")).select("edition_id", "b.sample", (-F.col("b.m")).alias("n"))


def title_mismatch(listed: Column, found: Column) -> Column:
    """Whether the beginnings of two titles, both there, are neither in the other."""
    a, b = (strip_space(F.coalesce(c, F.lit(""))) for c in (listed, found))
    return (a != "") & (b != "") & ~found.contains(F.substring(a, 1, 8)) & ~listed.contains(F.substring(b, 1, 8))


def review_flags(body: Column, gap: Column | None = None, listed: Column | None = None, found: Column | None = None, certainty: Column | None = None) -> Column:
    """The flags of an article: of its glyphs, a page of it with a gap, titles that differ, doubtful authors, an empty body."""
    g = glyph_counts(body)
    no = F.lit(False)
    return with_review(flags(
        unmapped_glyph=g["latin_leftover_count"] > 5, glyph_split_matra=g["split_matra_count"] > 2, layout_gap=no if gap is None else gap,
        toc_mismatch=no if listed is None or found is None else F.coalesce(title_mismatch(listed, found), no), author_uncertain=no if certainty is None else certainty < 0.5,
        empty_body=strip_space(F.coalesce(body, F.lit(""))) == "",
    ))


def article_flags(articles: DataFrame) -> DataFrame:
    """(id, flags) of each article from its body."""
    return articles.select("id", review_flags(F.col("body")).alias("flags")).dropDuplicates(["id"])


def article_confidence(base: Column, found: Column) -> Column:
    """0.2 for an empty body, 0.55 for any other flag, else ``base``."""
    return F.when(F.array_contains(found, "empty_body"), 0.2).when(F.size(found) > 0, 0.55).otherwise(base)


def reading_agreement(texts: DataFrame, decoded: str, other: str) -> DataFrame:
    """``texts`` with both masses, their ratio (1 where the other reading is empty), flags, and words of one side only."""
    mine, theirs = telugu_mass(F.col(decoded)), telugu_mass(F.col(other))
    ratio = F.when(theirs == 0, F.lit(1.0)).otherwise(mine / theirs)
    longest = lambda words: F.slice(F.array_sort(F.transform(words, lambda w: F.struct((-F.length(w)).alias("l"), w.alias("w")))), 1, 8)["w"]
    return texts.select(
        "*", mine.alias("decoded_mass"), theirs.alias("other_mass"), ratio.alias("ratio"), flags(coverage_low=(theirs > 40) & (ratio < 0.55)).alias("flags"),
        longest(F.array_except(word_set(F.col(other)), word_set(F.col(decoded)))).alias("missing"), longest(F.array_except(word_set(F.col(decoded)), word_set(F.col(other)))).alias("extra"),
    )


def verified_editions(readings: DataFrame) -> DataFrame:
    """(edition_id, pages, split_virama_pages, coverage_low_pages, disagreements, flags): two readings of each page compared.

    ``readings``: (edition_id, page_number, decoded, other), each page once; a null ``other`` is a reading that failed.
    ``disagreements``: the 30 commonest of each page's five longest words that only the other reading has, ties by
    code point.
    """
    tidy = readings.where("other is not null").withColumn("__d", collapse_space(F.col("decoded"))).withColumn("__o", collapse_space(F.col("other")))
    judged = reading_agreement(tidy, "__d", "__o").withColumn("split", has_split_virama(F.col("decoded"))).withColumn("low", F.size("flags") > 0)
    numbers = lambda c: F.array_sort(F.collect_list(F.when(F.col(c), F.col("page_number"))))
    by_edition = judged.groupBy("edition_id").agg(F.count("*").alias("pages"), numbers("split").alias("split_virama_pages"), numbers("low").alias("coverage_low_pages"))
    words = judged.select("edition_id", F.explode(F.slice("missing", 1, 5)).alias("w")).groupBy("edition_id", "w").agg(F.count("*").alias("n"))
    top = words.groupBy("edition_id").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "w"))), 1, 30), lambda x: x["w"]).alias("disagreements"))
    failed = readings.groupBy("edition_id").agg(F.count_if(F.col("other").isNull()).alias("failed"))
    none = F.array().cast("array<int>")
    joined = failed.join(by_edition, "edition_id", "left").join(top, "edition_id", "left").select(
        "edition_id", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("split_virama_pages", none).alias("split_virama_pages"), F.coalesce("coverage_low_pages", none).alias("coverage_low_pages"),
        F.coalesce("disagreements", F.array().cast("array<string>")).alias("disagreements"), "failed",
    )
    found = flags(split_virama=F.size("split_virama_pages") > 0, coverage_low=F.size("coverage_low_pages") > 0, ocr_unavailable=F.col("failed") > 0)
    return joined.withColumn("flags", with_review(found)).drop("failed")


def review_queue(articles: DataFrame, below: float = 0.6) -> DataFrame:
    """Articles flagged for review, for glyphs or layout, or of low confidence; a null confidence doesn't count as low."""
    text = F.coalesce(F.col("review_flags_json"), F.lit(""))
    wanted = text.contains("needs_review") | text.contains("glyph") | text.contains("layout") | F.coalesce(F.col("confidence") < below, F.lit(False))
    return articles.where(wanted)
