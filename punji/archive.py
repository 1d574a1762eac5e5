"""One object over the archive's tables, whose methods return DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punji.functions.text import in_years, like_contains
from punji.operators import quality, search, tables
from punji.runtime import table


@dataclass
class Archive:
    """editions, pages, articles and catalog_entries; changes return a new Archive and leave the files alone."""

    editions: DataFrame
    pages: DataFrame
    articles: DataFrame
    catalog: DataFrame

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Archive:
        """The tables of a folder, each key once, editions in their latest form."""
        read = lambda n: table(spark, folder, n)
        return cls(
            tables.latest(read("editions"), ["id"], [F.col("created_at")]), read("pages").dropDuplicates(["id"]),
            read("articles").dropDuplicates(["id"]), read("catalog_entries").dropDuplicates(["id"]),
        )

    def _dated(self, rows: DataFrame, first: int | None, last: int | None) -> DataFrame:
        if first is None and last is None:
            return rows
        wanted = self.editions.where(in_years(F.col("publish_year"), first, last)).select(F.col("id").alias("edition_id"))
        return rows.join(wanted, "edition_id", "left_semi")

    def years(self) -> DataFrame:
        return self.editions.select("publish_year").where("publish_year is not null").distinct().orderBy("publish_year")

    def _titled(self, found: DataFrame) -> DataFrame:
        """``found`` with the title, year, month and file of each row's edition."""
        edition = self.editions.select(F.col("id").alias("edition_id"), F.col("title").alias("edition_title"), "publish_year", "publish_month", "pdf_path")
        return found.join(edition, "edition_id")

    def _best(self, ranked: DataFrame, table: DataFrame, keys: list[str], limit: int) -> DataFrame:
        """The ``limit`` best of ``ranked`` (keys, rank) with their rows of ``table``."""
        best = ranked.orderBy(F.round("rank", 6), *reversed(keys)).limit(limit)
        return table.join(F.broadcast(best), keys)

    def search(self, query: str, limit: int = 10, around: int = 15) -> DataFrame:
        """Pages by rank with their edition and a snippet; an invalid query raises."""
        found = self._best(search.match(self.pages, ["full_text"], query, ["id"]), self.pages, ["id"], limit)
        return self._titled(found.withColumn("snippet", self._snippet("full_text", query, around))).orderBy("rank", "id")

    @staticmethod
    def _snippet(column: str, query: str, around: int):
        try:
            leaves = search.phrases(search.parse(query)) if query.strip() else []
        except search.QuerySyntaxError:
            leaves = []
        words = [(w, leaf.prefix and k == len(ws) - 1) for leaf in leaves for ws in [search.query_words(leaf.text)] for k, w in enumerate(ws)]
        return search.snippet(F.col(column), [w for w, p in words if not p], around, [w for w, p in words if p])

    def search_catalog(self, query: str, kind: str | None = None, exact: bool = False, first: int | None = None, last: int | None = None, limit: int = 30) -> DataFrame:
        """Catalogue entries by rank with the titles of edition and article; statistics cover all entries, filters apply before the limit.

        A query that isn't valid is looked for LIKE-wise.
        """
        ranked = search.match_or_like(self.catalog, ["text"], search.shape_catalog(query, exact), ["text"], ["id"])
        wanted = self._dated(self.catalog.where(F.col("kind") == kind) if kind else self.catalog, first, last)
        if kind or first is not None or last is not None:
            ranked = ranked.join(wanted.select("id"), "id", "left_semi")
        article = self.articles.select("edition_id", F.col("id").alias("article_id"), F.col("title").alias("article_title"))
        found = self._best(ranked, self.catalog, ["id"], limit).join(article, ["edition_id", "article_id"], "left")
        return self._titled(found).orderBy("rank", "id")

    def search_articles(self, query: str = "", author: str | None = None, title: str | None = None, series: str | None = None, exact: bool = False, first: int | None = None, last: int | None = None, limit: int = 20, around: int = 20) -> DataFrame:
        """Articles by rank with their edition, the body's opening and a snippet.

        Exact over all fields (an invalid query finds nothing), else substrings of the body (an invalid one is looked
        for LIKE-wise in body and title); without a query, by fields alone.
        """
        keys = ["edition_id", "id"]
        none = self.articles.select(*keys).withColumn("rank", F.lit(0.0))
        if query.strip() and exact:
            try:
                ranked = search.match(self.articles, ["title", "authors_json", "series", "body"], search.shape_article(query), keys)
            except search.QuerySyntaxError:
                ranked = none.limit(0)
        elif query.strip():
            ranked = search.substring_or_like(self.articles, "body", query.strip(), ["body", "title"], keys)
        elif author or title or series:
            ranked = none
        else:
            ranked = none.limit(0)
        wanted = self.articles
        for column, text in (("authors_json", author), ("title", title), ("series", series)):
            if text:
                wanted = wanted.where(like_contains(F.col(column), text))
        wanted = self._dated(wanted, first, last)
        if wanted is not self.articles:
            ranked = ranked.join(wanted.select(*keys), keys, "left_semi")
        found = self._best(ranked, self.articles, keys, limit).withColumn("opening", F.substring("body", 1, 160)).withColumn("snippet", self._snippet("body", query, around))
        return self._titled(found).orderBy("rank", "id")

    def search_both(self, query: str, limit: int = 15, **filters) -> tuple[DataFrame, DataFrame]:
        """Catalogue and article results of one query, apart."""
        dated = {k: v for k, v in filters.items() if k in ("first", "last", "exact")}
        return self.search_catalog(query, limit=limit, **dated), self.search_articles(query, limit=limit, **filters)

    def review_queue(self, limit: int = 200) -> DataFrame:
        return quality.review_queue(self.articles).orderBy(F.col("confidence").asc_nulls_first(), "id").limit(limit)

    def article(self, edition_id: str, article_id: str) -> DataFrame:
        edition = self.editions.select(F.col("id").alias("edition_id"), F.col("title").alias("edition_title"), "pdf_path")
        return self.articles.where((F.col("edition_id") == edition_id) & (F.col("id") == article_id)).join(edition, "edition_id")

    def upsert(self, name: str, batch: DataFrame) -> Archive:
        """The archive with ``batch`` in the table ``name``: rows of known keys replaced, others added."""
        keys = ["edition_id", "id"] if name == "articles" else ["id"]
        return Archive(**(self.__dict__ | {name: tables.upsert(getattr(self, name), batch, keys)}))

    def delete_editions(self, gone: DataFrame) -> Archive:
        """Without the editions of ``gone`` (id) and everything that belongs to them."""
        named = gone.select(F.col("id").alias("edition_id"))
        below = {n: tables.delete(getattr(self, n), named, ["edition_id"]) for n in ("pages", "articles", "catalog")}
        return Archive(editions=tables.delete(self.editions, gone, ["id"]), **below)

    def edit_articles(self, edits: DataFrame) -> Archive:
        return Archive(**(self.__dict__ | {"articles": tables.apply_edits(self.articles, edits, ["edition_id", "id"])}))
