"""Queries over the archive's tables, each beside the SQL that gives the same rows.

Rows delivered twice count once; an edition delivered again counts in its latest form.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punji.archive import Archive
from punji.functions import text as T
from punji.operators import quality, search, segment, tables
from punji.runtime import checkpoint_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return keep


def editions(s: SparkSession, d: str) -> DataFrame:
    return tables.latest(table(s, d, "editions"), ["id"], [F.col("created_at")])


def articles(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "articles").dropDuplicates(["id"])


def entries(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "catalog_entries").dropDuplicates(["id"])


def pages(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").dropDuplicates(["id"])


ED = "e as (select * from (select *, row_number() over (partition by id order by created_at desc nulls last) as rn from editions) where rn = 1)"
AR = "a as (select distinct * from articles)"
CE = "c as (select distinct * from catalog_entries)"
PG = "p as (select distinct * from pages)"
STRIP = lambda x: f"regexp_replace({x}, '^[\\s\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+|[\\s\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+$', '', 'g')"
TOK = lambda x: f"regexp_extract_all(translate(lower(coalesce({x}, '')), '{T.FOLD_FROM}', '{T.FOLD_TO}'), '[\\p{{L}}\\p{{N}}\\p{{Co}}\\x{{0C00}}-\\x{{0C7F}}]+')"
ASCII = lambda x: f"translate({x}, '{T.UPPER}', '{T.LOWER}')"


# Filters, projections, distinct, labels


@registered(f"with {ED} select distinct publish_year from e where publish_year is not null")
def years(s, d):
    return editions(s, d).select("publish_year").where("publish_year is not null").distinct()


@registered(f"with {ED} select distinct (publish_year // 10) * 10 as decade from e where publish_year is not null")
def decades(s, d):
    return editions(s, d).where("publish_year is not null").select((F.floor(F.col("publish_year") / 10) * 10).cast("int").alias("decade")).distinct()


@registered(f"with {ED} select id, title, publish_year from e where publish_year between 2005 and 2014")
def editions_in_scope(s, d):
    first, last = T.scope_years("2005s")
    return editions(s, d).where(T.in_years(F.col("publish_year"), first, last)).select("id", "title", "publish_year")


@registered(
    f"""with {ED} select id, case when publish_year is not null and publish_month is not null
        then format('{{}} ({{}}-{{:02d}})', coalesce(nullif(title, ''), id), publish_year, publish_month)
        when publish_year is not null then format('{{}} ({{}})', coalesce(nullif(title, ''), id), publish_year)
        else coalesce(nullif(title, ''), id) end as label from e"""
)
def edition_labels(s, d):
    return editions(s, d).select("id", T.edition_label(F.col("title"), F.col("publish_year"), F.col("publish_month"), F.col("id")).alias("label"))


@registered(f"with {CE} select id, edition_id, text, page from c where kind = 'heading' and alignment = 'center'")
def headings(s, d):
    return entries(s, d).where("kind = 'heading' and alignment = 'center'").select("id", "edition_id", "text", "page")


@registered(
    f"""with {ED}, {AR} select a.id, e.title as edition_title, substr(a.body, 1, 160) as opening from a join e on a.edition_id = e.id
        where {ASCII("a.authors_json")} like '%రావు%' and {ASCII("a.title")} like '%క%' and e.publish_year >= 1990"""
)
def metadata_search(s, d):
    found = articles(s, d).where(T.like_contains(F.col("authors_json"), "రావు") & T.like_contains(F.col("title"), "క"))
    e = editions(s, d).where(T.in_years(F.col("publish_year"), 1990, None)).select(F.col("id").alias("edition_id"), F.col("title").alias("edition_title"))
    return found.join(e, "edition_id").select("id", "edition_title", F.substring("body", 1, 160).alias("opening"))


@registered(
    f"""with {AR} select id, confidence from a where coalesce(review_flags_json, '') like '%needs_review%' or coalesce(review_flags_json, '') like '%glyph%'
        or coalesce(review_flags_json, '') like '%layout%' or coalesce(confidence < 0.6, false)
        order by confidence asc nulls first, id limit 200"""
)
def review_queue(s, d):
    return quality.review_queue(articles(s, d)).orderBy(F.col("confidence").asc_nulls_first(), "id").limit(200).select("id", "confidence")


@registered(
    f"""with {AR}, f as (select id, from_json(review_flags_json, '["VARCHAR"]') as l from a)
        select id, coalesce(array_to_string(list_filter(l, lambda x: x <> 'needs_review'), ', '), '—') as flags from f"""
)
def flags_after_accept(s, d):
    flags = F.array_remove(F.from_json("review_flags_json", "array<string>"), "needs_review")
    return articles(s, d).select("id", F.coalesce(F.array_join(flags, ", "), F.lit("—")).alias("flags"))


@registered(
    f"""with {ED}, {AR} select a.id, a.title, e.title as edition_title, e.pdf_path, a.start_page from a join e on a.edition_id = e.id
        where a.id = (select min(id) from articles)"""
)
def article_by_id(s, d):
    one = articles(s, d)
    first = one.agg(F.min("id").alias("id"))
    e = editions(s, d).select(F.col("id").alias("edition_id"), F.col("title").alias("edition_title"), "pdf_path")
    return one.join(first, "id").join(e, "edition_id").select("id", "title", "edition_title", "pdf_path", "start_page")


@registered(f"with {ED}, {AR}, {CE} select c.id, c.kind, c.text, e.title as edition_title, a.title as article_title from c join e on c.edition_id = e.id left join a on a.id = c.article_id and a.edition_id = c.edition_id")
def catalog_listing(s, d):
    e = editions(s, d).select(F.col("id").alias("edition_id"), F.col("title").alias("edition_title"))
    a = articles(s, d).select(F.col("id").alias("article_id"), "edition_id", F.col("title").alias("article_title"))
    return entries(s, d).join(e, "edition_id").join(a, ["edition_id", "article_id"], "left").select("id", "kind", "text", "edition_title", "article_title")


@registered(
    f"""with {AR} select id, format('{{:02d}}_{{}}', coalesce(toc_index, 0), case when t = '' then 'article' else t end) as slug from (select id, toc_index,
        substr(regexp_replace({STRIP("regexp_replace(coalesce(title, ''), '[<>:\"/\\\\|?*]', '', 'g')")}, '[\\s\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', '_', 'g'), 1, 60) as t from a)"""
)
def slugs(s, d):
    return articles(s, d).select("id", T.slug(F.col("title"), F.coalesce("toc_index", F.lit(0))).alias("slug"))


@registered(
    f"""with {ED} select id, case when regexp_matches(pdf_path, '(^|/)\\d{{4}}/\\d{{1,2}}\\.[^./]*$') then regexp_replace(pdf_path, '^(?:.*/)?(\\d{{4}})/(\\d{{1,2}})\\.[^./]*$', '\\1-') || lpad(regexp_extract(pdf_path, '/(\\d{{1,2}})\\.[^./]*$', 1), 2, '0')
        when regexp_matches(stem, '^\\d{{4}}-\\d{{2}}$') then stem else regexp_replace(lower(stem), '_extracted$', '') end as from_path
        from (select *, regexp_replace(regexp_extract(pdf_path, '([^/]*)$', 1), '\\.[^.]*$', '') as stem from e)"""
)
def ids_from_paths(s, d):
    return editions(s, d).select("id", T.edition_id_of(F.col("pdf_path")).alias("from_path"))


# Ranked search


def _rank_sql(fields: list[str], from_cte: str, source: str, key: str, phrases: list[tuple[list[str], bool]], where: str, limit: int | None) -> str:
    count = []
    for k, (words, prefix) in enumerate(phrases):
        parts = []
        for i in range(len(fields)):
            tests = [f"starts_with(t{i}[i + {j}], '{w}')" if prefix and j == len(words) - 1 else f"t{i}[i + {j}] = '{w}'" for j, w in enumerate(words)]
            parts.append(f"len(list_filter(range(1, len(t{i}) - {len(words)} + 2), lambda i: {' and '.join(tests)}))")
        count.append(f"{' + '.join(parts)} as f{k}")
    size = " + ".join(f"len(t{i})" for i in range(len(fields)))
    stats = ", ".join(f"sum(case when f{k} > 0 then 1 else 0 end) as n{k}" for k in range(len(phrases)))
    rank = " + ".join(f"(case when ln((n - n{k} + 0.5) / (n{k} + 0.5)) <= 0 then 0.000001 else ln((n - n{k} + 0.5) / (n{k} + 0.5)) end) * f{k} * 2.2 / (f{k} + 1.2 * (0.25 + 0.75 * size / avgsize))" for k in range(len(phrases)))
    return f"""with {from_cte}, t as (select {key} as id, {", ".join(f"{TOK(x)} as t{i}" for i, x in enumerate(fields))} from {source}),
        g as (select id, {size} as size, {", ".join(count)} from t), st as (select count(*) as n, avg(size) as avgsize, {stats} from g),
        r as (select id, round(-({rank}), 6) as rank from g, st where {where}) select id, rank from r order by rank, id {f"limit {limit}" if limit else ""}"""


def _top(df: DataFrame, limit: int | None = None) -> DataFrame:
    out = df.select(F.col("id"), F.round("rank", 6).alias("rank")).orderBy("rank", "id")
    return out.limit(limit) if limit else out


ARTICLE_FIELDS = ["title", "authors_json", "series", "body"]


@registered(_rank_sql(["full_text"], PG, "p", "id", [(["పిల్లలు"], False), (["కిటికీ"], False)], "f0 > 0 and f1 > 0", 10))
def page_search(s, d):
    return _top(search.match(table(s, d, "pages"), ["full_text"], "పిల్లలు కిటికీ", ["id"]), 10)


@registered(_rank_sql(ARTICLE_FIELDS, AR, "a", "id", [(["వెన్నెల"], False), (["ముచ్చట్లు"], False)], "f0 > 0 and f1 > 0", 20))
def article_search_exact(s, d):
    return _top(search.match(table(s, d, "articles"), ARTICLE_FIELDS, search.shape_article("వెన్నెల ముచ్చట్లు"), ["id"]), 20)


@registered(_rank_sql(["body"], AR, "a", "id", [(["మా", "తాత"], False)], "f0 > 0", None))
def phrase_search(s, d):
    return _top(search.match(table(s, d, "articles"), ["body"], '"మా తాత"', ["id"]))


@registered(_rank_sql(["text"], CE, "c", "id", [(["వెన్"], True)], "f0 > 0", 30))
def catalog_prefix_search(s, d):
    return _top(search.match(table(s, d, "catalog_entries"), ["text"], search.shape_catalog("వెన్"), ["id"]), 30)


@registered(_rank_sql(["body"], AR, "a", "id", [(["broken"], False), (["కిటికీ"], False), (["నీరు"], False)], "(f0 > 0 or f1 > 0) and not f2 > 0", None))
def boolean_search(s, d):
    return _top(search.match(table(s, d, "articles"), ["body"], "(broken OR కిటికీ) NOT నీరు", ["id"]))


# None of the substrings begins as it ends, so occurrences don't overlap and the pieces between them count them.
@registered(
    f"""with {AR}, g as (select id, greatest(length(coalesce(body, '')) - 2, 0) as size, len(string_split(lower(coalesce(body, '')), 'తాతక')) - 1 as f from a),
        st as (select count(*) as n, avg(size) as avgsize, sum(case when f > 0 then 1 else 0 end) as k from g)
        select id, round(-((case when ln((n - k + 0.5) / (k + 0.5)) <= 0 then 0.000001 else ln((n - k + 0.5) / (k + 0.5)) end) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / avgsize))), 6) as rank from g, st where f > 0"""
)
def substring_search(s, d):
    return _top(search.substring_match(table(s, d, "articles"), "body", "తాతక", ["id"]))


@registered(f"with {CE} select id, 0.0::double as rank from c where {ASCII('text')} like '%no.%'")
def catalog_fallback_search(s, d):
    return _top(search.match_or_like(table(s, d, "catalog_entries"), ["text"], search.shape_catalog("No."), ["text"], ["id"]))


@registered(f"with {AR}, t as (select id, unnest({TOK('title')}) as term from a) select term, count(distinct id) as documents, count(*) as occurrences from t group by term")
def title_index(s, d):
    index = search.postings(articles(s, d), "id", ["title"])
    return index.groupBy("term").agg(F.count("*").alias("documents"), F.sum(F.size("positions")).alias("occurrences"))


@registered(
    f"""with r as ({_rank_sql(["body"], AR, "a", "id", [(["కిటికీ"], False)], "f0 > 0", 20)}), q as (select id, regexp_split_to_array(coalesce(body, ''), '[\\s\\x{{0B}}]+') as ws from (select distinct id, body from articles) join r using (id)),
        h as (select *, list_transform(ws, lambda w: list_contains({TOK("w")}, 'కిటికీ')) as hs from q),
        c as (select *, list_transform(range(1, len(ws) + 1), lambda i: case when hs[i] then len(list_filter(hs[greatest(0, i - 3) + 1:greatest(0, i - 3) + 20], lambda x: x)) else 0 end * 100000 - greatest(0, i - 3)) as scores from h),
        w as (select *, cast(((100000 - list_max(scores) % 100000) % 100000) as int) + 1 as start from c)
        select id, case when start > 1 then '...' else '' end || array_to_string(list_transform(range(start, least(start + 20, len(ws) + 1)), lambda i: case when hs[i] then '<b>' || ws[i] || '</b>' else ws[i] end), ' ')
          || case when len(ws) >= start + 20 then '...' else '' end as snippet from w"""
)
def search_snippets(s, d):
    best = search.match(table(s, d, "articles"), ["body"], "కిటికీ", ["id"]).orderBy(F.round("rank", 6), "id").limit(20)
    found = table(s, d, "articles").select("id", "body").join(F.broadcast(best.select("id")), "id").dropDuplicates(["id"])  # twenty ids
    return found.select("id", search.snippet(F.col("body"), ["కిటికీ"], 20).alias("snippet"))


def _near_starts(words: list[str], t: str = "t0") -> str:
    test = " and ".join(f"{t}[i + {j}] = '{w}'" for j, w in enumerate(words))
    return f"list_filter(range(1, len({t}) + 1), lambda i: coalesce({test}, false))"


@registered(
    f"""with {AR}, t as (select id, {TOK("body")} as t0 from a), p as (select id, len(t0) as size, {_near_starts(["మా", "తాత"])} as x, {_near_starts(["కిటికీ"])} as y from t),
        m as (select *, list_filter(list_distinct(list_concat(x, y)), lambda l: len(list_filter(x, lambda k: k <= l and k >= l - 2 - 30)) > 0 and len(list_filter(y, lambda k: k <= l and k >= l - 1 - 30)) > 0) as last from p),
        g as (select id, size, len(x) as h0, len(y) as h1, len(list_filter(x, lambda k: len(list_filter(last, lambda l: k <= l and k >= l - 2 - 30)) > 0)) as f0, len(list_filter(y, lambda k: len(list_filter(last, lambda l: k <= l and k >= l - 1 - 30)) > 0)) as f1 from m),
        st as (select count(*) as n, avg(size) as avgsize, sum((h0 > 0)::int) as n0, sum((h1 > 0)::int) as n1 from g)
        select id, round(-({" + ".join(f"(case when ln((n - n{k} + 0.5) / (n{k} + 0.5)) <= 0 then 0.000001 else ln((n - n{k} + 0.5) / (n{k} + 0.5)) end) * f{k} * 2.2 / (f{k} + 1.2 * (0.25 + 0.75 * size / avgsize))" for k in range(2))}), 6) as rank from g, st where f0 > 0 and f1 > 0"""
)
def near_search(s, d):
    return _top(search.match(table(s, d, "articles"), ["body"], 'NEAR("మా తాత" కిటికీ, 30)', ["id"]))


@registered(
    f"""with {AR}, t as (select id, {TOK("title")} as t0, {TOK("body")} as t1 from a), g as (select id, len(t0) + len(t1) as size, len(list_filter(t0, lambda x: starts_with(x, 'వె'))) as f0, case when t1[1] = 'మా' then 1 else 0 end as f1 from t),
        st as (select count(*) as n, avg(size) as avgsize, sum((f0 > 0)::int) as n0, sum((f1 > 0)::int) as n1 from g)
        select id, round(-({" + ".join(f"(case when ln((n - n{k} + 0.5) / (n{k} + 0.5)) <= 0 then 0.000001 else ln((n - n{k} + 0.5) / (n{k} + 0.5)) end) * f{k} * 2.2 / (f{k} + 1.2 * (0.25 + 0.75 * size / avgsize))" for k in range(2))}), 6) as rank from g, st where f0 > 0 or f1 > 0"""
)
def column_search(s, d):
    return _top(search.match(table(s, d, "articles"), ["title", "body"], "title : వె* OR - title : ^మా", ["id"]))


@registered(_rank_sql(ARTICLE_FIELDS, AR, "a", "id", [(["వెన్నెల"], False), (["మా", "తాత"], False), (["కిటి"], True)], "f0 > 0 and (f1 > 0 or f2 > 0)", None))
def indexed_search(s, d):
    """The articles' postings, stored once in order of terms, and a search that reads those of its terms only."""
    path = f"{checkpoint_dir(s)}/articles-index-{uuid.uuid4().hex}"
    search.store_index(articles(s, d), "id", ARTICLE_FIELDS, path)
    return search.match_index(s, path, 'వెన్నెల AND ("మా తాత" OR కిటి*)').select(F.col("doc").alias("id"), F.round("rank", 6).alias("rank"))


@registered(
    f"""with {AR}, g as (select id, greatest(length(coalesce(body, '')) - 2, 0) as size, {", ".join(f"len(string_split(lower(coalesce(body, '')), '{w}')) - 1 as f{k}" for k, w in enumerate(("తాతక", "కిటికీ లో", "నీరు")))} from a),
        st as (select count(*) as n, avg(size) as avgsize, {", ".join(f"sum((f{k} > 0)::int) as n{k}" for k in range(3))} from g)
        select id, round(-({" + ".join(f"(case when ln((n - n{k} + 0.5) / (n{k} + 0.5)) <= 0 then 0.000001 else ln((n - n{k} + 0.5) / (n{k} + 0.5)) end) * f{k} * 2.2 / (f{k} + 1.2 * (0.25 + 0.75 * size / avgsize))" for k in range(3))}), 6) as rank from g, st where (f0 > 0 or f1 > 0) and not f2 > 0"""
)
def substring_boolean_search(s, d):
    return _top(search.substring_match(table(s, d, "articles"), "body", '(తాతక OR "కిటికీ లో" OR మా) NOT నీరు', ["id"]))


@registered(f"with {AR} select id, 0.0::double as rank from a where {ASCII('body')} like '%no.%' or {ASCII('title')} like '%no.%'")
def body_fallback_search(s, d):
    return _top(search.substring_or_like(table(s, d, "articles"), "body", "No.", ["body", "title"], ["id"]))


@registered(
    f"""with {ED}, r as ({_rank_sql(["full_text"], PG, "p", "id", [(["కిటికీ"], False)], "f0 > 0", 10)})
        select r.id, e.title as edition_title, e.publish_year, x.page_number, r.rank from r join (select distinct id, edition_id, page_number from pages) x using (id) join e on e.id = x.edition_id"""
)
def page_hits(s, d):
    return Archive.open(s, d).search("కిటికీ").select("id", "edition_title", "publish_year", "page_number", F.round("rank", 6).alias("rank"))


@registered(
    f"""with {ED}, {AR}, r as ({_rank_sql(ARTICLE_FIELDS, AR, "a", "id", [(["వెన్నెల"], False), (["ముచ్చట్లు"], False)], "f0 > 0 and f1 > 0", None)})
        select r.id, a.title, e.title as edition_title, a.start_page, r.rank from r join a using (id) join e on e.id = a.edition_id
        where e.publish_year between 1990 and 2015 and {ASCII("a.authors_json")} like '%రావు%' order by r.rank, r.id limit 20"""
)
def article_hits(s, d):
    found = Archive.open(s, d).search_articles("వెన్నెల ముచ్చట్లు", author="రావు", exact=True, first=1990, last=2015)
    return found.select("id", "title", "edition_title", "start_page", F.round("rank", 6).alias("rank"))


@registered(
    f"""with {ED}, {AR}, {CE}, r as ({_rank_sql(["text"], CE, "c", "id", [(["వెన్"], True)], "f0 > 0", None)})
        select r.id, c.kind, c.text, e.title as edition_title, a.title as article_title, r.rank from r join c using (id) join e on e.id = c.edition_id left join a on a.id = c.article_id and a.edition_id = c.edition_id
        where c.kind = 'series' order by r.rank, r.id limit 30"""
)
def catalog_hits(s, d):
    return Archive.open(s, d).search_catalog("వెన్", kind="series").select("id", "kind", "text", "edition_title", "article_title", F.round("rank", 6).alias("rank"))


# Tables


@registered(f"with {ED} select id, title, flags_json from e")
def latest_editions(s, d):
    return editions(s, d).select("id", "title", "flags_json")


@registered(f"with {ED} select id, case when publish_year < 2000 then 'old' else title end as title from e")
def upserted_editions(s, d):
    base = editions(s, d).select("id", "title", "publish_year")
    batch = base.where("publish_year < 2000").withColumn("title", F.lit("old"))
    return tables.upsert(base, batch, ["id"]).select("id", "title")


@registered(f"with {ED}, {AR} select a.id, a.edition_id from a where a.edition_id not in (select id from e where publish_year >= 2000)")
def articles_after_delete(s, d):
    gone = editions(s, d).where("publish_year >= 2000").select(F.col("id").alias("edition_id"))
    return tables.delete(articles(s, d), gone, ["edition_id"]).select("id", "edition_id")


@registered(f"with {AR} select id, case when confidence < 0.5 then 'edited' else title end as title, case when confidence < 0.5 then 1.0 else confidence end as confidence, start_page from a")
def edited_articles(s, d):
    base = articles(s, d)
    edits = base.where("confidence < 0.5").select("id", "edition_id", F.lit("edited").alias("title"), F.lit(1.0).alias("confidence"), F.lit(-1).alias("start_page"))
    return tables.apply_edits(base, edits, ["id", "edition_id"]).select("id", "title", "confidence", "start_page")


@registered(f"with {CE} select id, edition_id || '-cat-' || case when length(n::varchar) < 4 then lpad(n::varchar, 4, '0') else n::varchar end as entry_id from (select *, row_number() over (partition by edition_id order by id) as n from c)")
def catalog_ids(s, d):
    return segment.catalogue_ids(entries(s, d), ["id"]).select("id", "entry_id")


@registered(f"with {ED}, {AR} select e.id, count(a.id) as articles, count(case when coalesce(a.review_flags_json, '') like '%needs_review%' then 1 end) as to_review from e left join a on a.edition_id = e.id group by e.id")
def batch_summary(s, d):
    a = articles(s, d).groupBy("edition_id").agg(F.count("*").alias("articles"), F.count_if(F.coalesce("review_flags_json", F.lit("")).contains("needs_review")).alias("to_review"))
    joined = editions(s, d).select(F.col("id")).join(a.withColumnRenamed("edition_id", "id"), "id", "left")
    return joined.select("id", F.coalesce("articles", F.lit(0)).alias("articles"), F.coalesce("to_review", F.lit(0)).alias("to_review"))


# Segmentation

BLOCK_SQL = f"""with {PG}, l as (select id as page_id, edition_id, page_number, from_json(blocks_json, '[{{"block_no":"INTEGER","bbox":["DOUBLE"],"type":"VARCHAR","text":"VARCHAR","alignment":"VARCHAR","reading_order":"INTEGER"}}]') as bs from p),
    b as (select page_id, edition_id, page_number, i - 1 as "at", bs[i].text as text, bs[i].type as type, bs[i].alignment as alignment, bs[i].bbox[1] as x0, bs[i].bbox[2] as y0, bs[i].bbox[3] as x1, bs[i].bbox[4] as y1
      from (select *, unnest(range(1, len(bs) + 1)) as i from l))"""


@registered(
    BLOCK_SQL
    + f"""select kind, count(*) as blocks from (select case when abs((x0 + x1) / 2 - 300) < 40 and short then 'heading' when x0 > 330 and x1 > 450 and short then 'right_subheading' else 'paragraph' end as kind
        from (select *, len(string_split(text, chr(10))) <= 2 and length({STRIP("text")}) < 60 as short from b)) group by kind"""
)
def block_kinds(s, d):
    b = segment.page_blocks(table(s, d, "pages"))
    return b.groupBy(segment.block_kind(F.col("x0"), F.col("x1"), F.col("text")).alias("kind")).agg(F.count("*").alias("blocks"))


@registered(
    BLOCK_SQL
    + """select page_id, "at", row_number() over (partition by page_id order by case when n >= 4 and l >= 2 and n - l >= 2 then 1 - is_left else 0 end, y0, x0, "at") - 1 as "order"
        from (select *, count(*) over (partition by page_id) as n, sum(is_left) over (partition by page_id) as l from (select *, case when (x0 + x1) / 2 < 275 then 1 else 0 end as is_left from b))"""
)
def reading_orders(s, d):
    return segment.reading_order(segment.page_blocks(table(s, d, "pages"))).select("page_id", "at", "order")


@registered(BLOCK_SQL + "select page_id, count(*) as kept from b where not (y1 < 0.12 * 842.0 or y0 > 0.92 * 842.0) group by page_id")
def blocks_outside_bands(s, d):
    return segment.drop_bands(segment.page_blocks(table(s, d, "pages"))).groupBy("page_id").agg(F.count("*").alias("kept"))


@registered(
    f"""with {ED}, {AR} select id, case when later is not null then greatest(start_page, later - 1) else total_pages end as end_page
        from (select a.id, start_page, total_pages, lead(start_page) over (partition by edition_id order by start_page, a.id) as later
        from a join (select id as eid, total_pages from e) on a.edition_id = eid where start_page is not null)"""
)
def page_ranges(s, d):
    from pyspark.sql import Window

    e = editions(s, d).select(F.col("id").alias("edition_id"), "total_pages")
    a = articles(s, d).where("start_page is not null").select("id", "edition_id", "start_page").join(e, "edition_id")
    placed = a.withColumn("position", F.row_number().over(Window.partitionBy("edition_id").orderBy("start_page", "id")))
    return segment.page_ends(placed).select("id", "end_page")


@registered(
    BLOCK_SQL
    + f""", {AR} select a.id, count(*) as blocks, sum(length(b.text)) as characters from a join b on a.edition_id = b.edition_id and b.page_number between a.start_page and a.end_page group by a.id"""
)
def blocks_by_article(s, d):
    joined = segment.blocks_of_articles(segment.page_blocks(table(s, d, "pages")), articles(s, d))
    return joined.groupBy(F.col("article_id").alias("id")).agg(F.count("*").alias("blocks"), F.sum(F.length("text")).alias("characters"))


@registered(
    f"""with {PG}, sc as (select edition_id, page_number, {" + ".join(f"(case when contains(coalesce(full_text, ''), '{m}') then 3 else 0 end)" for m in T.TOC_MARKERS)}
        + least(10, len(list_filter(string_split(coalesce(full_text, ''), chr(10)), lambda x: regexp_matches(x, '^[\\s\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]*\\p{{Nd}}+\\s*[.]')))) as score from p)
        select edition_id, page_number, score from (select *, max(score) over (partition by edition_id) as best from sc where score >= 6) where score >= best - 2"""
)
def contents_pages(s, d):
    return segment.contents_pages(table(s, d, "pages"))


@registered(
    f"""with {PG} select id, try_cast(translate(regexp_extract(full_text, 'సంపుటి\\s*(\\p{{Nd}}+)', 1), '౦౧౨౩౪౫౬౭౮౯', '0123456789') as int) as volume,
        try_cast(translate(regexp_extract(full_text, 'సంచిక\\s*(\\p{{Nd}}+)', 1), '౦౧౨౩౪౫౬౭౮౯', '0123456789') as int) as issue from p where contains(full_text, 'సంపుటి') or contains(full_text, 'సంచిక')"""
)
def volumes_and_issues(s, d):
    volume, issue = T.volume_issue(F.col("full_text"))
    return pages(s, d).where(F.col("full_text").contains("సంపుటి") | F.col("full_text").contains("సంచిక")).select("id", volume.alias("volume"), issue.alias("issue"))


@registered(
    f"""with {CE}, h as (select c.id, c.text, (select arg_min(series_name, -length(series_name) * 1000 + series_id) from series_catalog where contains(c.text, series_name)) as series_name from c)
        select id, series_name, try_cast(coalesce(nullif(regexp_extract(text, '(?:సంచిక|సంఖ్య|no\\.?|#)\\s*(\\d+)', 1), ''), nullif(regexp_extract({STRIP("replace(text, series_name, '')")}, '(\\d+)\\s*$', 1), '')) as int) as number
        from h where series_name is not null"""
)
def series_in_catalog(s, d):
    return segment.series_in_text(entries(s, d).select("id", "text"), table(s, d, "series_catalog")).select("id", "series_name", "number")


@registered(
    f"""with {PG}, l as (select id, unnest(string_split(coalesce(full_text, ''), chr(10))) as x, generate_subscripts(string_split(coalesce(full_text, ''), chr(10)), 1) as i from p),
        k as (select id, {STRIP("x")} as x, i from l), n as (select *, row_number() over (partition by id order by i desc) as back from k where x <> ''),
        m as (select distinct id, regexp_replace(regexp_replace({STRIP("x")}, '^[-–—\\s]+', ''), '^[ .,–—-]+|[ .,–—-]+$', '', 'g') as name from n where back <= 12 and regexp_matches(x, '^[-–—]{{1,2}}\\s*[^\\n\\-–—]{{2,60}}$'))
        select id, name, 0.85::double as confidence from m where length(name) between 2 and 50 and not regexp_matches(name, '(?i)ఇంకావుంది|నీతి|భావం|Printed|Published|సంపాదక|జవాబు|క్విజ్')
        and not regexp_matches(name, '^\\p{{Nd}}+$') and name not in ('వినోదం', 'విజ్ఞానం', 'భావం')"""
)
def trailing_authors(s, d):
    return segment.trailing_authors(table(s, d, "pages"), F.col("full_text")).withColumn("confidence", F.col("confidence").cast("double"))


@registered(
    f"""with {AR}, n as (select id, unnest(from_json(authors_json, '["VARCHAR"]')) as name, coalesce(confidence, 0.7) as confidence, 'listed' as source, 1 as s from a union all
        select article_id, text, 0.75, 'layout', 0 from (select distinct * from catalog_entries) where kind = 'author' and article_id is not null and text is not null)
        select id, name, source, confidence from (select *, row_number() over (partition by id, name order by confidence desc, s) as r from n) where r = 1"""
)
def best_authors(s, d):
    listed = articles(s, d).select("id", F.explode(F.from_json("authors_json", "array<string>")).alias("name"), F.lit("listed").alias("source"), F.coalesce("confidence", F.lit(0.7)).alias("confidence"))
    layout = entries(s, d).where("kind = 'author' and article_id is not null and text is not null").select(F.col("article_id").alias("id"), F.col("text").alias("name"), F.lit("layout").alias("source"), F.lit(0.75).cast("double").alias("confidence"))
    return segment.best_authors(layout, listed)


# Quality


@registered(
    f"""with {PG} select id, length(t) as char_count, len(regexp_extract_all(t, '{T.LATIN_LEFT}')) as latin_leftover_count,
        len(regexp_extract_all(t, '{T.CONSONANT}{T.FREE_VOWEL}')) + len(regexp_extract_all(t, '{T.CONSONANT}[\\s\\x{{0B}}]+{T.SIGN}')) + len(regexp_extract_all(t, '{T.CONSONANT}[\\s\\x{{0B}}]+్{T.CONSONANT}')) as split_matra_count
        from (select id, coalesce(full_text, '') as t from p)"""
)
def page_glyphs(s, d):
    return quality.page_quality(table(s, d, "pages")).select("id", "char_count", "latin_leftover_count", "split_matra_count")


@registered(
    f"""with {PG}, g as (select edition_id, length(t) as c, len(regexp_extract_all(t, '{T.LATIN_LEFT}')) as l,
        len(regexp_extract_all(t, '{T.CONSONANT}{T.FREE_VOWEL}')) + len(regexp_extract_all(t, '{T.CONSONANT}[\\s\\x{{0B}}]+{T.SIGN}')) + len(regexp_extract_all(t, '{T.CONSONANT}[\\s\\x{{0B}}]+్{T.CONSONANT}')) as m
        from (select edition_id, coalesce(full_text, '') as t from p)), k as (select edition_id, count(*) as pages, sum(c) as c, sum(l) as l, sum(m) as m from g group by edition_id)
        select edition_id, pages, c::bigint as char_count, l::bigint as latin_leftover_count, m::bigint as split_matra_count, (c > 0 and l / c > 0.02)::int + 2 * (c > 0 and m / c > 0.005)::int as flag_bits from k"""
)
def edition_quality(s, d):
    q = quality.edition_quality(quality.page_quality(table(s, d, "pages")))
    bits = F.array_contains("flags", "unmapped_glyph").cast("int") + 2 * F.array_contains("flags", "glyph_split_matra").cast("int")
    return q.select("edition_id", "pages", "char_count", "latin_leftover_count", "split_matra_count", bits.alias("flag_bits"))


@registered(
    f"""with {PG}, x as (select edition_id, unnest(regexp_extract_all(full_text, '{T.LATIN_LEFT}')) as sample from p), n as (select edition_id, sample, count(*) as n from x group by all)
        select edition_id, sample, n from (select *, row_number() over (partition by edition_id order by n desc, sample) as r from n) where r <= 20"""
)
def leftover_samples(s, d):
    return quality.leftover_samples(table(s, d, "pages"))


def _glyph_flags(body: str) -> str:
    """SQL: the names of the flags of a body, one behind the other."""
    split = " + ".join(f"len(regexp_extract_all({body}, '{x}'))" for x in (T.CONSONANT + T.FREE_VOWEL, rf"{T.CONSONANT}[\s\x{{0B}}]+{T.SIGN}", rf"{T.CONSONANT}[\s\x{{0B}}]+్{T.CONSONANT}"))
    return f"(case when len(regexp_extract_all({body}, '{T.LATIN_LEFT}')) > 5 then 'unmapped_glyph,' else '' end || case when {split} > 2 then 'glyph_split_matra,' else '' end)"


@registered(
    f"""with {AR}, f as (select id, {_glyph_flags("coalesce(body, '')")} || case when {STRIP("coalesce(body, '')")} = '' then 'empty_body,' else '' end as f from a)
        select id, f || case when f <> '' then 'needs_review' else '' end as flags from f"""
)
def article_flags(s, d):
    return quality.article_flags(table(s, d, "articles")).select("id", F.array_join("flags", ",").alias("flags"))


@registered(
    f"""with {AR}, g as (select id, confidence, length(regexp_replace(coalesce(title, ''), '[^ఀ-౿]', '', 'g')) as dm, length(regexp_replace(coalesce(body, ''), '[^ఀ-౿]', '', 'g')) as om,
        list_distinct(regexp_extract_all(coalesce(body, ''), '[A-Za-zఀ-౿]{{2,}}')) as ow, list_distinct(regexp_extract_all(coalesce(title, ''), '[A-Za-zఀ-౿]{{2,}}')) as dw from a)
        select id, dm as decoded_mass, om as other_mass, len(list_filter(ow, lambda x: not list_contains(dw, x))) as missing_words, len(list_filter(dw, lambda x: not list_contains(ow, x))) as extra_words,
        (om > 40 and dm / om < 0.55) as low from g"""
)
def reading_agreement(s, d):
    a = articles(s, d).select("id", "title", "body")
    r = quality.reading_agreement(a, "title", "body")
    missing = F.size(F.array_except(T.word_set(F.col("body")), T.word_set(F.col("title"))))
    extra = F.size(F.array_except(T.word_set(F.col("title")), T.word_set(F.col("body"))))
    return r.select("id", "decoded_mass", "other_mass", missing.alias("missing_words"), extra.alias("extra_words"), (F.size("flags") > 0).alias("low"))


@registered(
    BLOCK_SQL + "select page_number % 2 = 1 as odd, median(x0) as left_pad, median(x1 - x0) as width, count(*) as blocks from b group by odd"
)
def page_measures(s, d):
    b = segment.page_blocks(table(s, d, "pages"))
    return b.groupBy((F.col("page_number") % 2 == 1).alias("odd")).agg(F.median("x0").alias("left_pad"), F.median(F.col("x1") - F.col("x0")).alias("width"), F.count("*").alias("blocks"))


@registered(
    f"""with {PG}, r as (select id, nfc_normalize(full_text) as t from p where full_text is not null), """
    + ", ".join(
        f"""r{k} as (select id, regexp_replace(regexp_replace(t, '({T.CONSONANT})[ \\x{{A0}}\\x{{200B}}\\x{{200C}}\\x{{200D}}]+(్{T.CONSONANT})', '\\1\\2', 'g'), '({T.CONSONANT}(?:్{T.CONSONANT})*)[ \\x{{A0}}\\x{{200B}}]+({T.SIGN})', '\\1\\2', 'g') as t from r{k - 1 if k > 1 else ""})"""
        for k in range(1, 6)
    )
    + " select id, md5("
    + "replace(" * len(T.WORD_FIXES)
    + "t"
    + "".join(f", '{a}', '{b}')" for a, b in T.WORD_FIXES)
    + ") as digest from r5"
)
def repaired_pages(s, d):
    return pages(s, d).where("full_text is not null").select("id", F.md5(T.repair_telugu(F.col("full_text"))).alias("digest"))
