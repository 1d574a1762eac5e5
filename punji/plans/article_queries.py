"""Queries that build articles and catalogue entries, measure layout and read file names, each beside the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punji.functions import geometry as G
from punji.functions import text as T
from punji.operators import articles as A
from punji.operators import catalog, quality, segment
from punji.plans.archive_queries import AR, BLOCK_SQL, CE, ED, PG, STRIP, _glyph_flags, articles, editions, entries, registered
from punji.runtime import table

WS = r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


# Pieces of SQL


def _noise(t: str) -> str:
    months = "|".join(segment.MONTHS)
    return (
        f"(case when {t} = '' then true when starts_with({t}, 'సంపుటి') then length({t}) < 20 else (starts_with({t}, 'సంచిక') and length({t}) < 20) "
        f"or (contains({t}, '{segment.MASTHEAD}') and length({t}) < 40 and not contains({t}, chr(10))) or regexp_matches({t}, '^({months})[{WS}]+\\p{{Nd}}{{4}}$') end)"
    )


def _repair(t: str) -> str:
    out = f"nfc_normalize({t})"
    for _ in range(5):
        out = f"regexp_replace({out}, '({T.CONSONANT})[ \\x{{A0}}\\x{{200B}}\\x{{200C}}\\x{{200D}}]+(్{T.CONSONANT})', '\\1\\2', 'g')"
        out = f"regexp_replace({out}, '({T.CONSONANT}(?:్{T.CONSONANT})*)[ \\x{{A0}}\\x{{200B}}]+({T.SIGN})', '\\1\\2', 'g')"
    for wrong, right in T.WORD_FIXES:
        out = f"replace({out}, '{wrong}', '{right}')"
    return out


def _bodies(held: str, key: str) -> str:
    """CTEs from ``held`` (key, page_number, at, u: a block's stripped text) to ``bodies`` (key, body)."""
    return f"""{held}2 as (select *, coalesce(list_position(list_transform(string_split(u, chr(10)), lambda l: {_noise(STRIP("l"))}), false), 0) as first_line from {held} where not {_noise("u")}),
        {held}3 as (select *, case when first_line = 0 then '' else {STRIP("array_to_string(string_split(u, chr(10))[first_line:], chr(10))")} end as rest from {held}2),
        bodies as (select {key}, string_agg({_repair("rest")}, chr(10) || chr(10) order by page_number, "at") as body from {held}3 where rest <> '' and not {_noise("rest")} group by {key})"""


def _clean(x: str) -> str:
    return f"regexp_replace(regexp_replace({STRIP(x)}, '^[-–—{WS}]+', ''), '^[ .,–—-]+|[ .,–—-]+$', '', 'g')"


PLAUSIBLE = "length(name) between 2 and 50 and not regexp_matches(name, '(?i)ఇంకావుంది|నీతి|భావం|Printed|Published|సంపాదక|జవాబు|క్విజ్') and not regexp_matches(name, '^\\p{Nd}+$') and name not in ('వినోదం', 'విజ్ఞానం', 'భావం')"
BEHIND = r"[-–—]{1,2}\s*((?:శ్రీమతి|శ్రీ|సా\.?|డా\.?|కుమారి)?\s*[\x{C01}-\x{C7F}A-Za-z. ]{2,40})\s*\.?\s*$"
IN_TITLE = r"(?:\.{2,}|…)\s*((?:శ్రీమతి|శ్రీ|డా\.?|సా\.?)[^.]{2,40})$"
CONTENTS = (
    "cs as (select edition_id, page_number, "
    + " + ".join(f"(case when contains(coalesce(full_text, ''), '{m}') then 3 else 0 end)" for m in T.TOC_MARKERS)
    + rf" + least(10, len(list_filter(string_split(coalesce(full_text, ''), chr(10)), lambda x: regexp_matches(x, '^[\s\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{205F}}\x{{3000}}]*\p{{Nd}}+\s*[.]')))) as score from p),"
    " cp as (select edition_id, page_number, score from (select *, max(score) over (partition by edition_id) as best from cs where score >= 6) where score >= best - 2)"
)
LAYOUT = f"""lo as (select page_id, edition_id, page_number, count(*) as "raw", count(case when y1 < 0.12 * 842.0 or y0 > 0.92 * 842.0 then 1 end) as dropped,
        count(case when not (y1 < 0.12 * 842.0 or y0 > 0.92 * 842.0) and {STRIP("coalesce(text, '')")} <> '' then 1 end) as kept from b group by page_id, edition_id, page_number)"""
SLUG = (
    "format('{:02d}_{}', coalesce(toc_index, 0), coalesce(nullif(substr(regexp_replace("
    + STRIP("regexp_replace(coalesce(title, ''), '[<>:\"/\\\\|?*]', '', 'g')")
    + f", '[{WS}]+', '_', 'g'), 1, 60), ''), 'article'))"
)


# Contents


@registered(
    rf"""with recursive {PG}, {CONTENTS}, q as (select edition_id, page_number, list_filter(list_transform(string_split(coalesce(full_text, ''), chr(10)), lambda x: {STRIP("x")}), lambda x: x <> '') as ls from p join cp using (edition_id, page_number)),
        st as (select *, unnest(range(1, len(ls) + 1)) as k from q), ln as (select edition_id, page_number, k, ls[k] as one, coalesce(ls[k + 1], '') as two, coalesce(ls[k + 2], '') as three from st),
        kd as (select *, case when regexp_replace(one, '[ .]+$', '') in ('క్రమసంఖ్య', 'విషయాలు', 'పుట సంఖ్య', 'ఈ సంచికలో', 'విషయసూచిక') or starts_with(one, 'సంపుటి') or starts_with(one, 'సంచిక') or contains(one, 'మాసపత్రిక')
            or (length(one) < 40 and ({" or ".join(f"contains(one, '{m}')" for m in segment.MONTHS)})) then 0
          when regexp_full_match(one, '(\p{{Nd}}+)[{WS}]*[.،]?[{WS}]*(.+?)[{WS}]*(?:\.+|[{WS}]{{2,}})[{WS}]*(\p{{Nd}}+)') then 1
          when regexp_full_match(one, '(\p{{Nd}}+)[{WS}]*[.،]?[{WS}]*(.+)') and regexp_full_match(two, '\p{{Nd}}{{1,3}}')
            and regexp_replace(regexp_replace(regexp_extract(one, '^(\p{{Nd}}+)[{WS}]*[.،]?[{WS}]*(.+)$', 2), '[{WS}]+', ' ', 'g'), '^[ .…]+|[ .…]+$', '', 'g') <> '' then 2
          when regexp_full_match(one, '(\p{{Nd}}{{1,2}})[{WS}]*[.،]?') and length(two) > 1 and not regexp_full_match(two, '\p{{Nd}}{{1,3}}') and not regexp_full_match(two, '(\p{{Nd}}{{1,2}})[{WS}]*[.،]?')
            and regexp_full_match(three, '\p{{Nd}}{{1,3}}') and cast(translate(three, '౦౧౨౩౪౫౬౭౮౯', '0123456789') as int) <= 200 then 3 else 0 end as kind from ln),
        w as (select edition_id, page_number, 1::bigint as k from q union all select kd.edition_id, kd.page_number, kd.k + greatest(kd.kind, 1) from w join kd on w.edition_id = kd.edition_id and w.page_number = kd.page_number and w.k = kd.k),
        v as (select kd.* from kd join w using (edition_id, page_number, k) where kind > 0 ),
        f as (select edition_id, page_number, k, kind, regexp_extract(one, '^(\p{{Nd}}+)', 1) as n1,
          case kind when 1 then regexp_extract(one, '^(\p{{Nd}}+)[{WS}]*[.،]?[{WS}]*(.+?)[{WS}]*(?:\.+|[{WS}]{{2,}})[{WS}]*(\p{{Nd}}+)$', 2) when 2 then regexp_extract(one, '^(\p{{Nd}}+)[{WS}]*[.،]?[{WS}]*(.+)$', 2) else two end as t,
          case kind when 1 then regexp_extract(one, '^(\p{{Nd}}+)[{WS}]*[.،]?[{WS}]*(.+?)[{WS}]*(?:\.+|[{WS}]{{2,}})[{WS}]*(\p{{Nd}}+)$', 3) when 2 then two else three end as pg from v)
        select edition_id, page_number, (row_number() over (partition by edition_id, page_number order by k) - 1)::int as position, cast(translate(n1, '౦౧౨౩౪౫౬౭౮౯', '0123456789') as int) as toc_index,
          regexp_replace(regexp_replace(t, '[{WS}]+', ' ', 'g'), '^[ .…]+|[ .…]+$', '', 'g') as title, cast(translate(pg, '౦౧౨౩౪౫౬౭౮౯', '0123456789') as int) as start_page from f"""
)
def contents_entries(s: SparkSession, d: str) -> DataFrame:
    return segment.parse_contents(table(s, d, "pages"))


@registered(
    BLOCK_SQL
    + f""", {AR}, h as (select a.id as article_id, a.edition_id, b.page_number, b."at", {STRIP("b.text")} as u from a join b on a.edition_id = b.edition_id and b.page_number between a.start_page and a.end_page),
        {_bodies("h", "article_id, edition_id")} select article_id, edition_id, md5(body) as digest, length(body) as characters from bodies"""
)
def article_bodies(s, d):
    built = segment.article_bodies(segment.page_blocks(table(s, d, "pages")), articles(s, d))
    return built.select("article_id", "edition_id", F.md5("body").alias("digest"), F.length("body").alias("characters"))


@registered(
    "with t as (select distinct title from articles where title is not null), "
    + f"""m as (select title, ({" or ".join(f"contains(title, '{m}')" for m in T.SERIAL)}) as serial, regexp_replace(regexp_extract(title, '^((?s:.*?))(?:\\.{{2,}}|\\(|$)', 1), '^[ .]+|[ .]+$', '', 'g') as base from t)
        select title, case when serial then coalesce(nullif(base, ''), title) else coalesce({", ".join(f"case when contains(title, '{c}') then '{c}' end" for c in T.COLUMNS)}) end as series from m"""
)
def detected_series(s, d):
    return table(s, d, "articles").select("title").where("title is not null").distinct().select("title", T.detect_series(F.col("title")).alias("series"))


_NAMED_SERIES = "(select arg_min(series_name, alias) from series_aliases where alias <> '' and contains(coalesce(nullif({x}.series, ''), {x}.title, ''), alias))"


@registered(f"with {AR} select id, coalesce({_NAMED_SERIES.format(x='a')}, series) as series from a")
def normal_series(s, d):
    return A.normal_series(table(s, d, "articles").select("id", "title", "series"), table(s, d, "series_aliases")).select("id", "series").distinct()


# The article builder

_BUILT = (
    BLOCK_SQL
    + f""", {ED}, {AR}, {CONTENTS}, {LAYOUT}, gp as (select distinct edition_id, page_number from lo where kept / greatest("raw" - dropped, 1) < 0.75 and "raw" > 10),
    tp as (select e.id as edition_id, e.title, coalesce(nullif(e.total_pages, 0), n.n, 0) as total from e left join (select edition_id, count(*) as n from p group by edition_id) n on n.edition_id = e.id),
    en as (select edition_id, title, series, toc_index, start_page, row_number() over (partition by edition_id order by start_page, id) as position from a where start_page is not null),
    pl as (select *, coalesce(greatest(start_page, lead(start_page) over (partition by edition_id order by position) - 1), total) as raw_end0, lead(start_page) over (partition by edition_id order by position) as later from en join (select edition_id, total from tp) using (edition_id)),
    pe as (select * exclude (raw_end0, later), case when later is null then total else raw_end0 end as raw_end from pl),
    reach as (select edition_id, total, min(start_page) as f, max(raw_end) as l from pe group by edition_id, total),
    sp as (select edition_id, 'article' as kind, position, title, series, toc_index, greatest(1, least(start_page, total)) as s, greatest(greatest(1, least(start_page, total)), least(raw_end, total)) as t from pe
      union all select edition_id, 'front_matter', -1, 'Edition front matter', null, 0, 1, f - 1 from reach where f > 1
      union all select edition_id, 'back_matter', 1099511627776, 'Edition back matter', null, 999, l + 1, total from reach where l < total
      union all select edition_id, 'full_edition', 0, coalesce(nullif(title, ''), 'Untitled'), null, 0, 1, total from tp where edition_id not in (select edition_id from en)),
    pgs as (select edition_id, kind, position, unnest(range(s, t + 1)) as page_number from sp where t >= s),
    hb as (select pgs.edition_id, pgs.kind, pgs.position, pgs.page_number, b."at", b.type, b.x0, {STRIP("b.text")} as u from pgs join b on b.edition_id = pgs.edition_id and b.page_number = pgs.page_number
      left join cp on cp.edition_id = pgs.edition_id and cp.page_number = pgs.page_number where (cp.page_number is null or kind = 'front_matter') and b.text is not null),
    {_bodies("hb", "edition_id, kind, position")},
    wb as (select sp.*, coalesce(body, '') as body from sp left join bodies using (edition_id, kind, position)),
    rt as (select *, max((type = 'right_subheading')::int) over (partition by edition_id, kind, position) as typed from hb2),
    rc as (select *, row_number() over (partition by edition_id, kind, position order by page_number, "at") as k from rt where case when typed = 1 then type = 'right_subheading' else x0 > 330 and u <> '' and length(u) <= 50 and len(string_split(u, chr(10))) <= 2 end),
    bl as (select edition_id, kind, position, title, list_filter(list_transform(string_split(body, chr(10)), lambda x: {STRIP("x")}), lambda x: x <> '') as ls from wb where kind = 'article'),
    tl as (select *, unnest(range(1, len(ls) + 1)) as i from bl),
    cand as (select edition_id, position, 0 as g, k as i, {_clean("string_split(u, chr(10))[1]")} as name, 0.75 as sure, 'right_subheading' as source from rc where k <= 3 and kind = 'article'
      union all select edition_id, position, 1, i, {_clean("ls[i]")}, 0.85, 'trailing_dash' from tl where i > len(ls) - 12 and regexp_matches(ls[i], '^[-–—]{{1,2}}[\\s\\x{{0B}}]*[^\\n\\-–—]{{2,60}}$')
      union all select edition_id, position, 2, i, {_clean(f"regexp_extract(ls[i], '{BEHIND}', 1)")}, 0.8, 'trailing_dash' from tl where i > len(ls) - 4 and regexp_matches(ls[i], '^[-–—]') and regexp_matches(ls[i], '{BEHIND}')
      union all select edition_id, position, 3, 1, {_clean(f"regexp_extract({STRIP('title')}, '{IN_TITLE}', 1)")}, 0.7, 'toc_title' from bl where title is not null),
    cn as (select *, row_number() over (partition by edition_id, position order by g, i) as o from cand where {PLAUSIBLE}),
    nm as (select edition_id, position, name, min(o) as o, arg_min(source, (-sure, o)) as source, max(sure) as sure from cn group by edition_id, position, name),
    au as (select edition_id, position, string_agg(name || '/' || source, '|' order by o) as authors from nm group by edition_id, position),
    fl as (select wb.*, case when wb.kind = 'article' then coalesce(authors, '') else '' end as authors, case when wb.kind = 'article' then {_glyph_flags("body")}
      || case when exists (select 1 from gp where gp.edition_id = wb.edition_id and gp.page_number between wb.s and wb.t) then 'layout_gap,' else '' end || case when {STRIP("body")} = '' then 'empty_body,' else '' end else '' end as flags
      from wb left join au on au.edition_id = wb.edition_id and au.position = wb.position and wb.kind = 'article')
    """
)


@registered(
    _BUILT
    + f"""select edition_id, case kind when 'article' then {SLUG} when 'front_matter' then '00_front_matter' when 'back_matter' then '99_back_matter' else '00_full_edition' end as article_id, kind, title, s::int as start_page, t::int as end_page,
        case when kind = 'article' then coalesce({_NAMED_SERIES.format(x='fl')}, series) end as series, toc_index, authors, md5(body) as digest, case when kind = 'article' and contains(body, 'ఇంకావుంది') then 'continued_marker' end as continuation_of,
        (case kind when 'article' then case when contains(flags, 'empty_body') then 0.2 when flags <> '' then 0.55 else 0.9 end when 'front_matter' then 0.85 when 'back_matter' then 0.7 else 0.3 end)::double as confidence,
        case when kind = 'full_edition' then 'needs_review,toc_parse_failed' when flags <> '' then flags || 'needs_review' else '' end as review_flags
        from fl where not (kind = 'back_matter' and {STRIP("body")} = '')"""
)
def built_articles(s, d):
    pages = table(s, d, "pages")
    blocks = segment.page_blocks(pages)
    at = F.row_number().over(Window.partitionBy("edition_id").orderBy("start_page", "id"))
    listed = articles(s, d).where("start_page is not null").select("id", "edition_id", "title", "series", "toc_index", "start_page").withColumn("position", at.cast("long")).drop("id")
    held = pages.select("id", "edition_id").distinct().groupBy("edition_id").agg(F.count("*").cast("int").alias("n"))
    known = editions(s, d).select(F.col("id").alias("edition_id"), "title", "total_pages").join(held, "edition_id", "left").select("edition_id", "title", F.coalesce(F.nullif("total_pages", F.lit(0)), "n", F.lit(0)).alias("total_pages"))
    built = A.build_articles(listed, blocks, known, table(s, d, "series_aliases"), segment.contents_pages(pages), quality.page_layout(blocks).where("gap"))
    named = F.array_join(F.transform("author_sources", lambda a: F.concat(a["name"], F.lit("/"), a["source"])), "|")
    return built.select(
        "edition_id", "article_id", "kind", "title", "start_page", "end_page", "series", "toc_index", named.alias("authors"), F.md5("body").alias("digest"), "continuation_of", "confidence", F.array_join("review_flags", ",").alias("review_flags"),
    )


@registered(
    f"""with {AR}, {ED}, k as (select a.edition_id, start_page, row_number() over (partition by a.edition_id order by start_page, a.id) as position, total_pages from a join (select id as eid, total_pages from e) on eid = a.edition_id where start_page is not null)
        select edition_id, count(*) as articles, min(start_page) as first_page, max(case when later is null then total_pages else greatest(start_page, later - 1) end) as last_page
        from (select *, lead(start_page) over (partition by edition_id order by position) as later from k) group by edition_id"""
)
def edition_reach(s, d):
    at = F.row_number().over(Window.partitionBy("edition_id").orderBy("start_page", "id"))
    rows = articles(s, d).where("start_page is not null").select("id", "edition_id", "start_page").withColumn("position", at)
    placed = segment.page_ends(rows.join(editions(s, d).select(F.col("id").alias("edition_id"), "total_pages"), "edition_id"))
    return placed.groupBy("edition_id").agg(F.count("*").alias("articles"), F.min("start_page").alias("first_page"), F.max("end_page").alias("last_page"))


# The catalogue

_MATCHED = "(select arg_min(series_name, -length(series_name) * 1000 + series_id) from series_catalog where series_name <> '' and contains(sc.u, series_name))"


@registered(
    BLOCK_SQL
    + f""", {AR}, o as (select edition_id, id as article_id, {STRIP("coalesce(title, '')")} as title, start_page, end_page, series, coalesce(from_json(authors_json, '["VARCHAR"]'), []) as authors, row_number() over (partition by edition_id order by id) as ord from a),
    s0 as (select o.*, b."at", b.type, {STRIP("coalesce(b.text, '')")} as u, coalesce(b.alignment, 'left') as al, b.y0 as y from o join b on b.edition_id = o.edition_id and b.page_number = o.start_page),
    s1 as (select *, min(case when type = 'heading' or (al = 'center' and title <> '' and contains(u, substr(title, 1, 8))) then "at" end) over (partition by edition_id, article_id) as head_at from s0),
    sc as (select * from (select *, max(case when "at" = head_at then y end) over (partition by edition_id, article_id) as hy from s1) where u <> '' and length(u) <= 80),
    r0 as (select *, {STRIP("string_split(u, chr(10))[1]")} as line from sc where (type = 'right_subheading' or al = 'right') and not list_contains(authors, u) and length(u) < 50),
    r1 as (select *, min("at") over (partition by edition_id, article_id, line) as known from r0),
    m0 as (select *, {_MATCHED} as name from sc), m1 as (select *, coalesce(y < hy - 2, false) as above from m0 where name is not null),
    m2 as (select *, row_number() over (partition by edition_id, article_id, name order by "at") as k from m1 where (above or al in ('left', 'center')) and name is distinct from series),
    n as (select edition_id, article_id, ord, 0 as step, 0 as seq, 'heading' as kind, title as text, start_page as page, 'center' as alignment, 'toc' as source, null::int as series_number from o where title <> ''
      union all select edition_id, article_id, ord, 1, 0, 'series', series, start_page, 'center', 'toc_or_alias', null from o where series <> ''
      union all select edition_id, article_id, ord, 2, i, 'author', authors[i], coalesce(nullif(end_page, 0), start_page), 'right', 'autotag', null from (select *, unnest(range(1, len(authors) + 1)) as i from o)
      union all select edition_id, article_id, ord, 3, "at" * 2, 'author', line, start_page, 'right', 'layout_right', null from r1 where contains(u, chr(10)) or known = "at"
      union all select edition_id, article_id, ord, 3, "at" * 2 + 1, 'series', name, start_page, al, case when above then 'layout_above_heading' else 'layout_match' end,
        try_cast(coalesce(nullif(regexp_extract(u, '(?:సంచిక|సంఖ్య|no\\.?|#)\\s*(\\d+)', 1), ''), nullif(regexp_extract({STRIP("replace(u, name, '')")}, '(\\d+)\\s*$', 1), '')) as int) from m2 where k = 1)
    select edition_id || '-cat-' || case when length(x::varchar) < 4 then lpad(x::varchar, 4, '0') else x::varchar end as entry_id, article_id, kind, text, page, alignment, source, series_number
    from (select *, row_number() over (partition by edition_id order by ord, article_id, step, seq) as x from n)"""
)
def emitted_catalog(s, d):
    order = F.row_number().over(Window.partitionBy("edition_id").orderBy("article_id"))
    listed = articles(s, d).select("edition_id", F.col("id").alias("article_id"), F.lit("article").alias("kind"), "title", "start_page", "end_page", "series", F.from_json("authors_json", "array<string>").alias("authors")).withColumn("order", order)
    return catalog.emit_catalog(listed, segment.page_blocks(table(s, d, "pages")), table(s, d, "series_catalog")).drop("edition_id")


@registered(f"with {CE}, k as (select *, row_number() over (partition by article_id, kind, text order by id) as n from c where article_id is not null) select id, article_id, kind, text from k where n = 1")
def first_entries(s, d):
    """An entry of an article counts where it first says what it says."""
    first = entries(s, d).where("article_id is not null").groupBy("article_id", "kind", "text").agg(F.min("id").alias("id"))
    return first.select("id", "article_id", "kind", "text")


# Layout and a second reading


@registered(
    BLOCK_SQL + f""", {LAYOUT} select page_id, "raw" as all_blocks, dropped, kept, round(1 - kept / "raw", 4) as drop_rate, round(kept / greatest("raw" - dropped, 1), 4) as kept_ratio, kept / greatest("raw" - dropped, 1) < 0.75 and "raw" > 10 as gap from lo"""
)
def page_layout(s, d):
    return quality.page_layout(segment.page_blocks(table(s, d, "pages"))).select("page_id", F.col("raw").alias("all_blocks"), "dropped", "kept", "drop_rate", "kept_ratio", "gap")


_HALF = "array_to_string(string_split(full_text, chr(10))[1:len(string_split(full_text, chr(10))) // 2 + 1], chr(10))"
_TIDY = lambda x: f"regexp_replace({STRIP(x)}, '[{WS}]+', ' ', 'g')"


@registered(
    f"""with {PG}, r as (select edition_id, page_number, {_HALF} as decoded, {_TIDY(f"coalesce({_HALF}, '')")} as x, {_TIDY("full_text")} as y from p where full_text is not null),
    q as (select *, length(regexp_replace(x, '[^ఀ-౿]', '', 'g')) as dm, length(regexp_replace(y, '[^ఀ-౿]', '', 'g')) as om, list_distinct(regexp_extract_all(x, '[A-Za-zఀ-౿]{{2,}}')) as dw, list_distinct(regexp_extract_all(y, '[A-Za-zఀ-౿]{{2,}}')) as ow from r),
    j as (select edition_id, page_number, coalesce(regexp_matches(decoded, '{T.CONSONANT}[ \\x{{A0}}\\x{{200B}}\\x{{200C}}\\x{{200D}}]+్{T.CONSONANT}'), false) as split, om > 40 and dm / om < 0.55 as low,
      list_transform(list_sort(list_transform(list_filter(ow, lambda w: not list_contains(dw, w)), lambda w: {{'l': -length(w), 'w': w}}))[1:5], lambda z: z.w) as missing from q),
    w as (select edition_id, w, count(*) as n from (select edition_id, unnest(missing) as w from j) group by edition_id, w),
    t as (select edition_id, string_agg(w, ' ' order by n desc, w) as words from (select *, row_number() over (partition by edition_id order by n desc, w) as k from w) where k <= 30 group by edition_id),
    g as (select edition_id, count(*) as pages, coalesce(string_agg(case when split then page_number end, ',' order by page_number), '') as split_pages, coalesce(string_agg(case when low then page_number end, ',' order by page_number), '') as low_pages from j group by edition_id),
    a as (select edition_id, count(case when full_text is null then 1 end) as failed from p group by edition_id),
    f as (select a.edition_id, coalesce(pages, 0) as pages, coalesce(split_pages, '') as split_virama_pages, coalesce(low_pages, '') as coverage_low_pages, coalesce(words, '') as disagreements,
      case when coalesce(split_pages, '') <> '' then 'split_virama,' else '' end || case when coalesce(low_pages, '') <> '' then 'coverage_low,' else '' end || case when failed > 0 then 'ocr_unavailable,' else '' end as flags from a left join g using (edition_id) left join t using (edition_id))
    select edition_id, pages, split_virama_pages, coverage_low_pages, disagreements, flags || case when flags <> '' then 'needs_review' else '' end as flags from f"""
)
def verified_editions(s, d):
    """The first half of each page's lines held against the whole page, as a poor reading against a good one."""
    lines = F.split("full_text", "\n", -1)
    half = F.array_join(F.slice(lines, 1, F.floor(F.size(lines) / 2).cast("int") + 1), "\n")
    readings = table(s, d, "pages").select("id", "edition_id", "page_number", half.alias("decoded"), F.col("full_text").alias("other")).dropDuplicates(["id"]).drop("id")
    text = lambda c, by: F.array_join(F.transform(c, lambda x: x.cast("string")), by).alias(c)
    return quality.verified_editions(readings).select("edition_id", "pages", text("split_virama_pages", ","), text("coverage_low_pages", ","), text("disagreements", " "), text("flags", ","))


@registered(
    BLOCK_SQL
    + f""", {ED}, g as (select edition_id, length(t) as c, len(regexp_extract_all(t, '{T.LATIN_LEFT}')) as l from (select edition_id, coalesce(full_text, '') as t from p)),
        k as (select edition_id, sum(c) as c, sum(l) as l from g group by edition_id), {LAYOUT},
        f as (select edition_id, string_agg(page_number, ',' order by page_number) as pages from lo where kept / greatest("raw" - dropped, 1) < 0.75 and "raw" > 10 group by edition_id)
        select k.edition_id, round(case when c > 0 then l / c else 0 end, 6)::double as latin_leftover_rate, coalesce(f.pages, '') as flagged_pages from k left join f using (edition_id)"""
)
def edition_layout(s, d):
    pages = table(s, d, "pages")
    q = quality.edition_quality(quality.page_quality(pages), quality.page_layout(segment.page_blocks(pages)))
    return q.select("edition_id", "latin_leftover_rate", F.array_join(F.transform("flagged_pages", lambda x: x.cast("string")), ",").alias("flagged_pages"))


@registered(f"with {PG} select id from p where regexp_matches(full_text, '{T.CONSONANT}[ \\x{{A0}}\\x{{200B}}\\x{{200C}}\\x{{200D}}]+్{T.CONSONANT}')")
def split_virama_pages(s, d):
    return table(s, d, "pages").where(T.has_split_virama(F.col("full_text"))).select("id").distinct()


@registered(BLOCK_SQL + "select case when odd = 1 then 'right' else 'left' end as design, x as size, count(*) as pages from (select page_number % 2 as odd, round(max(x1) - min(x0), 2) as x from b group by page_id, page_number) where x is not null group by odd, x")
def facing_sizes(s, d):
    """The width of what is printed on right and left pages, by how many pages have it."""
    b = segment.page_blocks(table(s, d, "pages"))
    printed = b.groupBy("page_id", "page_number").agg(F.round(F.max("x1") - F.min("x0"), 2).alias("size")).where("size is not null")
    side = F.when(G.design_page(F.col("page_number"), 2) == 0, "right").otherwise("left").alias("design")
    return printed.groupBy(side, "size").agg(F.count("*").alias("pages"))


# Names of files and lists typed by hand

_PAPER = "case " + " ".join(f"when (abs(w - {w}) <= 2 and abs(h - {h}) <= 2) or (abs(w - {h}) <= 2 and abs(h - {w}) <= 2) then '{name}'" for name, w, h in G.PAPERS) + " else 'Custom' end"


@registered(f"select p_partkey, round(w / 72, 4) as width_in, round(w / 72 * 25.4, 3) as width_mm, {_PAPER} as paper from (select p_partkey, 590 + p_size::double as w, 840 - p_size::double as h from part)")
def paper_names(s, d):
    w, h = F.lit(590.0) + F.col("p_size"), F.lit(840.0) - F.col("p_size")
    units = G.in_units(width=w, height=h)
    return table(s, d, "part").select("p_partkey", units["width_in"].alias("width_in"), units["width_mm"].alias("width_mm"), G.paper_name(w, h).alias("paper"))


_FILE = "case when publish_month % 3 = 0 then 'in/' || publish_year || '/' || lpad(publish_month::varchar, 2, '0') || '.pdf' when publish_month % 3 = 1 then 'Sept_' || publish_year || '_extracted.pdf' else 'x/no date.pdf' end"


@registered(
    f"""with {ED}, m as (select id, {_FILE} as path, publish_year as y, publish_month as m from e where publish_year is not null and publish_month is not null)
        select id, case m % 3 when 0 then 'Issue ' || ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'][m] || ' ' || y when 1 then 'Issue Sept ' || y else 'Issue Edition' end as title,
        case m % 3 when 2 then 2000 else y end as year, case m % 3 when 0 then m when 1 then 9 else 1 end as month from m"""
)
def file_names(s, d):
    known = editions(s, d).where("publish_year is not null and publish_month is not null")
    named = known.select("id", F.expr(_FILE.replace("::varchar", "::string")).alias("path"))
    title, year, month = T.edition_info(F.col("path"))
    return named.select("id", title.alias("title"), year.alias("year"), month.alias("month"))


@registered(
    f"""with {ED}, t as (select id, total_pages as n, '2-4, ' || (total_pages - 1) || ',3,900,7-5' as spec from e where total_pages > 0),
        x as (select id, n, unnest([2, 3, 4, n - 1, 3, 900]) as p from t) select id, string_agg(distinct (p - 1)::varchar, ',' order by (p - 1)::varchar) as pages from x where p between 1 and n group by id"""
)
def page_lists(s, d):
    known = editions(s, d).where("total_pages > 0").select("id", "total_pages", F.concat(F.lit("2-4, "), (F.col("total_pages") - 1).cast("string"), F.lit(",3,900,7-5")).alias("spec"))
    listed = T.page_indexes(F.col("spec"), F.col("total_pages"))
    return known.select("id", F.array_join(F.array_sort(F.transform(listed, lambda x: x.cast("string"))), ",").alias("pages")).where("pages <> ''")


@registered(f"with {AR} select id, array_to_string(list_filter(list_transform(string_split(coalesce(authors_json, ''), ','), lambda x: {STRIP('x')}), lambda x: x <> ''), '|') as names from a")
def typed_lists(s, d):
    return table(s, d, "articles").select("id", F.array_join(T.typed_authors(F.col("authors_json")), "|").alias("names")).distinct()
