"""The registered queries of this subpackage: pN_found and further results of each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punji.llm import boilerplate, canonical, encodings, leakage, lookalikes, names, packing, reprints, subjects
from punji.runtime import cut, table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return names.same_name_pairs(names.written_names(table(spark, sf, "catalog_entries"), table(spark, sf, "articles")))


def p1_entities(spark: SparkSession, sf: str) -> DataFrame:
    return names.name_entities(names.written_names(table(spark, sf, "catalog_entries"), table(spark, sf, "articles")))


def _archive(spark: SparkSession, sf: str) -> DataFrame:
    return encodings.archive_records(table(spark, sf, "articles"), table(spark, sf, "pages"), table(spark, sf, "catalog_entries"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return encodings.garbled(_archive(spark, sf)).select(F.col("field").alias("record_src"), F.col("id").alias("record_id"))


def p2_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return encodings.repaired(_archive(spark, sf)).select(F.col("field").alias("record_src"), F.col("id").alias("record_id"), "chain", F.col("text").alias("restored"))


def _series_values(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    articles = table(spark, sf, "articles").select(F.lit("articles.series").alias("record_src"), F.col("id").cast("string").alias("record_id"), F.col("series").alias("value"))
    typed = table(spark, sf, "catalog_entries").where("kind = 'series'").select(F.lit("catalog_entries.text").alias("record_src"), F.col("id").cast("string").alias("record_id"), F.col("text").alias("value"))
    listed = table(spark, sf, "series_catalog")
    # A value that is a series_name needs no mapping.
    values = articles.unionByName(typed).where("value is not null").distinct().join(listed.select(F.col("series_name").alias("value")), "value", "left_anti")
    other = table(spark, sf, "series_aliases").join(listed, "series_name").select(F.col("series_id").alias("reference_id"), F.col("alias").alias("name"))
    return values, listed.select(F.col("series_id").alias("reference_id"), F.col("series_name").alias("name")).unionByName(other), listed


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    values, references, _ = _series_values(spark, sf)
    mapped = canonical.map_values(values, references)
    return values.join(mapped, "value").select("record_src", "record_id", F.col("reference_id").alias("series_id"))


def p3_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Values that mean no entry, with how many records hold each."""
    values, references, _ = _series_values(spark, sf)
    none = canonical.map_values(values, references).where("reference_id = 0")
    return values.join(none, "value").groupBy("value").agg(F.count("*").alias("records"))


def _looks(spark: SparkSession, sf: str) -> DataFrame:
    articles, catalog = table(spark, sf, "articles"), table(spark, sf, "catalog_entries")
    source = F.split("edition_id", "-")[0].alias("source")
    body = articles.select(F.lit("articles.body").alias("field"), source, F.col("id").cast("string").alias("id"), F.col("body").alias("text"))
    title = articles.select(F.lit("articles.title").alias("field"), source, F.col("id").cast("string").alias("id"), F.col("title").alias("text"))
    text = catalog.select(F.lit("catalog_entries.text").alias("field"), source, F.col("id").cast("string").alias("id"), "text")
    return body.unionByName(title).unionByName(text).where("text is not null")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    records = _looks(spark, sf)
    odd = lookalikes.odd_records(records)
    # Only records that look odd can be cases, so only they are held against the garbled ones of p2.
    garbled = encodings.garbled(records)
    return odd.join(garbled, ["field", "id"], "left_anti").select(F.col("field").alias("record_src"), F.col("id").alias("record_id"))


def p4_unified(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.unified(_looks(spark, sf)).select(F.col("field").alias("record_src"), F.col("id").alias("record_id"), "text")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return reprints.reprint_pairs(table(spark, sf, "articles"))


def p5_classes(spark: SparkSession, sf: str) -> DataFrame:
    return reprints.reprint_classes(table(spark, sf, "articles"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.standing_lines(table(spark, sf, "pages")).select(F.col("page_id").cast("int"), F.col("line_no").cast("int"))


def p6_patterns(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.standing_patterns(table(spark, sf, "pages"))


def p6_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Each page's text without standing lines, and the texts that its blocks keep, one below the other."""
    clean = boilerplate.without_standing_lines(table(spark, sf, "pages"))
    return clean.select("page_id", "full_text", F.array_join(F.transform(F.from_json("blocks_json", "array<struct<text:string>>"), lambda b: b["text"]), "\n").alias("block_texts"))


def p7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), table(spark, sf, "pack_capacity"))


def p7_report(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packing_report(cut(p7_packing(spark, sf)), table(spark, sf, "pack_capacity"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_near(spark: SparkSession, sf: str) -> DataFrame:
    """Exact phrase matches and, beside them, documents with an item's twelve rarest words close together."""
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"), near=12)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.document_subjects(table(spark, sf, "documents"), table(spark, sf, "subject_labels"), table(spark, sf, "subjects"))


def p9_composition(spark: SparkSession, sf: str) -> DataFrame:
    """How much of the corpus deals with each subject."""
    found = p9_found(spark, sf).groupBy("subject_id").agg(F.count("*").alias("documents"))
    return table(spark, sf, "subjects").select("subject_id", "subject_name").join(found, "subject_id", "left").select("subject_id", "subject_name", F.coalesce("documents", F.lit(0)).alias("documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (p1_found, p1_entities, p2_found, p2_repaired, p3_found, p3_unmatched, p4_found, p4_unified, p5_found, p5_classes, p6_found, p6_patterns, p6_cleaned, p7_packing, p7_report, p8_found, p8_near, p9_found, p9_composition)
    return {f.__name__: f for f in listed}


_WHITE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

_P5 = """with a as (select distinct id, coalesce(title, '') as title, body from articles where body is not null),
    w as (select id, list_filter(regexp_split_to_array(lower(title || ' ' || body), '[ \\t\\n\\r]+'), lambda x: x <> '') as ws from a
      where len(list_filter(regexp_split_to_array(body, '[ \\t\\n\\r]+'), lambda x: x <> '')) >= 20),
    s as (select id, unnest(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) as g from w),
    n as (select id, count(*) as n from s group by id),
    o as (select x.id as a, y.id as b, count(*) as c from s x join s y on x.g = y.g and x.id < y.id group by x.id, y.id)
    select a as article_a, b as article_b from o join n p on p.id = a join n q on q.id = b where c >= 0.6 * (p.n + q.n - c)"""

_P6 = f"""with p as (select distinct id, split_part(edition_id, '-', 1) as pub, full_text from pages where full_text is not null),
    l as (select id, pub, generate_subscripts(string_split(full_text, chr(10)), 1) as line_no, unnest(string_split(full_text, chr(10))) as x from p),
    k as (select id, pub, line_no, trim(regexp_replace(regexp_replace(lower(x), '\\p{{Nd}}+', '0', 'g'), '{_WHITE}', ' ', 'g')) as x from l),
    t as (select pub, count(*) as total from p group by pub), c as (select pub, x, count(distinct id) as n from k where x <> '' group by pub, x)
    select k.id::int as page_id, k.line_no::int as line_no from k join c using (pub, x) join t using (pub) where c.n >= 3 and c.n >= 0.1 * t.total"""

_P8 = """with d as (select distinct doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}]+') as ws from documents where text is not null),
    i as (select distinct item_id, regexp_extract_all(lower(passage), '[\\p{L}\\p{M}\\p{N}]+') as ws from eval_items where passage is not null),
    dw as (select doc_id, unnest(list_transform(range(1, len(ws) - 8), lambda k: array_to_string(ws[k:k + 9], ' '))) as g from d where len(ws) >= 10),
    iw as (select item_id, unnest(list_transform(range(1, len(ws) - 8), lambda k: array_to_string(ws[k:k + 9], ' '))) as g from i where len(ws) >= 10)
    select distinct doc_id, item_id from dw join iw using (g)"""

_P8_NEAR = f"""with exact as ({_P8}),
    dw as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as p from (select distinct doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') as ws from documents where text is not null)),
    iw as (select item_id, w, min(p) as p from (select item_id, unnest(ws) as w, generate_subscripts(ws, 1) as p from
      (select item_id, regexp_extract_all(lower(passage), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') as ws from eval_items where passage is not null)) group by item_id, w),
    f as (select w, count(distinct doc_id) as df from dw where w in (select w from iw) group by w),
    r as (select item_id, w from (select item_id, w, row_number() over (partition by item_id order by df, p) as k, count(*) over (partition by item_id) as c from iw join f using (w)) where k <= 12 and c >= 12),
    h as (select doc_id, item_id, p, w from dw join r using (w)),
    whole as (select doc_id, item_id from h group by doc_id, item_id having count(distinct w) = 12),
    k as (select h.* from h join whole using (doc_id, item_id)),
    near as (select x.doc_id, x.item_id from k x join k y on x.doc_id = y.doc_id and x.item_id = y.item_id and y.p between x.p and x.p + 29 group by x.doc_id, x.item_id, x.p having count(distinct y.w) = 12)
    select doc_id, item_id, 'exact' as kind from exact union all select doc_id, item_id, 'near' as kind from (select distinct doc_id, item_id from near) where (doc_id, item_id) not in (select (doc_id, item_id) from exact)"""

_P5_CLASSES = """with recursive a as (select distinct id, coalesce(title, '') as title, body from articles where body is not null),
    w as (select id, lower(title || ' ' || body) as t from a where len(list_filter(regexp_split_to_array(body, '[ \\t\\n\\r]+'), lambda x: x <> '')) >= 20),
    u as (select t, min(id) as id from w group by t), v as (select id, list_filter(regexp_split_to_array(t, '[ \\t\\n\\r]+'), lambda x: x <> '') as ws from u),
    s as (select id, unnest(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) as g from v), n as (select id, count(*) as n from s group by id),
    o as (select x.id as a, y.id as b, count(*) as c from s x join s y on x.g = y.g and x.id <> y.id group by x.id, y.id),
    e as (select a, b from o join n p on p.id = a join n q on q.id = b where c >= 0.6 * (p.n + q.n - c)),
    reach as (select a as x, a as y from e union select r.x, e.b from reach r join e on r.y = e.a), comp as (select x, min(y) as class_id from reach group by x), deg as (select a, count(*) as links from e group by a),
    m as (select w.id, u.id as rep from w join u using (t))
    select m.id, coalesce(class_id, m.rep) as class_id, coalesce(links, 0) as links from m left join comp on comp.x = m.rep left join deg on deg.a = m.rep
    union all select id, id, 0 from (select distinct id from articles) where id not in (select id from w)"""

_FREQUENT = f"""p as (select distinct id, split_part(edition_id, '-', 1) as pub, full_text, blocks_json from pages),
    k as (select id, pub, line_no, trim(regexp_replace(regexp_replace(lower(x), '\\p{{Nd}}+', '0', 'g'), '{_WHITE}', ' ', 'g')) as x, x as line from
      (select id, pub, generate_subscripts(string_split(full_text, chr(10)), 1) as line_no, unnest(string_split(full_text, chr(10))) as x from p where full_text is not null)),
    t as (select pub, count(*) as total from p where full_text is not null group by pub),
    f as (select pub, x, total from (select pub, x, count(distinct id) as n from k where x <> '' group by pub, x) join t using (pub) where n >= 3 and n >= 0.1 * total)"""

_P6_PATTERNS = (
    f"with {_FREQUENT}, s as (select k.id, k.pub, k.line_no, k.x, f.total from k join f using (pub, x)), "
    + "g as ("
    + " union all ".join(
        f"select s1.pub, {' || chr(10) || '.join(f's{i}.x' for i in range(1, n + 1))} as pattern, {n} as length, count(distinct s1.id) as pages, any_value(s1.total) as total from s s1 "
        + " ".join(f"join s s{i} on s{i}.id = s1.id and s{i}.line_no > s{i - 1}.line_no" for i in range(2, n + 1))
        + " group by 1, 2"
        for n in range(1, 6)
    )
    + ") select pub as source, pattern, length, pages from g where pages >= 3 and pages >= 0.1 * total"
)

_P6_CLEANED = f"""with {_FREQUENT}, g as (select k.id, string_agg(line, chr(10) order by line_no) as full_text from k left join f using (pub, x) where f.x is null group by k.id),
    b as (select id, pub, i, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as n from
      (select id, pub, i, bs[i].text as t from (select id, pub, bs, unnest(range(1, len(bs) + 1)) as i from (select id, pub, from_json(blocks_json, '[{{"text":"VARCHAR"}}]') as bs from p)))),
    c as (select b.id, i, string_agg(line, chr(10) order by n) as t from (select *, trim(regexp_replace(regexp_replace(lower(line), '\\p{{Nd}}+', '0', 'g'), '{_WHITE}', ' ', 'g')) as x from b) b left join f using (pub, x) where f.x is null group by b.id, i),
    d as (select id, string_agg(t, chr(10) order by i) as block_texts from c where t <> '' group by id)
    select p.id as page_id, case when p.full_text is not null then coalesce(g.full_text, '') end as full_text, case when p.blocks_json is not null then coalesce(d.block_texts, '') end as block_texts from p left join g on g.id = p.id left join d on d.id = p.id"""


def oracle_sql() -> dict[str, str]:
    return {"p5_classes": _P5_CLASSES, "p6_patterns": _P6_PATTERNS, "p6_cleaned": _P6_CLEANED, "p8_near": _P8_NEAR, "p5_found": _P5, "p6_found": _P6, "p8_found": _P8}
