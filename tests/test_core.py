"""The engine's own operators on hand-made cases and, for the registered queries, against SQL."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from punji import batch, catalogue
from punji.archive import Archive
from punji.functions import decode, geometry, text
from punji.functions.edit import levenshtein
from punji.functions.translit import reduced_key
from punji.operators import articles, catalog, components, quality, search, segment, tables
from punji.sources import archive_io
from punji.streaming.ingest import ingest_extracts

DATA = "/root/testdata/sf0.001"


def value(spark, expression, given=None, kind="string"):
    return spark.createDataFrame([(given,)], f"x {kind}").select(expression.alias("v")).head()["v"]


@pytest.mark.parametrize(("given", "expected"), [("లక్ష ్మమ్మ", "లక్ష్మమ్మ"), ("మీ పేి", "మీ పేరు"), ("సంరాతం", "సంగీతం"), ("", ""), (None, None)])
def test_repair(spark, given, expected):
    assert value(spark, text.repair_telugu(F.col("x")), given) == expected


def test_contents_entries():
    assert segment.contents_entries("1. Title ..... 3") == [(1, "Title", 3)]
    assert segment.contents_entries("1. Title 3") == []
    assert segment.contents_entries("1. Title\n3") == [(1, "Title", 3)]
    assert segment.contents_entries("1.\nTitle\n3") == [(1, "Title", 3)]
    assert segment.contents_entries("విషయాలు\n1. A ..... 3\nసంపుటి 4\n2. B ..... 5") == [(1, "A", 3), (2, "B", 5)]
    assert segment.contents_entries(None) == []


def test_page_ends(spark):
    df = spark.createDataFrame([("e", i, s, 12) for i, s in enumerate((3, 5, 5, 9))], "edition_id string, position int, start_page int, total_pages int")
    assert [r["end_page"] for r in segment.page_ends(df).orderBy("position").collect()] == [4, 5, 8, 12]


def test_scopes_and_ids(spark):
    assert [text.scope_years(x) for x in ("2000s", "2005s", "2026", "all", "x", None)] == [(2000, 2009), (2005, 2014), (2026, 2026), (None, None), (None, None), (None, None)]
    for path, expected in (("issues/2026/01.pdf", "2026-01"), ("2026-01.pdf", "2026-01"), ("jan2002_extracted.pdf", "jan2002")):
        assert value(spark, text.edition_id_of(F.col("x")), path) == expected


def test_reading_order_and_kinds(spark):
    rows = [("p", i, x, y, x + 180.0, y + 14.0, "t") for i, (x, y) in enumerate([(350.0, 10.0), (60.0, 50.0), (350.0, 50.0), (60.0, 10.0)])]
    df = spark.createDataFrame(rows, "page_id string, at int, x0 double, y0 double, x1 double, y1 double, text string")
    assert [r["at"] for r in segment.reading_order(df).orderBy("order").collect()] == [3, 1, 0, 2]
    kinds = spark.createDataFrame([(210.0, 390.0, "short"), (400.0, 500.0, "name"), (60.0, 540.0, "x" * 90)], "x0 double, x1 double, text string")
    assert [r[0] for r in kinds.select(segment.block_kind(F.col("x0"), F.col("x1"), F.col("text"))).collect()] == ["heading", "right_subheading", "paragraph"]


def test_search_grammar(spark):
    for bad in ("one-two", "a.b", "it's", '"open', "AND", "(a", "a OR", "*"):
        with pytest.raises(search.QuerySyntaxError):
            search.parse(bad)
    assert [search.shape_catalog(q) for q in ("abc", "abc*", "a b")] == ["abc*", "abc*", "a b"]
    assert search.shape_catalog("a b", exact=True) == '"a b"' and search.shape_article("a b") == "a b" and search.shape_article("a") == '"a"'
    docs = spark.createDataFrame([(1, "the quick brown fox"), (2, "a Résumé of the fox"), (3, None), (4, ""), (5, "aaa aaa aaa the"), (5, "aaa aaa aaa the")], "id int, body string")
    hit = lambda q: sorted(r["id"] for r in search.match(docs, ["body"], q).collect())
    assert hit("fox") == [1, 2] and hit('"quick brown"') == [1] and hit("resume") == [2] and hit("qui*") == [1]
    assert hit("fox NOT quick") == [2] and hit("quick OR aaa") == [1, 5, 5] and hit("") == [] and hit("fox the") == [1, 2]
    assert sorted(r["id"] for r in search.substring_match(docs, "body", "UICK B").collect()) == [1]
    assert search.substring_match(docs, "body", "fo").count() == 0
    assert search.match(docs.limit(0), ["body"], "fox").count() == 0
    assert [r["id"] for r in search.match_or_like(docs, ["body"], "quick-", ["body"]).collect()] == []
    assert "<b>fox</b>" in search.match(docs, ["body"], "fox").select(search.snippet(F.col("body"), ["fox"])).head()[0]
    index = {(r["term"], r["doc"]): r["positions"] for r in search.postings(docs.where("id < 3"), "id", ["body"]).collect()}
    assert index["the", 2] == [3] and index["the", 1] == [0]


def test_bm25_by_hand(spark):
    import math

    docs = spark.createDataFrame([(1, "a b"), (2, "a a b c"), (3, "c"), (4, "d"), (5, "d e")], "id int, body string")
    got = {r["id"]: r["rank"] for r in search.match(docs, ["body"], "a").collect()}
    idf, avg = math.log((5 - 2 + 0.5) / 2.5), 10 / 5
    for i, f, size in ((1, 1, 2), (2, 2, 4)):
        assert got[i] == pytest.approx(-idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / avg)))


def test_tables(spark):
    base = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", None)], "id int, title string, at int")
    newest = tables.latest(base, ["id"], [F.col("at")])
    assert sorted(map(tuple, newest.collect())) == [(1, "b", 2), (2, "c", None)]
    batch = spark.createDataFrame([(2, "z", 9), (3, "n", 1)], "id int, title string, at int")
    assert sorted(r["title"] for r in tables.upsert(newest, batch, ["id"]).collect()) == ["b", "n", "z"]
    assert [r["id"] for r in tables.delete(newest, batch, ["id"]).collect()] == [1]
    edits = spark.createDataFrame([(1, "edited", 77)], "id int, title string, at int")
    assert sorted(map(tuple, tables.apply_edits(newest, edits, ["id"]).collect())) == [(1, "edited", 2), (2, "c", None)]


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51), (51, 50), (7, 7), (90, 90), (None, 3)], "a int, b int")
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert {k for k, v in got.items() if v == 0} == set(range(21)) and got[51] == 50 and got[90] == 90
    assert components.connected_components(links.limit(0)).count() == 0


def test_quality(spark):
    pages = spark.createDataFrame([(1, "e", 1, "కఅ abc ka"), (1, "e", 1, "కఅ abc ka"), (2, "e", 2, None), (3, "f", 1, "కథ")], "id int, edition_id string, page_number int, full_text string")
    found = {r["edition_id"]: r for r in quality.edition_quality(quality.page_quality(pages)).collect()}
    assert found["e"]["latin_leftover_count"] == 5 and found["e"]["split_matra_count"] == 1 and found["e"]["pages"] == 2
    assert found["e"]["flags"] == ["unmapped_glyph", "glyph_split_matra", "needs_review"] and found["f"]["flags"] == []


def test_decoding(spark):
    rules = spark.createDataFrame([("k", "క", "base"), ("kh", "ఖ", "base"), ("i", "ి", "sign"), ("e", "ె", "pre"), ("R", "ర", "tail"), ("k", "x", "base"), (None, "y", "base")], "glyphs string, text string, role string")
    assert value(spark, decode.decode_glyphs(F.col("x"), rules), "kikh ekR!") == "కిఖ క్రె!"
    assert value(spark, decode.replace_in_order(F.col("x"), rules), "khk") == "ఖక"
    assert value(spark, decode.mac_to_windows(F.col("x")), "Ä") == "€" and value(spark, decode.decode_glyphs(F.col("x"), rules), None) is None


def test_keys_and_distance():
    assert reduced_key("వెన్నెల") == reduced_key("Vennela") and reduced_key("సంఘం") == reduced_key("Samgham")
    assert levenshtein("kitten", "sitting") == 3 and levenshtein("", "ab") == 2 and levenshtein("a", "a") == 0


def test_files_and_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    block = {"block_no": 0, "bbox": [0, 0, 1, 1], "type": "heading", "text": " శీర్షిక ", "alignment": "center", "reading_order": 0}
    document = {"pdf_path": "x/2026/01.pdf", "total_pages": 1, "pages": [{"page_number": 1, "blocks": [block, block | {"text": ""}], "images": []}], "images": [{"page_number": 1, "xref": 3}, {"page_number": 1, "xref": 3}]}
    (source / "a.json").write_text(json.dumps(document, ensure_ascii=False))
    extracts = archive_io.read_extracts(spark, str(source))
    assert [tuple(r)[:3] for r in archive_io.extract_pages(extracts).collect()] == [("2026-01", 1, "శీర్షిక")]
    assert archive_io.extract_images(extracts).count() == 1
    for _ in range(2):
        ingest_extracts(spark, str(source), str(tmp_path / "pages"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "pages")).count() == 1
    blocks = spark.createDataFrame([("e", 1, 0, "heading", "H"), ("e", 1, 1, "paragraph", "p")], "edition_id string, page_number int, at int, type string, text string")
    archive_io.write_text(blocks, str(tmp_path / "text"))
    assert "[HEADING] H\np" in "".join(open(p, encoding="utf-8").read() for p in glob.glob(str(tmp_path / "text/*/*.txt")))
    archive_io.write_archive(spark.createDataFrame([("e", "a", 'T"', '["n"]', "s", "b")], "edition_id string, id string, title string, authors_json string, series string, body string"), str(tmp_path / "out"))
    assert glob.glob(str(tmp_path / "out/articles/edition_id=e/*.json"))


def test_archive(spark):
    archive = Archive.open(spark, DATA)
    assert archive.search("పిల్లలు").count() <= 10 and archive.years().count() > 0
    assert archive.search_catalog("వెన్").count() > 0 and archive.search_articles("").count() == 0
    assert archive.search_articles("పిల్ల", first=1900, last=2100).count() > 0 and archive.search_articles("a-b", exact=True).count() == 0
    one = archive.articles.head()
    assert archive.article(one["edition_id"], one["id"]).count() == 1
    gone = archive.editions.where(F.col("id") == one["edition_id"]).select("id")
    assert archive.delete_editions(gone).articles.where(F.col("edition_id") == one["edition_id"]).count() == 0
    assert archive.upsert("editions", archive.editions.limit(1)).editions.count() == archive.editions.count()


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_against_sql(spark, name):
    import duckdb

    frame = catalogue.queries()[name](spark, DATA)
    rows = frame.collect()
    sql = catalogue.oracle_sql().get(name)
    if not sql:
        return
    db = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    tidy = lambda v: round(v, 6) if isinstance(v, float) else v
    want = sorted(repr([tidy(dict(zip(columns, r, strict=True))[c]) for c in sorted(columns)]) for r in result.fetchall())
    assert sorted(repr([tidy(r[c]) for c in sorted(columns)]) for r in rows) == want


def test_wider_grammar(spark):
    docs = spark.createDataFrame([(1, "red fox", "a b c d e"), (2, "blue", "red a x y z b"), (3, "red", None), (1, "red fox", "a b c d e")], "id int, title string, body string")
    hit = lambda q: sorted(r["id"] for r in search.match(docs, ["title", "body"], q, ["id"]).collect())
    assert hit("NEAR(a b, 0)") == [1] and hit("NEAR(a b, 3)") == [1, 2] and hit("NEAR(b a)") == [1, 2] and hit("NEAR(a b fox)") == []
    assert hit("title : red") == [1, 3] and hit("- title : red") == [2] and hit("{title body} : (red AND a)") == [1, 2] and hit("^red") == [1, 2, 3] and hit("^fox") == []
    assert hit("red + fox") == [1] and hit("title : ^re*") == [1, 3]
    for bad in ("nowhere : red", "NEAR(a,b)", "{title : a", "^", "a +"):
        with pytest.raises(search.QuerySyntaxError):
            search.match(docs, ["title", "body"], bad, ["id"])
    part = lambda q: sorted(r["id"] for r in search.substring_match(docs, "body", q, ["id"]).collect())
    assert part('"a b" NOT zz') == [1] and part('"b c" OR "y z"') == [1, 2] and part("ab") == [] and part('"a x" AND q') == [2]


def test_stored_index_answers_like_the_scan(spark, tmp_path):
    docs = spark.createDataFrame([(i, " ".join(f"w{i * k % 7}" for k in range(1, 9)), f"t{i % 3} w1") for i in range(40)] + [(99, None, None)], "id int, body string, title string")
    search.store_index(docs, "id", ["title", "body"], str(tmp_path / "index"))
    for query in ("w1", "w1 w2", '"w1 w2"', "w1 NOT w3", "t* AND w4", "NEAR(w1 w5, 2)", "title : w1", "^w3", "nothing"):
        want = {r["id"]: round(r["rank"], 9) for r in search.match(docs, ["title", "body"], query, ["id"]).collect()}
        found = search.match_index(spark, str(tmp_path / "index"), query)
        assert {r["doc"]: round(r["rank"], 9) for r in found.collect()} == want, query
    plan = search.match_index(spark, str(tmp_path / "index"), "w1 t*")._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(" in plan and "In(term, [w1])" in plan.replace("EqualTo(term,w1)", "In(term, [w1])")


def test_texts_are_not_shuffled_to_drop_repeats(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    for df in (search.match(pages, ["full_text"], "x", ["id"]), quality.page_quality(pages), segment.contents_pages(pages)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        above = plan[: plan.rindex("Relation")]  # the last projection over the scan ends with the texts
        assert "full_text" not in above.rsplit("Aggregate", 1)[0].split("Project", 1)[0] and "first(full_text" not in plan


def test_sizes_and_boxes(spark):
    one = spark.range(1)
    names = [one.select(geometry.paper_name(F.lit(w), F.lit(h))).head()[0] for w, h in ((612.0, 792.0), (842.0, 595.0), (100.0, 100.0))]
    assert names == ["Letter", "A4", "Custom"]
    unit = one.select(geometry.in_units(w=F.lit(72.0))).head()[0]
    assert (unit["w_pt"], unit["w_in"], unit["w_mm"]) == (72.0, 1.0, 25.4)
    box = [F.lit(float(x)) for x in (0, 0, 10, 10)]
    assert [one.select(geometry.boxes_differ(box, [*box[:3], F.lit(y)])).head()[0] for y in (10.4, 10.6)] == [False, True]
    assert [one.select(geometry.design_page(F.lit(p), n, c)).head()[0] for p, n, c in ((1, 3, True), (2, 3, True), (3, 3, False), (2, 2, False), (2, 1, False))] == [0, 2, 1, 1, 0]
    place = one.select(geometry.placed(F.lit(500.0), F.lit(700.0), None, F.lit(200.0))).head()[0]
    assert (place["x0"], place["y0"], place["x1"], place["y1"]) == (56.0, 92.0, 556.0, 792.0)
    with pytest.raises(ValueError):
        geometry.design_page(F.lit(1), 2, True)


def test_layout_gap_both_ends(spark):
    rows = [("p", "e", 1, 10.0, 20.0, "x")] * 12 + [("q", "e", 2, 10.0, 20.0, "x")] * 11 + [("q", "e", 2, 300.0, 400.0, "x")]
    df = spark.createDataFrame(rows, "page_id string, edition_id string, page_number int, y0 double, y1 double, text string")
    assert {r["page_id"]: r["gap"] for r in quality.page_layout(df).collect()} == {"p": True, "q": False}


def test_authors_of_an_article(spark):
    body = "one\n- కమల రావు\ntwo\nthree\n– శ్రీ రాజు – సీత."
    row = spark.createDataFrame([(body, "Tale ...శ్రీమతి లలిత", [("paragraph", 400.0, "కమల రావు\nx"), ("paragraph", 10.0, "left")])], "body string, title string, blocks array<struct<type:string,x0:double,text:string>>")
    found = row.select(articles.merged_authors(articles.byline_authors(F.col("blocks")), articles.dash_authors(F.col("body")), articles.title_authors(F.col("title"))).alias("a")).head()["a"]
    assert [(a["name"], a["source"], a["confidence"]) for a in found] == [("కమల రావు", "trailing_dash", 0.85), ("సీత", "trailing_dash", 0.8), ("శ్రీమతి లలిత", "toc_title", 0.7)]
    none = row.select(articles.author_confidence(articles.merged_authors(articles.dash_authors(F.lit(None).cast("string")))).alias("c")).head()["c"]
    assert none == 1.0


def test_titles_and_fonts(spark):
    assert value(spark, text.glyph_font(F.col("x")), "ABC+Anupama-Bold") and not value(spark, text.glyph_font(F.col("x")), None)
    assert value(spark, text.detect_series(F.col("x")), "రంగుల లోకం (సీరియల్)") == "రంగుల లోకం" and value(spark, text.detect_series(F.col("x")), "plain") is None
    mismatch = lambda a, b: spark.range(1).select(quality.title_mismatch(F.lit(a), F.lit(b))).head()[0]
    assert mismatch("First title", "Other words") and not mismatch("First title", "First title again") and not mismatch("", "x")
    assert value(spark, segment.without_leading_noise(F.col("x")), "సంపుటి 4\nసంచిక 2\nReal text\nmore") == "Real text\nmore"
    assert value(spark, text.html_bold(F.col("x")), "<b>a</b> & <i>") == "<b>a</b> &amp; &lt;i&gt;"
    assert value(spark, text.trigrams(F.col("x")), "AbcD") == ["abc", "bcd"] and value(spark, text.trigrams(F.col("x")), "ab") == []
    start, end = segment.clamp_pages(F.lit(0), F.lit(99), F.lit(12))
    assert tuple(spark.range(1).select(start, end).head()) == (1, 12)


def _extract(path, pages, pdf):
    blocks = lambda texts: [{"block_no": i, "bbox": [60.0, 150.0 + 20 * i, 540.0, 165.0 + 20 * i], "type": kind, "text": t, "alignment": al, "reading_order": i} for i, (kind, t, al) in enumerate(texts)]
    document = {"metadata": {}, "pdf_path": pdf, "total_pages": len(pages), "pages": [{"page_number": n + 1, "width": 600.0, "height": 842.0, "blocks": blocks(p), "images": []} for n, p in enumerate(pages)], "images": []}
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(document, f, ensure_ascii=False)


def test_batch_job_and_search(spark, tmp_path, capsys):
    contents = "విషయాలు\nపుట సంఖ్య\n1. వెన్నెల కథ ..... 3\n2. మన ఊరు ..... 4"
    pages = [[("paragraph", "cover words", "left")], [("paragraph", contents, "left")], [("heading", "వెన్నెల కథ", "center"), ("right_subheading", "కమల రావు", "right"), ("paragraph", "పిల్లలు ఆడుకున్నారు ఇంకావుంది", "left")], [("paragraph", "ఊరి మాట", "left")], []]
    _extract(str(tmp_path / "in" / "2002" / "01.json"), pages, "issues/2002/01.pdf")
    _extract(str(tmp_path / "in" / "2002" / "02.json"), pages[:1], "issues/2002/02.pdf")
    series = spark.createDataFrame([(1, "వెన్నెల")], "series_id int, series_name string")
    aliases = spark.createDataFrame([("ఊరు", "మన ఊరి కథలు")], "alias string, series_name string")
    out = str(tmp_path / "out")
    first = {r["edition_id"]: r for r in batch.process_extracts(spark, str(tmp_path / "in"), out, series, aliases).collect()}
    assert {k: (r["status"], r["articles"]) for k, r in first.items()} == {"2002-01": ("ok", 3), "2002-02": ("ok", 1)}
    built = {r["article_id"]: r for r in spark.read.parquet(f"{out}/articles").where("edition_id = '2002-01'").collect()}
    assert set(built) == {"00_front_matter", "01_వెన్నెల_కథ", "02_మన_ఊరు"}
    story = built["01_వెన్నెల_కథ"]
    assert (story["start_page"], story["end_page"], story["authors"], story["continuation_of"]) == (3, 3, ["కమల రావు"], "continued_marker")
    assert built["02_మన_ఊరు"]["series"] == "మన ఊరి కథలు" and "విషయాలు" in built["00_front_matter"]["body"]
    kinds = [(r["kind"], r["text"], r["source"]) for r in spark.read.parquet(f"{out}/catalog_entries").where("edition_id = '2002-01'").orderBy("entry_id").collect()]
    assert kinds[:3] == [("heading", "వెన్నెల కథ", "toc"), ("author", "కమల రావు", "autotag"), ("series", "వెన్నెల", "layout_match")]
    again = batch.process_extracts(spark, str(tmp_path / "in"), out, series, aliases)
    assert {r["status"] for r in again.collect()} == {"skipped"} and spark.read.parquet(f"{out}/articles").count() == 4
    for words, expected in ((["కథ", "--mode", "both"], 0), (["వెన్నెల"], 1), (["--author", "రావు"], 0)):
        assert batch.main(["search", DATA, *words, "-l", "5"]) == 0
        assert len(capsys.readouterr().out.splitlines()) >= expected


def test_archive_folder_without_catalogue(spark, tmp_path):
    for edition in ("2001-01", "2001-02"):
        os.makedirs(tmp_path / edition / "articles")
        with open(tmp_path / edition / "articles" / "01.json", "w") as f:
            json.dump({"id": "01_a", "title": "Boats", "start_page": 1, "end_page": 2, "authors": ["Mina"], "kind": "article"}, f)
    with open(tmp_path / "2001-01" / "catalog.json", "w") as f:
        json.dump({"entries": [{"id": "x", "edition_id": "2001-01", "kind": "heading", "text": "Kept"}]}, f)
    _extract(str(tmp_path / "2001-02" / "raw_extract.json"), [[("paragraph", "Paper Boats No. 4", "left")]], "x.pdf")
    series = spark.createDataFrame([(1, "Paper Boats")], "series_id int, series_name string")
    rows = {(r["edition_id"], r["kind"], r["text"]) for r in archive_io.archive_catalog(spark, str(tmp_path), series).collect()}
    assert rows == {("2001-01", "heading", "Kept"), ("2001-02", "heading", "Boats"), ("2001-02", "author", "Mina"), ("2001-02", "series", "Paper Boats")}
    found = {r["edition_id"] for r in archive_io.find_pdfs(spark, str(_touch(tmp_path / "pdfs", "2001/01.pdf", "flat.pdf"))).collect()}
    assert found == {"2001-01"} and archive_io.find_pdfs(spark, str(tmp_path / "pdfs"), "1999").count() == 0


def _touch(folder, *names):
    for n in names:
        os.makedirs(os.path.dirname(folder / n), exist_ok=True)
        with open(folder / n, "w") as f:
            f.write("%PDF")
    return folder


def test_repeated_keys_in_a_batch(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch_rows = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "z")], "id int, v string")
    assert sorted(tuple(r) for r in tables.upsert(base, batch_rows, ["id"], [F.col("v")]).collect()) == [(1, "y"), (2, "b"), (3, "z")]


def test_rules_from_letters_and_reordering(spark):
    letters = spark.createDataFrame(
        [("చ", "a", "base", 1), ("ౘ", "a", "base", 2), ("ౙ", "b", "base", 3), ("ౘ", "b", "base", 4), ("ి", "i", "base", 5), ("౧", "1", "base", 6), ("క", "k", "base", 7), ("గ", "k", "tail", 8), ("", "x", "base", 9), ("ఖ", None, "base", 10)],
        "text string, glyphs string, kind string, position int",
    )
    assert {r["glyphs"]: (r["text"], r["role"]) for r in decode.rules_from_letters(letters).collect()} == {"a": ("చ", "base"), "b": ("ౙ", "base"), "i": ("ి", "sign"), "k": ("గ", "tail")}
    for given, expected in (("¿కమల", "కేమల"), ("Ãస్త", "స్తె"), ("„క", "క్ర"), ("కి్త", "క్తి"), ("plain", "plain"), (None, None)):
        assert value(spark, decode.reorder_signs(F.col("x")), given) == expected


def test_images_of_articles_and_sizes(spark):
    spans = spark.createDataFrame([("e", "a", 1, 2), ("e", "b", 3, 3), ("e", "c", 9, 9)], "edition_id string, article_id string, start_page int, end_page int")
    images = spark.createDataFrame([("e", 1, "x.png")], "edition_id string, page_number int, path string")
    beside = spark.createDataFrame([("e", 2, "y.png"), ("e", 3, "z.png")], "edition_id string, page_number int, path string")
    assert sorted((r["article_id"], r["path"]) for r in articles.article_images(images, spans, beside).collect()) == [("a", "x.png"), ("b", "z.png")]
    pages = spark.createDataFrame([(612.0, 792.0)] * 3 + [(595.281, 841.892), (None, 1.0)], "width double, height double")
    assert sorted((r["name"], r["pages"]) for r in geometry.size_variants(pages).collect()) == [("A4", 1), ("Letter", 3)]
    from punji.runtime import short_list

    with pytest.raises(ValueError):
        short_list(pages, 3)


def test_rows_delivered_twice_count_once(spark):
    from punji.runtime import once

    rows = [(1, "a"), (2, "b"), (1, "a"), (None, "c"), (None, "c"), (3, "d")]
    df = spark.createDataFrame(rows, "id int, n string")
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r) for r in once(df, "id").collect()), key=key) == sorted(set(rows), key=key)
    assert once(df.where("id = 3"), "id").count() == 1 and once(df.limit(0), "id").count() == 0
    assert once(df, "id", "n").count() == 4
