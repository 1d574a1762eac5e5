"""Text expressions over columns: folding, tokens, counts of odd glyphs, names, labels, ids."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Small Latin letters with marks and the plain letter they are searched as, made from the Unicode data by rule.
_MARKED = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for c in range(0xC0, 0x250) if unicodedata.decomposition(chr(c)) and unicodedata.normalize("NFD", chr(c))[0].isascii() and chr(c).lower() == chr(c)}
FOLD_FROM = "".join(_MARKED)
FOLD_TO = "".join(_MARKED.values())
TOKEN = r"[\p{L}\p{N}\p{Co}\x{0C00}-\x{0C7F}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Glyph classes by which spoilt Telugu is measured.
CONSONANT = "[క-హౘ-ౚ]"
SIGN = "[ా-ౄె-ౌౕౖఁ-ః]"
FREE_VOWEL = "[అ-ఌఎ-ఐఒ-ఔ]"
LATIN_LEFT = r"[A-Za-z\x{80}-\x{24F}\x{370}-\x{3FF}\x{2000}-\x{206F}\x{20A0}-\x{20CF}]"
ORPHAN = rf"(?:^|[\s\x{{200C}}\x{{200D}}.,;:!?\-—–\"'()]){SIGN}"
# Words that the glyph repair gets wrong, with their corrections, in this order.
WORD_FIXES = (("సంరాతం", "సంగీతం"), ("సంరాతాన్ని", "సంగీతాన్ని"), ("సంరాత", "సంగీత"), ("మీ పేి", "మీ పేరు"), ("పేి", "పేరు"))


def ascii_lower(c: Column) -> Column:
    """Lower case of ASCII letters alone, as SQLite's LIKE compares."""
    return F.translate(c, UPPER, LOWER)


def fold(c: Column) -> Column:
    """Lower case without Latin marks; Telugu signs stay."""
    low = F.lower(c)
    return F.when(low.rlike(r"[\x{C0}-\x{24F}]"), F.translate(low, FOLD_FROM, FOLD_TO)).otherwise(low)


def tokens(c: Column) -> Column:
    """Search tokens in order; null as none."""
    return F.regexp_extract_all(fold(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(0))


def trigrams(c: Column) -> Column:
    """Every run of three code points, case-folded; none for shorter text."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.when(F.length(low) >= 3, F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substring(low, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))


def like_contains(c: Column, pattern: str) -> Column:
    """LIKE '%pattern%' with ASCII case folded only; % and _ in the pattern keep their meaning."""
    return ascii_lower(c).like("%" + pattern.translate(str.maketrans(UPPER, LOWER)) + "%")


def nfc(c: Column) -> Column:
    """Composed Unicode form. Texts without combining marks of other scripts are in it already and skip Python."""

    @F.pandas_udf(StringType())
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    return F.when(c.rlike(r"[\x{300}-\x{36F}\x{C56}\x{1E00}-\x{1FFF}\x{2126}\x{212A}\x{212B}\x{F900}-\x{FAFF}\x{340}-\x{345}]"), compose(c)).otherwise(c)


def _rejoin(c: Column) -> Column:
    c = F.regexp_replace(c, rf"({CONSONANT})[ \x{{A0}}\x{{200B}}\x{{200C}}\x{{200D}}]+(్{CONSONANT})", "$1$2")
    return F.regexp_replace(c, rf"({CONSONANT}(?:్{CONSONANT})*)[ \x{{A0}}\x{{200B}}]+({SIGN})", "$1$2")


def repair_telugu(c: Column, passes: int = 5) -> Column:
    """Composed form, signs and joined consonants put back on their letters until stable, known words corrected."""
    out = nfc(c)
    for _ in range(passes):
        out = _rejoin(out)
    for wrong, right in WORD_FIXES:
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def has_split_virama(c: Column) -> Column:
    """Whether a joined consonant stands apart from its letter; false for null."""
    return F.coalesce(c.rlike(rf"{CONSONANT}[ \x{{A0}}\x{{200B}}\x{{200C}}\x{{200D}}]+్{CONSONANT}"), F.lit(False))


def collapse_space(c: Column) -> Column:
    """Each run of white space as one blank, none at the ends; null as empty."""
    return strip_space(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def glyph_counts(c: Column) -> dict[str, Column]:
    """Counts by which a text's glyphs are judged, 0 for null."""
    t = F.coalesce(c, F.lit(""))
    indep = F.regexp_count(t, F.lit(f"{CONSONANT}{FREE_VOWEL}"))
    apart = F.regexp_count(t, F.lit(rf"{CONSONANT}[\s]+{SIGN}"))
    virama = F.regexp_count(t, F.lit(rf"{CONSONANT}[\s]+్{CONSONANT}"))
    return {
        "char_count": F.length(t), "latin_leftover_count": F.regexp_count(t, F.lit(LATIN_LEFT)), "split_matra_count": indep + apart + virama,
        "split_virama_count": virama, "orphan_matra_count": F.regexp_count(t, F.lit(ORPHAN)),
    }


def telugu_mass(c: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), "[^ఀ-౿]", ""))


def word_set(c: Column) -> Column:
    """Distinct words of two or more Latin or Telugu letters."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Za-zఀ-౿]{2,}"), F.lit(0)))


def strip_space(c: Column) -> Column:
    """Without Unicode white space at the ends (trim only knows the plain blank)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_author(c: Column) -> Column:
    """Without dashes, dots, commas and blanks around it."""
    return F.regexp_replace(F.regexp_replace(strip_space(c), r"(?U)^[-–—\s]+", ""), r"^[ .,–—-]+|[ .,–—-]+$", "")


def plausible_author(c: Column) -> Column:
    name = clean_author(c)
    # What an author's line never holds, and three headings that look like one.
    no = name.rlike("(?i)ఇంకావుంది|నీతి|భావం|Printed|Published|సంపాదక|జవాబు|క్విజ్")
    return F.length(name).between(2, 50) & ~no & ~name.rlike(r"(?U)^\d+$") & ~name.isin("వినోదం", "విజ్ఞానం", "భావం")


def slug(title: Column, index: Column) -> Column:
    """NN_title without path characters, blanks as underscores, 60 characters at most."""
    safe = F.substring(F.regexp_replace(strip_space(F.regexp_replace(F.coalesce(title, F.lit("")), r'[<>:"/\\|?*]', "")), r"(?U)\s+", "_"), 1, 60)
    return F.concat(F.format_string("%02d_", index), F.when(safe == "", "article").otherwise(safe))


def edition_label(title: Column, year: Column, month: Column, fallback: Column) -> Column:
    """title (Y-MM), title (Y) or the title; the id where there is no title."""
    name = F.coalesce(F.nullif(title, F.lit("")), fallback)
    return F.when(year.isNotNull() & month.isNotNull(), F.format_string("%s (%d-%02d)", name, year, month)).when(year.isNotNull(), F.format_string("%s (%d)", name, year)).otherwise(name)


def edition_id_of(path: Column) -> Column:
    """YYYY/MM.pdf and YYYY-MM.pdf as YYYY-MM, else the lower-case stem without _extracted."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")
    folder = F.regexp_extract(path, r"(?:^|/)(\d{4})/(\d{1,2})\.[^./]*$", 1)
    month = F.regexp_extract(path, r"(?:^|/)(\d{4})/(\d{1,2})\.[^./]*$", 2)
    return F.when(folder != "", F.concat(folder, F.lit("-"), F.lpad(month, 2, "0"))).when(stem.rlike(r"^\d{4}-\d{2}$"), stem).otherwise(F.regexp_replace(F.lower(stem), "_extracted$", ""))


# Month names in file names.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def edition_of_file(path: Column, name: str = "Issue") -> tuple[Column, Column, Column]:
    """Title, year and month of a file named like jan2002.pdf; an unknown month is January, no date is January 2000."""
    base = F.lower(F.regexp_extract(path, r"([^/]*)$", 1))
    word, year = (F.regexp_extract(base, r"([a-z]{3,9})[-_]?(\d{4})", k) for k in (1, 2))
    number = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(word, 1, 3)), F.lit(0)), F.lit(1)).cast("int")
    none = word == ""
    title = F.when(none, F.lit(f"{name} Edition")).otherwise(F.concat(F.lit(f"{name} "), F.initcap(word), F.lit(" "), year))
    return title, F.when(none, 2000).otherwise(year.try_cast("int")), F.when(none, 1).otherwise(number)


def edition_info(path: Column, name: str = "Issue") -> tuple[Column, Column, Column]:
    """Title, year and month by the edition id of a path, if it is YYYY-MM, else by the file's name."""
    eid = edition_id_of(path)
    year, month = (F.regexp_extract(eid, r"^(\d{4})-(\d{2})$", k).try_cast("int") for k in (1, 2))
    named = F.coalesce(F.try_element_at(F.array(*(F.lit(m.capitalize()) for m in MONTHS)), F.nullif(month, F.lit(0))), month.cast("string"))
    title, y, m = edition_of_file(path, name)
    dated = year.isNotNull()
    return F.when(dated, F.concat(F.lit(f"{name} "), named, F.lit(" "), year.cast("string"))).otherwise(title), F.coalesce(year, y), F.when(dated, month).otherwise(m)


def page_indexes(spec: Column, pages: Column) -> Column:
    """Page numbers from 0 that a list like '1-5,10' names, in order, each once, within ``pages``; all for an empty list."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda x: F.trim(x)), lambda x: x != "")
    bounds = F.transform(parts, lambda x: F.struct(F.split(x, "-", 2)[0].try_cast("int").alias("a"), F.coalesce(F.get(F.split(x, "-", 2), F.lit(1)), x).try_cast("int").alias("b")))
    run = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    named = F.flatten(F.transform(bounds, lambda r: run(F.greatest(r["a"], F.lit(1)), F.least(r["b"], pages))))
    return F.when(F.coalesce(spec, F.lit("")) == "", run(F.lit(0), pages - 1)).otherwise(F.array_sort(F.array_distinct(F.transform(named, lambda x: x - 1))))


def typed_authors(c: Column) -> Column:
    """The names of a list typed with commas, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip_space), lambda x: x != "")


# Words that mark a serial in a contents title, and columns that recur, the first found counting.
SERIAL = ("సీరియల్", "సీరియలు", "serial")
COLUMNS = (
    "తెలుసుకుందాం", "తెలుసుకుందామా", "విద్యార్థులారా", "స్వామి సందేశం", "స్వామి సూక్తులు", "సాయిమాట", "పద్య సూక్తి", "మన చారిత్రక", "బొమ్మల కథ",
    "స్వామి కథ", "నీతి కథలు", "విజ్ఞానం", "స్వామితో నా అనుభవం",
)


def detect_series(title: Column) -> Column:
    """The series a contents title names: what stands before dots or a bracket in a serial, else a known column; null for none."""
    serial = F.greatest(*(title.contains(m) for m in SERIAL))
    base = F.regexp_replace(F.split(title, r"\.{2,}|\(", 2)[0], r"^[ .]+|[ .]+$", "")
    known = F.coalesce(*(F.when(title.contains(c), F.lit(c)) for c in COLUMNS))
    return F.when(serial, F.coalesce(F.nullif(base, F.lit("")), title)).otherwise(known)


def glyph_font(font: Column) -> Column:
    """Whether a font's name is one of the glyph fonts; false for null."""
    # Parts of the names of fonts that hold glyphs in place of letters.
    return F.coalesce(F.lower(font).rlike("priyaanka|ajantha|brahma|manupama|royankee|anu|kranthi|ramana|ramanabrush"), F.lit(False))


def volume_issue(c: Column) -> tuple[Column, Column]:
    """Volume and issue number named in a text; null where there is none."""
    def number(word: str) -> Column:
        found = F.regexp_extract(c, rf"(?U){word}\s*(\d+)", 1)
        return F.translate(found, "౦౧౨౩౪౫౬౭౮౯", "0123456789").try_cast("int")

    return number("సంపుటి"), number("సంచిక")


# Headings of a table of contents.
TOC_MARKERS = ("విషయాలు", "పుట సంఖ్య", "క్రమసంఖ్య", "ఈ సంచికలో")


def toc_score(c: Column) -> Column:
    """3 for each marker in a page and 1 for each numbered line, 10 at most."""
    marks = sum((F.when(c.contains(m), 3).otherwise(0) for m in TOC_MARKERS), F.lit(0))
    return marks + F.least(F.lit(10), F.regexp_count(c, F.lit(r"(?Umd)^\s*\d+\s*[.]")))


def scope_years(scope: str | None) -> tuple[int | None, int | None]:
    """'2000s' as that year and nine more, '2026' as itself, anything else as no bound."""
    if m := re.fullmatch(r"(\d{4})(s?)", scope or ""):
        year = int(m[1])
        return year, year + (9 if m[2] else 0)
    return None, None


def in_years(year: Column, first: int | None, last: int | None) -> Column:
    """Both ends inclusive, each optional; a null year is outside any bound."""
    ok = F.lit(True)
    if first is not None:
        ok = ok & (year >= first)
    if last is not None:
        ok = ok & (year <= last)
    return ok


def html_bold(c: Column) -> Column:
    """Escaped for HTML, but for <b> marks."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"), ("&lt;b&gt;", "<b>"), ("&lt;/b&gt;", "</b>")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c
