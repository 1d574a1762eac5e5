"""p4: text that looks the same and differs in its characters, brought to one form.

Every word is mapped by a table of look-alikes, the mapped values are grouped under the accent-sensitive Unicode
collation (which also makes composed and decomposed accents equal), each class gets one canonical member, and that is
joined back to the words. A record is a case where some word isn't its class's canonical member.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punji.runtime import cut

# Characters nobody sees, and blanks other than space, tab and line break.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋᠌᠍᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩⁪⁫⁬⁭⁮⁯︀︁︎️﻿"
BLANKS = "               　"
# Cyrillic and Greek letters drawn like Latin ones.
CYRILLIC = ("АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝһӏ", "ABESIJKMHOPCTYXaesijopcyxdqwhl")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανικρυ", "ABEZHIKMNOPTYXoavikpu")
# Armenian and Cherokee letters drawn like Latin ones.
ARMENIAN = ("օսհցԼՏՕ", "ouhgLSO")
CHEROKEE = ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏚᏞᏟᏢᏦᏴ", "DRTAJEWMHGZSLCPKB")
# Kannada letters lie 0x80 above their Telugu partners; these are drawn alike.
KANNADA = "ಂಃಅಆಇಈಉಊಒಓಔಗಜಠಡಢಣದಧನಬಭಮಯರಱಲಳವಶಸಾಿುೂೃ್೦೧೨೩೪೫೬೭೮೯"

_LETTERS = dict(zip(map(ord, CYRILLIC[0] + GREEK[0] + ARMENIAN[0] + CHEROKEE[0]), CYRILLIC[1] + GREEK[1] + ARMENIAN[1] + CHEROKEE[1], strict=True))
_ALWAYS = {ord(c): chr(ord(c) - 0x80) for c in KANNADA} | {ord(c): " " for c in BLANKS} | dict.fromkeys(map(ord, INVISIBLE))
# Full-width forms, joined letters, mathematical letters and Roman numerals, by their compatibility forms.
COMPATIBLE = ((0xFF01, 0xFF5E), (0xFB00, 0xFB04), (0x1D400, 0x1D7FF), (0x2160, 0x217F))
_ALWAYS |= {c: unicodedata.normalize("NFKC", chr(c)) for low, high in COMPATIBLE for c in range(low, high + 1) if unicodedata.category(chr(c)) != "Cn"}
_LATIN = re.compile(r"[A-Za-zＡ-Ｚａ-ｚ]")
_TELUGU = re.compile(r"[ఀ-౿]")
_ZERO = re.compile(r"(?<=[అ-ౌ])౦(?![౦-౯])")  # the digit zero behind a letter, for the sign of m
_RING = re.compile(r"(?<=[అ-ౌ])[oO0○◦](?=[ఀ-౿]|$)")
# What can make a word differ from its look: the operator's cheap test, run by the JVM.
_ODD = "".join(sorted(INVISIBLE + BLANKS)) + "".join(x[0] for x in (CYRILLIC, GREEK, ARMENIAN, CHEROKEE)) + KANNADA + "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in COMPATIBLE) + "\\x{300}-\\x{36F}"
SUSPECT = f"[{_ODD}]|[అ-ౌ][౦oO0○◦]|ౖ"
# Much cheaper for whole texts, and implied by it: one pass takes away ASCII and Telugu, but for the two signs that
# matter, and only the short rest is held against the long class; rings that are ASCII are looked for from themselves.
PLAIN = r"[\x00-\x7F\x{C00}-\x{C55}\x{C57}-\x{C65}\x{C67}-\x{C7F}]+"
RING = r"[oO0](?<=[\x{C05}-\x{C4C}].)"


def unusual(column) -> F.Column:
    """The cheap test for whole texts, before they are cut into words."""
    return F.regexp_replace(column, PLAIN, "").rlike(f"[{_ODD}౦○◦ౖ]") | column.rlike(RING)


def suspicious(column) -> F.Column:
    """Whether a text or word can hold anything to be mapped."""
    return unusual(column) & column.rlike(SUSPECT)


def plain_look(text: str) -> str:
    """``text`` with look-alikes mapped to the ordinary characters, in composed form.

    Letters of other scripts are mapped only in words that also hold Latin letters or that consist of look-alikes
    alone; Kannada signs become Telugu ones.
    """
    out = text.translate(_ALWAYS)
    if any(ord(c) in _LETTERS for c in out):
        parts = re.split(r"(\s+)", out)
        for i, part in enumerate(parts):
            if _LATIN.search(part) or all(ord(c) in _LETTERS or not c.isalpha() for c in part):
                parts[i] = part.translate(_LETTERS)
        out = "".join(parts)
    if _TELUGU.search(out):
        out = _RING.sub("ం", _ZERO.sub("ం", out))
    return unicodedata.normalize("NFC", out)


def _map_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(mapped=pdf["word"].map(plain_look))


def canonical_words(words: DataFrame) -> DataFrame:
    """(word, canonical) for the words of ``words`` (word, n) that aren't the canonical member of their class.

    ``words`` has each word once with its count. A class holds the words whose mapped forms are equal under the
    accent-sensitive collation UNICODE. Its canonical member is the most frequent word that is its own mapped form
    (ties: the smaller by code point), or the mapped form itself if the class has no such word. An empty table gives
    an empty result, null words are left out.
    """
    words = cut(words)
    odd = words.where(suspicious(F.col("word"))).select("word").mapInPandas(_map_words, "word string, mapped string").where("word <> mapped")
    mapped = words.where("word is not null").join(odd, "word", "left").select("word", "n", F.coalesce("mapped", "word").alias("mapped"))
    mapped = cut(mapped)
    mapped.createOrReplaceTempView("punji_mapped_words")
    spark = words.sparkSession
    return spark.sql(
        """
        with odd as (select word, mapped, mapped collate UNICODE as look from punji_mapped_words where word <> mapped),
        looks as (select look, min(mapped collate UTF8_BINARY) as mapped from odd group by look),
        members as (
          select l.look, max_by(m.word, struct(m.n, -length(m.word), m.word)) as best
          from looks l join punji_mapped_words m on m.word = m.mapped and m.mapped collate UNICODE = l.look
          group by l.look)
        select o.word, coalesce(m.best, l.mapped) as canonical
        from odd o join looks l on o.look = l.look left join members m on o.look = m.look
        where o.word <> coalesce(m.best, l.mapped)
        """
    )


def _words(records: DataFrame) -> DataFrame:
    return records.select("field", "id", F.explode(F.split("text", "[ \\t\\n\\r]+")).alias("word")).where("word <> ''")


def canonical_map(records: DataFrame) -> DataFrame:
    """(word, canonical) over all words of ``records``; every delivery of a row counts in the choice of a member."""
    return canonical_words(_words(records).groupBy("word").agg(F.count("*").alias("n")))


def odd_records(records: DataFrame) -> DataFrame:
    """(field, id) of the records of (field, id, text) that hold a word which isn't canonical.

    Null and empty texts hold none; a record delivered twice counts once. Only words that match SUSPECT can differ
    from their mapped form, so the others needn't be joined.
    """
    changed = canonical_map(records)
    held = _words(records.where(unusual(F.col("text")))).where(suspicious(F.col("word"))).select("field", F.col("id").cast("string").alias("id"), "word").distinct()
    return held.join(changed, "word").select("field", "id").distinct()


def unified(records: DataFrame) -> DataFrame:
    """(field, id, text): the odd records of (field, id, text) with each word replaced by its canonical member.

    Words are joined back in their order; the blanks between them stay as they were.
    """
    changed = canonical_map(records)
    odd = records.where(unusual(F.col("text"))).select("field", F.col("id").cast("string").alias("id"), "text").dropDuplicates(["field", "id"])
    pieces = odd.select("field", "id", F.posexplode(F.regexp_extract_all("text", F.lit(r"[^ \t\n\r]+|[ \t\n\r]+"), F.lit(0))).alias("at", "word"))
    joined = pieces.join(changed, "word", "left").groupBy("field", "id").agg(
        F.array_sort(F.collect_list(F.struct("at", F.coalesce("canonical", "word").alias("w")))).alias("ws"), F.max(F.col("canonical").isNotNull()).alias("odd")
    )
    return joined.where("odd").select("field", "id", F.array_join(F.col("ws.w"), "").alias("text"))
