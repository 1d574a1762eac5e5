"""Legacy glyph fonts to Unicode: table-driven longest-match decoding and ordered replacement rules.

The tables are inputs: rows of (glyphs, text, role). Roles: base (a letter), sign (a vowel sign that follows its
letter), pre (a sign drawn before its letter), tail (a joined consonant below), other (taken over as it is).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

VIRAMA = "్"
MAX_RULES = 50_000  # rows of a table that are sent to the tasks


@dataclass(frozen=True)
class Rule:
    glyphs: str
    text: str
    role: str = "base"


def load_rules(rules: DataFrame) -> list[Rule]:
    """The rules of a table, the longest glyph strings first, the first of equal ones kept; raises beyond MAX_RULES."""
    rows = rules.where("glyphs is not null and glyphs <> ''").select("glyphs", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("base")).alias("role")).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError("too many rules for one table")
    first: dict[str, Rule] = {}
    for r in rows:
        first.setdefault(r["glyphs"], Rule(r["glyphs"], r["text"], r["role"]))
    return sorted(first.values(), key=lambda r: (-len(r.glyphs), r.glyphs))


def rules_from_letters(letters: DataFrame) -> DataFrame:
    """(glyphs, text, role) from a table made for writing (text, glyphs, kind, position): which letters a glyph string reads as.

    ``kind`` is base, tail or sign, ``position`` the order of the table's rows. Digits are left out, base entries that
    begin with a vowel sign are signs. Where several letters are written alike the last counts, but letters of the two
    rare affricates only where no other is written so; of those the first.
    """
    # Telugu digits, vowel signs and the two rare affricates.
    known = letters.where("glyphs <> '' and text <> ''").where(~F.col("text").rlike("^[౦-౯]"))
    role = F.when((F.col("kind") == "base") & F.col("text").rlike("^[ా-ౌ]"), "sign").otherwise(F.col("kind"))
    entry = F.struct("text", role.alias("role"))
    rare = F.col("text").rlike("[ౘౙ]")
    chosen = F.coalesce(F.max_by(entry, F.when(~rare, F.col("position"))), F.min_by(entry, F.col("position")))
    return known.groupBy("glyphs").agg(chosen.alias("c")).select("glyphs", "c.text", "c.role")


def reorder_signs(c: Column) -> Column:
    """Signs that are drawn before their letters put behind the whole cluster, and joined consonants before vowel signs."""
    # The three glyphs left from decoding that stand before a cluster, and what they read as.
    cluster = r"([క-హౘ-ౚౠ-ౡ](?:్[క-హౘ-ౚౠ-ౡ])*[ా-ౄె-ౌౕౖఁ-ః]*)"
    for glyph, sign in (("¿", "ే"), ("Ã", "ె"), ("„", "్ర")):
        c = F.regexp_replace(c, glyph + cluster, "$1" + sign)
    return F.regexp_replace(c, r"([క-హౘ-ౚ])([ా-ౄె-ౌౕౖ])్([క-హౘ-ౚ])", "$1్$3$2")


class Decoder:
    """Decodes by syllables: what is drawn before a letter waits for it, signs and tails are put in spoken order."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = {r.glyphs: r for r in rules}
        longest_first = sorted(self.rules, key=len, reverse=True)
        self.pattern = re.compile("|".join(map(re.escape, longest_first)) or r"(?!)")

    def decode(self, text: str) -> str:
        out: list[str] = []
        waiting = ""
        base, tails, signs = "", "", ""

        def close() -> None:
            nonlocal base, tails, signs
            if base or tails or signs:
                out.append(base + tails + signs)
            base = tails = signs = ""

        at = 0
        while at < len(text):
            m = self.pattern.match(text, at)
            if not m:
                close()
                out.append(text[at])
                at += 1
                continue
            rule = self.rules[m[0]]
            at = m.end()
            if rule.role == "pre":
                close()
                waiting += rule.text
            elif rule.role == "sign":
                signs += rule.text
            elif rule.role == "tail":
                tails += rule.text if rule.text.startswith(VIRAMA) else VIRAMA + rule.text
            else:
                close()
                base = rule.text
                if rule.role == "base" and waiting:
                    signs, waiting = waiting, ""
        close()
        return "".join(out) + waiting


def decode_glyphs(c: Column, rules: DataFrame) -> Column:
    """The decoded text of a column; null stays null, glyphs without a rule stay as they are."""
    listed = load_rules(rules)

    @F.pandas_udf(StringType())
    def decode(texts: pd.Series) -> pd.Series:
        decoder = Decoder(listed)
        return texts.map(decoder.decode, na_action="ignore")

    return decode(c)


def replace_in_order(c: Column, rules: DataFrame) -> Column:
    """All rules applied one after the other, the longest first, each to the whole text."""
    listed = load_rules(rules)

    @F.pandas_udf(StringType())
    def replace(texts: pd.Series) -> pd.Series:
        for r in listed:
            texts = texts.str.replace(r.glyphs, r.text, regex=False)
        return texts

    return replace(c)


def _mac_to_windows() -> tuple[str, str]:
    source, target = "", ""
    for b in range(0x80, 0x100):
        mac = bytes([b]).decode("mac_roman")
        try:
            windows = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            windows = chr(b)
        if mac != windows:
            source, target = source + mac, target + windows
    return source, target


def mac_to_windows(c: Column) -> Column:
    """Text whose bytes were read as Mac Roman, as if read as Windows-1252 (the Greek delta as the increment sign)."""
    source, target = _mac_to_windows()
    return F.translate(F.replace(c, F.lit("Δ"), F.lit("∆")), source, target)
