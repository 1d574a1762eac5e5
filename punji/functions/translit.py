"""Reduced Latin keys for Telugu and Latin spellings, so that both scripts and common slips meet."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# The Latin reduction of each Telugu letter. Aspirates, retroflexes and long vowels share a key with
# their plain partners.
CONSONANTS = dict(
    zip(
        "కఖగఘఙచఛజఝఞటఠడఢణతథదధనపఫబభమయరఱలళవశషసహఴ",
        "k k g g n c c j j n t t d d n t t d d n p p b b m y r r l l v s s s h l".split(),
        strict=True,
    )
)
VOWELS = dict(zip("అఆఇఈఉఊఋఎఏఐఒఓఔ", "a a i i u u ru e e ai o o au".split(), strict=True))
SIGNS = dict(zip("ాిీుూృెేైొోౌ", "a i i u u ru e e ai o o au".split(), strict=True))
VIRAMA, ANUSVARA, VISARGA = "్", "ం", "ః"

_LATIN = [(re.compile(a), b) for a, b in (("chh", "c"), ("ch", "c"), ("sh", "s"), ("([kgjtdpb])h", r"\1"), ("ee", "i"), ("oo", "u"), ("w", "v"), ("z", "j"), ("q", "k"), ("x", "ks"), ("f", "p"))]
_DOUBLE = re.compile(r"(.)\1+")
_NASAL = re.compile(r"m(?=[kgcjtdpbsh]|$)")


def _telugu(word: str) -> str:
    out: list[str] = []
    bare = False  # the last consonant still carries its inherent vowel
    for ch in word:
        if ch in CONSONANTS:
            if bare:
                out.append("a")
            out.append(CONSONANTS[ch])
            bare = True
        elif ch in SIGNS:
            out.append(SIGNS[ch])
            bare = False
        elif ch == VIRAMA:
            bare = False
        else:
            if bare:
                out.append("a")
                bare = False
            out.append("m" if ch == ANUSVARA else "h" if ch == VISARGA else VOWELS.get(ch, ch))
    if bare:
        out.append("a")
    return "".join(out)


@lru_cache(maxsize=1 << 17)
def reduced_key(word: str) -> str:
    """The key of one word: lower-case Latin, no aspirates, short vowels, single consonants; digits stay."""
    latin = _telugu(word).lower()
    latin = "".join(c for c in unicodedata.normalize("NFD", latin) if not unicodedata.combining(c))
    for pattern, to in _LATIN:
        latin = pattern.sub(to, latin)
    return _DOUBLE.sub(r"\1", _NASAL.sub("n", _DOUBLE.sub(r"\1", latin)))


def syllables(key: str) -> list[str]:
    """``key`` cut after each vowel run, e.g. bunajedeva -> bu na je de va."""
    return re.findall(r"[^aeiou]*[aeiou]+(?:[^aeiou]+$)?|[^aeiou]+$", key)
