"""Edit distance on code points (a true metric)."""

from __future__ import annotations


def levenshtein(a: str, b: str) -> int:
    """Least number of insertions, deletions and substitutions that turn ``a`` into ``b``.

    One column of the dynamic programme is held as two bit vectors (rises and falls), so a step costs a few integer
    operations whatever the length of ``a``.
    """
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    top = 1 << (len(a) - 1)
    rises, falls, distance = full, 0, len(a)
    for ch in b:
        equal = places.get(ch, 0)
        diagonal = (((equal & rises) + rises) ^ rises) | equal | falls
        up = falls | (full & ~(diagonal | rises))
        down = rises & diagonal
        distance += bool(up & top) - bool(down & top)
        up = ((up << 1) | 1) & full
        down = (down << 1) & full
        rises = down | (full & ~(diagonal | up))
        falls = up & diagonal
    return distance
