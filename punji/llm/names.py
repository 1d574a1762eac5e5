"""p1: variant spellings of the names of persons and bodies.

Distinct names are reduced to token keys that both scripts share. A set-similarity join on syllable q-grams of the
tokens (weighted by rarity, prefix-filtered) proposes pairs; each is verified by a soft weighted token similarity in
which rare tokens count more. Full spellings linked by slips of the pen form entities (connected components);
shortened spellings (initials, pet names, a name left out) join every entity they can stand for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punji.functions.translit import reduced_key, syllables
from punji.operators.components import connected_components
from punji.runtime import cut

# Forms of address, which say nothing about who is meant.
HONORIFICS = frozenset("శ్రీ శ్రీమతి కుమారి డా డాక్టర్ ప్రొ ఆచార్య పండిత్ గారు గారి sri shri smt srimati shrimati kumari dr mr mrs ms prof garu".split())
# Pet names that share too few letters with the name they stand for (reduced keys).
PET_NAMES = {"kitu": "krusna", "kistaya": "krusna", "laci": "laksmi", "laksi": "laksmi"}
MIN_SIMILARITY = 0.7  # soft weighted similarity of the smaller name
MIN_SHARED = 0.35  # part of the smaller name's q-gram weight that must be shared

_SEPARATOR = re.compile(r"[\s,;/()\-]+")


def name_tokens(name: str) -> list[str]:
    """Keys of the words of ``name``, initials with a dot behind them, in sorted order; [] for an empty name."""
    out = []
    for chunk in _SEPARATOR.split(name):
        pieces = re.findall(r"[^.]+\.?", chunk)
        for piece in pieces:
            word = piece.rstrip(".")
            if word.lower() in HONORIFICS:
                continue
            key = reduced_key(word)
            if not key:
                continue
            short = (len(syllables(key)) <= 1 and len(key) <= 4) or (piece.endswith(".") and len(key) <= 5)
            out.append(key + "." if short else key)
    return sorted(out)


def grams(token: str) -> list[str]:
    """Padded syllable bigrams of a full token; none for an initial."""
    if token.endswith("."):
        return []
    parts = ["^", *syllables(token), "$"]
    return [f"{a}{b}" for a, b in zip(parts, parts[1:])]


def _slips(a: str, b: str, most: int) -> int:
    """Edits with adjacent transpositions from ``a`` to ``b``, ``most`` + 1 where there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        now = [i] + [0] * len(b)
        for j in range(1, len(b) + 1):
            x = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                x = min(x, before[j - 2] + 1)
            now[j] = x
        if min(now) > most:
            return most + 1
        before, row = row, now
    return row[-1]


def _pet(short: str, full: str) -> bool:
    if len(short) >= len(full) or len(short) > 7:
        return False
    if PET_NAMES.get(short, "\0") in full:
        return True
    return (len(short) >= 3 and short[:3] == full[:3]) or (len(short) >= 4 and full.endswith(short))


def compare(a: list[str], b: list[str], weight: dict[str, float]) -> tuple[str, float]:
    """How two names relate and how alike they are: same, a_short, b_short or differ.

    Words are matched exactly or with slips first, then initials, then pet names. A full word left over on both sides
    means different names, as does an initial that fits nothing.
    """
    rest_a, rest_b = list(a), list(b)
    matched: list[tuple[str, str, float]] = []
    for most in (0, 1, 2):
        for x in list(rest_a):
            if x.endswith(".") and most:
                continue
            limit = min(most, 0 if len(x) < 4 else 1 if len(x) < 8 else 2)
            if limit < most:
                continue
            for y in rest_b:
                if not (y.endswith(".") and most) and _slips(x, y, most) <= most:
                    matched.append((x, y, 1 - 0.1 * most))
                    rest_a.remove(x)
                    rest_b.remove(y)
                    break
    for one, other in ((rest_a, rest_b), (rest_b, rest_a)):  # two words run together
        for x in list(one):
            for y in list(other):
                for z in list(other):
                    if x in one and y in other and z in other and y != z and not x.endswith(".") and _slips(x, y + z, 1) <= 1:
                        matched += [(x, y, 0.9), (x, z, 0.9)] if one is rest_a else [(y, x, 0.9), (z, x, 0.9)]
                        one.remove(x)
                        other.remove(y)
                        other.remove(z)
    if not matched or max(weight.get(x, 9.0) for x, _, _ in matched) < 0.5 * max(weight.get(x, 9.0) for x in a + b if not x.endswith(".")):
        return "differ", 0.0
    a_short = b_short = False
    for x in list(rest_a):
        for y in list(rest_b):
            stem_x, stem_y = x.rstrip("."), y.rstrip(".")
            if x.endswith(".") and y.startswith(stem_x) or not x.endswith(".") and not y.endswith(".") and _pet(x, y):
                a_short = True
            elif y.endswith(".") and x.startswith(stem_y) or not x.endswith(".") and not y.endswith(".") and _pet(y, x):
                b_short = True
            else:
                continue
            matched.append((x, y, 0.8))
            rest_a.remove(x)
            rest_b.remove(y)
            break
    if (rest_a and rest_b) or any(x.endswith(".") for x in rest_a + rest_b):
        return "differ", 0.0
    a_short |= bool(rest_b)
    b_short |= bool(rest_a)
    if a_short and b_short:
        return "differ", 0.0
    smaller = b if b_short else a
    total = sum(weight.get(x, 9.0) for x in smaller if not x.endswith(".")) or 1.0
    side = 1 if b_short else 0
    score = sum(weight.get(m[side], 9.0) * m[2] for m in matched if not m[side].endswith(".")) / total
    if len(matched) == 1 and not a_short and not b_short and len(a) > 1:
        return "differ", 0.0
    if score < MIN_SIMILARITY:
        return "differ", score
    return ("a_short" if a_short else "b_short" if b_short else "same"), score


def _tokens_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        tokens = pdf["name"].map(name_tokens)
        yield pd.DataFrame({"name": pdf["name"], "sig": tokens.map(" ".join)})


def _grams_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(sig, gram) for sig in pdf["sig"] for gram in sorted({g for t in sig.split(" ") for g in grams(t)})]
        yield pd.DataFrame(rows, columns=["sig", "gram"])


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for a, b, wa, wb in zip(pdf["a"], pdf["b"], pdf["wa"], pdf["wb"], strict=True):
            ta, tb = a.split(" "), b.split(" ")
            kind, score = compare(ta, tb, dict(zip(ta, wa, strict=True)) | dict(zip(tb, wb, strict=True)))
            if kind != "differ":
                out.append((a, b, kind, float(score)))
        yield pd.DataFrame(out, columns=["a", "b", "kind", "score"])


def name_links(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name, sig) of every distinct non-empty ``name``, and the verified links (a, b, kind, score) of signatures.

    Repeated names count once; null and blank names are left out; names that reduce to the same tokens share a
    signature and need no link. Other columns of ``names`` are ignored.
    """
    signed = cut(
        names.select("name").where("name is not null and trim(name) <> ''").distinct()
        .mapInPandas(_tokens_of, "name string, sig string").where("sig <> ''")
    )
    sigs = signed.select("sig").distinct()
    total = sigs.agg(F.count("*").alias("total"))  # one row
    tokens = sigs.select("sig", F.posexplode(F.split("sig", " ")).alias("at", "token"))
    counts = tokens.select("sig", "token").distinct().groupBy("token").agg(F.count("*").alias("df"))
    weights = counts.join(total).select("token", F.log(1 + F.col("total") / F.col("df")).alias("w"))
    weighted = (
        tokens.join(weights, "token").groupBy("sig")
        .agg(F.array_sort(F.collect_list(F.struct("at", "w"))).alias("ws")).select("sig", F.col("ws.w").alias("ws"))
    )
    posted = sigs.mapInPandas(_grams_of, "sig string, gram string")
    gram_df = posted.groupBy("gram").agg(F.count("*").alias("df"))
    posted = cut(posted.join(gram_df, "gram").join(total).select("sig", "gram", F.log(1 + F.col("total") / F.col("df")).alias("w")))
    # Prefix: the rarest grams of a name, up to where the rest weighs less than the part that must be shared.
    whole = posted.groupBy("sig").agg(F.sum("w").alias("whole"), F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("r"), "gram"))).alias("gs"))
    prefix = (
        whole.select("sig", "whole", F.posexplode("gs").alias("at", "g"), "gs")
        .select("sig", F.col("g.gram").alias("gram"), F.expr("aggregate(slice(gs, 1, at), 0D, (s, x) -> s - x.r)").alias("before"), "whole")
        .where(F.col("before") <= (1 - MIN_SHARED) * F.col("whole") + 1e-9)
        .select("sig", "gram")
    )
    pairs = (
        prefix.withColumnRenamed("sig", "p").join(posted.select("gram", F.col("sig").alias("q")), "gram").where("p <> q")
        .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    )
    wa, wb = (weighted.select(F.col("sig").alias(s), F.col("ws").alias(f"w{s}")) for s in "ab")
    verified = pairs.join(wa, "a").join(wb, "b").select("a", "b", "wa", "wb").mapInPandas(_verify, "a string, b string, kind string, score double")
    return signed, cut(verified)


def _final_parts(arcs: DataFrame) -> DataFrame:
    """(from, to) for every ``from`` of ``arcs`` with each part at the end of a way along them.

    Where every way runs in a circle, the parts stand for themselves and for those that arcs lead to.
    """
    arcs = arcs.select("from", "to")
    inner = cut(arcs.select("from").distinct())
    reached, fresh = arcs, arcs.join(inner.withColumnRenamed("from", "to"), "to", "left_semi").select("from", "to")
    while True:  # a round for each further arc of the longest way; mostly the short form fits the end directly
        onward = fresh.join(arcs.select(F.col("from").alias("to"), F.col("to").alias("next")), "to").where("from <> next")
        fresh = cut(onward.select("from", F.col("next").alias("to")).distinct().join(reached, ["from", "to"], "left_anti"))
        if fresh.isEmpty():
            break
        reached = cut(reached.unionByName(fresh))
    ends = reached.join(inner.withColumnRenamed("from", "to"), "to", "left_anti").select("from", "to")
    circling = cut(inner.join(ends.select("from").distinct(), "from", "left_anti"))
    into = arcs.join(circling.withColumnRenamed("from", "to"), "to", "left_semi").select("from", "to")
    return ends.unionByName(into).unionByName(circling.select("from", F.col("from").alias("to")))


def name_entities(names: DataFrame) -> DataFrame:
    """(name, entity): every distinct name with each entity it can stand for; a name without links is its own."""
    signed, links = name_links(names)
    sigs = signed.select("sig").distinct()
    parts = connected_components(links.where("kind = 'same'"))
    part = cut(sigs.join(parts, F.col("sig") == F.col("node"), "left").select("sig", F.coalesce("component", "sig").alias("part")))
    short = links.where("kind <> 'same'").select(
        F.when(F.col("kind") == "a_short", F.col("a")).otherwise(F.col("b")).alias("less"),
        F.when(F.col("kind") == "a_short", F.col("b")).otherwise(F.col("a")).alias("more"),
        "score",
    )
    arcs = cut(
        short.join(part.select(F.col("sig").alias("less"), F.col("part").alias("from")), "less")
        .join(part.select(F.col("sig").alias("more"), F.col("part").alias("to")), "more")
        .where(F.col("from") != F.col("to")).groupBy("from", "to").agg(F.max("score").alias("score"))
    )
    stands = _final_parts(arcs).unionByName(part.select(F.col("part").alias("from"), F.col("part").alias("to")).join(arcs.select("from").distinct(), "from", "left_anti"))
    stands = stands.select(F.col("from").alias("part"), F.col("to").alias("entity")).distinct()
    return signed.join(part, "sig").join(stands, "part").select("name", "entity").distinct()


def same_name_pairs(names: DataFrame) -> DataFrame:
    """(name_a, name_b), each pair of distinct spellings of one entity once, the smaller first."""
    entities = cut(name_entities(names))
    a, b = (entities.select(F.col("name").alias(f"name_{s}"), "entity") for s in "ab")
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b").distinct()


def written_names(catalog: DataFrame, articles: DataFrame) -> DataFrame:
    """The author names of both fields as written; a malformed authors_json gives none."""
    listed = articles.select(F.explode(F.from_json("authors_json", "array<string>")).alias("name"))
    return catalog.where("kind = 'author'").select(F.col("text").alias("name")).unionByName(listed)
