"""p3: freely typed values mapped to the entry of a reference list that they mean.

The forms of every reference entry (name, other names, words in another order, a word left out, run together,
initials) stand in a BK-tree under the Levenshtein metric on reduced keys. The list is cut into shards of about
SHARD_REFERENCES entries, a tree each, and every block of values meets every shard; the triangle inequality prunes,
every form within the threshold is returned and ranked, and the shards' winners are merged.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punji.functions.edit import levenshtein
from punji.functions.translit import reduced_key
from punji.llm.lookalikes import plain_look
from punji.runtime import cut

SHARD_REFERENCES = 20_000  # reference entries in one tree
BLOCK_VALUES = 50_000  # distinct values that a task holds against a shard
# Words that people put before or behind a series' name.
AROUND = frozenset("శీర్షిక series భాగం ప్రత్యేకం కొనసాగింపు సంచిక part no old vol volume column special new contd continued issue ధారావాహిక".split())
NOTHING = 999.0  # the cost where no entry is meant
_WORD = re.compile(r"[^\s,_\-:;*'\"“”‘’()#/|\[\]]+")


class BKTree:
    """Values under a metric; ``within`` returns each value at most ``limit`` away, pruned by the triangle inequality."""

    def __init__(self, values=()) -> None:
        self.root: list | None = None
        for v in values:
            self.add(v)

    def add(self, value: str) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := levenshtein(value, node[0]):
            if d not in node[1]:
                node[1][d] = [value, {}]
                return
            node = node[1][d]

    def within(self, value: str, limit: int) -> list[tuple[int, str]]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            held, children = todo.pop()
            d = levenshtein(value, held)
            if d <= limit:
                found.append((d, held))
            todo += [child for edge, child in children.items() if d - limit <= edge <= d + limit]
        return sorted(found)


def words_of(value: str) -> tuple[list[str], bool]:
    """The words of a typed value without ornaments, numbers and words around a name; whether it is initials."""
    text = plain_look(value)
    text = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", text)
    initials = bool(re.fullmatch(r"\W*(?:[^\s.\d]{1,6}\.\s?){2,}[\s\W]*", text))
    raw = re.findall(r"[^\s.]+", text) if initials else [w.strip(".") for w in _WORD.findall(text)]
    out = [w.lower() for w in raw if w and not re.fullmatch(r"[\d.]+", w) and w.lower().strip(".") not in AROUND]
    return out, initials


def _first(word: str) -> str:
    m = re.match(r"[అ-హ][ా-ౌం]*(?:్[క-హ][ా-ౌం]*)*|.", word)
    return reduced_key(m[0])


def forms(name: str) -> dict[str, int]:
    """Keys under which ``name`` can be typed, with a handicap: 0 whole, 1 another order or a word left out."""
    words = [reduced_key(w) for w in words_of(name)[0]]
    out = {"".join(words): 0}
    if len(words) > 1:
        out.setdefault("".join(sorted(words)), 0)
    if len(words) > 2:
        for i in (0, len(words) - 1):
            out.setdefault("".join(words[:i] + words[i + 1 :]), 1)
    return {k: v for k, v in out.items() if k}


def tolerance(key: str) -> int:
    """Edits allowed on a key of this length: none up to 3 letters, then 1, 2 from 7, 3 from 11, 4 from 15."""
    return sum(len(key) >= least for least in (4, 7, 11, 15))


class Matcher:
    """One shard of the reference list; ``best`` gives (cost, reference) of the closest entry within tolerance."""

    def __init__(self, references: list[tuple[int, str]]) -> None:
        self.owner: dict[str, list[tuple[int, int, str]]] = {}
        self.initials: dict[str, list[int]] = {}
        for ref, name in references:
            for form, handicap in forms(name).items():
                self.owner.setdefault(form, []).append((handicap, ref, name.lower()))
            words = words_of(name)[0]
            self.initials.setdefault("|".join(_first(w) for w in words), []).append(ref)
        self.tree = BKTree(self.owner)
        self._found: dict[str, list[tuple[int, str]]] = {}

    def _within(self, key: str) -> list[tuple[int, str]]:
        if key not in self._found:
            if len(self._found) > 100_000:
                self._found.clear()
            self._found[key] = self.tree.within(key, tolerance(key))
        return self._found[key]

    def best(self, value: str) -> tuple[float, int] | None:
        words, initials = words_of(value)
        if not words:
            return None
        if initials or all(len(w) <= 4 for w in words) and len(words) > 1:
            hit = self.initials.get("|".join(reduced_key(w) for w in words))
            if hit:
                return (0.0, min(hit))
        keys = [reduced_key(w) for w in words]
        typed = " ".join(words)
        winner: tuple[float, int] | None = None
        for key in dict.fromkeys(("".join(keys), "".join(sorted(keys)))):
            for d, form in self._within(key):
                for handicap, ref, name in self.owner[form]:
                    if handicap and d > 1:
                        continue
                    # reduced keys forgive a lot, so ties are broken on the letters as typed
                    cost = d + handicap + min(levenshtein(typed, name), 50) / 100
                    if winner is None or (cost, ref) < winner:
                        winner = (cost, ref)
        return winner


def map_values(values: DataFrame, references: DataFrame) -> DataFrame:
    """(value, reference_id, cost) of each distinct non-null ``value``; reference_id 0 where nothing is meant.

    ``references``: (reference_id int, name string), several names an id allowed; null names are left out and an empty
    list maps everything to 0. Ties go to the smaller id. Values may repeat; blank ones get 0. Neither side is
    collected: the entries of a shard go to each block of values, whatever the length of either list.
    """
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = cut(values.select("value").where("value is not null").distinct())
    listed = cut(references.where("name is not null and reference_id is not null").select("reference_id", "name").distinct())
    shards = max(1, -(-listed.count() // SHARD_REFERENCES))
    blocks = max(parts, -(-distinct.count() // BLOCK_VALUES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    typed = distinct.select("value", F.pmod(F.xxhash64("value"), F.lit(blocks)).cast("int").alias("block")).select("*", every(shards).alias("shard"))
    # all names of an entry in one shard; a task has one block and one shard
    known = listed.select("reference_id", "name", F.pmod(F.xxhash64("reference_id"), F.lit(shards)).cast("int").alias("shard")).select("*", every(blocks).alias("block"))

    def winners(typed: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        matcher = Matcher(sorted(zip(known["reference_id"].tolist(), known["name"].tolist(), strict=True)))
        best = [matcher.best(v) or (NOTHING, 0) for v in typed["value"]]
        return pd.DataFrame({"value": typed["value"], "cost": [b[0] for b in best], "reference_id": [b[1] for b in best]})

    # an explicit number of tasks, as small values cost much here and would be merged into one task by their bytes
    sides = (side.repartition(blocks * shards, "block", "shard").groupBy("block", "shard") for side in (typed, known))
    found = next(sides).cogroup(next(sides)).applyInPandas(winners, "value string, cost double, reference_id int")
    return found.groupBy("value").agg(F.min_by("reference_id", F.struct("cost", "reference_id")).alias("reference_id"), F.min("cost").alias("cost"))
