"""p2: text that was decoded with the wrong character encoding, found and restored.

Each record has a latent encoding chain: clean, one or several wrong codecs on top of each other, or lost (letters
replaced by question marks or replacement characters). The evidence of a record is, for every chain that undoes
anything in it, how many odd sequences the chain decodes, how many it leaves, and how many letters stay lost.
Expectation-maximization per source and field pools the evidence of all records of the pool, so that a single odd
sequence counts for more where the pool is known to be spoilt. The rounds are aggregates over the records' signatures,
so no pool is gathered in a task. The posterior of a record decides, and its most probable chain repairs it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punji.runtime import cut

CODECS = ("cp1252", "latin1", "cp1251", "cp437", "mac_roman", "cp850", "cp866", "koi8_r", "cp1250")
SETTLED = 1e-3  # rounds end where no share or rate of any pool moves by more
STEP = 3  # rounds between two looks at that
TOO_MANY = 8  # sequences left above the fewest, with which a chain's posterior is below 1e-12 whatever the pool
VOID = 1e-7  # how likely a clean record holds a replacement character
TASK_ROWS = 500_000  # chains of signatures that a task weighs at a time

# Lost letters: a question mark that begins a word or stands between letters (emphatic ones follow a word).
LOST = r"(?:^|(?<=\s))\?|(?<=[A-Za-zఀ-౿])\?(?=[A-Za-zఀ-౿])"
_LOST = re.compile(LOST)


def _byte_of(codec: str) -> dict[str, int]:
    """The character that ``codec`` makes of each byte from 0x80; bytes it lacks stay control characters."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


def _class(table: dict[str, int], first: int, last: int) -> str:
    return "[" + "".join(re.escape(c) for c, b in table.items() if first <= b <= last) + "]"


class Codec:
    """Finds and undoes UTF-8 read as a one-byte encoding.

    A unit is the image of one character that such text can hold: Latin letters and signs, Indic scripts, general
    punctuation, currency and letterlike signs. Bytes the codec doesn't have may have become replacement characters.
    """

    def __init__(self, name: str) -> None:
        self.name = name
        self.byte = _byte_of(name)
        # UTF-8 lead and second byte of the ranges named above
        spans = [((0xC2,), (0x80, 0xBF)), ((0xC3,), (0x80, 0xBF)), ((0xC4, 0xC5), (0x80, 0xBF)), ((0xE0,), (0xA4, 0xB7)), ((0xE2,), (0x80, 0x86)), ((0xEF,), (0xBB, 0xBD))]
        tail = "(?:" + _class(self.byte, 0x80, 0xBF) + "|�)"
        image = {b: c for c, b in self.byte.items()}
        pieces = []
        for leads, (low, high) in spans:
            lead = "[" + "".join(re.escape(image[b]) for b in leads) + "]"
            pieces.append(lead + _class(self.byte, low, high) + (tail if leads[0] >= 0xE0 else ""))
        self.unit = re.compile("|".join(pieces))
        self.run = re.compile("(?:" + "|".join(pieces) + ")+")
        self.head = re.compile("[" + "".join(re.escape(image[b]) for leads, _ in spans for b in leads) + "]")

    def count(self, text: str) -> int:
        return sum(1 for _ in self.unit.finditer(text))

    def _decode(self, run: str) -> str:
        data = bytearray()
        for c in run:
            # the lost byte is one the codec lacks; 0x8D, the sign that joins letters, is the commonest of them
            data.append(0x8D if c == "�" else self.byte[c])
        return data.decode("utf-8", "replace")

    def undo(self, text: str) -> str:
        return self.run.sub(lambda m: self._decode(m[0]), text)


_CODECS: dict[str, Codec] = {}


def codec(name: str) -> Codec:
    if name not in _CODECS:
        _CODECS[name] = Codec(name)
    return _CODECS[name]


# What a text holds beside ASCII and Telugu is short mostly; a class of two ranges takes the rest away in one cheap pass.
PLAIN = r"[\x00-\x7F\x{C00}-\x{C7F}]+"
# LOST, put so that the JVM looks round question marks only.
_LOST_JVM = r"\?(?<=^\?|\s\?)|\?(?<=[A-Za-zఀ-౿]\?)(?=[A-Za-zఀ-౿])"


def head_pattern() -> str:
    """The characters with which a sequence of any codec begins, and the replacement character; none is ASCII or Telugu."""
    heads = sorted({c for name in CODECS for c, b in _byte_of(name).items() if b in (0xC2, 0xC3, 0xC4, 0xC5, 0xE0, 0xE2, 0xEF)})
    return "[�" + "".join(f"\\x{{{ord(c):X}}}" for c in heads) + "]"


def suspicious(column) -> F.Column:
    """Whether a text can have any evidence: the JVM's cheap test."""
    return F.regexp_replace(column, PLAIN, "").rlike(head_pattern()) | (column.contains("?") & column.rlike(_LOST_JVM))


def evidence(text: str) -> list[tuple[str, int, int, int, int]]:
    """(chain, hits, left, lost, void) of the text as it is (an empty chain) and of every chain that undoes anything in it.

    ``hits``: sequences that the chain's codecs decode, ``left``: those that each codec leaves which a rival would have
    decoded in its place, with the most that any could still decode behind the chain, ``lost``: question marks in the place of letters,
    ``void``: replacement characters.
    Every undoing makes the text shorter, so chains end by themselves; of chains that lead to the same text the one
    that leaves least counts. Chains that leave TOO_MANY more than another are not listed, and nothing is for a text
    without any evidence.
    """
    marks = len(_LOST.findall(text))
    nodes: dict[str, tuple[tuple[str, ...], int, int]] = {text: ((), 0, 0)}
    counted: dict[str, dict[str, int]] = {}
    todo = [text]
    while todo:
        at = todo.pop(0)
        chain, hits, left = nodes[at]
        counted[at] = {name: n for name in CODECS if codec(name).head.search(at) and (n := codec(name).count(at))}
        most = max(counted[at].values(), default=0)
        for name, n in sorted(counted[at].items(), key=lambda x: -x[1]):
            after, missed = codec(name).undo(at), left + most - n
            if after not in nodes or missed < nodes[after][2]:
                todo.append(after)
                nodes[after] = ((*chain, name), hits + n, missed)
    out = [(">".join(c), hits, left + max(counted[at].values(), default=0), marks, at.count("�")) for at, (c, hits, left) in nodes.items()]
    fewest = min(e[2] for e in out)
    return [out[0], *(e for e in out[1:] if e[2] <= fewest + TOO_MANY)] if any(out[0][2:]) else []


def repair(text: str, chain: str) -> str:
    """``text`` with the wrong decodings of ``chain`` undone, the outermost first; other text stays as it is."""
    for name in chain.split(">"):
        text = codec(name).undo(text)
    return text


NODES = "array<struct<chain:string,hits:int,left:int,lost:int,void:int>>"


def _evidence_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        nodes = [[dict(zip(("chain", "hits", "left", "lost", "void"), e, strict=True)) for e in evidence(t)] for t in pdf["text"]]
        yield pdf[["field", "source", "id"]].assign(nodes=nodes)


def _flat(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (field, source, nodes, ``key``, ...) with a row for each class: clean (no chain), lost, and every chain."""
    root = F.col("nodes")[0]
    lost = F.struct(F.lit("lost").alias("chain"), F.lit(0).alias("hits"), root["left"].alias("left"), root["lost"].alias("lost"), root["void"].alias("void"))
    listed = F.explode(F.concat("nodes", F.when(root["lost"] + root["void"] > 0, F.array(lost)).otherwise(F.array().cast(NODES))))
    return rows.select(*(c for c in rows.columns if c != "nodes"), listed.alias("c")).select(*(c for c in rows.columns if c != "nodes"), "c.*").withColumnRenamed(key, "row")


def _posterior(rows: pd.DataFrame, pool: pd.DataFrame) -> np.ndarray:
    """The probability of each class of ``rows`` (row, chain, hits, left, lost), the classes of a row one behind the other.

    ``pool`` (chain, share, chance, slip, miss). A clean record shows a sequence by chance with probability ``chance`` and
    a question mark for a letter with ``slip``, and hardly ever a replacement character; a spoilt one leaves a sequence undecoded with probability ``miss``; a record of lost
    letters loses one in two.
    """
    share = dict(zip(pool["chain"], pool["share"], strict=True))
    chance, slip, miss = (float(pool[c].iloc[0]) for c in ("chance", "slip", "miss"))
    chain = rows["chain"].to_numpy(dtype=object)
    hits, left, lost, void = (rows[c].to_numpy(dtype=float) for c in ("hits", "left", "lost", "void"))
    like = hits * np.log(1 - miss) + left * np.log(miss * chance) + (lost + void) * np.log(max(slip, 0.05))
    like = np.where(chain == "", left * np.log(chance) + lost * np.log(slip) + void * np.log(VOID), like)
    like = np.where(chain == "lost", left * np.log(chance) + (lost + void) * np.log(0.5), like)
    like += np.log([share.get(c, 1e-6) for c in chain])
    first = np.flatnonzero(np.r_[True, rows["row"].to_numpy()[1:] != rows["row"].to_numpy()[:-1]])
    size = np.diff(np.r_[first, len(rows)])
    weight = np.exp(like - np.repeat(np.maximum.reduceat(like, first), size))
    return weight / np.repeat(np.add.reduceat(weight, first), size)


def _with_pools(rows: DataFrame, pools: DataFrame, salts: int, weigh, schema: str) -> DataFrame:
    """``weigh`` (rows, pool) for the classes in ``rows`` (field, source, row, ...) of each pool, a large pool in parts."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    copied = pools.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    key = ("field", "source", "salt")
    return salted.groupBy(*key).cogroup(copied.groupBy(*key)).applyInPandas(weigh, schema)


def _expected(rows: pd.DataFrame, pool: pd.DataFrame) -> pd.DataFrame:
    if not len(rows) or not len(pool):
        return pd.DataFrame(columns=["field", "source", "chain", "mass", "left", "lost", "units"])
    rows = rows.sort_values("row", kind="stable")
    mass = _posterior(rows, pool) * rows["n"].to_numpy(dtype=float)
    sums = pd.DataFrame({"chain": rows["chain"], "mass": mass, "left": mass * rows["left"], "lost": mass * rows["lost"], "units": mass * (rows["hits"] + rows["left"])}).groupby("chain", as_index=False).sum()
    return sums.assign(field=rows["field"].iloc[0], source=rows["source"].iloc[0])


def _maximized(signatures: DataFrame, pools: DataFrame, salts: int) -> DataFrame:
    """The shares of the classes and the three rates of each pool that its records' posteriors make most likely, with pseudo-counts."""
    parts = _with_pools(signatures, pools, salts, _expected, "field string, source string, chain string, mass double, left double, lost double, units double")
    sums = parts.groupBy("field", "source", "chain").agg(*(F.sum(c).alias(c) for c in ("mass", "left", "lost", "units")))
    pool = Window.partitionBy("field", "source")
    clean, spoilt = F.col("chain") == "", ~F.col("chain").isin("", "lost")
    of = lambda kind, c: F.sum(F.when(kind, F.col(c)).otherwise(0.0)).over(pool)
    return sums.select(
        "field", "source", "chain", ((F.col("mass") + 0.01) / (F.sum("mass").over(pool) + 0.01 * F.count("*").over(pool))).alias("share"),
        F.least(F.lit(0.01), (of(clean, "left") + 1e-3) / (of(clean, "mass") + 1.0)).alias("chance"),
        F.least(F.lit(0.01), (of(clean, "lost") + 1e-3) / (of(clean, "mass") + 1.0)).alias("slip"),
        F.least(F.lit(0.2), (of(spoilt, "left") + 0.5) / (of(spoilt, "units") + 10.0)).alias("miss"),
    )


def encoding_pools(signatures: DataFrame) -> DataFrame:
    """(field, source, chain, share, chance, slip, miss) of each pool, by expectation-maximization until nothing moves.

    ``signatures``: (field, source, row, n, chain, hits, left, lost), the classes of each kind of evidence and how many
    records show it. Raises if the rounds don't settle, which the rising likelihood rules out.
    """
    salts = max(1, -(-signatures.count() // TASK_ROWS))
    pool = Window.partitionBy("field", "source")
    start = signatures.select("field", "source", "chain").distinct().withColumn("share", F.when(F.col("chain") == "", 0.98).otherwise(0.02 / F.greatest(F.count("*").over(pool) - 1, F.lit(1))))
    pools = cut(start.select("*", F.lit(1e-3).alias("chance"), F.lit(1e-3).alias("slip"), F.lit(0.05).alias("miss")))
    for _ in range(200):
        after = pools
        for _ in range(STEP):
            after = _maximized(signatures, after, salts)
        after = cut(after)
        before = pools.select("field", "source", "chain", F.col("share").alias("share_"), F.col("miss").alias("miss_"))
        moved = F.greatest(F.abs(F.col("share") - F.col("share_")), F.abs(F.col("miss") - F.col("miss_")))
        pools = after
        if (after.join(before, ["field", "source", "chain"]).agg(F.max(moved)).first()[0] or 0.0) < SETTLED:
            return pools
    raise RuntimeError("encoding shares did not settle")


def _decided(rows: pd.DataFrame, pool: pd.DataFrame) -> pd.DataFrame:
    if not len(rows) or not len(pool):
        return pd.DataFrame(columns=["field", "id", "chain", "p_clean"])
    rows = rows.sort_values("row", kind="stable")
    rows = rows.assign(p=_posterior(rows, pool))
    clean = rows[rows["chain"] == ""].set_index("row")["p"]
    best = rows[rows["chain"] != ""].sort_values(["row", "p", "hits", "chain"], ascending=[True, False, False, True]).drop_duplicates("row")
    best = best.assign(p_clean=best["row"].map(clean))
    best = best[best["p_clean"] < 0.5]
    return pd.DataFrame({"field": best["field"], "id": best["row"], "chain": best["chain"], "p_clean": best["p_clean"]})


def garbled(records: DataFrame) -> DataFrame:
    """(field, id, chain, p_clean) of the records of ``records`` (field, source, id, text) that are spoilt.

    ``chain`` names the codecs, the outermost first, or is lost where nothing can be restored. Rows repeated under one
    field and id count once, in the pools too; null and empty texts are clean; a null source is a pool of its own.
    """
    rows = records.select("field", F.coalesce("source", F.lit("")).alias("source"), F.col("id").cast("string").alias("id"), "text")
    suspect = rows.where(suspicious(F.col("text")))
    seen = suspect.mapInPandas(_evidence_of, f"field string, source string, id string, nodes {NODES}").where(F.size("nodes") > 0).dropDuplicates(["field", "id"])
    seen = cut(seen)
    spoken = seen.groupBy("field", "source").agg(F.count("*").alias("seen"))
    everything = rows.select("field", "source", "id").distinct().groupBy("field", "source").agg(F.count("*").alias("n"))
    plain = F.array(F.struct(F.lit("").alias("chain"), *(F.lit(0).alias(c) for c in ("hits", "left", "lost", "void")))).cast(NODES)
    silent = everything.join(spoken, ["field", "source"], "left").select("field", "source", plain.alias("nodes"), (F.col("n") - F.coalesce("seen", F.lit(0))).alias("n"))
    kinds = seen.groupBy("field", "source", "nodes").agg(F.count("*").alias("n")).unionByName(silent).withColumn("kind", F.xxhash64("nodes"))
    pools = encoding_pools(cut(_flat(kinds, "kind")))
    salts = max(1, -(-seen.count() * 4 // TASK_ROWS))
    return _with_pools(_flat(seen, "id"), pools, salts, _decided, "field string, id string, chain string, p_clean double")


def repaired(records: DataFrame) -> DataFrame:
    """(field, id, chain, text): the spoilt records with their restored text; lost ones keep theirs."""
    found = garbled(records)

    def fix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["text"] = [t if c == "lost" else repair(t, c) for t, c in zip(pdf["text"], pdf["chain"], strict=True)]
            yield pdf

    texts = records.where(suspicious(F.col("text"))).select("field", F.col("id").cast("string").alias("id"), "text").dropDuplicates(["field", "id"])
    return found.select("field", "id", "chain").join(texts, ["field", "id"]).mapInPandas(fix, "field string, id string, chain string, text string")


def archive_records(articles: DataFrame, pages: DataFrame, catalog: DataFrame) -> DataFrame:
    """The three fields of the archive as (field, source, id, text); the source is the publication."""
    publication = F.split("edition_id", "-")[0].alias("source")
    fields = ((articles, "articles.body", "body"), (pages, "pages.full_text", "full_text"), (catalog, "catalog_entries.text", "text"))
    out = None
    for df, field, column in fields:
        part = df.select(F.lit(field).alias("field"), publication, F.col("id").cast("string").alias("id"), F.col(column).alias("text")).where("text is not null")
        out = part if out is None else out.unionByName(part)
    return out
