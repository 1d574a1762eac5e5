"""p5: near-duplicate texts in a collection too large for pairwise comparison.

Texts become sets of hashed word shingles. Shingles that no other text has can't link anything: they are counted with
sums on the map side, and a text with too few shared ones has no partner and drops out. The texts left are points of
count-vector R-trees, one packed tree a shard: a point is a shingle of the text's prefix (its rarest shared shingles,
COMMON of which every partner must meet), the text's size and the counts of its shared shingles in GROUPS hash groups. Summed
coordinate minima bound the overlap from above, for a box (its maxima) as for a point, and prune. Every candidate pair
is an answer of the trees for COMMON shingles; the pairs are verified on the whole sets of 64-bit hashes.

A shingle that very many texts share is cut into blocks of texts, and each pair of blocks is a subtree of its own, so
no list is gathered in one task and no pair is lost.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punji.operators.components import connected_components
from punji.runtime import cut

SHINGLE = 3  # words
THRESHOLD = 0.6
LEAST_WORDS = 20  # of the body
GROUPS = 32  # coordinates of a count vector
COMMON = 3  # shingles that the prefixes of a pair share, or all that it needs where it needs fewer
LEAF = 16  # points in a leaf
BLOCK = 20_000  # texts of one shingle in a subtree; beyond, each pair of blocks is a subtree
QUERIES = 4_096  # points that go down a tree together
BROADCAST_ROWS = 1_000_000  # keys of 12 bytes that may be sent to every executor
_BLANK = r"[ \t\n\r]"
_WORD = re.compile(r"[^ \t\n\r]+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))  # odd constants


def shingles(text: str, known: dict[str, int], size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of ``size`` successive words of the lower-case ``text``."""
    hashed = []
    for w in _WORD.findall(text.lower()):
        h = known.get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            if len(known) < 500_000:
                known[w] = h
        hashed.append(h)
    if len(hashed) < size:
        return np.empty(0, dtype=np.int64)
    a = np.array(hashed, dtype=np.uint64)
    total = np.zeros(len(a) - size + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = (total ^ (a[k : len(a) - size + 1 + k] * _MIX[k % 3])) * np.uint64(0xD6E8FEB86659FD93)
            total ^= total >> np.uint64(32)
    return np.unique(total.view(np.int64))


def needed(na, nb, threshold: float = THRESHOLD):
    """Overlap that sets of these sizes need to reach the similarity."""
    return np.ceil(threshold / (1 + threshold) * (na + nb) - 1e-9)


def prefix_length(n: int, threshold: float = THRESHOLD, common: int = COMMON) -> int:
    """So many of a set's elements, in any common order, share ``common`` with those of every similar set, or all they have in common.

    Behind the first ``common`` elements that two sets share there are so many fewer than their overlap, in either set.
    """
    return min(n, n - math.ceil(threshold * n - 1e-9) + common)


class RTree:
    """Packed R-tree over points (token, size, count vector); ``query`` finds partners for many points at a time.

    A box keeps the range of its tokens, its least size and the maxima of the counts, all that an upper bound needs.
    ``owner`` gives each point's row of ``vectors`` and ``sizes``, as a text is a point for each of its tokens.
    ``visited`` counts boxes and points looked at under the right token, ``pruned`` those that the bound sent away.
    """

    def __init__(self, tokens: np.ndarray, owner: np.ndarray, sizes: np.ndarray, vectors: np.ndarray) -> None:
        self.order = np.lexsort((*vectors[owner, :4].T, sizes[owner], tokens))
        self.tokens, self.owner = tokens[self.order], owner[self.order]
        self.sizes, self.vectors = sizes, vectors
        self.visited = self.pruned = 0
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        first = last = self.tokens
        least, high = sizes[self.owner], None
        while len(first) > LEAF:
            starts = np.arange(0, len(first), LEAF)
            high = self._leaf_maxima(starts) if high is None else np.maximum.reduceat(high, starts, axis=0)
            first, last, least = first[starts], last[np.minimum(starts + LEAF, len(last)) - 1], np.minimum.reduceat(least, starts)
            self.levels.append((first, last, least, high))

    def _leaf_maxima(self, starts: np.ndarray) -> np.ndarray:
        out = np.empty((len(starts), self.vectors.shape[1]), dtype=self.vectors.dtype)
        for s in range(0, len(starts), QUERIES):
            part = starts[s : s + QUERIES]
            held = self.vectors[self.owner[part[0] : part[-1] + LEAF]]
            out[s : s + QUERIES] = np.maximum.reduceat(held, part - part[0], axis=0)
        return out

    def _bounded(self, high, least, vector, size, threshold: float) -> np.ndarray:
        return np.minimum(high, vector).sum(axis=1) >= needed(least, size, threshold)

    def query(self, tokens: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, after: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, place): the points at places beyond ``after`` that have the query's token and whose bound allows the similarity."""
        top = len(self.levels[-1][0]) if self.levels else len(self.tokens)
        q, node = np.repeat(np.arange(len(tokens)), top), np.tile(np.arange(top), len(tokens))
        for depth in range(len(self.levels) - 1, -1, -1):
            first, last, least, high = self.levels[depth]
            fit = (first[node] <= tokens[q]) & (tokens[q] <= last[node]) & ((node + 1) * LEAF ** (depth + 1) > after[q] + 1)
            q, node = q[fit], node[fit]
            good = self._bounded(high[node], least[node], vectors[q], sizes[q], threshold)
            self.visited += len(q)
            self.pruned += len(q) - int(good.sum())
            q, node = q[good], node[good]
            below = len(self.levels[depth - 1][0]) if depth else len(self.tokens)
            q, node = np.repeat(q, LEAF), (node[:, None] * LEAF + np.arange(LEAF)).ravel()
            q, node = q[node < below], node[node < below]
        fit = (self.tokens[node] == tokens[q]) & (node > after[q])
        q, node = q[fit], node[fit]
        own = self.owner[node]
        good = self._bounded(self.vectors[own], self.sizes[own], vectors[q], sizes[q], threshold)
        self.visited += len(q)
        self.pruned += len(q) - int(good.sum())
        return q[good], node[good]

    def pairs(self, ranks: np.ndarray, sides: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, row) of the owners of every two points of a token that the tree leaves, in parts.

        ``ranks``: a token's place in its text's order by rarity. The first COMMON tokens that two texts have in common
        leave enough of both behind them, so a pair is only taken at a token where that holds. ``sides``: 0 and 1 for the
        two blocks of a subtree, whose points only meet across; -1 for those that meet all.
        """
        ranks, sides = ranks[self.order], sides[self.order]
        for s in range(0, len(self.tokens), QUERIES):
            at = np.arange(s, min(s + QUERIES, len(self.tokens)))
            own = self.owner[at]
            q, place = self.query(self.tokens[at], self.sizes[own], self.vectors[own], at, threshold)
            q, a, b = q + s, self.owner[q + s], self.owner[place]
            left = np.minimum(self.sizes[a] - ranks[q], self.sizes[b] - ranks[place])
            fit = (needed(self.sizes[a], self.sizes[b], threshold) <= left + COMMON - 1) & ((sides[q] < 0) | (sides[q] != sides[place])) & (a != b)
            yield a[fit], b[fit]


def _flat(column) -> np.ndarray:
    parts = list(column)
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def _blocks(bucket: np.ndarray, count: int, **columns: np.ndarray) -> pd.DataFrame:
    """One row for each bucket, the columns cut into arrays; the order within a bucket is kept."""
    bucket = bucket.astype(np.int16 if count < 1 << 15 else np.int32)  # sorted by radix where it is short
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(count + 1))
    rows = [b for b in range(count) if ends[b] < ends[b + 1]]
    return pd.DataFrame({"bucket": np.array(rows, dtype=np.int32)} | {c: [v[order[ends[b] : ends[b + 1]]] for b in rows] for c, v in columns.items()})


def _points(texts: DataFrame, threshold: float, buckets: int) -> DataFrame:
    """(key, n, alone, prefix, df, counts) of the texts that can have a partner.

    ``prefix``: the rarest shared shingles, with the number of texts that have each; ``alone``: how many shingles come
    before them, as no other text has them; ``counts``: the shared shingles by hash group.

    A batch of texts sends a shingle once, with the texts that have it as short numbers beside it. Half of each hash
    stands for the shingle beside its bucket here; a collision only lets through what verification turns down.
    """

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for pdf in batches:
            pdf = pdf.drop_duplicates("key")
            sets = [shingles(t, known) for t in pdf["text"]]
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            if not sizes.sum():
                continue
            items, row = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
            del sets
            bucket = ((items & 0x7FFFFFFF) % buckets).astype(np.int16 if buckets < 1 << 15 else np.int32)
            order = np.argsort(items, kind="stable")
            order = order[np.argsort(bucket[order], kind="stable")]
            items, row, bucket = items[order], row[order], bucket[order]
            keys = pdf["key"].to_numpy(dtype=np.int64)
            ends = np.searchsorted(bucket, np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                mine, doc = items[ends[b] : ends[b + 1]], row[ends[b] : ends[b + 1]]
                if len(mine):
                    starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                    held, place = np.unique(doc, return_inverse=True)
                    times = np.diff(np.r_[starts, len(mine)])
                    out.append((b, (mine[starts] >> 32).astype(np.int32), times.astype(np.int32), place.astype(np.int32), keys[held], sizes[held].astype(np.int32)))
            yield pd.DataFrame(out, columns=["bucket", "tails", "times", "who", "keys", "n"])

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[np.ndarray]] = {c: [] for c in ("tails", "times", "who", "keys", "n")}
        base, source = 0, 0
        for pdf in batches:
            for b, who, keys in zip(pdf["bucket"], pdf["who"], pdf["keys"], strict=True):
                if base and b != source:
                    raise RuntimeError("a partition holds more than one bucket")
                held["who"].append(np.asarray(who) + np.int32(base))
                base, source = base + len(keys), b
            for c in ("tails", "times", "keys", "n"):
                held[c] += list(pdf[c])
        if not base:
            return
        tails, times, who, keys, n = (np.concatenate(held[c]) for c in ("tails", "times", "who", "keys", "n"))
        held.clear()
        _, token = np.unique(tails, return_inverse=True)
        df = np.bincount(token, weights=times).astype(np.int64)[token]  # a batch has summed up its own
        kept = np.repeat(df > 1, times)
        who, tails, df = who[kept], np.repeat(tails, times)[kept], np.repeat(np.minimum(df, 0x7FFFFFFF).astype(np.int32), times)[kept]
        order = np.argsort(keys[who], kind="stable")
        who, tails, df = who[order], tails[order], df[order]
        if len(who):
            yield _blocks((keys[who] & 0x7FFFFFFF) % buckets, buckets, items=tails, keys=keys[who], n=n[who], df=df).assign(source=np.int32(source))

    def survivors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if not held:
            return
        items = np.concatenate([_flat([(np.int64(b) << 32) | (np.asarray(x).astype(np.int64) & 0xFFFFFFFF) for b, x in zip(p["source"], p["items"], strict=True)]) for p in held])
        keys, n, df = (np.concatenate([_flat(p[c]) for p in held]) for c in ("keys", "n", "df"))
        held.clear()
        order = np.lexsort((items, df, keys))
        items, keys, n, df = items[order], keys[order], n[order], df[order]
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (items[1:] != items[:-1])][: len(keys)]  # a text may come twice
        items, keys, n, df = items[fresh], keys[fresh], n[fresh], df[fresh]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        ends = np.r_[starts[1:], len(keys)]
        size = n[starts]
        able = (ends - starts) >= np.ceil(threshold * size - 1e-9)
        rows = []
        for s, e, total in zip(starts[able], ends[able], size[able], strict=True):
            # the shingles nobody shares come first in the order by rarity, and need no point
            alone = max(0, int(total) - int(e - s))
            rest = prefix_length(int(total), threshold) - alone
            if rest > 0:
                counts = np.bincount((items[s:e] >> 7) & (GROUPS - 1), minlength=GROUPS)
                rows.append((int(keys[s]), int(total), alone, items[s : s + rest] * np.int64(_MIX[2]), df[s : s + rest], counts.astype(np.int32)))
        for at in range(0, len(rows), 5_000):
            yield pd.DataFrame(rows[at : at + 5_000], columns=["key", "n", "alone", "prefix", "df", "counts"])

    posted = texts.mapInPandas(post, "bucket int, tails array<int>, times array<int>, who array<int>, keys array<bigint>, n array<int>").repartitionById(buckets, F.col("bucket"))
    common = posted.mapInPandas(shared, "bucket int, items array<int>, keys array<bigint>, n array<int>, df array<int>, source int").repartitionById(buckets, F.col("bucket"))
    return common.mapInPandas(survivors, "key long, n int, alone int, prefix array<bigint>, df array<int>, counts array<int>")


def candidates(texts: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(a, b, visited, pruned): the pairs of keys that the R-trees over ``texts`` (key, text) leave at enough shingles.

    Chance lets two texts share a rare shingle, hardly ever COMMON of them, so few pairs have to be verified.
    A row with null keys tells how many boxes and points the trees looked at and how many the bound sent away.
    """
    buckets = max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    points = _points(texts, threshold, buckets)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts: dict[str, list[np.ndarray]] = {c: [] for c in ("token", "rank", "side", "row")}
            keys, n, counts = pdf["key"].to_numpy(dtype=np.int64), pdf["n"].to_numpy(), list(pdf["counts"])
            for i, (df, token, alone) in enumerate(zip(pdf["df"], pdf["prefix"], pdf["alone"], strict=True)):
                rank, side, hot = alone + np.arange(len(token)), np.full(len(token), -1), np.asarray(df) > block
                if hot.any():
                    token, rank, side = _pair_blocks(np.asarray(token), rank, np.asarray(df), hot, int(keys[i]), block)
                for c, v in (("token", token), ("rank", rank), ("side", side), ("row", np.full(len(token), i))):
                    parts[c].append(v)
            token, rank, side, row = (_flat(parts[c]) for c in ("token", "rank", "side", "row"))
            bucket = (token & 0x7FFFFFFF) % buckets
            order = np.lexsort((row, bucket))
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                mine = order[ends[b] : ends[b + 1]]
                if len(mine):
                    docs, place = np.unique(row[mine], return_inverse=True)  # a text goes to a bucket once
                    out.append((b, token[mine], rank[mine].astype(np.int32), side[mine].astype(np.int8), place.astype(np.int32), keys[docs], n[docs].astype(np.int32), np.concatenate([counts[d] for d in docs]).astype(np.int32)))
            yield pd.DataFrame(out, columns=["bucket", "tokens", "ranks", "sides", "place", "keys", "n", "counts"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[np.ndarray]] = {c: [] for c in ("tokens", "ranks", "sides", "place", "keys", "n", "counts")}
        base = 0
        for pdf in batches:
            for place, keys in zip(pdf["place"], pdf["keys"], strict=True):
                held["place"].append(np.asarray(place, dtype=np.int64) + base)
                base += len(keys)
            for c in ("tokens", "ranks", "sides", "keys", "n", "counts"):
                held[c] += list(pdf[c])
        if not base:
            return
        token, rank, side, at, key, size, counts = (np.concatenate(held[c]) for c in ("tokens", "ranks", "sides", "place", "keys", "n", "counts"))
        held.clear()
        # counts are of shared shingles only, which is all that two texts can have in common
        tree = RTree(token, at, size.astype(np.int64), counts.reshape(-1, GROUPS))
        found, waiting = [], 0
        for a, b in tree.pairs(rank.astype(np.int64), side, threshold):
            least = np.minimum(needed(tree.sizes[a], tree.sizes[b], threshold), COMMON).astype(np.int64)
            found.append(np.stack([np.minimum(key[a], key[b]), np.maximum(key[a], key[b]), least], axis=1))
            waiting += len(a)
            if waiting > 500_000:
                yield _pair_rows(found)
                found, waiting = [], 0
        yield _pair_rows(found, tree)

    schema = "bucket int, tokens array<bigint>, ranks array<int>, sides array<tinyint>, place array<int>, keys array<bigint>, n array<int>, counts array<int>"
    sharded = points.mapInPandas(spread, schema).repartitionById(buckets, F.col("bucket"))
    met = sharded.mapInPandas(search, "a long, b long, least long, common long, visited long, pruned long").groupBy("a", "b")
    summed = met.agg(F.max("least").alias("least"), F.sum("common").alias("common"), F.sum("visited").alias("visited"), F.sum("pruned").alias("pruned"))
    return summed.where("a is null or common >= least").select("a", "b", "visited", "pruned")


def _pair_blocks(token: np.ndarray, rank: np.ndarray, df: np.ndarray, hot: np.ndarray, key: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The points of a text whose ``hot`` tokens are cut into blocks: one for each pair of blocks that holds its own."""
    tokens, ranks, sides = [token[~hot]], [rank[~hot]], [np.full(int((~hot).sum()), -1)]
    for t, r, n in zip(token[hot], rank[hot], df[hot], strict=True):
        blocks = int(-(-n // block))
        own = (key ^ (key >> 29)) % blocks
        other = np.arange(blocks)
        cell = np.minimum(own, other) * blocks + np.maximum(own, other)
        with np.errstate(over="ignore"):
            mixed = (np.full(blocks, t, dtype=np.int64).view(np.uint64) ^ (cell.astype(np.uint64) + np.uint64(1)) * _MIX[0]) * _MIX[1]
        tokens.append((mixed ^ (mixed >> np.uint64(31))).view(np.int64))
        ranks.append(np.full(blocks, r))
        sides.append(np.where(other == own, -1, (own > other).astype(int)))
    return np.concatenate(tokens), np.concatenate(ranks), np.concatenate(sides)


def _pair_rows(found: list[np.ndarray], tree: RTree | None = None) -> pd.DataFrame:
    """A row for each pair, with the number of tokens at which it was found; and one for what ``tree`` looked at."""
    pairs, common = np.unique(np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64), axis=0, return_counts=True)
    a, b, least = (pd.array(pairs[:, c], dtype="Int64") for c in range(3))
    rows = pd.DataFrame({"a": a, "b": b, "least": least, "common": common, "visited": 0, "pruned": 0})
    if tree is not None:
        none = pd.array([None], dtype="Int64")
        rows = pd.concat([rows, pd.DataFrame({"a": none, "b": none, "least": none, "common": [0], "visited": [tree.visited], "pruned": [tree.pruned]})])
    return rows


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(key, n, items array<bigint>): the whole shingle set of each distinct text."""

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for pdf in batches:
            sets = [shingles(t, known) for t in pdf["text"]]
            yield pd.DataFrame({"key": pdf["key"], "n": [len(s) for s in sets], "items": sets})

    return texts.dropDuplicates(["key"]).mapInPandas(whole, "key long, n int, items array<bigint>")


def similar_keys(texts: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity): every pair of different keys whose shingle sets reach ``threshold``, verified on the whole sets.

    ``texts``: (key long, text); equal keys stand for equal texts and count once.
    """
    pairs = cut(candidates(texts, threshold, block).where("a is not null").select("a", "b"))
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    sets = cut(shingle_sets(texts.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, "key", "left_semi")))
    a, b = (sets.select(F.col("key").alias(s), F.col("n").alias(f"n{s}"), F.col("items").alias(f"s{s}")) for s in "ab")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(pdf["sa"], pdf["sb"], strict=True)], dtype=float)
            alike = both / np.maximum(pdf["na"].to_numpy() + pdf["nb"].to_numpy() - both, 1)
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "similarity": alike})[alike >= threshold - 1e-12]

    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "sa", "sb")
    return joined.mapInPandas(verify, "a long, b long, similarity double")


def _texts(articles: DataFrame) -> DataFrame:
    """(id, key, text) of the articles whose body has LEAST_WORDS words; the key is the text's 64-bit hash.

    Two of n different texts get one key with a chance of n^2 / 2^65.
    """
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.col("body"))
    long = F.col("body").rlike(f"^{_BLANK}*(?:[^ \\t\\n\\r]+{_BLANK}+){{{LEAST_WORDS - 1}}}[^ \\t\\n\\r]")
    return articles.where(long).select("id", F.xxhash64(F.lower(text)).alias("key"), text.alias("text"))


def reprint_pairs(articles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(article_a, article_b): every pair of different ids whose texts are similar, the smaller first.

    A row delivered twice counts once; null and short bodies have no partner; null titles are empty. Equal texts are
    one point for the search and become pairs of their ids only in the result, which this form asks for.
    """
    rows = _texts(articles)
    links = similar_keys(rows.select("key", "text"), threshold).select("a", "b")
    members = cut(rows.select("id", "key").distinct())
    a, b = (members.select(F.col("id").alias(f"id_{s}"), F.col("key").alias(s)) for s in "ab")
    across = links.join(a, "a").join(b, "b").select("id_a", "id_b")
    copies = members.join(members.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "key")
    same = copies.select(F.col("id").alias("id_a"), "key").join(copies.select(F.col("id").alias("id_b"), "key"), "key").where("id_a < id_b").select("id_a", "id_b")
    return across.unionByName(same).select(F.least("id_a", "id_b").alias("article_a"), F.greatest("id_a", "id_b").alias("article_b")).distinct()


def reprint_classes(articles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, links) of every article: its class of texts linked by similarity, and how many links it has.

    Copies of one text aren't expanded: they share its links and class. An article without a partner is its own class.
    """
    rows = _texts(articles)
    links = cut(similar_keys(rows.select("key", "text"), threshold).select("a", "b"))
    members = rows.select("id", "key").distinct()
    classes = connected_components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("links"))
    placed = members.join(classes, F.col("key") == F.col("node"), "left").select("id", "key", F.coalesce("component", "key").alias("component")).join(degree, "key", "left")
    first = placed.groupBy("component").agg(F.min("id").alias("class_id"))
    placed = placed.join(first, "component").select("id", "class_id", F.coalesce("links", F.lit(0)).alias("links"))
    rest = articles.select("id").distinct().join(members.select("id"), "id", "left_anti")
    return placed.unionByName(rest.select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("links")))
