"""p8: evaluation passages that leaked into the corpus, by a distributed positional inverted index.

The postings of the whole corpus are stored once, as a table in the shared folder: a row is a shard of documents and
holds, for each term of theirs, in how many of them it stands and at which positions. All searches read that table and
no text. The passages are the stated query set, sent to the shards in blocks of bounded size. How rare a term is, is
counted from the index over all documents. Each window of a passage is looked up from its rarest term; the positions,
adjusted by the term's offset, are intersected with those of the other terms. What holds for a window of WINDOW
successive words is an exact phrase match; an item's rarest words in one short stretch are a proximity match.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punji.runtime import cut, once, stored

WINDOW = 10  # successive words that make a leak
NEAR_SPAN = 30  # words within which a proximity match must lie
SHARD_TERMS = 500_000  # words in a shard of the index; a longer document is a shard of its own
BLOCK_TERMS = 1_000_000  # words of passages that are sent to the shards together
LOOKUPS = 1_000_000  # positions compared at a time

_TOKEN = regex.compile(r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{No}]+")
INDEX = "docs array<bigint>, ends array<int>, terms array<bigint>, held array<int>, counts array<int>, positions binary"


def words(text: str) -> list[str]:
    """Lower-case words, everything but letters, marks and digits taken as a blank."""
    return _TOKEN.findall(text.lower())


def term_of(word: str) -> int:
    """The 64-bit hash that stands for a word in the index."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)


def _shard_row(docs: list[int], coded: list[list[int]], hashes: np.ndarray) -> tuple:
    """A row of the index; behind each document a position stays free, so no phrase crosses into the next one."""
    sizes = np.array([len(c) for c in coded], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    stream = np.concatenate([np.array(c, dtype=np.int32) for c in coded])
    place = np.arange(len(stream)) + np.repeat(np.arange(len(coded)), sizes)
    order = np.argsort(stream, kind="stable")
    code, position = stream[order], place[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])[: len(code)]
    doc = np.searchsorted(ends, position, side="right")
    fresh = np.r_[True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])][: len(code)]
    held = np.add.reduceat(fresh.astype(np.int32), starts) if len(code) else np.empty(0, dtype=np.int32)
    gaps = np.diff(position, prepend=0).astype("<i4")
    gaps[starts] = position[starts]
    return docs, ends.astype(np.int32), hashes[code[starts]], held, np.diff(np.r_[starts, len(code)]).astype(np.int32), gaps.tobytes()


def _index_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, int] = {}
    hashes: list[int] = []
    docs: list[int] = []
    coded: list[list[int]] = []
    size = 0

    def row() -> pd.DataFrame:
        hashes.extend(term_of(w) for w in islice(known, len(hashes), None))
        return pd.DataFrame([_shard_row(docs, coded, np.array(hashes, dtype=np.int64))], columns=[c.split()[0] for c in INDEX.split(", ")])

    for pdf in batches:
        for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            found = words(text)
            if docs and size + len(found) > SHARD_TERMS:
                yield row()
                docs, coded, size = [], [], 0
                if len(known) > 1_000_000:
                    known, hashes = {}, []
            docs.append(int(doc))
            coded.append([known.setdefault(w, len(known)) for w in found])
            size += len(found) + 1
    if docs:
        yield row()


def positional_index(documents: DataFrame) -> DataFrame:
    """The stored postings of ``documents`` (doc_id, text), one row a shard; null texts are left out.

    ``terms`` are 64-bit hashes of words, ``held`` and ``counts`` say in how many of the shard's documents and at how
    many positions each stands, ``positions`` holds their positions, term after term, as 32-bit steps. A doc_id
    delivered twice is indexed once.
    """
    rows = documents.where("text is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(once(rows, "doc_id").mapInPandas(_index_rows, INDEX), "postings")


class Shard:
    """One row of the index, opened."""

    def __init__(self, docs, ends, terms, counts, positions: bytes) -> None:
        self.docs, self.ends = np.asarray(docs), np.asarray(ends, dtype=np.int64)
        terms, counts = np.asarray(terms, dtype=np.int64), np.asarray(counts, dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        steps = np.frombuffer(positions, dtype="<i4").astype(np.int64)
        total = np.concatenate(([0], np.cumsum(steps)))
        self.postings = total[1:] - np.repeat(total[self.first[:-1]], counts)
        self.sorter = np.argsort(terms)
        self.terms = terms[self.sorter]
        self.stream = np.full(int(self.ends[-1]) if len(self.ends) else 0, -1, dtype=np.int32)  # which term stands where
        self.stream[self.postings] = np.repeat(np.arange(len(terms), dtype=np.int32), counts)

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """The shard's numbers of ``terms``, -2 for those it doesn't hold."""
        if not len(self.terms):
            return np.full(len(terms), -2, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, self.sorter[at], -2)

    def positions(self, number: int) -> np.ndarray:
        return self.postings[self.first[number] : self.first[number + 1]]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions, side="right")

    def standing(self, at: np.ndarray) -> np.ndarray:
        """The number of the term at each position, -1 where there is none."""
        inside = (at >= 0) & (at < len(self.stream))
        return np.where(inside, self.stream[np.where(inside, at, 0)], -1) if len(self.stream) else np.full(at.shape, -1)


class Passages:
    """A block of items: their terms one behind the other, and the anchors from which windows are looked up."""

    def __init__(self, items, sizes, terms, df, window: int, near: int | None) -> None:
        self.items, self.terms = np.asarray(items), np.asarray(terms, dtype=np.int64)
        df = np.asarray(df, dtype=np.int64)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
        anchors, self.rare = [], []
        for k, (begin, end) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
            if end - begin >= window:  # each window is looked up from its rarest term
                views = np.lib.stride_tricks.sliding_window_view(df[begin:end], window)
                at = np.unique(begin + np.arange(len(views)) + views.argmin(axis=1))
                anchors.append(np.stack([np.full(len(at), k), at, np.full(len(at), begin), np.full(len(at), end)]))
            if near:
                self.rare.append((k, rarest_terms(self.terms[begin:end], df[begin:end], near)))
        self.anchors = np.concatenate(anchors, axis=1) if anchors else np.empty((4, 0), dtype=np.int64)


def rarest_terms(passage: np.ndarray, df: np.ndarray, near: int) -> np.ndarray:
    """The ``near`` terms of ``passage`` that the fewest documents hold, ties to the earlier in it; empty if it has fewer.

    Words that no document holds are passed over: they can't be found, nor tell one document from another.
    """
    _, at = np.unique(passage, return_index=True)
    at = np.sort(at[df[at] > 0])
    return passage[at[np.argsort(df[at], kind="stable")[:near]]] if len(at) >= near else passage[:0]


def phrase_hits(shard: Shard, passages: Passages, window: int = WINDOW) -> set[tuple[int, int]]:
    """(document, item) of the shard and the block where ``window`` successive terms of the item occur in succession."""
    number = shard.numbers(passages.terms)
    item, at, begin, end = passages.anchors
    there = number[at] >= 0
    item, at, begin, end = item[there], at[there], begin[there], end[there]
    low, high = shard.first[number[at]], shard.first[number[at] + 1]
    found: set[tuple[int, int]] = set()
    parts = np.cumsum(high - low) // LOOKUPS
    for part in np.unique(parts):
        mine = np.flatnonzero(parts == part)
        count = (high - low)[mine]
        anchor = np.repeat(mine, count)
        position = shard.postings[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[mine], count)]
        keep = np.zeros(len(anchor), dtype=bool)
        for step in (-1, 1):  # the neighbours thin the list before the whole stretch is compared
            to = at[anchor] + step
            inside = (to >= begin[anchor]) & (to < end[anchor])
            keep |= inside & (shard.standing(position + step) == number[np.where(inside, to, 0)]) if window > 1 else True
        anchor, position = anchor[keep], position[keep]
        if not len(anchor):
            continue
        offsets = np.arange(1 - window, window)
        to = at[anchor][:, None] + offsets
        inside = (to >= begin[anchor][:, None]) & (to < end[anchor][:, None])
        same = inside & (shard.standing(position[:, None] + offsets) == number[np.where(inside, to, 0)])
        total = np.cumsum(np.pad(same, ((0, 0), (1, 0))), axis=1)
        hit = (total[:, window:] - total[:, :-window] == window).any(axis=1)
        found.update(zip(shard.document(position[hit]).tolist(), item[anchor[hit]].tolist(), strict=True))
    return found


def near_hits(shard: Shard, terms: np.ndarray, span: int = NEAR_SPAN) -> set[int]:
    """Documents in which all ``terms`` (numbers of the shard) stand in one stretch of ``span`` words, looked up from the rarest."""
    at = shard.positions(int(terms[0]))
    for term in terms[1:]:  # every term near enough to the rarest thins the list before stretches are compared
        where = shard.positions(int(term))
        right = np.searchsorted(where, at)
        before, after = where[np.maximum(right - 1, 0)], where[np.minimum(right, len(where) - 1)]
        at = at[(np.abs(before - at) < span) | (np.abs(after - at) < span)]
        if not len(at):
            return set()
    doc = shard.document(at)
    begin, end = np.concatenate(([0], shard.ends))[doc], shard.ends[doc]
    pos = at[:, None] + np.arange(1 - span, span)[None, :]
    stream = np.where((pos >= begin[:, None]) & (pos < end[:, None]), shard.standing(pos), -1)
    ok = np.ones((len(at), span), dtype=bool)  # for each stretch that holds the position
    for term in terms:
        total = np.cumsum(np.pad(stream == term, ((0, 0), (1, 0))), axis=1)
        ok &= total[:, span:] > total[:, :-span]
    return set(doc[ok.any(axis=1)].tolist())


def _passage_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"item_id": pdf["item_id"], "terms": [[term_of(w) for w in words(p)] for p in pdf["passage"]]})


def document_frequencies(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df): how many of all documents of ``index`` hold each of ``terms`` (block, term) that any holds."""
    blocks = terms.groupBy("block").agg(F.collect_set("term").alias("wanted"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for own, held, wanted in zip(pdf["terms"], pdf["held"], pdf["wanted"], strict=True):
                own, held = np.asarray(own, dtype=np.int64), np.asarray(held)
                there = np.isin(own, np.asarray(wanted, dtype=np.int64))
                yield pd.DataFrame({"term": own[there], "df": held[there].astype(np.int64)})

    found = _each_block(index.select("terms", "held"), blocks, count, "term long, df long")
    return found.groupBy("term").agg(F.sum("df").alias("df"))


def _each_block(index: DataFrame, blocks: DataFrame, search, schema: str) -> DataFrame:
    """``search`` over every shard with every block; a block is one row of bounded size and is sent to all shards."""
    total = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    out = None
    for block in range(total):
        part = index.withColumn("block", F.lit(block)).join(F.broadcast(blocks.where(F.col("block") == block)), "block").mapInPandas(search, schema)
        out = part if out is None else out.unionByName(part)
    return out


def leaks(documents: DataFrame, items: DataFrame, window: int = WINDOW, near: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """(doc_id, item_id): documents that contain ``window`` successive words of an item's passage in succession.

    With ``near``, also (kind = near) documents holding the item's ``near`` rarest words in one stretch of NEAR_SPAN
    words, rare being what few of all documents hold; then the result has a column kind. Null or short texts and
    passages match nothing. ``index`` is what positional_index stored of ``documents``; without it, it is built.
    The items are the stated query set, held against all shards in blocks of about BLOCK_TERMS words. Repeated rows
    give one result row.
    """
    index = positional_index(documents) if index is None else index
    passages = items.where("passage is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "passage").distinct()
    passages = passages.mapInPandas(_passage_terms, "item_id long, terms array<bigint>").where(F.size("terms") > 0).select(F.xxhash64("item_id", "terms").alias("query"), "item_id", "terms")
    passages = cut(passages)
    blocks = -(-(passages.agg(F.sum(F.size("terms"))).first()[0] or 1) // BLOCK_TERMS)
    passages = passages.withColumn("block", F.pmod("query", F.lit(blocks)).cast("int"))
    terms = passages.select("query", "block", F.posexplode("terms").alias("at", "term"))
    df = document_frequencies(index, terms.select(F.pmod("term", F.lit(blocks)).cast("int").alias("block"), "term"))
    counted = terms.join(df, "term", "left").groupBy("query").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("df", F.lit(0)).alias("df")))).alias("df"))
    whole = passages.join(counted, "query").select("block", F.struct("item_id", "terms", F.col("df.df").alias("df")).alias("p"))
    sent = cut(whole.groupBy("block").agg(F.array_sort(F.collect_list("p")).alias("p")).select(
        "block", F.col("p.item_id").alias("items"), F.transform("p", lambda p: F.size(p["terms"])).alias("sizes"), F.flatten("p.terms").alias("flat"), F.flatten("p.df").alias("df")
    ))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict[int, Passages] = {}
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.block not in opened:
                    opened = {r.block: Passages(r.items, r.sizes, r.flat, r.df, window, near)}
                block = opened[r.block]
                shard = Shard(r.docs, r.ends, r.terms, r.counts, r.positions)
                exact = phrase_hits(shard, block, window)
                rows = [(shard.docs[d], block.items[k], "exact") for d, k in exact]
                for k, rare in block.rare:
                    number = shard.numbers(rare)
                    if len(rare) and (number >= 0).all():
                        rows += [(shard.docs[d], block.items[k], "near") for d in near_hits(shard, number) if (d, k) not in exact]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "kind"])

    hits = _each_block(index.drop("held"), sent, search, "doc_id long, item_id long, kind string")
    return hits.distinct() if near else hits.select("doc_id", "item_id").distinct()
