"""p7: documents put together into containers of a fixed number of tokens, little room left over.

Sizes come from a public tokenizer. A document larger than the container is cut into full pieces and a rest. Items are
packed in shards of bounded size (a uniform mix of sizes each): best fit decreasing first, then a swap-based local
search that exchanges one for one or two for one, or moves items, between underfull containers, each exchange
increasing the sum of squared fills, until containers empty out or no exchange helps.
"""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punji.runtime import cut

TOKENIZER = os.environ.get("PUNJI_TOKENIZER", "/opt/tokenizers/piece_bpe_32k.model")  # a sentencepiece model
SHARD_ITEMS = 20_000  # items in one packing task

_models: dict[str, object] = {}
_lengths: dict[str, dict[str, int]] = {}


def _model(path: str, proto: bytes | None = None):
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_proto=proto) if proto else sentencepiece.SentencePieceProcessor(model_file=path)
        _lengths[path] = {}
    return _models[path], _lengths[path]


def count_tokens(texts, path: str = TOKENIZER, proto: bytes | None = None) -> list[int]:
    """Tokens of each text. Pieces never cross a blank, so words are counted once and remembered.

    That holds for texts whose blanks are single and not at the ends; others are encoded whole.
    """
    model, known = _model(path, proto)
    base = len(model.encode("a"))
    out = []
    for text in texts:
        if not text:
            out.append(0)
            continue
        if "  " in text or text[0] == " " or text[-1] == " " or "▁" in text:
            out.append(len(model.encode(text)))
            continue
        total = 0
        for word in text.split(" "):
            n = known.get(word)
            if n is None:
                if len(known) > 500_000:
                    known.clear()
                n = known[word] = len(model.encode("a " + word)) - base
            total += n
        out.append(total)
    return out


def token_sizes(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens) of every document; null and empty texts have 0.

    The driver reads the model, of under a megabyte, and sends it along, so the machines need no copy of the file.
    """
    with open(path, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tokens": count_tokens(pdf["text"], path, shared.value)})

    return documents.select("doc_id", "text").mapInPandas(sizes, "doc_id long, tokens int")


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit decreasing: lists of item positions, each at most ``capacity`` in sum."""
    frees: list[int] = []  # distinct free sizes in order
    at: dict[int, list[int]] = defaultdict(list)
    bins: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        k = bisect_left(frees, size)
        if k < len(frees):
            free = frees[k]
            b = at[free].pop()
            if not at[free]:
                del frees[k]
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(int(i))
        free -= size
        if free:
            if not at[free]:
                insort(frees, free)
            at[free].append(b)
    return bins


def local_search(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins that increase the sum of squared fills; empty bins are dropped.

    The emptiest bin gives: an item moves to the fullest bin that has room, or is exchanged for a smaller item, or for
    two items of one bin that are smaller together. Stops when a pass over all underfull bins changes nothing.
    """
    fill = np.array([sizes[b].sum() for b in bins], dtype=np.int64)
    changed = True
    while changed:
        under = np.array([b for b in np.argsort(fill, kind="stable") if bins[b] and fill[b] < capacity], dtype=np.int64)
        if len(under) < 2:
            break
        changed = False
        items = [i for b in under for i in bins[b]]
        index = np.array(items, dtype=np.int64)
        size = sizes[index].astype(np.int64)
        home = np.array([b for b in under for _ in bins[b]], dtype=np.int64)
        place = {i: k for k, i in enumerate(items)}
        held = np.ones(len(under), dtype=bool)  # bins that aren't empty
        where = {int(b): k for k, b in enumerate(under)}
        sums = [_pair_sums(bins[b], sizes, int(b)) for b in under]
        pairs = None
        for donor in where:
            again = True
            while again and bins[donor] and fill[donor] < capacity:  # a full bin has nothing to gain
                again = False
                for i in sorted(bins[donor], key=lambda i: -sizes[i]):
                    x = int(sizes[i])
                    room = capacity - fill[under]
                    fits = np.flatnonzero(held & (room >= x) & (fill[under] > fill[donor] - x) & (under != donor))
                    back = []
                    if len(fits):
                        to = int(under[fits[np.argmin(room[fits])]])
                    else:
                        k = _largest_gain(x - size, home, fill, donor, capacity)
                        if k >= 0:
                            to, back = int(home[k]), [int(index[k])]
                        else:
                            if pairs is None:
                                pairs = np.concatenate(sums, axis=1)
                            k = _largest_gain(x - pairs[0], pairs[1], fill, donor, capacity)
                            if k < 0:
                                continue
                            to, back = int(pairs[1, k]), [int(j) for j in pairs[2:, k]]
                    gain = x - int(sum(sizes[j] for j in back))
                    bins[donor].remove(i)
                    bins[donor] += back
                    for j in back:
                        bins[to].remove(j)
                        home[place[j]] = donor
                    bins[to].append(i)
                    home[place[i]] = to
                    fill[donor] -= gain
                    fill[to] += gain
                    held[where[donor]] = bool(bins[donor])
                    for b in (donor, to):
                        sums[where[b]] = _pair_sums(bins[b], sizes, b)
                    pairs = None
                    again = changed = True
                    break
    return [b for b in bins if b]


def _largest_gain(gain, home, fill, donor, capacity) -> int:
    """Place of the largest ``gain`` that its bin has room for and that increases the sum of squared fills; -1 for none."""
    at = fill[home]
    good = (gain > 0) & (gain <= capacity - at) & (at > fill[donor] - gain) & (home != donor)
    if not good.any():
        return -1
    return int(np.argmax(np.where(good, gain, -1)))


def _pair_sums(held: list[int], sizes: np.ndarray, home: int) -> np.ndarray:
    """Columns (sum, home, item, item) of the pairs of items of a bin; of a size, two items stand for all."""
    order = np.array(held, dtype=np.int64)[np.argsort(sizes[held], kind="stable")] if held else np.empty(0, dtype=np.int64)
    s = sizes[order].astype(np.int64)
    kept = np.ones(len(s), dtype=bool)
    kept[2:] = s[2:] != s[:-2]
    order, s = order[kept], s[kept]
    a, b = np.triu_indices(len(s), 1)
    return np.stack([s[a] + s[b], np.full(len(a), home), order[a], order[b]])


def pack(documents: DataFrame, capacities: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(capacity_name, container, doc_id, piece, tokens, first_container): every document in containers of every capacity.

    Pieces count from 0; a document within the capacity is one piece. Empty documents are a piece of 0 tokens. A
    doc_id delivered twice is packed once. Capacities that are null or below 1 are left out; an empty table gives no
    rows. Container names are unique within a capacity; ``first_container`` is where the piece lay before the search.
    """
    sized = cut(token_sizes(documents, path).dropDuplicates(["doc_id"]))
    wanted = F.broadcast(capacities.where("max_tokens > 0").select("capacity_name", "max_tokens").distinct())  # a list of sizes, written by hand
    items = sized.join(wanted).select(
        "capacity_name", "max_tokens", "doc_id",
        F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("tokens") / F.col("max_tokens")).cast("int") - 1, F.lit(0)))).alias("piece"), "tokens",
    ).withColumn("tokens", F.least(F.col("max_tokens"), F.col("tokens") - F.col("piece") * F.col("max_tokens")))
    full = items.where("tokens = max_tokens").select("capacity_name", F.concat_ws("-", F.lit("full"), "doc_id", "piece").alias("container"), "doc_id", "piece", "tokens").withColumn("first_container", F.col("container"))
    rest = items.where("tokens < max_tokens")
    shards = max(1, -(-sized.count() // SHARD_ITEMS))
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))

    def fill_shard(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        sizes = pdf["tokens"].to_numpy(dtype=np.int64)
        capacity = int(pdf["max_tokens"].iloc[0])
        start = best_fit(sizes, capacity)
        named = {}
        for column, bins in (("first_container", start), ("container", local_search([list(b) for b in start], sizes, capacity))):
            named[column] = np.empty(len(pdf), dtype=object)
            for k, held in enumerate(bins):
                named[column][held] = f"{key[1]}-{k}"
        return pd.DataFrame({"capacity_name": pdf["capacity_name"], "doc_id": pdf["doc_id"], "piece": pdf["piece"], "tokens": pdf["tokens"], **named})

    schema = "capacity_name string, container string, doc_id long, piece int, tokens int, first_container string"
    return rest.groupBy("capacity_name", "shard").applyInPandas(fill_shard, schema).unionByName(full)


def packing_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(capacity_name, first_containers, containers, least_containers, tokens, fill): containers before and after the search.

    ``least_containers`` is the number that the tokens need at the very least, ``fill`` how full the containers are.
    """
    used = packed.groupBy("capacity_name").agg(F.countDistinct("first_container").alias("first_containers"), F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    least = F.ceil(F.col("tokens") / F.col("max_tokens")).alias("least_containers")
    return used.join(capacities.select("capacity_name", "max_tokens").distinct(), "capacity_name").select("capacity_name", "first_containers", "containers", least, "tokens", (F.col("tokens") / (F.col("containers") * F.col("max_tokens"))).alias("fill"))
