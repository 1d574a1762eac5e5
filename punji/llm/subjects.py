"""p9: the subject areas of each document.

Documents are embedded by term weighting and a truncated singular value decomposition (randomized subspace iteration;
each round is one pass over the term table with partial sums a task). Labelled documents give seed centroids, one a
subject and script. Each round of refinement assigns every document to the centroid of highest cosine, where it leads
clearly, and makes each centroid the mean of its documents. Sentences are embedded like documents, their terms weighted
by how clearly the refined centroids tell a term's subject; a sentence is about the subject whose centroid has the
highest cosine, and a document has the subjects of enough of its sentences.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punji.runtime import cut, once

BITS = 17  # terms are hashed to this many bits and one for the script, so the model's size is fixed
TERMS = 1 << (BITS + 1)
RANK = 40
POWER_ROUNDS = 3
REFINEMENTS = 5
CLEAR = 0.1  # by how much a document's cosine must lead for it to count in a centroid
MIN_COSINE, MIN_MARGIN = 0.45, 0.3  # of a term or sentence to its subject, and of a term ahead of the next
SHARE = 0.2  # of the sentences, as the definition has it; times how many of them show their subject
LEAST = 2  # sentences
CHUNK = 2_000  # documents whose terms are held in matrices at a time

_WORD = regex.compile(r"[\p{L}\p{M}]+")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
_TELUGU = re.compile("[ఀ-౿]")


def term_id(word: str) -> int:
    """The hashed number of a word; odd for Telugu."""
    return (zlib.crc32(word.encode()) & ((1 << BITS) - 1)) << 1 | bool(_TELUGU.match(word))


def _tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, int] = {}
    for pdf in batches:
        ids, ends = [], []
        for text in pdf["text"]:
            row: list[int] = []
            cuts: list[int] = []
            for sentence in _SENTENCE.split(text.lower() if text else ""):
                words = _WORD.findall(sentence)
                if words:
                    for w in words:
                        n = known.get(w)
                        if n is None:
                            n = term_id(w)
                            if len(known) < 500_000:
                                known[w] = n
                        row.append(n)
                    cuts.append(len(row))
            ids.append(np.array(row, dtype=np.int32))
            ends.append(np.array(cuts, dtype=np.int32))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids, "ends": ends} | _counted(ids))


def _counted(ids: list[np.ndarray]) -> dict[str, list[np.ndarray]]:
    """The distinct terms of each document, and how often each occurs; counted once for all passes."""
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    rows = np.repeat(np.arange(len(ids), dtype=np.int64), sizes)
    keys, counts = np.unique(rows * TERMS + (np.concatenate(ids) if len(ids) else 0), return_counts=True)
    ends = np.searchsorted(keys, np.arange(1, len(ids)) * TERMS)
    return {"terms": np.split((keys % TERMS).astype(np.int32), ends), "times": np.split(counts.astype(np.int32), ends)} if len(ids) else {"terms": [], "times": []}


def term_table(documents: DataFrame) -> DataFrame:
    """(doc_id, ids, ends, terms, times, all array<int>): a document's hashed terms, where its sentences end, distinct terms and their counts."""
    return once(documents.select("doc_id", "text"), "doc_id").mapInPandas(_tokenise, "doc_id long, ids array<int>, ends array<int>, terms array<int>, times array<int>")


class Weights:
    """What a task needs of the model so far, for the terms that occur: their numbers, rarity and rows of the basis.

    Without a basis, the random one is drawn where it is used, so that it needn't be sent.
    """

    def __init__(self, used: np.ndarray, idf: np.ndarray, basis: np.ndarray | None) -> None:
        self.used, self.idf, self._basis = used.astype(np.int32), idf.astype(np.float32), basis
        self._place: np.ndarray | None = None

    @property
    def place(self) -> np.ndarray:
        if self._place is None:
            self._place = np.zeros(TERMS, dtype=np.int32)
            self._place[self.used] = np.arange(len(self.used), dtype=np.int32)
        return self._place

    @property
    def basis(self) -> np.ndarray:
        if self._basis is None:
            self._basis = np.random.default_rng(0).standard_normal((len(self.used), RANK)).astype(np.float32)
        return self._basis


def _matrix(terms: list[np.ndarray], times: list[np.ndarray], weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and unit-length weight of each entry of the documents' term matrix, in row order."""
    sizes = np.array([len(x) for x in terms], dtype=np.int64)
    row = np.repeat(np.arange(len(terms), dtype=np.int64), sizes)
    if not len(row):
        return row, np.empty(0, dtype=np.int32), np.empty(0, dtype=np.float32)
    term = weights.place[np.concatenate(terms)]
    weight = np.log1p(np.concatenate(times)) * weights.idf[term]
    norm = np.sqrt(np.bincount(row, weights=weight**2, minlength=len(terms)))
    return row, term, (weight / np.maximum(norm[row], 1e-9)).astype(np.float32)


def _embed(terms: list[np.ndarray], times: list[np.ndarray], weights: Weights) -> tuple[np.ndarray, tuple]:
    basis = weights.basis
    row, term, weight = _matrix(terms, times, weights)
    out = np.zeros((len(terms), RANK), dtype=np.float32)
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] = np.add.reduceat(weight[:, None] * basis[term], first, axis=0)
    return out, (row, term, weight)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), CHUNK):
            yield pdf.iloc[at : at + CHUNK]


_COLUMNS = [f"y{i}" for i in range(RANK)]


def _power(terms: DataFrame, shared) -> pd.DataFrame:
    """One pass: the transposed term matrix times the matrix times the basis, summed by term over all documents."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        y = np.zeros((len(shared.value.used), RANK), dtype=np.float32)
        for pdf in _chunks(batches):
            embedded, (row, term, weight) = _embed(list(pdf["terms"]), list(pdf["times"]), shared.value)
            if not len(row):
                continue
            order = np.argsort(term, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(term[order]) != 0])
            y[term[order][first]] += np.add.reduceat(weight[order, None] * embedded[row[order]], first, axis=0)
        used = np.flatnonzero(y.any(axis=1))
        yield pd.DataFrame({"term": used.astype(np.int32)} | {c: y[used, i].astype(float) for i, c in enumerate(_COLUMNS)})

    schema = "term int, " + ", ".join(f"{c} double" for c in _COLUMNS)
    return terms.select("terms", "times").mapInPandas(partial, schema).groupBy("term").agg(*(F.sum(c).alias(c) for c in _COLUMNS)).toPandas()


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


class Model:
    """The terms that tell a subject, with their embeddings and weights, and the refined centroids; of fixed size."""

    def __init__(self, weights: Weights, centroids: np.ndarray, general: int) -> None:
        # centroids: (script, subject, RANK); general: the index of the subject for texts of none, or -1
        vector = _unit(weights.basis * weights.idf[:, None].astype(float))
        self.others = np.array([s for s in range(centroids.shape[1]) if s != general], dtype=np.int64)
        self.centroids = centroids[:, self.others]
        self.subjects, self.general = centroids.shape[1], general
        near = np.where((weights.used & 1 == 1)[:, None], vector @ self.centroids[1].T, vector @ self.centroids[0].T) if len(self.others) else np.zeros((len(vector), 1))
        ranked = np.sort(near, axis=1)
        margin = ranked[:, -1] - (ranked[:, -2] if near.shape[1] > 1 else 0)
        tells = (ranked[:, -1] > MIN_COSINE) & (margin > MIN_MARGIN)
        self.place = np.full(TERMS, -1, dtype=np.int32)
        self.place[weights.used[tells]] = np.arange(int(tells.sum()))
        self.vectors = (vector[tells] * (ranked[tells, -1] * margin[tells])[:, None]).astype(np.float32)

    def sentences(self, ids: list[np.ndarray], ends: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(document, subject index) counts of sentences by cosine to the centroids, and each document's sentences."""
        total = np.array([len(e) for e in ends], dtype=np.int64)
        count = np.zeros((len(ids), self.subjects), dtype=np.int64)
        if not total.sum() or not len(self.others):
            return count, total
        terms = np.concatenate(ids)
        words = np.array([len(x) for x in ids], dtype=np.int64)
        stops = np.concatenate(ends) + np.repeat(np.cumsum(words) - words, total)
        held = self.place[terms]
        at = np.flatnonzero(held >= 0)
        if not len(at):
            return count, total
        sentence = np.searchsorted(stops, at, side="right")
        first = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]])
        embedded = np.add.reduceat(self.vectors[held[at]], first, axis=0)
        embedded = embedded / np.maximum(np.linalg.norm(embedded, axis=1, keepdims=True), 1e-9)
        near = np.where((terms[at[first]] & 1 == 1)[:, None], embedded @ self.centroids[1].T, embedded @ self.centroids[0].T)
        about = near.max(axis=1) > MIN_COSINE
        document = np.searchsorted(np.cumsum(total), sentence[first][about], side="right")
        np.add.at(count, (document, self.others[near.argmax(axis=1)[about]]), 1)
        return count, total


def embedded_documents(terms: DataFrame, shared) -> DataFrame:
    """(doc_id, script, vector array<float>): the unit-length embedding of every document that holds a term."""

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _chunks(batches):
            pdf = pdf[[len(x) > 0 for x in pdf["terms"]]]
            if len(pdf):
                vectors = _unit(_embed(list(pdf["terms"]), list(pdf["times"]), shared.value)[0])
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "script": [int(((x & 1) * t).sum() > 0.5 * t.sum()) for x, t in zip(pdf["terms"], pdf["times"], strict=True)], "vector": list(vectors)})

    return terms.select("doc_id", "terms", "times").mapInPandas(embed, "doc_id long, script int, vector array<float>")


def _sums(rows: DataFrame, group, subjects: int, context) -> np.ndarray:
    """(script, subject, RANK + 1): sums of the vectors, and numbers, of ``rows`` by the subject index that ``group`` gives."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, subjects, RANK + 1))
        for pdf in _chunks(batches):
            vectors, script = np.stack(pdf["vector"]), pdf["script"].to_numpy()
            subject = group(pdf, vectors, script)
            good = subject >= 0
            np.add.at(sums, (script[good], subject[good]), np.c_[vectors[good], np.ones(int(good.sum()))])
        yield pd.DataFrame([(a, s, sums[a, s].tolist()) for a in (0, 1) for s in range(subjects) if sums[a, s, RANK]], columns=["script", "subject", "sums"])

    out = np.zeros((2, subjects, RANK + 1))
    summed = rows.mapInPandas(partial, "script int, subject int, sums array<double>").groupBy("script", "subject")
    for r in summed.agg(*(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(RANK + 1))).collect():  # two rows a subject
        out[r[0], r[1]] = r[2:]
    return out


def refined_centroids(documents: DataFrame, labels: DataFrame, listed: list[int]) -> np.ndarray:
    """(script, subject, RANK): unit centroids, seeded by labelled documents and refined over all of ``documents``.

    Vectors are taken from the mean of all documents of their script. A subject that keeps no document keeps its seed.
    """
    context, k = documents.sparkSession.sparkContext, max(1, len(listed))
    index = {s: i for i, s in enumerate(listed)}
    total = _sums(documents, lambda pdf, v, script: np.zeros(len(v), dtype=np.int64), 1, context)[:, 0]
    mean = total[:, :RANK] / np.maximum(total[:, RANK:], 1)
    seeds = _sums(documents.join(labels, "doc_id"), lambda pdf, v, script: np.array([index.get(s, -1) for s in pdf["subject_id"]], dtype=np.int64), k, context)
    centroids = np.where(seeds[:, :, RANK:] > 0, _unit(seeds[:, :, :RANK] / np.maximum(seeds[:, :, RANK:], 1) - mean[:, None]), 0.0)
    for _ in range(REFINEMENTS):

        def nearest(pdf, v, script, centroids=centroids):
            near = np.einsum("ij,ikj->ik", _unit(v - mean[script]), centroids[script])
            ranked = np.sort(near, axis=1)
            clear = ranked[:, -1] - (ranked[:, -2] if k > 1 else 0) > CLEAR
            return np.where(clear, near.argmax(axis=1), -1)

        after = _sums(documents, nearest, k, context)
        centroids = np.where(after[:, :, RANK:] > 0, _unit(after[:, :, :RANK] / np.maximum(after[:, :, RANK:], 1) - mean[:, None]), centroids)
    return centroids


def single_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, subject_id) of the documents whose labels agree."""
    labelled = labels.where("subject_id is not null and doc_id is not null").groupBy("doc_id").agg(F.min("subject_id").alias("subject_id"), F.max("subject_id").alias("other"))
    return labelled.where("subject_id = other").drop("other")


def fit(terms: DataFrame, single: DataFrame, subjects: DataFrame, general: str = "general") -> tuple[Model, list[int]]:
    """The model over all documents of ``terms``, and the subject ids its indexes stand for.

    Inverse document frequencies, decomposition and refinement use every document, seeds every document of ``single``;
    subjects are a list written by hand. The driver holds TERMS x RANK numbers, whatever the size of the corpus.
    """
    context = terms.sparkSession.sparkContext
    listed = sorted((r[0], r[1]) for r in subjects.where("subject_id is not null").select("subject_id", "subject_name").distinct().collect())
    index = {s: k for k, (s, _) in enumerate(listed)}
    kept = next((index[s] for s, name in listed if name == general), -1)
    total = terms.count()
    df = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toPandas().sort_values("term")  # at most TERMS rows
    used, idf = df["term"].to_numpy(dtype=np.int64), np.log((1 + total) / (1 + df["df"].to_numpy(dtype=float)))
    weights = Weights(used, idf, None)
    for _ in range(POWER_ROUNDS):
        shared = context.broadcast(weights)
        y = _power(terms, shared)
        shared.destroy()
        dense = np.zeros((max(len(used), RANK), RANK))
        dense[y["term"].to_numpy(dtype=np.int64)] = y[_COLUMNS].to_numpy()
        q, r = np.linalg.qr(dense)
        weights = Weights(used, idf, q[: len(used)].astype(np.float32))
    if len(used):
        # Directions weigh by how far they rise above the weakest, which holds noise; the first two, for what all
        # texts of a script share, weigh no more than the third.
        turn, square, _ = np.linalg.svd(r)
        rise = np.sqrt(np.maximum(np.minimum(square, square[2]) - square[-1], 0))
        weights = Weights(used, idf, (q[: len(used)] @ turn * (rise / max(rise.max(), 1e-12))).astype(np.float32))
    shared = context.broadcast(weights)
    documents = cut(embedded_documents(terms, shared))
    shared.destroy()
    return Model(weights, refined_centroids(documents, single, [s for s, _ in listed]), kept), [s for s, _ in listed]


def sentence_counts(terms: DataFrame, model: Model) -> DataFrame:
    """(doc_id, total, shown, counts array<int>): a document's sentences, those that show a subject, and those of each."""
    shared = terms.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _chunks(batches):
            counts, total = shared.value.sentences(list(pdf["ids"]), list(pdf["ends"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "total": total, "shown": counts.sum(axis=1), "counts": list(counts.astype(np.int32))})

    return terms.select("doc_id", "ids", "ends").mapInPandas(count, "doc_id long, total int, shown int, counts array<int>")


def _shown(counted: DataFrame, labels: DataFrame) -> float:
    """How many of a document's sentences show a subject, by the median of all labelled documents; 1 without any."""
    share = F.col("shown") / F.greatest("total", F.lit(1))
    return counted.select("doc_id", share.alias("share")).join(labels, "doc_id").agg(F.median("share")).first()[0] or 1.0


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, general: str = "general") -> DataFrame:
    """(doc_id, subject_id): the one or more subjects of every document; the general one only where none is found.

    Null and empty texts are general. A doc_id delivered twice counts once. Without labels, or where no subject is
    called ``general``, documents without a subject get none. An empty table gives no rows.
    """
    terms, single = cut(term_table(documents)), single_labels(labels)
    model, ids = fit(terms, single, subjects, general)
    rest = [ids[model.general]] if model.general >= 0 else []
    counted = cut(sentence_counts(terms, model))
    threshold = SHARE * _shown(counted, single.where(F.col("subject_id") != (rest or [-1])[0]))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _chunks(batches):
            enough = np.stack(pdf["counts"]) >= np.maximum(LEAST, threshold * pdf["total"].to_numpy() - 1e-9)[:, None]
            rows = [(d, s) for d, row in zip(pdf["doc_id"], enough, strict=True) for s in [ids[k] for k in np.flatnonzero(row)] or rest]
            yield pd.DataFrame(rows, columns=["doc_id", "subject_id"])

    return counted.select("doc_id", "total", "counts").mapInPandas(assign, "doc_id long, subject_id int")
