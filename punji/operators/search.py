"""Ranked full-text search: terms, phrases, prefixes, NEAR, column filters, AND / OR / NOT, substrings, BM25, snippets.

A document is one line of tokens for each indexed column. Every phrase of a query becomes one expression that counts
its occurrences; what is shuffled afterwards are keys and counts, never texts. Corpus statistics are one aggregate row;
the rank is an expression of both. A search is one scan, or, over a stored index, a pushed-down filter on terms.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punji.functions.text import FOLD_FROM, FOLD_TO, TOKEN, fold, like_contains, tokens

K1, B = 1.2, 0.75  # of BM25
LEAST_IDF = 1e-6
NEAR_TOKENS = 10  # between the phrases of a NEAR that names no number
NOT_TOKEN = "[^" + TOKEN[1:]


class QuerySyntaxError(ValueError):
    """The query text isn't a valid match expression."""


@dataclass
class Node:
    """op: phrase, near, and, or, not.

    A phrase holds its raw text, whether its last token is a prefix, whether it must begin its column and the columns it
    may stand in (None for all); near holds phrases and the most tokens between them.
    """

    op: str
    parts: list[Node] = field(default_factory=list)
    text: str = ""
    prefix: bool = False
    first: bool = False
    columns: frozenset[str] | None = None
    span: int = NEAR_TOKENS


_LEXEME = re.compile(r'\s*(?:"((?:[^"]|"")*)"|([A-Za-z0-9_\x1a\x80-\U0010FFFF]+)|([(){}:^+,*-]))')


def _lexemes(query: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while query[at:].strip():
        m = _LEXEME.match(query, at)
        if not m:
            raise QuerySyntaxError(query)
        at = m.end()
        if m[3]:
            out.append((m[3], ""))
        elif m[2] in ("AND", "OR", "NOT"):
            out.append((m[2], ""))
        else:
            out.append(("word", m[2]) if m[2] is not None else ("string", m[1].replace('""', '"')))
    return out


class _Parser:
    """Recursive descent: OR binds least, then AND, NOT, and words side by side most."""

    def __init__(self, query: str) -> None:
        self.query, self.lexemes, self.at = query, _lexemes(query), 0

    def fail(self):
        raise QuerySyntaxError(self.query)

    def kind(self, ahead: int = 0) -> str:
        return self.lexemes[self.at + ahead][0] if self.at + ahead < len(self.lexemes) else ""

    def take(self, *kinds: str) -> str | None:
        if self.kind() in kinds:
            self.at += 1
            return self.lexemes[self.at - 1][1] or self.lexemes[self.at - 1][0]
        return None

    def need(self, *kinds: str) -> str:
        return self.take(*kinds) or self.fail()

    def phrase(self) -> Node:
        first = bool(self.take("^"))
        if self.kind() not in ("word", "string"):
            self.fail()
        text = self.lexemes[self.at][1]
        self.at += 1
        while self.take("+"):
            if self.kind() not in ("word", "string"):
                self.fail()
            text += " " + self.lexemes[self.at][1]
            self.at += 1
        return Node("phrase", text=text, prefix=bool(self.take("*")), first=first)

    def near(self) -> Node:
        if self.kind() == "word" and self.lexemes[self.at][1] == "NEAR" and self.kind(1) == "(":
            self.at += 2
            node = Node("near", [self.phrase()])
            while self.kind() in ("word", "string", "^"):
                node.parts.append(self.phrase())
            if self.take(","):
                number = self.need("word")
                node.span = int(number) if number.isdecimal() else self.fail()
            self.need(")")
            return node
        return self.phrase()

    def filtered(self) -> tuple[bool, list[str]] | None:
        """The column filter that begins here, if one does: whether it excludes, and its names."""
        start = self.at
        without = bool(self.take("-"))
        if self.take("{"):
            names = []
            while self.kind() in ("word", "string"):
                names.append(self.take("word", "string"))
            self.need("}")
        elif self.kind() in ("word", "string"):
            names = [self.take("word", "string")]
        else:
            names = []
        if names and self.take(":"):
            return without, names
        self.at = start
        return None

    def primary(self) -> Node:
        limit = self.filtered()
        if self.take("("):
            inner = self.either()
            self.need(")")
        else:
            inner = self.near()
        return _limited(inner, *limit) if limit else inner

    def implicit(self) -> Node:
        parts = [self.primary()]
        while self.kind() in ("word", "string", "^", "(", "{", "-"):
            parts.append(self.primary())
        return parts[0] if len(parts) == 1 else Node("and", parts)

    def without(self) -> Node:
        left = self.implicit()
        while self.take("NOT"):
            left = Node("not", [left, self.implicit()])
        return left

    def both(self) -> Node:
        parts = [self.without()]
        while self.take("AND"):
            parts.append(self.without())
        return parts[0] if len(parts) == 1 else Node("and", parts)

    def either(self) -> Node:
        parts = [self.both()]
        while self.take("OR"):
            parts.append(self.both())
        return parts[0] if len(parts) == 1 else Node("or", parts)


def _limited(node: Node, without: bool, names: list[str]) -> Node:
    """``node`` within a column filter; a filter inside it is narrowed."""
    if node.op != "phrase":
        return replace(node, parts=[_limited(p, without, names) for p in node.parts])
    own = frozenset(f"-{n}" for n in names) if without else frozenset(names)
    if node.columns is None:
        return replace(node, columns=own)
    inside = {n for n in node.columns if not n.startswith("-")}
    if without:
        return replace(node, columns=frozenset(inside - set(names)) if inside else node.columns | own)
    return replace(node, columns=frozenset(n for n in names if f"-{n}" not in node.columns and (not inside or n in inside)))


def parse(query: str) -> Node:
    """The tree of a match expression.

    Barewords, "phrases", one + two, prefix*, ^first, NEAR(a b, 5), column : x, {a b} : x, - column : x, AND / OR / NOT,
    brackets, implicit AND. Raises QuerySyntaxError on anything else, such as a hyphen, a dot or an unbalanced quote.
    """
    parser = _Parser(query)
    tree = parser.either()
    if parser.kind():
        parser.fail()
    return tree


def phrases(node: Node) -> list[Node]:
    return [node] if node.op == "phrase" else [p for part in node.parts for p in phrases(part)]


def query_words(text: str) -> list[str]:
    """The tokens of a query phrase, by the rule of the documents' tokens: folded runs of letters, numbers and Telugu signs."""
    low = text.lower().translate(str.maketrans(FOLD_FROM, FOLD_TO))
    held = lambda c: unicodedata.category(c)[0] in "LN" or unicodedata.category(c) == "Co" or "\u0c00" <= c <= "\u0c7f"
    return "".join(c if held(c) else " " for c in low).split()


def _line(c: Column) -> Column:
    """The tokens of a column as one line, a blank before and behind each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(fold(F.coalesce(c, F.lit(""))), NOT_TOKEN, " ")), F.lit(" "))


def _size(line: Column) -> Column:
    return F.when(F.length(line) <= 2, 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) - 1)


def _occurrences(line: Column, words: list[str], prefix: bool, first: bool) -> Column:
    """How often the words follow each other in the line; overlapping occurrences all count."""
    run = " " + " ".join(words) + ("" if prefix else " ")
    if first:
        return line.startswith(run).cast("int")
    # tokens are letters and digits only, so nothing needs escaping; the look-ahead lets occurrences overlap
    return F.when(line.contains(run), F.regexp_count(line, F.lit(f"(?={run})"))).otherwise(0)


def _bound(body, **values: Column) -> Column:
    """``body`` of a struct of ``values``; within it they are variables, so that no inner function computes them again."""
    return F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), body)[0]


def _line_starts(line: Column, words: list[str], prefix: bool, first: bool) -> Column:
    """The places (from 0) at which the words stand in the line."""
    run = " " + " ".join(words) + ("" if prefix else " ")

    def places(held: Column) -> Column:
        beside = F.arrays_zip(*(F.slice(held["t"], j + 1, F.size(held["t"])).alias(f"w{j}") for j in range(len(words))))

        def here(z: Column, i: Column) -> Column:
            out = F.lit(True) if not first else i == 0
            for j, w in enumerate(words):
                out = out & (z[f"w{j}"].startswith(w) if prefix and j == len(words) - 1 else z[f"w{j}"] == w)
            return F.when(F.coalesce(out, F.lit(False)), i)

        return F.array_compact(F.transform(beside, here))

    return F.when(line.contains(run), _bound(places, t=F.split(F.trim(line), " "))).otherwise(F.array().cast("array<int>"))


def _near(starts: list[Column], lengths: list[int], span: int) -> Column:
    """How many places of each phrase lie within a group of all phrases with at most ``span`` tokens between them.

    A group is known by its last place; every phrase begins no further before it than its own length and the span.
    """

    def within(p: Column, x: Column, n: int) -> Column:
        return (p <= x) & (p >= x - n - span)

    def last(held: Column) -> Column:
        def whole(x: Column) -> Column:
            out = F.lit(True)
            for k, n in enumerate(lengths):
                out = out & F.exists(held[f"p{k}"], _of(lambda p, n: within(p, x, n), n))
            return out

        return F.filter(F.array_distinct(F.concat(*(held[f"p{k}"] for k in range(len(lengths))))), whole)

    def counted(held: Column) -> Column:
        def grouped(n: int):
            return lambda p: F.exists(held["last"], lambda x: within(p, x, n))

        return F.array(*(F.size(F.filter(held[f"p{k}"], grouped(n))) for k, n in enumerate(lengths)))

    names = [f"p{k}" for k in range(len(starts))]
    whole = _bound(lambda held: F.struct(*(held[p].alias(p) for p in names), last(held).alias("last")), **dict(zip(names, starts, strict=True)))
    return _bound(lambda held: counted(held["h"]), h=whole)


def _of(f, n: int):
    return lambda p: f(p, n)


class _Query:
    """A parsed query over ``columns``: its leaves, their words and the counts that a document needs."""

    def __init__(self, query: str, columns: list[str]) -> None:
        self.tree, self.columns = parse(query), columns
        self.leaves = phrases(self.tree)
        self.words = [query_words(leaf.text) for leaf in self.leaves]
        self.place = {id(leaf): k for k, leaf in enumerate(self.leaves)}
        for leaf in self.leaves:
            for name in leaf.columns or ():
                if name.lstrip("-") not in columns:
                    raise QuerySyntaxError(f"no column {name.lstrip('-')}")

    def allowed(self, leaf: Node) -> list[str]:
        if leaf.columns is None:
            return self.columns
        given = [c for c in self.columns if c in leaf.columns]
        return given if any(not n.startswith("-") for n in leaf.columns) or not leaf.columns else [c for c in self.columns if f"-{c}" not in leaf.columns]

    def counts(self, occurrences, starts) -> list[Column]:
        """``__f`` (occurrences that count) and ``__h`` (occurrences at all) of each leaf.

        ``occurrences`` and ``starts`` give the number and the places of a leaf in a column.
        """
        total = lambda parts: sum(parts[1:], parts[0]) if parts else F.lit(0)
        f: dict[int, Column] = {}
        plain = [total([occurrences(c, self.words[k], leaf) for c in self.allowed(leaf)]) if self.words[k] else F.lit(0) for k, leaf in enumerate(self.leaves)]

        def walk(node: Node) -> None:
            if node.op == "near":
                places = [self.place[id(p)] for p in node.parts if self.words[self.place[id(p)]]]
                by_column: list[list[Column]] = []
                for c in self.columns:
                    if places and all(c in self.allowed(self.leaves[k]) for k in places):
                        by_column.append(_near([starts(c, self.words[k], self.leaves[k]) for k in places], [len(self.words[k]) for k in places], node.span))
                for i, k in enumerate(places):
                    f[k] = total([found[i] for found in by_column])
            for part in node.parts:
                walk(part)

        walk(self.tree)
        return [c for k in range(len(self.leaves)) for c in (f.get(k, plain[k]).cast("long").alias(f"__f{k}"), plain[k].cast("long").alias(f"__h{k}"))]

    def matches(self, node: Node | None = None) -> Column:
        node = self.tree if node is None else node
        if node.op == "phrase":
            return F.col(f"__f{self.place[id(node)]}") > 0
        parts = [self.matches(p) for p in node.parts]
        out = parts[0]
        for p in parts[1:]:
            out = (out | p) if node.op == "or" else (out & ~p) if node.op == "not" else (out & p)
        return out


def _ranked(counted: DataFrame, stats: DataFrame, matches: Column, leaves: int, kept: list[str]) -> DataFrame:
    """The matching rows of ``counted`` with their rank; ``stats``: one row of __n, __avg and __n0, __n1, ..."""
    scored = counted.where(matches).join(F.broadcast(stats))
    rank = F.lit(0.0)
    for k in range(leaves):
        n, f = F.col(f"__n{k}"), F.col(f"__f{k}")
        idf = F.log((F.col("__n") - n + 0.5) / (n + 0.5))
        rank = rank - F.when(idf <= 0, LEAST_IDF).otherwise(idf) * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("__d") / F.col("__avg")))
    return scored.select(*kept, rank.alias("rank"))


def _statistics(counted: DataFrame, leaves: int) -> DataFrame:
    return counted.agg(F.count("*").alias("__n"), F.avg("__d").alias("__avg"), *(F.count_if(F.col(f"__h{k}") > 0).alias(f"__n{k}") for k in range(leaves)))


def _nothing(documents: DataFrame, keys: list[str] | None) -> DataFrame:
    return (documents.select(*keys) if keys else documents).withColumn("rank", F.lit(0.0)).limit(0)


def match(documents: DataFrame, columns: list[str], query: str, keys: list[str] | None = None) -> DataFrame:
    """``documents`` that match, with their ``rank``: negative BM25, the best first in ascending order.

    With ``keys`` only those columns are returned, and a document delivered twice counts once: its texts are reduced to
    counts before the shuffle that drops repeats. Without, all columns are, and rows must be unique. All ``columns``
    count alike; a phrase lies within one column. The statistics cover every document. Raises QuerySyntaxError; a blank
    query or one without tokens matches nothing. Null columns are empty.
    """
    if not query.strip():
        return _nothing(documents, keys)
    q = _Query(query, columns)
    kept = keys or documents.columns
    cut = {c: f"__t{i}" for i, c in enumerate(columns)}
    df = documents.select(*kept, *(_line(F.col(c)).alias(t) for c, t in cut.items()))
    hits = q.counts(
        lambda c, words, leaf: _occurrences(F.col(cut[c]), words, leaf.prefix, leaf.first),
        lambda c, words, leaf: _line_starts(F.col(cut[c]), words, leaf.prefix, leaf.first),
    )
    size = sum((_size(F.col(t)) for t in list(cut.values())[1:]), _size(F.col("__t0"))).alias("__d")
    counted = df.select(*kept, size, *hits)
    counted = counted.dropDuplicates(keys) if keys else counted
    return _ranked(counted, _statistics(counted, len(q.leaves)), q.matches(), len(q.leaves), kept)


def substring_match(documents: DataFrame, column: str, query: str, keys: list[str] | None = None) -> DataFrame:
    """Documents whose ``column`` holds the substrings of ``query``, case folded, ranked by BM25 on trigrams.

    Words and "phrases" are substrings of 3 code points at least; AND, OR, NOT and brackets join them; NEAR is as AND,
    and prefixes are substrings anyway. A shorter substring is passed over, by itself it matches nothing. Overlapping
    occurrences count. ``keys`` and errors as in ``match``.
    """
    if not query.strip():
        return _nothing(documents, keys)

    def long(node: Node) -> Node | None:
        if node.op == "phrase":
            return node if len(node.text) >= 3 else None
        parts = [p for p in map(long, node.parts) if p]
        return None if not parts else parts[0] if len(parts) == 1 else replace(node, parts=parts)

    tree = long(parse(query))
    if tree is None:
        return _nothing(documents, keys)
    leaves = phrases(tree)
    kept = keys or documents.columns
    df = documents.select(*kept, F.lower(F.coalesce(F.col(column), F.lit(""))).alias("__t"))
    text = F.col("__t")
    hits = []
    for k, leaf in enumerate(leaves):
        low = leaf.text.lower()
        found = F.when(text.contains(low), F.regexp_count(text, F.lit("(?=" + re.escape(low) + ")"))).otherwise(0)
        hits += [found.alias(f"__f{k}"), found.alias(f"__h{k}")]
    counted = df.select(*kept, F.greatest(F.length(text) - 2, F.lit(0)).alias("__d"), *hits)
    counted = counted.dropDuplicates(keys) if keys else counted
    place = {id(leaf): k for k, leaf in enumerate(leaves)}

    def matches(node: Node) -> Column:
        if node.op == "phrase":
            return F.col(f"__f{place[id(node)]}") > 0
        parts = [matches(p) for p in node.parts]
        out = parts[0]
        for p in parts[1:]:
            out = (out | p) if node.op == "or" else (out & ~p) if node.op == "not" else (out & p)
        return out

    return _ranked(counted, _statistics(counted, len(leaves)), matches(tree), len(leaves), kept)


def postings(documents: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(term, column, doc, positions, size): where each term stands in each document; ``size``: its tokens in all columns.

    A document's terms are grouped inside its row, so nothing but the postings themselves is shuffled.
    """
    sized = documents.select(F.col(key).alias("doc"), *(tokens(F.col(c)).alias(c) for c in columns))
    size = sum((F.size(c) for c in columns[1:]), F.size(columns[0]))
    parts = [sized.select("doc", F.lit(c).alias("column"), size.alias("size"), F.posexplode(c).alias("at", "term")) for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("term", "column", "doc", "size").agg(F.sort_array(F.collect_list("at")).alias("positions"))


def store_index(documents: DataFrame, key: str, columns: list[str], path: str) -> None:
    """Writes the postings of ``documents`` (one row a ``key``) below ``path``, in order of terms, and their statistics.

    The order lets a search read only the row groups of its terms; ranges of (term, doc) split a term that very many
    documents hold.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings(documents, key, columns).repartitionByRange(parts, "term", "doc").sortWithinPartitions("term", "doc").write.mode("overwrite").option("parquet.block.size", 32 << 20).parquet(f"{path}/postings")
    size = sum((F.size(tokens(F.col(c))) for c in columns[1:]), F.size(tokens(F.col(columns[0]))))
    documents.agg(F.count("*").alias("__n"), F.avg(size).alias("__avg"), F.lit(json.dumps(columns)).alias("columns")).write.mode("overwrite").parquet(f"{path}/statistics")


def match_index(spark: SparkSession, path: str, query: str) -> DataFrame:
    """(doc, rank) of the documents of the index at ``path`` that match ``query``, as ``match`` has them.

    Only the postings of the query's terms are read, by a filter that reaches the files; no text is.
    """
    corpus = spark.read.parquet(f"{path}/statistics")
    columns = json.loads(corpus.select("columns").first()[0])  # one row
    index = spark.read.parquet(f"{path}/postings")
    if not query.strip():
        return index.select("doc", F.lit(0.0).alias("rank")).limit(0)
    q = _Query(query, columns)
    exact = sorted({w for words, leaf in zip(q.words, q.leaves, strict=True) for w in (words[:-1] if leaf.prefix else words)})
    begun = sorted({words[-1] for words, leaf in zip(q.words, q.leaves, strict=True) if leaf.prefix and words})
    wanted = F.col("term").isin(exact) if exact else F.lit(False)
    for w in begun:
        wanted = wanted | F.col("term").startswith(w)
    held = index.where(wanted).groupBy("doc").agg(F.first("size").alias("__d"), F.collect_list(F.struct("column", "term", "positions")).alias("__p"))

    def of(column: str, word: str, prefix: bool) -> Column:
        mine = F.filter("__p", lambda p: (p["column"] == column) & (p["term"].startswith(word) if prefix else p["term"] == word))
        return F.flatten(F.transform(mine, lambda p: p["positions"]))

    def starts(column: str, words: list[str], leaf: Node) -> Column:
        places = {f"w{j}": of(column, w, leaf.prefix and j == len(words) - 1) for j, w in enumerate(words)}

        def following(held: Column) -> Column:
            out = held["w0"]
            for j in range(1, len(words)):
                out = F.filter(out, _of(lambda i, j: F.array_contains(held[f"w{j}"], i + j), j))
            return F.filter(out, lambda i: i == 0) if leaf.first else out

        return _bound(following, **places)

    counted = held.select("doc", "__d", *q.counts(lambda c, words, leaf: F.size(starts(c, words, leaf)), starts))
    found = counted.agg(*(F.count_if(F.col(f"__h{k}") > 0).alias(f"__n{k}") for k in range(len(q.leaves))))
    return _ranked(counted, corpus.select("__n", "__avg").join(F.broadcast(found)), q.matches(), len(q.leaves), ["doc"])


def shape_catalog(query: str, exact: bool = False) -> str:
    """The match expression of a catalog search: exact as a phrase, one word as a prefix, else as typed."""
    q = query.strip()
    if exact:
        return '"' + q.replace('"', '""') + '"'
    return q + "*" if q and " " not in q and not q.endswith("*") else q


def shape_article(query: str) -> str:
    """The match expression of an exact article search: several words as typed (all must occur), one as a phrase."""
    q = query.strip()
    return q if " " in q else '"' + q.replace('"', '""') + '"'


def like_any(documents: DataFrame, columns: list[str], query: str, keys: list[str] | None = None) -> DataFrame:
    """Documents that hold the query LIKE-wise in one of ``columns``, with rank 0."""
    held = F.lit(False)
    for c in columns:
        held = held | F.coalesce(like_contains(F.col(c), query.strip().rstrip("*")), F.lit(False))
    found = documents.where(held)
    return (found.select(*keys).dropDuplicates(keys) if keys else found).withColumn("rank", F.lit(0.0))


def match_or_like(documents: DataFrame, columns: list[str], query: str, like: list[str], keys: list[str] | None = None) -> DataFrame:
    """``match``; where the query isn't valid, those that hold it LIKE-wise in a column of ``like``, with rank 0."""
    try:
        return match(documents, columns, query, keys)
    except QuerySyntaxError:
        return like_any(documents, like, query, keys)


def substring_or_like(documents: DataFrame, column: str, query: str, like: list[str], keys: list[str] | None = None) -> DataFrame:
    """``substring_match``; where the query isn't valid, those that hold it LIKE-wise in a column of ``like``, with rank 0."""
    try:
        return substring_match(documents, column, query, keys)
    except QuerySyntaxError:
        return like_any(documents, like, query, keys)


def snippet(column: Column, words: list[str], around: int = 15, prefixes: list[str] | None = None) -> Column:
    """``around`` white-space words with the most hits among them, hits marked <b>, from two words before a hit.

    A hit holds one of ``words``, or a token that begins with one of ``prefixes``. Of equal stretches the first counts,
    without a hit the beginning.
    """
    parts = F.split(F.coalesce(column, F.lit("")), r"\s+")
    begun = prefixes or []
    hit = lambda t: F.exists(tokens(t), lambda x: F.greatest(F.lit(False), x.isin(words) if words else F.lit(False), *(x.startswith(p) for p in begun)))
    flags = F.transform(parts, hit)
    begin = lambda i: F.greatest(F.lit(0), i - 2)
    score = F.transform(flags, lambda f, i: F.struct(F.when(f, F.size(F.filter(F.slice(flags, begin(i) + 1, around), lambda x: x))).otherwise(0).alias("n"), (-begin(i)).alias("at")))
    start = -F.array_max(score)["at"] + 1
    window = F.transform(F.slice(parts, start, around), lambda t: F.when(hit(t), F.concat(F.lit("<b>"), t, F.lit("</b>"))).otherwise(t))
    return F.concat(F.when(start > 1, "...").otherwise(""), F.array_join(window, " "), F.when(F.size(parts) >= start + around, "...").otherwise(""))
