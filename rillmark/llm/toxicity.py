"""Toxicity (operator 3): Levenshtein automata on a lexicon trie, and context windows that tell quotation from abuse."""

from __future__ import annotations

import dataclasses
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.llm.common import stored

WINDOW = 12  # words on either side of a term
REMEMBERED = 200_000  # words whose match a task keeps at once
STATES = 50_000  # states of the determinised automaton kept at once

# Quotation marks, and words that report what others said.
OPENING, CLOSING = "\"'“‘«„‹>", "\"'”’»“›"
REPORTING = {"said", "says", "wrote", "called", "quoted", "reported", "term", "word", "phrase", "slur", "alleged"}
_EDGES = re.compile(r"^\W+|\W+$")


@dataclasses.dataclass(frozen=True)
class Term:
    """A lexicon entry: a word, or a stem that any ending may follow; edits allowed; weight of a match in (0, 1]."""

    text: str
    stem: bool
    edits: int
    weight: float


class TermAutomaton:
    """Deterministic product of the lexicon trie with Levenshtein automata, made state by state as words need it.

    A state is a set of (trie node, edits so far); a word costs one table look-up per character once its states are known,
    and leaves as soon as no term is within reach.
    """

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach = [0]  # most edits of the terms below a node
        for k, term in enumerate(terms):
            node = 0
            self.reach[0] = max(self.reach[0], term.edits)
            for c in term.text:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.next[node][c]
                self.reach[node] = max(self.reach[node], term.edits)
            self.ends[node].append(k)
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)}) if self.terms else None

    def _state(self, configs: set) -> int:
        """The state of a set of configurations, closed under skipping a character of a term."""
        todo = list(configs)
        while todo:
            node, e = todo.pop()
            if node >= 0:
                for child in self.next[node].values():
                    if e < self.reach[child] and (child, e + 1) not in configs:
                        configs.add((child, e + 1))
                        todo.append((child, e + 1))
                for k in self.ends[node]:
                    if self.terms[k].stem and e <= self.terms[k].edits:
                        configs.add((-1 - k, e))  # a stem once met stays met
        key = frozenset(configs)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.sets[state]:
            if node < 0:
                out.add((node, e))
                continue
            for d, child in self.next[node].items():
                cost = e + (c != d)
                if cost <= self.reach[child]:
                    out.add((child, cost))
            if e < self.reach[node]:
                out.add((node, e + 1))
        return self._state(out) if out else -1

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term, ties to the heavier one; None if no term is within its edits."""
        if self.start is None:
            return None
        if len(self.sets) > STATES:
            self._reset()
        state = self.start
        for c in word:
            to = self.moves[state].get(c)
            if to is None:
                to = self.moves[state][c] = self._step(state, c)
            if to < 0:
                return None
            state = to
        found = [(e, -self.terms[-1 - node].weight, -1 - node) for node, e in self.sets[state] if node < 0]
        found += [(e, -self.terms[k].weight, k) for node, e in self.sets[state] if node >= 0
                  for k in self.ends[node] if e <= self.terms[k].edits]
        return (min(found)[2], min(found)[0]) if found else None


def quoted(words: list[str], at: int) -> bool:
    """Whether the word at ``at`` stands in a quotation: marks open before it and close after it within the window, or a
    reporting word goes before it together with a mark."""
    left = words[max(0, at - WINDOW):at + 1]
    opened = reported = False
    for k in range(len(left) - 1, -1, -1):
        w = left[k]
        if k < len(left) - 1 and w[-1] in CLOSING and not w[0] in OPENING:
            break
        if w[0] in OPENING:
            opened = True
            reported = any(_EDGES.sub("", x).lower() in REPORTING for x in left[:k + 1])
            break
    if not opened:
        return False
    closed = any(_EDGES.sub("", w) != w and w.rstrip(".,;:!?")[-1:] in CLOSING for w in words[at:at + WINDOW + 1])
    return closed or reported


FEATURES = 5


class Scorer:
    """Features of a text: weights of exact and of misspelled terms, outside and inside quotations, and their density."""

    def __init__(self, terms: list[Term]):
        self.automaton, self.known = TermAutomaton(terms), {}
        self.terms = terms

    def hits(self, text: str) -> tuple[list[tuple[int, int, bool]], int]:
        """(term, edits, quoted) of every matching word, and the number of words."""
        words = text.split()
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        some = False
        for w in set(words):
            if w not in known:
                known[w] = self.automaton.match(_EDGES.sub("", w).lower())
            some = some or known[w] is not None
        if not some:
            return [], len(words)
        return [(*known[w], quoted(words, k)) for k, w in enumerate(words) if known.get(w) is not None], len(words)

    def features(self, text: str) -> tuple[np.ndarray, int]:
        found, n = self.hits(text)
        total = np.zeros((2, 2))
        for k, e, q in found:
            total[int(q), int(e > 0)] += self.terms[k].weight
        return np.array([*np.log1p(total).ravel(), math.log1p(100 * total[0].sum() / max(n, 1))]), len(found)


def _terms_of(text: Column, stems: tuple[int, ...]) -> Column:
    """Distinct words (lower case) of a text, and as 'stem*' the beginnings of its longer words."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}]{3,}"), F.lit(0)))

    def beginnings(n: int) -> Column:  # lambdas of one argument: Spark would pass the index as a second one
        return F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))

    return F.array_distinct(F.concat(words, *map(beginnings, stems))) if stems else words


def learn_lexicon(sample: DataFrame, size: int = 500, support: int = 8, ratio: float = 1.5,
                  stems: tuple[int, ...] = (4, 5, 6, 7)) -> list[Term]:
    """Terms of toxic texts: at least ``support`` toxic texts have them and their log odds ratio is ``ratio`` or more.

    Stems that clean texts hold once in a while are terms of a small weight: the fitted features decide by the number and
    density of their matches. A longer term goes under a stem only if its odds are no higher, so its own weight is kept.

    ``sample`` (toxic, text) is a bounded sample of labelled rows. Terms of its toxic texts are counted first; only those
    with support are counted in the other texts. 4 * ``size`` terms at most reach the driver, those with the largest product of
    texts and log odds. A word stands for a stem that it nearly fills, a stem for its words otherwise.
    """
    texts = sample.select("toxic", F.explode(_terms_of(F.col("text"), stems)).alias("term"))
    often = texts.where("toxic = 1").groupBy("term").agg(F.count("*").alias("t")).where(F.col("t") >= support)
    counts = often.join(texts.where("toxic = 0").groupBy("term").agg(F.count("*").alias("n")), "term", "left")
    of = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = of.get(1, 0), of.get(0, 0)
    odds = F.log((F.col("t") + 0.5) / (bad - F.col("t") + 0.5)) - F.log(
        (F.coalesce("n", F.lit(0)) + 0.5) / (good - F.coalesce("n", F.lit(0)) + 0.5))
    top = counts.withColumn("odds", odds).where(F.col("odds") >= ratio).orderBy(
        F.desc(F.col("t") * F.col("odds")), "term").limit(4 * size).collect()
    count = {r.term: r.t for r in top}
    odds_of = {r.term: r.odds for r in top}
    kept: list[str] = []
    for term in sorted(count, key=lambda x: (len(x), x)):
        body = term.rstrip("*")
        longer = [x for x in count if x != term and x.startswith(body) and len(x.rstrip("*")) >= len(body)]
        if term.endswith("*") and any(count[x] >= 0.9 * count[term] for x in longer):
            continue  # a longer stem or a word says the same
        if not any(k.endswith("*") and body.startswith(k[:-1]) and odds_of[term] <= odds_of[k] for k in kept):
            kept.append(term)
    kept = sorted(kept, key=lambda x: (-count[x] * odds_of[x], x))[:size]
    most = max((odds_of[x] for x in kept), default=1.0)
    edits = lambda x: 0 if x.endswith("*") or len(x) < 5 else 1 if len(x) < 9 else 2
    return [Term(x.rstrip("*"), x.endswith("*"), edits(x), odds_of[x] / most) for x in kept]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights (last: constant) of a logistic regression by Newton steps, classes weighted equally."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = -4.0 if not len(y) or y[0] == 0 else 4.0
        return w
    c = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w + np.linalg.solve((z * (c * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (c * (y - p)) - ridge @ w)
    return w


@dataclasses.dataclass(frozen=True)
class Model:
    terms: list[Term]
    weights: np.ndarray


def train(docs: DataFrame, labels: DataFrame, each: int = 8000) -> Model:
    """Learn lexicon and weights from labelled documents: at most ``each`` toxic and ``each`` other ones.

    ``labels`` (doc_id, toxic) names the rows to learn from; of larger tables the ids with the least hash are taken, so the
    sample is the same in every run. Ids with a null label or without a text teach nothing; an id with both labels is toxic.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lot = F.xxhash64("doc_id")
    picked = known.where("toxic = 1").orderBy(lot).limit(each).unionAll(known.where("toxic = 0").orderBy(lot).limit(each))
    # at most 2 * each pairs of numbers are broadcast
    sample = stored(docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id"), "labelled")
    terms = learn_lexicon(sample)

    def describe(batches):
        scorer = Scorer(terms)
        for batch in batches:
            rows = np.array([scorer.features(t)[0] for t in batch.column("text").to_pylist()]).reshape(-1, FEATURES)
            yield pa.record_batch({"toxic": batch.column("toxic"), **{f"x{k}": pa.array(rows[:, k]) for k in range(FEATURES)}})

    schema = T.StructType([sample.schema["toxic"]] + [T.StructField(f"x{k}", T.DoubleType()) for k in range(FEATURES)])
    got = sample.select("toxic", "text").mapInArrow(describe, schema).toArrow()
    x = np.stack([got.column(f"x{k}").to_numpy() for k in range(FEATURES)], 1)
    return Model(terms, fit(x, got.column("toxic").to_numpy()))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Add score (0 to 1), predicted (score >= 0.5) and n_terms (matches) to every row; columns of those names are replaced.

    Whole texts are read, word by word. Null and empty texts have no match and get the score of a text without one.
    """
    docs = docs.drop("score", "predicted", "n_terms")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most ``size`` terms

    def run(batches):
        m = shared.value
        scorer = Scorer(m.terms)
        for batch in batches:
            got = [scorer.features(t or "") for t in batch.column("text").to_pylist()]
            z = np.array([x for x, _ in got]).reshape(-1, FEATURES) @ m.weights[:-1] + m.weights[-1]
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield (batch.append_column("score", pa.array(score)).append_column("predicted", pa.array((score >= 0.5).astype(np.int32)))
                   .append_column("n_terms", pa.array([n for _, n in got], pa.int32())))

    extra = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
             T.StructField("n_terms", T.IntegerType())]
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + extra))
