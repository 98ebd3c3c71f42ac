"""Toxicity from weak supervision.

1. Voters. Some are written down: a list of insults and four patterns. The others come from labelled rows: terms (words,
   and beginnings of words) that toxic rows hold far more often than clean ones. Every voter votes toxic or abstains, and
   one votes clean where no other speaks.
2. A generative label model over the voters, fitted by expectation maximisation, estimates how often each
   votes on toxic and on clean rows, and how much pairs of them agree beyond that. Voters that depend on each other
   count as one source.
3. A logistic regression over sparse terms is trained on the model's posterior, and it alone scores texts.

Labels serve to find terms, and to anchor the label model. The training rows are a bounded sample, ``SAMPLE`` rows with the
smallest hashes of their ids among the labelled ones; all else covers every row.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import add_column, free_name, lean

#: Labelled rows that training reads at most.
SAMPLE = 12_000
#: Terms that the classifier knows at most, and learned voters.
TERMS, VOTERS = 4096, 192
#: A word's beginnings that are terms, in bytes.
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.7
#: A term has to be in so many toxic rows, and in that share of them.
LEAST_ROWS, LEAST_SHARE = 4, 0.02

INSULTS = b"clown disgusting dumb fool idiot imbecile jerk loser moron pathetic scum stupid trash vermin worthless".split()
_CUT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
PATTERNS = (
    ("addressed", re.compile(rb"\b(?:you|u)(?: are|'re| r)?(?: such)?(?: an?)? (?:" + b"|".join(INSULTS) + rb")\b", re.I)),
    ("wished", re.compile(rb"\b(?:shut up|go to hell|get lost|drop dead|kill yourself)\b", re.I)),
    ("hated", re.compile(rb"\bi (?:really )?(?:hate|despise) (?:you|them|those)\b", re.I)),
    ("shouted", re.compile(rb"(?:\b[A-Z]{3,}\b[^a-z\w]+){4,}!|!{4,}")),
)


def terms_of(text: bytes) -> set[bytes]:
    """The distinct words, ``beginning*``, and ``beginning**`` or ``beginning****`` where 2 or 4 distinct words begin so."""
    words = set(text.translate(_CUT).split())
    begun = Counter(w[:n] + b"*" for w in words for n in STEMS if len(w) > n)
    return words | with_repeats(begun)


def with_repeats(begun: dict[bytes, int]) -> set[bytes]:
    return set(begun) | {t + b"*" for t, n in begun.items() if n > 1} | {t + b"***" for t, n in begun.items() if n > 3}


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column) -> DataFrame:
    """(id, text, toxic) of at most SAMPLE labelled rows."""
    known = labels.where(usable & labels[id_col].isNotNull() & labels[label_col].isin(0, 1)).groupBy(labels[id_col].alias("lid")).agg(F.max(label_col).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("lid"), "lid").limit(SAMPLE)
    return docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("t")).join(F.broadcast(chosen), F.col("id") == F.col("lid")).select("id", "t", "toxic")  # at most SAMPLE pairs of numbers


def _exploded(batches):
    """Terms of each row with a signature that copies, and most near copies, have in common."""
    for batch in batches:
        toxic = batch.column(1).to_pylist()
        terms, marks, signs = [], [], []
        for t, y in zip(batch.column(0), toxic, strict=True):
            own = terms_of(t.as_buffer().to_pybytes())
            terms += own
            marks += [y] * len(own)
            signs += [min(map(zlib.crc32, own), default=0)] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(terms, type=pa.binary()), pa.array(marks, type=pa.int32()), pa.array(signs, type=pa.int64())], names=["term", "toxic", "sign"])


def _indexed(terms):
    def run(batches):
        index = {t: i for i, t in enumerate(terms.value)}
        for batch in batches:
            found, marks = [], []
            for t in batch.column(0):
                raw = t.as_buffer().to_pybytes()
                found.append(sorted(index[x] for x in terms_of(raw) if x in index))
                marks.append(sum(1 << k for k, (_, p) in enumerate(PATTERNS) if p.search(raw)))
            yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.list_(pa.int32())), pa.array(marks, type=pa.int32()), batch.column(1)], names=["found", "marks", "toxic"])

    return run


class LabelModel:
    """Class-conditional vote rates, fitted without labels, and groups of voters that depend on each other."""

    #: Correlation beyond which voters count as one source.
    DEPENDENT = 0.4

    def __init__(self, prior: float, rounds: int = 40):
        self.prior, self.rounds = min(max(prior, 1e-3), 1 - 1e-3), rounds

    def fit(self, votes: np.ndarray, anchor: np.ndarray | None = None) -> LabelModel:
        """votes: rows by voters, 1 where a voter votes toxic; the last voter votes clean.

        ``anchor``, what is known of each row's class, has half the say when rates are estimated; it keeps a large group of
        voters that agree for another reason (copies of one text) from taking over a class.
        """
        speaks = votes[:, :-1].any(axis=1)
        post = np.where(speaks, 0.9, 0.02)
        self.group = np.arange(votes.shape[1])
        for step in range(self.rounds):
            held = post if anchor is None else (post + anchor) / 2
            on, off = held.sum(), (1 - held).sum()
            self.rate = np.stack([(held @ votes + 0.05) / (on + 0.1), ((1 - held) @ votes + 0.05) / (off + 0.1)])
            if step == self.rounds // 2:
                self._correlate(votes, held)
            post = self.posterior(votes)
        return self

    def _correlate(self, votes: np.ndarray, post: np.ndarray) -> None:
        rest = votes - post[:, None] * self.rate[0] - (1 - post)[:, None] * self.rate[1]
        cov = rest.T @ rest / len(votes)
        dev = np.sqrt(np.diag(cov)) + 1e-9
        self.correlation = cov / dev[:, None] / dev[None, :]
        for i, j in zip(*np.nonzero(np.triu(self.correlation > self.DEPENDENT, 1)), strict=True):
            a, b = self.group[i], self.group[j]
            self.group[self.group == max(a, b)] = min(a, b)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Of a group's votes the strongest counts. An abstention doesn't: voters are silent on most rows of either kind."""
        rate = np.clip(self.rate, 1e-4, 1 - 1e-4)
        said = votes * (np.log(rate[0]) - np.log(rate[1]))
        order = np.argsort(self.group, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(self.group[order]) > 0])
        said = said[:, order]
        logit = np.maximum.reduceat(np.maximum(said, 0), first, axis=1).sum(axis=1) + np.minimum.reduceat(np.minimum(said, 0), first, axis=1).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit + math.log(self.prior / (1 - self.prior)), -40, 40)))


def fit_linear(rows: list[np.ndarray], target: np.ndarray, width: int, rounds: int = 400, l2: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft targets (full-batch Adam)."""
    n = len(rows)
    size = np.array([len(r) for r in rows])
    col = np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(n), size)
    w, b = np.zeros(width + 1), 0.0
    share = min(max(float(target.mean()), 1e-3), 1 - 1e-3)
    w[width] = math.log(share / (1 - share))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=w[col], minlength=n) + w[width]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / n
        grad = np.r_[np.bincount(col, weights=error[row], minlength=width), error.sum()]
        grad[:width] += l2 * w[:width]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-12)
    b = float(w[width])
    return w[:width], b


class Model:
    """Term weights and a bias."""

    def __init__(self, terms: list[bytes], weights: np.ndarray, bias: float):
        self.weights = {t: float(w) for t, w in zip(terms, weights, strict=True) if w}
        self.bias = bias
        self.tracked = {t.rstrip(b"*") + b"*" if t.endswith(b"*") else t for t in self.weights}
        self.seen: dict[bytes, tuple[bytes, ...]] = {}

    def _known(self, word: bytes) -> tuple[bytes, ...]:
        got = tuple(t for t in (word, *(word[:n] + b"*" for n in STEMS if len(word) > n)) if t in self.tracked)
        if len(self.seen) < 200_000:
            self.seen[word] = got
        return got

    def score(self, text: bytes) -> float:
        held: dict[bytes, int] = {}
        for word in set(text.translate(_CUT).split()):
            got = self.seen.get(word)
            if got is None:
                got = self._known(word)
            for t in got:
                held[t] = held.get(t, 0) + 1
        terms = with_repeats(held) & self.weights.keys()
        z = self.bias + sum(self.weights[t] for t in sorted(terms))
        return 1 / (1 + math.exp(-min(max(z, -40.0), 40.0)))


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labelled rows for which ``usable`` (on the labels) holds.

    Labels other than 0 and 1 and null ids don't count; an id with both labels counts as toxic. Without rows of both
    labels the model knows no terms and gives every text the share of toxic rows (0 without rows).
    """
    spark = docs.sparkSession
    rows = _sampled(docs, labels, id_col, text_col, label_col, usable)
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    if not bad or not good:
        return Model([], np.zeros(0), math.log(40) if bad else -40.0)
    sides = rows.select("t", F.col("toxic").cast("int").alias("toxic")).mapInArrow(lean(_exploded), "term binary, toxic int, sign long").distinct().groupBy("term").agg(F.sum("toxic").alias("on"), F.sum(1 - F.col("toxic")).alias("off"))
    ratio = F.log((F.col("on") + 0.5) / (bad + 1)) - F.log((F.col("off") + 0.5) / (good + 1))
    # terms of many rows and a clear lean; a fixed number of them
    top = sides.where(F.col("on") >= max(LEAST_ROWS, LEAST_SHARE * bad)).withColumn("lean", ratio).where("lean > 4.2").orderBy(F.desc(F.col("lean") * F.sqrt("on")), "term").limit(TERMS - len(INSULTS)).collect()
    terms = [bytes(r.term) for r in top]
    terms += [t for t in INSULTS if t not in set(terms)]
    found = rows.select("t", F.col("toxic").cast("int").alias("toxic")).mapInArrow(lean(_indexed(spark.sparkContext.broadcast(terms))), "found array<int>, marks int, toxic int").toPandas()  # at most SAMPLE rows
    held = [np.asarray(x, dtype=np.int64) for x in found["found"]]
    place = {t: i for i, t in enumerate(terms)}
    learned = [place[bytes(r.term)] for r in top ][:VOTERS]
    voters = list(dict.fromkeys([*(place[t] for t in INSULTS), *learned]))
    column = {t: j for j, t in enumerate(voters)}
    votes = np.zeros((len(held), len(voters) + len(PATTERNS) + 1))
    for i, own in enumerate(held):
        for t in own:
            if (j := column.get(int(t))) is not None:
                votes[i, j] = 1
    marks = found["marks"].to_numpy(dtype=np.int64)
    for k in range(len(PATTERNS)):
        votes[:, len(voters) + k] = marks >> k & 1
    votes[:, -1] = ~votes[:, :-1].any(axis=1)
    model = LabelModel(bad / (bad + good)).fit(votes, found["toxic"].to_numpy(dtype=np.float64))
    weights, bias = fit_linear(held, model.posterior(votes), len(terms))
    return Model(terms, weights, bias)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxicity") -> tuple[DataFrame, str]:
    """The documents with a score column (double, 0 to 1) added, and that column's name.

    Null counts as the empty text, which gets the score of a text without known terms. Repeated rows score alike.
    """
    name = free_name(docs, name)
    model.seen.clear()
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most TERMS weights

    def make():
        own = shipped.value
        return lambda texts: pa.array([own.score(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts], type=pa.float64())

    return add_column(docs, name, "double", text_col, make), name
