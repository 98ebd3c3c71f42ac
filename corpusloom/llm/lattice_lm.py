"""Language-model scores from a lattice of subwords.

A text is a run of words and an end. The lattice's probability of a word is summed over every way to spell it as pieces of an
existing vocabulary, the first of which opens the word. A piece's
score is its log probability as a unigram. Forward recursion in log space gives the sum, so no segmentation is picked
and none is left out. The pieces that open words and those that go on share one distribution; as the next opening piece
ends a word, the spelt words add up to 1.

The vocabulary's own scores are ranks of merges, so they only start the estimate: expected counts over all distinct
training words replace them, ``ROUNDS`` times (words are spelt when they are new, so each distinct word counts once).
``rounds=0`` leaves them as they are.

``lattice_score`` is of the lattice alone, with the share of ends that training has. In ``score`` a word that training has can
also be a unit of its own, one more arc from its beginning to its end; units give up ``DISCOUNT`` counts each to the
spelt words, so that it too adds up to 1.

Counts of all words don't fit one machine. The most frequent ones, a fixed number, go to every task; the rest of a
text's words meet their counts in a shuffle on the word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import lean
from .workspace import written

DISCOUNT = 0.5
#: Words whose counts every task holds.
HEAD_WORDS = 1 << 17
#: Rounds of estimation, each over all distinct training words. More change little: see the README.
ROUNDS = 2
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 300_000
LAST = 2**63 - 1

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_NEVER = -1e300
_MARK = "▁"
LOG10 = math.log(10)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def read_pieces(path: str) -> dict[str, float]:
    """Natural log probability of each piece of a sentencepiece model, from its order where its scores are only ranks."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
    score = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())}
    names.sort(key=lambda x: -score[x])
    weight = {p: 1.0 / (i + 50) for i, p in enumerate(names)}
    total = sum(weight.values())
    return {p: math.log(w / total) for p, w in weight.items()}


def byte_pieces() -> list[str]:
    return [f"<0x{b:02X}>" for b in range(256)]


class Lattice:
    """Pieces in an automaton that finds, in one pass over a word, every piece that ends at each character.

    A word is read with a mark before it, which opening pieces begin with. Words with that mark inside or characters that
    no piece spells (these go as bytes) are rare and have their arcs listed one by one.
    """

    def __init__(self, pieces: dict[str, float]):
        spelt = {p: s for p, s in pieces.items() if not (len(p) == 6 and p.startswith("<0x"))}
        self.opening = {p[1:]: s for p, s in spelt.items() if p[:1] == _MARK and _MARK not in p[1:]}
        self.inner = {p: s for p, s in spelt.items() if _MARK not in p}
        floor = min(pieces.values()) if pieces else -20.0
        self.bytes = [pieces.get(p, floor) for p in byte_pieces()]
        self.longest = max(map(len, [*self.opening, *self.inner, ""]))
        self.single = {p for p in self.inner if len(p) == 1}
        self.found = ahocorasick.Automaton()
        for p, s in (*((_MARK + p, s) for p, s in self.opening.items()), *self.inner.items()):
            if p:
                self.found.add_word(p, (len(p), s, p))
        if len(self.found):
            self.found.make_automaton()
        self.plain = bool(len(self.found)) and "" in self.opening

    def arcs(self, word: str) -> list[tuple[int, tuple[int, float, str]]]:
        """(position where an arc ends, (its length, score, piece)) in ascending order of position.

        An arc starts at its end less its length, which is -1 before the word. A piece "" is a character by its bytes.
        """
        if self.plain and self.single.issuperset(word):
            return list(self.found.iter(_MARK + word))
        n, opening, inner = len(word), self.opening, self.inner
        out = []
        for j in range(n + 1):
            if j <= self.longest and (s := opening.get(word[:j])) is not None:
                out.append((j, (j + 1, s, _MARK + word[:j])))
            for i in range(max(0, j - self.longest), j):
                if (s := inner.get(word[i:j])) is not None:
                    out.append((j, (j - i, s, word[i:j])))
            if j and word[j - 1] not in inner:
                out.append((j, (1, sum(self.bytes[b] for b in word[j - 1].encode("utf-8", "replace")), "")))
            if not j and not out:
                out.append((0, (1, self.bytes[0], _MARK)))
        return out

    def forward(self, n: int, arcs: Iterable[tuple[int, tuple[int, float, str]]]) -> list[float]:
        """Log of the summed probability of all ways to reach each position."""
        out = [_NEVER] * (n + 1)
        exp, log1p = math.exp, math.log1p
        for j, (length, s, _) in arcs:
            if j >= length:
                s += out[j - length]
            total = out[j]
            if total <= _NEVER:
                out[j] = s
            elif s > total:
                out[j] = s + log1p(exp(total - s))
            elif s > total - 40:
                out[j] = total + log1p(exp(s - total))
        return out

    def log_probability(self, word: str) -> float:
        return self.forward(len(word), self.arcs(word))[-1]

    def expect(self, word: str, weight: float, into_counts: dict[str, float]) -> None:
        """Add the expected count of every piece in the word's segmentations."""
        arcs = self.arcs(word)
        n = len(word)
        ahead = self.forward(n, arcs)
        total, back = ahead[-1], [_NEVER] * (n + 1)
        back[n] = 0.0
        exp, log1p = math.exp, math.log1p
        for j, (length, s, piece) in reversed(arcs):
            way = back[j]
            if way <= _NEVER:
                continue
            way += s
            i = j - length
            share = exp((way if i < 0 else ahead[i] + way) - total) * weight
            if piece:
                into_counts[piece] = into_counts.get(piece, 0.0) + share
            else:
                for b in word[i:j].encode("utf-8", "replace"):
                    into_counts[f"<0x{b:02X}>"] = into_counts.get(f"<0x{b:02X}>", 0.0) + share
            if i >= 0:
                before = back[i]
                if before <= _NEVER:
                    back[i] = way
                elif way > before:
                    back[i] = way + log1p(exp(before - way))
                elif way > before - 40:
                    back[i] = before + log1p(exp(way - before))


def reestimated(pieces: dict[str, float], counts: dict[str, float]) -> dict[str, float]:
    """Log probabilities from expected counts; a little is kept for pieces that never came up."""
    least = 0.01
    total = sum(counts.get(p, 0.0) + least for p in pieces)
    return {p: math.log((counts.get(p, 0.0) + least) / total) for p in pieces}


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, c long) over a one-column frame of texts."""

    def run(batches):
        held: Counter[bytes] = Counter()

        def out():
            names = list(held)
            for a in range(0, len(names), 50_000):
                part = names[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, type=pa.binary()), pa.array([held[w] for w in part], type=pa.int64())], names=["word", "c"])
            held.clear()

        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    held.update(words_of(text.as_buffer().to_pybytes()))
                    if len(held) > HELD_WORDS:
                        yield from out()
        yield from out()

    return texts.mapInArrow(lean(run), "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _expected(pieces):
    def run(batches):
        lattice, counts = Lattice(pieces.value), {}
        for batch in batches:
            for word in batch.column(0):
                lattice.expect(word.as_py().decode("utf-8", "replace"), 1.0, counts)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), type=pa.string()), pa.array(list(counts.values()), type=pa.float64())], names=["piece", "n"])

    return run


class Model:
    """What a task needs to score words; counts of rarer words are given to it."""

    def __init__(self, pieces: dict[str, float], n: int, v: int, ends: int):
        self.lattice, self.n, self.v = Lattice(pieces), n, v
        self.spare = math.log(DISCOUNT * v / n) if n else 0.0
        self.end_score = math.log10((ends - DISCOUNT) / n) if ends else math.log10(0.5)
        self.end_base = math.log10((ends + 1) / (n + v + 1))
        share = (ends + 0.5) / (n + 1)
        self.end_lattice, self.more = math.log10(share), math.log10(1 - share)

    def base(self, c: int) -> float:
        return math.log10((c + 1) / (self.n + self.v + 1))

    def score(self, word: bytes, c: int) -> tuple[float, float]:
        """log10 probability of the word, and that of the lattice alone."""
        alone = self.lattice.log_probability(word.decode("utf-8", "replace"))
        spelt, lattice = self.spare + alone, alone / LOG10 + self.more
        if not c:
            return spelt / LOG10, lattice
        unit = math.log((c - DISCOUNT) / self.n)
        top = max(unit, spelt)
        return (top + math.log1p(math.exp(-abs(unit - spelt)))) / LOG10, lattice


_ROWS = "k long, th long, word binary, n long, known long, base double, score double, lattice double, tokens long"


def _known_part(model, head):
    """A row for each document of what its frequent words give, and a row for each other distinct word."""

    def run(batches):
        own = Model(*model.value)
        words, counts = head.value
        table = dict(zip(words, counts, strict=True))
        seen: dict[bytes, tuple[float, float, float]] = {}
        for batch in batches:
            ks, ths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            docs: list[tuple] = []
            words: list[bytes] = []
            times: list[int] = []
            for k, th, text in zip(ks, ths, batch.column(2), strict=True):
                held = Counter(words_of(text.as_buffer().to_pybytes())) if text.is_valid else {}
                known = total = 1
                base, score, lattice = own.end_base, own.end_score, own.end_lattice
                if not own.n:
                    known = 0
                before = len(words)
                for word, n in held.items():
                    total += n
                    if (c := table.get(word)) is not None:
                        if (got := seen.get(word)) is None:
                            got = seen[word] = own.base(c), *own.score(word, c)
                        known += n
                        base += n * got[0]
                        score += n * got[1]
                        lattice += n * got[2]
                    else:
                        words.append(word)
                        times.append(n)
                docs.append((k, th, known, base, score, lattice, total, len(words) - before))
                if len(words) + len(docs) >= 50_000:
                    yield _batch(docs, words, times)
                    docs, words, times = [], [], []
            if docs:
                yield _batch(docs, words, times)

    return run


def _batch(docs: list[tuple], words: list[bytes], times: list[int]) -> pa.RecordBatch:
    """A row for each document, then one for each of its other words."""
    k, th, known, base, score, lattice, total, other = (np.array(x) for x in zip(*docs, strict=True))
    none = np.zeros(len(words), dtype=np.int64)
    cells = (
        np.r_[k, np.repeat(k, other)],
        np.r_[th, np.repeat(th, other)],
        pa.array([None] * len(docs) + words, type=pa.binary()),
        np.r_[np.zeros(len(docs), dtype=np.int64), np.array(times, dtype=np.int64)],
        np.r_[known, none],
        np.r_[base, none.astype(np.float64)],
        np.r_[score, none.astype(np.float64)],
        np.r_[lattice, none.astype(np.float64)],
        np.r_[total, none],
    )
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cells], names=["k", "th", "word", "n", "known", "base", "score", "lattice", "tokens"])


def _rare_part(model):
    """Rows sorted by word, the count of each (k null) first, become what each document's rows of the word give."""

    def run(batches):
        own = Model(*model.value)
        now, c, base, score, lattice = None, 0, 0.0, None, 0.0
        for batch in batches:
            out = ks, ths, knowns, bases, scores, lattices = [], [], [], [], [], []
            for word, k, th, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if word != now:
                    now, c, score = word, 0, None
                    base = own.base(0)
                if k is None:
                    c = n
                    base = own.base(c)
                    continue
                if score is None:
                    score, lattice = own.score(word, c)
                ks.append(k)
                ths.append(th)
                knowns.append(n if c else 0)
                bases.append(n * base)
                scores.append(n * score)
                lattices.append(n * lattice)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(out, kinds, strict=True)], names=["k", "th", "known", "base", "score", "lattice"])

    return run


def score_documents(docs: DataFrame, train: Column, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, lattice_score) of every row, learning from rows where ``train``.

    Null counts as the empty text, whose only token is the end. A null id is a valid id and stays null. Rows equal in id
    and text are scored alike, each in a row of its own. With no training rows every count is 0, words are spelt by the
    vocabulary's own scores, and the end has half of all probability. An empty table gives an empty one. Texts are read whole; words of any length are
    scored. Other columns don't take part, whatever their names.
    """
    spark = docs.sparkSession
    shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[id_col].cast("long"), F.lit(LAST)).alias("k"), F.xxhash64(docs[text_col]).alias("th"), docs[text_col].alias("t"), F.coalesce(train, F.lit(False)).alias("train"))
    counts = written(word_counts(rows.where("train").select("t")), "word-counts")
    ends = rows.where("train").count()
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = (sums.n or 0) + ends, sums.v + (ends > 0)
    # classes of frequency, as many from the top as stay within the fixed number of words
    level = F.floor(F.log2("c") * 8)
    held, least = 0, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
        held += r["count"]
        if held > head_words:
            break
        least = r.level
    frequent = level >= least if least is not None else F.lit(False)
    top = counts.where(frequent).collect()
    pieces = read_pieces(vocabulary)
    for _ in range(rounds if sums.v else 0):
        shared = spark.sparkContext.broadcast(pieces)  # a vocabulary's pieces, whatever the corpus
        got = counts.select("word").mapInArrow(_expected(shared), "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        pieces = reestimated(pieces, {r.piece: r.n for r in got})
    model = spark.sparkContext.broadcast((pieces, n, v, ends))
    head = spark.sparkContext.broadcast(([bytes(r.word) for r in top], [r.c for r in top]))
    parts = written(rows.select("k", "th", "t").mapInArrow(lean(_known_part(model, head)), _ROWS), "word-scores")
    tail = parts.where("word is not null").select("word", "k", "th", "n")
    rest = counts.where(~frequent).select("word", F.lit(None).cast("long").alias("k"), F.lit(None).cast("long").alias("th"), F.col("c").alias("n"))
    met = tail.unionByName(rest).repartition(shards, "word").sortWithinPartitions("word", F.asc_nulls_first("k"))
    rare = met.mapInArrow(lean(_rare_part(model)), "k long, th long, known long, base double, score double, lattice double")
    whole = parts.where("word is null").select("k", "th", "known", "base", "score", "lattice", "tokens", F.lit(1).alias("copies"))
    every = whole.unionByName(rare.withColumns({"tokens": F.lit(0).cast("long"), "copies": F.lit(0)}))
    summed = every.groupBy("k", "th").agg(*(F.sum(c).alias(c) for c in ("known", "base", "score", "lattice", "tokens", "copies")))
    one = summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    share = lambda c: (F.col(c) / F.col("copies"))
    known_id = F.when(F.col("k") != LAST, F.col("k"))
    return one.select(known_id.alias("doc_id"), share("tokens").cast("long").alias("n_tokens"), share("known").cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), share("base").alias("base_score"), share("score").alias("score"), share("lattice").alias("lattice_score"))
