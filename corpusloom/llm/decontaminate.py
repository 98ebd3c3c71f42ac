"""Benchmark decontamination: Wu-Manber search for runs of benchmark words in documents.

Words, not bytes, are the alphabet, so a pattern of 10 words lets the search leap up to 9 words at a time. A shift
table over blocks of two words skips positions where no pattern can end; where the shift is 0, the block's bucket names
the patterns to compare word by word. Patterns of one length share a matcher (items shorter than a window have their
own, so they don't shorten the leaps of the others). The benchmark's words are numbered, and patterns are places in one
array of numbers, so an index takes about 45 times its text's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import add_column, free_name
from .workspace import written

WINDOW = 10
#: Bytes of benchmark text that one broadcast, and so one index, holds; a larger benchmark takes a pass for each such part.
SHARD_BYTES = 4 << 20

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of ASCII letters (in lower case), digits and bytes beyond ASCII."""
    return text.translate(_TABLE).split()


class WuManber:
    """Finds where any of the patterns, runs of one length in ``words`` (numbers), begin.

    A block of two words is the number of the first times 2**32 plus that of the second; a word of no pattern is -1.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, length: int):
        self.words, self.length = words, length
        self.block = b = min(2, length)
        self.leap = length - b + 1
        self.shift: dict[int, int] = {}
        for end in range(b, length + 1):  # the last block has the smallest shift, and is written last
            self.shift.update(dict.fromkeys(self._blocks(starts + end).tolist(), length - end))
        # buckets: patterns sorted by their last blocks
        self.place = np.argsort(keys := self._blocks(starts + length), kind="stable")
        self.starts, self.keys = starts[self.place], keys[self.place]

    def _blocks(self, ends: np.ndarray) -> np.ndarray:
        last = self.words[ends - 1]
        return (self.words[ends - 2] << 32) + last if self.block == 2 else last

    def find(self, numbers: list[int]) -> list[tuple[int, int]]:
        """(first word, number of the pattern) of every occurrence."""
        out = []
        shift, leap, m, n = self.shift.get, self.leap, self.length, len(numbers)
        i = m
        if self.block == 2:
            while i <= n:
                key = (numbers[i - 2] << 32) + numbers[i - 1]
                step = shift(key, leap)
                if step:
                    i += step
                    continue
                here = numbers[i - m : i]
                k = int(np.searchsorted(self.keys, key))
                while k < len(self.keys) and self.keys[k] == key:
                    if self.words[self.starts[k] : self.starts[k] + m].tolist() == here:
                        out.append((i - m, int(self.place[k])))
                    k += 1
                i += 1
        else:
            for i, w in enumerate(numbers):
                if w in self.shift:
                    out.append((i, int(self.place[np.searchsorted(self.keys, w)])))
        return out


class Matcher:
    """All windows of the items; equal ones are one pattern with several items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.number: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        cut = [np.array([self.number.setdefault(w, len(self.number)) for w in words_of(text)], dtype=np.int64) for _, text in items]
        words = np.concatenate([*cut, np.zeros(0, dtype=np.int64)])
        ends = np.cumsum([len(c) for c in cut])
        self.parts: list[tuple[WuManber, np.ndarray, np.ndarray]] = []
        for size in sorted({min(window, len(c)) for c in cut} - {0}):
            rows = [np.arange(end - len(c), end - size + 1) for c, end in zip(cut, ends, strict=True) if min(window, len(c)) == size]
            starts = np.concatenate(rows)
            owner = np.repeat([i for i, c in enumerate(cut) if min(window, len(c)) == size], [len(r) for r in rows])
            order = np.lexsort([words[starts + t] for t in range(size)])
            starts, owner = starts[order], owner[order]
            new = np.zeros(len(starts), dtype=bool)
            new[0] = True
            for t in range(size):
                column = words[starts + t]
                new[1:] |= column[1:] != column[:-1]
            first = np.flatnonzero(new)
            self.parts.append((WuManber(words, starts[first], size), np.r_[first, len(starts)], owner))

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(spans of hit words, items whose windows occur)."""
        spans, names = [], set()
        numbers = [self.number.get(w, -1) for w in words]
        for part, first, owner in self.parts:
            for at, k in part.find(numbers):
                spans.append((at, at + part.length))
                names.update(self.names[i] for i in owner[first[k] : first[k + 1]])
        return spans, names


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


MATCH = "struct<n_words:long,n_hit:long,items:array<string>,spans:array<struct<start:long,end:long>>>"


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", name: str = "benchmark_match", shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, str]:
    """The documents with a struct column added: words, hit words, items found (sorted as strings) and hit word spans.

    Also returns that column's name: ``name``, with underscores if the documents have it already. An item of fewer words
    than ``window`` is one window; one without words matches nothing. Null texts have no words; an item whose id is null
    is named "". Repeated rows and items count as they stand, an item's name once. With an empty benchmark nothing is hit,
    and an empty documents table gives an empty one. A text of any length is searched whole.

    The index in a task is of ``shard_bytes`` of benchmark text. A larger benchmark is searched part by part, and what has been found
    goes with the documents through a table in the shared folder, so neither memory nor broadcasts grow with it.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(benchmark[item_id].cast("string"), F.lit("")).alias("name"), F.coalesce(benchmark[item_text], F.lit("")).alias("body"))
    total = items.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    name = free_name(docs, name)
    for s in range(shards):
        part = items if shards == 1 else items.where(F.pmod(F.xxhash64("name", "body"), F.lit(shards)) == s)
        shipped = spark.sparkContext.broadcast([(r.item, r.body.encode()) for r in part.withColumnRenamed("name", "item").collect()])  # about shard_bytes

        def make(shipped=shipped):
            matcher = Matcher(shipped.value, window)

            def add(texts: pa.Array, before: pa.Array | None = None) -> pa.Array:
                out = []
                for i, text in enumerate(texts):
                    words = words_of(text.as_buffer().to_pybytes() if text.is_valid else b"")
                    spans, names = matcher.find(words)
                    if before is not None:
                        old = before[i].as_py()
                        spans += [(x["start"], x["end"]) for x in old["spans"]]
                        names |= set(old["items"])
                    spans = merged(spans)
                    out.append({"n_words": len(words), "n_hit": sum(b - a for a, b in spans), "items": sorted(names), "spans": [{"start": a, "end": b} for a, b in spans]})
                return pa.array(out, type=kind)

            return add

        docs = add_column(docs, name, MATCH, text_col, make, before=s > 0)
        if s + 1 < shards:
            docs = written(docs, "matched")
            shipped.unpersist()
    return docs, name
