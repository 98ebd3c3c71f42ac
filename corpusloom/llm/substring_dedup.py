"""Substring dedup: words whose window of 13 also starts in an earlier document go.

A suffix automaton of a reference tells, for each word of a streamed text, how long a run that ends there occurs in the
reference (the matching statistics). Here the reference is the corpus itself, so no automaton of it can be sent out
whole. The corpus is cut so that each piece only needs one small automaton:

1. Each window of 13 words names its anchor, the smallest hash of its 6-word runs. Equal windows have equal anchors.
2. Of documents with equal texts only the first goes on; the others lose every window by that.
   Anchors that only one document holds are dropped (``shared_keys``): their windows can't repeat.
3. For the others, each stretch of windows with one anchor is a piece of 13 to 20 words. Equal pieces of a task collapse to
   the smallest document that has one, before anything moves.
4. All pieces of an anchor meet in one shard. In ascending order of document each is streamed through the shard's
   automaton; a match of 13 words gives the window's first document, and the stretches that match nothing are added.
   Shards hold a bounded number of words.
5. Each document looks up its pieces, and the windows whose first document is smaller than its own are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import free_name, lean
from .shared import cut_keys, shard_count, shared_keys
from .textops import gram_hashes, hash_words, scan, slices, sliding_argmin

WINDOW = 13
ANCHOR = 6
#: Words in an automaton after which the next anchor starts a new one.
SHARD_WORDS = 20_000
#: Stands for a null document id: after all others.
LAST = 2**63 - 1


class SuffixAutomaton:
    """Of several word sequences. Each state keeps the owner of the first sequence that has its words."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [0]

    def _state(self, length: int, link: int, owner: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.first.append(owner)
        return len(self.link) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state that p reaches by the word, with no longer words than p's and that one."""
        if self.length[q] == self.length[p] + 1:
            return q
        half = self._state(self.length[p] + 1, self.link[q], self.first[q], self.next[q].copy())
        self.link[q] = half
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = half
            p = self.link[p]
        return half

    def add(self, words: list[bytes], owner: int) -> None:
        last = 0
        for word in words:
            if (q := self.next[last].get(word)) is not None:
                last = self._split(last, word, q)
                continue
            new = self._state(self.length[last] + 1, 0, owner, {})
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word, self.next[p][word])
            last = new

    def first_owners(self, words: list[bytes], window: int) -> list[int | None]:
        """For each run of ``window`` words, the first owner of it, or None."""
        out: list[int | None] = []
        state, size = 0, 0
        edges, link, length = self.next, self.link, self.length
        for i, word in enumerate(words):
            while state and word not in edges[state]:
                state = link[state]
                size = length[state]
            if (to := edges[state].get(word)) is not None:
                state, size = to, size + 1
                if size > window or length[link[state]] >= window:
                    while length[link[state]] >= window:
                        state = link[state]
                    size = min(size, window)
            if i >= window - 1:
                out.append(self.first[state] if size >= window else None)
        return out


def _anchors(wh: np.ndarray, row: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows that lie in one row, the position of each one's anchor, hash of the k words at each position)."""
    grams = gram_hashes(wh, k)
    best = sliding_argmin(grams, window - k + 1)
    at = np.flatnonzero(row[: len(best)] == row[window - 1 : window - 1 + len(best)])
    return at, best[at], grams


def _anchor_keys(window: int, k: int):
    def extract(batch: pa.RecordBatch):
        keys = np.array(batch.column("k"), dtype=np.int64)
        for a, _b, raw, off in slices(batch.column("t")):
            start, end, row = scan(raw, off)
            if len(start) < window:
                continue
            at, best, grams = _anchors(hash_words(raw, start, end), row, window, k)
            if len(at):
                best = np.unique(best)
                yield grams[best], keys[a + row[best]]

    return extract


def _pieces(window: int, k: int):
    def run(batches):
        for batch in batches:
            keys, hashes, lists = (batch.column(c) for c in ("k", "th", "keys"))
            for a, b, raw, off in slices(batch.column("t")):
                start, end, row = scan(raw, off)
                if len(start) < window:
                    continue
                at, best, grams = _anchors(hash_words(raw, start, end), row, window, k)
                out: list[list] = [[], [], [], []]
                ends = np.searchsorted(row[at], np.arange(b - a + 1))
                for r in range(b - a):
                    i, j = ends[r], ends[r + 1]
                    if i == j:
                        continue
                    shared = np.array(lists[a + r].values, dtype=np.int64)
                    mine = best[i:j]
                    edge = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                    stop = np.r_[edge[1:], j - i]
                    keep = np.isin(cut_keys(grams[mine[edge]]), shared)
                    base = int(np.searchsorted(row, r))
                    for x, y in zip(edge[keep], stop[keep], strict=True):
                        u, v = at[i + x], at[i + y - 1] + window
                        out[0].append(a + r)
                        out[1].append(int(u) - base)
                        out[2].append(int(grams[mine[x]].view(np.int64)))
                        out[3].append(b" ".join(raw[start[u] : end[v - 1]].tobytes().split()))
                if out[0]:
                    rows = pa.array(out[0])
                    yield pa.RecordBatch.from_arrays([keys.take(rows), hashes.take(rows), pa.array(out[1], type=pa.int32()), pa.array(out[2], type=pa.int64()), pa.array(out[3], type=pa.binary())], names=["k", "th", "at", "anchor", "piece"])

    return run


#: Distinct pieces that a task holds before it hands them on.
HELD_PIECES = 100_000


def _distinct(window: int, k: int):
    """Pieces with the smallest document of the task that has each."""
    cut = _pieces(window, k)

    def run(batches):
        held: dict[tuple[int, bytes], int] = {}

        def out():
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in held], type=pa.int64()), pa.array([p for _, p in held], type=pa.binary()), pa.array(list(held.values()), type=pa.int64())], names=["anchor", "piece", "owner"])
            held.clear()

        for batch in cut(batches):
            for key, owner in zip(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True), batch.column(0).to_pylist(), strict=True):
                if held.get(key, LAST) >= owner:
                    held[key] = owner
            if len(held) > HELD_PIECES:
                yield from out()
        yield from out()

    return run


def _first_documents(window: int, most: int):
    def run(batches):
        auto, held, now = SuffixAutomaton(), 0, None
        seen: set[bytes] = set()
        for batch in batches:
            out: list[list] = [[], [], []]
            for anchor, mark, piece, owner in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if anchor != now:
                    if held > most:
                        auto, held = SuffixAutomaton(), 0
                    now = anchor
                    seen.clear()
                if piece in seen:  # other tasks have it too
                    continue
                seen.add(piece)
                words = piece.split(b" ")
                found = auto.first_owners(words, window)
                i, n = 0, len(found)
                while i < n:
                    if found[i] is not None:
                        i += 1
                        continue
                    j = i
                    while j < n and found[j] is None:
                        found[j] = owner
                        j += 1
                    auto.add(words[i : j + window - 1], owner)
                    held += j - i + window - 1
                    i = j
                out[0].append(anchor)
                out[1].append(mark)
                out[2].append(found)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], type=pa.int64()), pa.array(out[1], type=pa.int64()), pa.array(out[2], type=pa.list_(pa.int64()))], names=["anchor", "mark", "firsts"])

    return run


DEDUP = "struct<n_words:long,n_removed:long,kept:string>"


def _cut(at_text: int, name: str, window: int):
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches):
        for batch in batches:
            out = []
            for text, copy, covered in zip(batch.column(at_text), batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1), strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                n = len(words)
                if copy:
                    words = words if n < window else []
                elif covered.is_valid and len(covered.values):
                    gone = np.zeros(n + 1, dtype=np.int32)
                    starts = np.array(covered.values, dtype=np.int64)
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + window, -1)
                    words = [w for w, c in zip(words, np.cumsum(gone[:n]).tolist(), strict=True) if not c]
                out.append({"n_words": n, "n_removed": n - len(words), "kept": b" ".join(words)})
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, type=kind)], names=[*batch.schema.names[:-2], name])

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", name: str = "dedup", anchor: int = ANCHOR, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, str]:
    """The documents with a struct column added: words, removed words, and the kept words joined by one space.

    Also returns that column's name: ``name``, with underscores if the documents have it already. A window's word sequence
    counts as repeated if it also starts in a document with a smaller id, whether or not it is removed there. Null and
    empty texts, and texts shorter than a window, lose nothing. Null ids come after all others, as one document; rows that
    repeat an id are one document too and don't cover each other. An empty table gives an empty one.
    """
    shards = shard_count(docs)
    k, th, th2, covered, copy = (free_name(docs, x) for x in ("_k", "_th", "_th2", "_covered", "_copy"))
    name = free_name(docs, name)
    text = docs[text_col]
    marked = docs.withColumns({k: F.coalesce(docs[id_col].cast("long"), F.lit(LAST)), th: F.xxhash64(text), th2: F.xxhash64(F.lit(1), text)})
    # everything meets the texts on the id alone, so that they move once; hashes of the text are compared beside it
    base = marked.repartition(shards, k)
    same = lambda a, b: F.col(a).bitwiseXOR(F.col(b)) == 0
    firsts = marked.groupBy(th, th2).agg(F.min(k).alias("fk")).select("fk", F.col(th).alias("fh"), F.col(th2).alias("fh2"))
    lead = base.join(firsts, (F.col(k) == F.col("fk")) & same(th, "fh") & same(th2, "fh2"))
    # with all columns, so that Spark finds the same exchange of the documents here and at the end
    lead = lead.select(F.col(k).alias("k"), F.col(th).alias("th"), F.col(text_col).alias("t"), F.col(th2), *(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col))
    hits = shared_keys(lead, _anchor_keys(window, anchor), shards)
    hits = hits.repartition(shards, "owner").groupBy("owner").agg(F.collect_list("key").alias("keys"))
    found = lead.join(hits, F.col("k") == F.col("owner"))
    pieces = found.mapInArrow(lean(_pieces(window, anchor)), "k long, th long, at int, anchor long, piece binary").select("k", "th", "at", "anchor", F.xxhash64("piece").alias("mark"))
    distinct = found.mapInArrow(lean(_distinct(window, anchor)), "anchor long, piece binary, owner long")
    ordered = distinct.repartition(shards, "anchor").sortWithinPartitions("anchor", "owner", "piece").select("anchor", F.xxhash64("piece").alias("mark"), "piece", "owner")
    earliest = ordered.mapInArrow(lean(_first_documents(window, shard_words)), "anchor long, mark long, firsts array<long>")
    spots = pieces.join(earliest, ["anchor", "mark"]).where(F.exists("firsts", lambda x: x < F.col("k")))
    earlier = F.filter(F.transform("firsts", lambda x, i: F.when(x < F.col("k"), F.col("at") + i)), lambda x: x.isNotNull())
    spans = spots.select(F.col("k").alias("sk"), F.col("th").alias("sh"), earlier.alias("starts")).repartition(shards, "sk").groupBy("sk", "sh").agg(F.flatten(F.collect_list("starts")).alias(covered))
    told = base.join(firsts.withColumn(copy, F.lit(False)), (F.col(k) == F.col("fk")) & same(th, "fh") & same(th2, "fh2"), "left").drop("fk", "fh", "fh2")
    joined = told.join(spans, (F.col(k) == F.col("sk")) & same(th, "sh"), "left").select(*docs.columns, F.coalesce(copy, F.lit(True)).alias(copy), covered)
    schema = docs.limit(0).withColumn(name, F.lit(None).cast(DEDUP)).schema
    return joined.mapInArrow(lean(_cut(docs.columns.index(text_col), name, window)), schema), name
