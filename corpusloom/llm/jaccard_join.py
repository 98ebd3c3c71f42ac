"""N-gram Jaccard join: documents whose sets of 5-word shingles are at least 0.75 similar, and their components.

1. A global order puts rare shingles first: by how often the shingle is held (heavy ones last), then by how common its
   words are, then by hash. Two sets with similarity t share a shingle among the first n - ceil(t n) + 1 of either.
   The counts behind the order only make prefixes selective; any order finds every pair.
   With l more in each prefix they share l + 1. Here l grows with n, so sharing a passage isn't enough.
2. Documents with equal sets become one, and sets with equal prefixes and sizes one group.
3. ``shared_keys`` drops prefix shingles that one group holds alone, and then all groups that share too few.
4. All remaining groups that share a prefix shingle join the cluster of the smallest of them, but leave out those that hold
   too little of their prefix to matter, so every candidate pair of
   groups meets in a cluster, and a group of several sets has one of its own. Here groups are expanded to their sets.
   A cluster's size is summed first; a large one is cut into blocks, and pairs of blocks go to tasks.
5. A task groups its sets again by prefix and size, in its own rare-first order; pairs of groups that pass the prefix index and
   the size bound are expanded, and their members verified by exact intersections, but for pairs that links connect already.
6. Links are closed to components over the sets, and the documents of a set follow it.
7. For the number of links (``links=True``), all pairs of a component's sets are decided once more, exactly, in blocks. A core
   of shingles that most sets hold decides most pairs by two numbers each; only where sets lack or add the same shingles beside it are
   pairs looked at. A document has a link to each document of a similar set and to each other one of its own.

All links of a large group of near copies are as many as its square, so they are counted where they are found, not returned.

Shingles are compared by 64-bit hashes, within candidate pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import binaries
from .components import components
from .frames import free_name, lean
from .shared import shard_count, shared_keys
from .textops import gram_hashes, hash_words, mix64, scan, slices, take_rows
from .workspace import written

SHINGLE = 5
#: Similarity as a fraction, so that bounds are exact.
NUMERATOR, DENOMINATOR = 3, 4
#: Words and shingles that the global order knows to be common: fixed sizes of its tables.
COMMON_WORDS, HEAVY_SHINGLES = 1 << 16, 1 << 18
#: Shingles of a cluster's block, and of a component's when links are counted.
BLOCK_SHINGLES, COUNT_SHINGLES = 1 << 20, 1 << 19
#: Bits that say which texts' sets are wanted: a fixed size, so that with very many only less is spared.
BITS = 1 << 27
#: Sets up to which those of large components are sent to all tasks, 8 bytes each.
SENT = 1 << 20
LAST = 2**63 - 1

_U = np.uint64


def shingles(raw: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, word hashes' position) of every k-word shingle; a row with fewer words has one of them all."""
    start, end, row = scan(raw, off)
    words = hash_words(raw, start, end, lower=True)
    grams = gram_hashes(words, k)
    at = np.flatnonzero(row[: len(grams)] == row[k - 1 : k - 1 + len(grams)]) if len(grams) else np.zeros(0, dtype=np.int64)
    rows, hashes = [row[at]], [grams[at]]
    count = np.bincount(row, minlength=len(off) - 1)
    first = np.r_[0, np.cumsum(count)[:-1]]
    places = [at]
    for n in range(1, k):
        short = np.flatnonzero(count == n)
        if len(short):
            rows.append(short)
            own = np.stack([words[first[short] + t] for t in range(n)])
            hashes.append(np.array([gram_hashes(np.ascontiguousarray(own[:, i]), n)[0] for i in range(len(short))], dtype=_U) ^ _U(n))
            places.append(np.full(len(short), -1))
    return np.concatenate(rows), np.concatenate(hashes), np.concatenate(places), words


def distinct_sets(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by row and value, without repeats; and which input each is."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    keep = np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])] if len(r) else np.zeros(0, dtype=bool)
    return r[keep], v[keep], order[keep]


def digests(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, 64-bit digest) of the set of each of n rows; 0 for empty sets."""
    size = np.bincount(row, minlength=n)
    total = np.zeros(len(value) + 1, dtype=_U)
    np.cumsum(mix64(value), out=total[1:])
    ends = np.r_[0, np.cumsum(size)]
    return size, np.where(size > 0, mix64(total[ends[1:]] - total[ends[:-1]] + size.astype(_U)), _U(0))


def prefix_size(n: np.ndarray) -> np.ndarray:
    """How many of the first shingles of a set of n must hold one that any similar set holds among its first."""
    return n - -(-n * NUMERATOR // DENOMINATOR) + (n > 0)


def in_common(n):
    """How many shingles two similar sets share in their longer prefixes, the smaller of which has n. For arrays and columns."""
    return n // 10 if isinstance(n, np.ndarray) else F.floor(n / 10)


def long_prefix_size(n: np.ndarray) -> np.ndarray:
    return prefix_size(n) + np.maximum(in_common(n) - 1, 0)


def _frequencies(k: int):
    """Counts of common words (kind 0) and of shingles that several documents of a flush hold (kind 1)."""

    def flush(kind, parts, least):
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        keep = counts >= least
        return pa.RecordBatch.from_arrays([pa.array(np.full(int(keep.sum()), kind, dtype=np.int32)), pa.array(values[keep].view(np.int64)), pa.array(counts[keep])], names=["kind", "key", "n"])

    def run(batches):
        words, grams, held = [], [], 0
        for batch in batches:
            for _a, _b, raw, off in slices(batch.column(0)):
                row, value, _, w = shingles(raw, off, k)
                words.append(w)
                grams.append(distinct_sets(row, value)[1])
                held += len(w)
                if held >= 1 << 20:
                    yield flush(0, words, 8)
                    yield flush(1, grams, 4)
                    words, grams, held = [], [], 0
        if held:
            yield flush(0, words, 8)
            yield flush(1, grams, 4)

    return run


def _level(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """log2 of the table's count of each key; 0 where it has none."""
    known, level = table
    if not len(known):
        return np.zeros(len(keys), dtype=np.uint8)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, level[at], 0)


def _ordered(raw: np.ndarray, off: np.ndarray, k: int, tables) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(size and digest of each row's set, row and hash of each shingle in its long prefix)."""
    common, heavy = tables
    row, value, place, words = shingles(raw, off, k)
    usual = np.zeros(len(value), dtype=np.int64)
    level = _level(common, words).astype(np.int64)
    inside = place >= 0
    for t in range(k):
        usual[inside] += level[place[inside] + t]
    row, value, at = distinct_sets(row, value)
    size, digest = digests(row, value, len(off) - 1)
    rank = _level(heavy, value).astype(np.int64) * 1024 + usual[at]
    order = np.lexsort((value, rank, row))
    row, value = row[order], value[order]
    place = np.arange(len(row)) - np.r_[0, np.cumsum(size)][row]
    keep = place < long_prefix_size(size)[row]
    return size, digest, row[keep], value[keep]


def _group_names(size: np.ndarray, row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A digest of each row's prefix and size."""
    return mix64(digests(row, value, len(size))[1] + size.astype(_U) * _U(0x9E3779B97F4A7C15))


def _profile(k: int, tables):
    def run(batches):
        for batch in batches:
            for a, b, raw, off in slices(batch.column(2)):
                size, digest, row, value = _ordered(raw, off, k, tables.value)
                name = _group_names(size, row, value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(size, type=pa.int64()), pa.array(digest.view(np.int64)), pa.array(name.view(np.int64))], names=["k", "th", "n", "g", "p"])

    return run


def _prefixes(k: int, tables):
    def extract(batch: pa.RecordBatch):
        for _a, _b, raw, off in slices(batch.column(0)):
            size, _, row, value = _ordered(raw, off, k, tables.value)
            yield value, _group_names(size, row, value).view(np.int64)[row]

    return extract


def _bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """A bit for each remainder that a hash has by ``BITS``; the driver gets its words, of which there is a fixed number."""
    spot = F.pmod(F.col(column), F.lit(BITS))
    words = hashes.select(spot.alias("spot")).selectExpr("CAST(spot DIV 64 AS INT) AS word", "shiftleft(1L, CAST(spot % 64 AS INT)) AS bit").groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(BITS // 64, dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out.view(_U)


def _sets(k: int, bits):
    """(k, th, members) of the texts whose hash has its bit set."""

    def run(batches):
        for batch in batches:
            spot = np.array(batch.column(1), dtype=np.int64) % BITS
            wanted = (bits.value[spot // 64] >> (spot % 64).astype(_U)) & _U(1) > 0
            batch = batch.filter(pa.array(wanted))
            for a, b, raw, off in slices(batch.column(2)):
                row, value, _, _ = shingles(raw, off, k)
                row, value, _ = distinct_sets(row, value)
                ends = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), binaries(value.view(np.uint8), 8 * ends)], names=["k", "th", "members"])

    return run


class Links:
    """Union-find over a task's groups."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return int(x)

    def roots(self, x: np.ndarray) -> np.ndarray:
        y = self.up[x]
        while not np.array_equal(z := self.up[y], y):
            y = z
        return y


class TaskSets:
    """Sets of a task in ascending order of size, their shingles numbered rare first, and groups of equal prefix and size."""

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(s) for s in sets], dtype=np.int64)
        self.order = np.argsort(size, kind="stable")
        self.size = size = size[self.order]
        self.ends = np.r_[0, np.cumsum(size)]
        values, token = np.unique(np.concatenate([sets[i] for i in self.order]), return_inverse=True)
        self.width = len(values)
        rank = np.empty(self.width, dtype=np.int64)
        rank[np.argsort(np.bincount(token), kind="stable")] = np.arange(self.width)
        self.owner, token = np.repeat(np.arange(len(sets)), size), rank[token]
        self.token = token = token[np.lexsort((token, self.owner))]
        head = np.arange(len(token)) - self.ends[self.owner] < prefix_size(size)[self.owner]
        name = _group_names(size, self.owner[head], token[head].astype(_U))
        _, one, group = np.unique(name, return_index=True, return_inverse=True)
        # groups in the order of their first sets, so by size
        place = np.empty(len(one), dtype=np.int64)
        place[np.argsort(one)] = np.arange(len(one))
        self.group, self.one = place[group], np.sort(one)
        self.members = np.argsort(self.group, kind="stable")
        self.begin = np.r_[0, np.cumsum(np.bincount(self.group, minlength=len(one)))]
        head &= np.isin(self.owner, self.one, assume_unique=False) if len(one) < len(sets) else True
        by = np.lexsort((self.group[self.owner[head]], token[head]))
        self.posting = self.group[self.owner[head]][by]
        self.at = np.searchsorted(token[head][by], np.arange(self.width + 1))

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        """(a set, those before it that may be similar, likeliest first), by filtered pairs of groups."""
        size = self.size[self.one]
        for x, one in enumerate(self.one):
            head = self.token[self.ends[one] : self.ends[one] + prefix_size(size[x : x + 1])[0]]
            near = self.posting[take_rows(self.at[head], self.at[head + 1] - self.at[head])]
            near = near[(near < x) & (size[near] * DENOMINATOR >= size[x] * NUMERATOR)]
            near, often = np.unique(near, return_counts=True)
            near = near[np.argsort(-often, kind="stable")]
            others = self.members[take_rows(self.begin[near], self.begin[near + 1] - self.begin[near])]
            own = self.members[self.begin[x] : self.begin[x + 1]]
            for i, member in enumerate(own):
                yield int(member), np.r_[own[:i], others]


def connect(sets: list[np.ndarray], block: np.ndarray, crossing: bool) -> list[tuple[int, int]]:
    """Links between similar sets (with ``crossing``, of different blocks) that connect as all links would."""
    held = TaskSets(sets)
    size, ends, token, block = held.size, held.ends, held.token, block[held.order]
    marked = np.zeros(held.width, dtype=bool)
    links, out = Links(len(sets)), []
    for x, near in held.candidates():
        if crossing:
            near = near[block[near] != block[x]]
        if not len(near):
            continue
        mine = token[ends[x] : ends[x + 1]]
        marked[mine] = True
        step = 8
        while len(near):
            near = near[links.roots(near) != links.root(x)]
            part, near = near[:step], near[step:]
            step *= 4
            if not len(part):
                break
            inside = np.r_[0, np.cumsum(marked[token[take_rows(ends[part], size[part])]])]
            stop = np.cumsum(size[part])
            both = inside[stop] - inside[stop - size[part]]
            for y in part[both * DENOMINATOR >= (size[part] + size[x] - both) * NUMERATOR]:
                if (a := links.root(int(y))) != (b := links.root(x)):
                    links.up[max(a, b)] = min(a, b)
                    out.append((int(held.order[x]), int(held.order[y])))
        marked[mine] = False
    return out


def reach(sets: list[np.ndarray], block: np.ndarray, crossing: bool, copies: np.ndarray) -> np.ndarray:
    """How many documents the similar other sets (with ``crossing``, of the other block) of each set have.

    With a core of c shingles, of which x holds a(x) and lacks the others, two sets share a(x) + a(y) - c shingles and those
    that both lack or both have beside it. They are similar where 7 times that is 3 times the sum of their sizes or more.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    values, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    often = np.bincount(token)
    core = 2 * often > n
    c = int(core.sum())
    place = np.cumsum(core) - 1
    inside = core[token]
    held = np.zeros((n, c), dtype=bool)
    held[owner[inside], place[token[inside]]] = True
    total = NUMERATOR + DENOMINATOR
    pull = total * held.sum(axis=1) - NUMERATOR * size
    lacks, gap = np.nonzero(~held)
    # where sets differ from the core: those that differ alike overlap there
    mark = np.r_[np.flatnonzero(core)[gap], token[~inside]]
    who = np.r_[lacks, owner[~inside]]
    by = np.argsort(who, kind="stable")
    mark, who = mark[by], who[by]
    ends = np.r_[0, np.cumsum(np.bincount(who, minlength=n))]
    differ = np.diff(ends)
    by = np.argsort(mark, kind="stable")
    posting = who[by]
    at = np.searchsorted(mark[by], np.arange(len(values) + 1))
    out = np.zeros(n, dtype=np.int64)
    for side in np.unique(block) if crossing else [None]:
        mine, others = (np.flatnonzero(block == side), np.flatnonzero(block != side)) if crossing else (np.arange(n), np.arange(n))
        by = others[np.argsort(pull[others], kind="stable")]
        weight = np.r_[0, np.cumsum(copies[by])]
        good = np.searchsorted(pull[by], total * c - pull[mine])
        out[mine] += weight[-1] - weight[good]
        if not crossing:  # itself
            out[mine] -= np.where(2 * pull[mine] >= total * c, copies[mine], 0)
        for x, left in zip(mine, good, strict=True):
            need = total * c - pull[x]
            if not left or need - pull[by[left - 1]] > total * differ[x]:
                continue  # all are similar already, or none of the rest can be
            spots = mark[ends[x] : ends[x + 1]]
            near = posting[take_rows(at[spots], at[spots + 1] - at[spots])]
            both = np.bincount(near, minlength=n)
            near = np.flatnonzero(both)
            near = near[(pull[near] < need) & (total * both[near] >= need - pull[near])]
            near = near[block[near] != side] if crossing else near[near != x]
            out[x] += copies[near].sum()
    return out


def _by_block(make, columns: int):
    """Runs ``make`` over the rows of each (name, i, j) in turn; rows equal in set are taken once."""

    def run(batches):
        held: list[tuple] = []
        now = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(columns)), strict=True):
                if row[:3] != now:
                    if len(held) > 1:
                        yield from make(now, held)
                    held.clear()
                    now = row[:3]
                if not held or held[-1][0] != row[3]:  # rows equal in id and text
                    held.append(row[3:])
        if len(held) > 1:
            yield from make(now, held)

    return run


def _connected(now, held):
    g, block, ks, sets = zip(*held, strict=True)
    got = connect([np.frombuffer(s, dtype=_U) for s in sets], np.array(block), now[1] != now[2])
    if got:
        yield pa.RecordBatch.from_arrays([pa.array([c[x] for x in side], type=pa.int64()) for side in zip(*got, strict=True) for c in (ks, g)], names=["ak", "ag", "bk", "bg"])


def _counted(now, held):
    g, block, copies, sets = zip(*held, strict=True)
    reached = reach([np.frombuffer(s, dtype=_U) for s in sets], np.array(block), now[1] != now[2], np.array(copies))
    yield pa.RecordBatch.from_arrays([pa.array(g, type=pa.int64()), pa.array(reached)], names=["g", "n"])


def _dealt(sets: DataFrame, shards: int, run, schema: str) -> DataFrame:
    """Sets with columns name, blocks, block, g, x and members, as ``run`` wants them."""
    other = sets.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = other.select("name", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "g", "block", "x", "members")
    return rows.repartition(shards, "name", "i", "j").sortWithinPartitions("name", "i", "j", "g").mapInArrow(lean(_by_block(run, 7)), schema)


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, links: bool = False) -> DataFrame:
    """(doc_id, text_hash, n_shingles, group, component_id, n_links) for each row; n_links only with ``links``.

    text_hash is xxhash64 of the text. group is null for an empty set (null, empty or blank text), which is linked with
    nothing; component_id is then the row's own id. A null id counts as larger than all others, and a component with no
    other id has null. Rows that repeat an id stand for themselves. An empty table gives an empty one. Whole texts of any
    length take part; other columns don't, whatever their names.
    n_links is the number of other rows that are similar enough, of equal and of different texts.
    """
    shards = shard_count(docs)
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(LAST)).alias("k"), F.xxhash64(docs[text_col]).alias("th"), F.coalesce(docs[text_col], F.lit("")).alias("t"))
    counts = written(rows.select("t").mapInArrow(lean(_frequencies(k)), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "frequencies")

    def head(kind: int, least: int, most: int):
        top = counts.where((F.col("kind") == kind) & (F.col("n") >= least)).orderBy(F.desc("n"), "key").limit(most).toPandas()  # most: the table's fixed size
        key = top["key"].to_numpy(dtype=np.int64).view(_U)
        order = np.argsort(key)
        return key[order], np.minimum(np.log2(top["n"].to_numpy(dtype=np.float64)), 63).astype(np.uint8)[order]

    tables = spark.sparkContext.broadcast((head(0, 64, COMMON_WORDS), head(1, 8, HEAVY_SHINGLES)))
    profile = written(rows.mapInArrow(lean(_profile(k, tables)), "k long, th long, n long, g long, p long"), "profiles")
    sets = profile.where("n > 0").groupBy("g").agg(F.min(F.struct("k", "th")).alias("one"), F.first("n").alias("n"), F.first("p").alias("p"), F.count("*").alias("copies"))
    groups = sets.groupBy("p").agg(F.first("n").alias("n"), F.count("*").alias("sets"))
    hits = shared_keys(rows.select("t"), _prefixes(k, tables), shards).repartition(shards, "owner")
    # the smallest set that a set of n can be similar to has ceil(n * 3 / 4)
    smallest = F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)
    enough = F.col("held") >= F.greatest(F.lit(1), in_common(smallest))
    sizes = groups.select(F.col("p").alias("sp"), "n")
    able = hits.groupBy("owner").agg(F.count("*").alias("held")).join(sizes, F.col("owner") == F.col("sp")).where(enough).select(F.col("owner").alias("able"))
    near = hits.join(able, F.col("owner") == F.col("able")).select("owner", "key")
    # summed before it moves, as a third of all groups may hold a key
    pivots = near.groupBy("key").agg(F.min("owner").alias("pivot"), F.count("*").alias("held")).where("held > 1").select(F.col("key").alias("pkey"), "pivot")
    members = written(near.join(pivots, F.col("key") == F.col("pkey")).groupBy(F.col("owner").alias("p"), "pivot").agg(F.count("*").alias("held")), "members")
    # once more, over what the groups left share with each other. Two similar sets share m shingles of their prefixes, so each
    # may leave out its rarest clusters, those that hold up to half of m - 1 of its shingles, and they meet in another
    left_out = F.floor((F.greatest(F.lit(1), in_common(smallest)) - 1) / 2)
    still = members.groupBy("p").agg(F.sum("held").alias("held")).join(sizes, F.col("p") == F.col("sp")).where(enough).select("sp", left_out.alias("less"))
    upto = F.sum("held").over(W.partitionBy("p").orderBy("held", "pivot"))
    kept = members.join(still, F.col("p") == F.col("sp")).withColumn("upto", upto).where(F.col("upto") > F.col("less")).select("p", "pivot")
    alone = groups.where("sets > 1").select("p", F.col("p").alias("pivot"))
    met = kept.union(alone).distinct()
    sized = met.select(F.col("p").alias("mp"), "pivot").join(sets, F.col("mp") == F.col("p"))
    blocks = sized.groupBy("pivot").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"), F.count("*").alias("held")).where("held > 1")
    block = F.pmod(F.xxhash64("g"), F.col("blocks")).cast("int").alias("block")
    placed = sized.join(blocks, "pivot").select("g", "one", "copies", F.struct(F.col("pivot").alias("name"), "blocks", block).alias("place"))
    wanted = written(placed.groupBy("g", "one", "copies").agg(F.collect_set("place").alias("places")).select("g", "places", "copies", F.col("one.k").alias("wk"), F.col("one.th").alias("wth")), "wanted")
    bits = spark.sparkContext.broadcast(_bitmap(wanted, "wth"))
    own_sets = rows.select("k", "th", "t").mapInArrow(lean(_sets(k, bits)), "k long, th long, members binary")
    found = own_sets.join(wanted, (F.col("k") == F.col("wk")) & (F.col("th") == F.col("wth"))).select("members", F.length("members").alias("size"), "g", "k", "copies", "places")
    if links:
        found = written(found, "sets")
    dealt = _dealt(found.select("g", F.col("k").alias("x"), "members", F.explode("places").alias("place")).select("g", "x", "members", "place.*"), shards, _connected, "ak long, ag long, bk long, bg long")
    node = lambda c: F.struct(F.col(f"{c}k").alias("k"), F.col(f"{c}g").alias("g")).alias(c)
    # a set's smallest document names it, so the smallest name of a component is its smallest document
    roots = components(dealt.select(node("a"), node("b"))).select(F.col("node.g").alias("ng"), F.col("root.k").alias("low"), F.col("root.g").alias("top"))
    told = sets.select(F.col("g").alias("cg"), "copies", F.col("one.k").alias("first")).join(roots, F.col("cg") == F.col("ng"), "left")
    told = told.select("cg", F.coalesce("low", "first").alias("low"), F.coalesce("top", "cg").alias("grp"), "copies")
    if links:
        within = roots.select("ng", "top").union(roots.select(F.col("top").alias("ng"), "top").distinct())
        own = sets.select("g", "copies").join(within, F.col("g") == F.col("ng")).groupBy("top").agg(F.count("*").alias("held"), F.sum("copies").alias("all"))
        # two sets make one link; pairs of more are decided
        pairs = within.join(own.where("held = 2").select(F.col("top").alias("ptop"), "all"), F.col("top") == F.col("ptop")).select(F.col("ng").alias("rg"), "all")
        more = written(within.join(own.where("held > 2").select("top"), "top", "left_semi"), "large")
        more = F.broadcast(more) if more.count() <= SENT else more
        named = found.join(more, F.col("g") == F.col("ng")).select(F.col("top").alias("name"), "g", "members", "size", F.col("copies").alias("x"))
        blocks = named.groupBy("name").agg(F.ceil(F.sum("size") / F.lit(8 * COUNT_SHINGLES)).cast("int").alias("blocks")).withColumnRenamed("name", "bname")
        linked = _dealt(named.join(blocks, F.col("name") == F.col("bname")).select("name", "blocks", block, "g", "x", "members"), shards, _counted, "g long, n long")
        reached = linked.groupBy(F.col("g").alias("rg")).agg(F.sum("n").alias("reached"))
        # of a pair, "all" has the set's own copies too
        reached = pairs.select("rg", F.lit(0).cast("long").alias("reached"), "all").union(reached.select("rg", "reached", F.lit(None).cast("long").alias("all")))
        told = told.join(reached, F.col("cg") == F.col("rg"), "left").select("cg", "low", "grp", F.coalesce(F.col("all") - 1, F.col("copies") - 1 + F.coalesce("reached", F.lit(0))).alias("n_links"))
    told = written(told, "told")  # a row for each set; read as a table, so that Spark can split a hot set's documents
    done = profile.join(told, F.col("g") == F.col("cg"), "left")
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    out = done.select(known("k").alias("doc_id"), F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"), F.col("grp").alias("group"), F.when(F.col("grp").isNull(), known("k")).otherwise(known("low")).alias("component_id"), *([F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if links else []))
    return out


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those whose component has a smaller id; of rows equal in id and text, or null in id, one of a component.

    Rows without a word are in none and all stay. Null ids come last, of several the one with the smallest hash of its text
    stays. All columns are handed on, whatever their names; an empty table gives an empty one.
    """
    groups = jaccard_groups(docs, id_col, text_col).where(F.col("group").isNotNull())
    rows = groups.groupBy("group", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = rows.groupBy("group").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("k"), "text_hash", "n")).alias("one"))
    i, h, n = (free_name(docs, x) for x in ("_keep_id", "_keep_hash", "_keep_rows"))
    kept = first.select(F.when(F.col("one.k") != LAST, F.col("one.k")).alias(i), F.col("one.text_hash").alias(h), F.col("one.n").alias(n))
    same = docs[id_col].eqNullSafe(F.col(i)) & (F.xxhash64(docs[text_col]) == F.col(h))
    filled = F.coalesce(docs[text_col].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    met = docs.where(filled).join(kept, same)
    # only rows that repeat an id and a text move once more
    once = met.where(F.col(n) == 1).select(*docs.columns)
    again = met.where(F.col(n) > 1).dropDuplicates([i, h]).select(*docs.columns)
    return once.union(again).union(docs.where(~filled))
