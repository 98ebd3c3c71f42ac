"""Files of token ids: Huffman-coded segments in ascending document order.

``<folder>/codebook`` holds a row (id, bits) for each id that occurs; ``<folder>/segments`` holds rows
(part, seq, first, n_docs, n_tokens, data), written in ascending (part, seq) order; a part is a range of document ids, and
first counts the part's ids before it. Both are Parquet only as an envelope, so
any store that Spark writes to will do. ``data`` is the format itself, little-endian: magic ``TOK1``, u32 documents,
u64 ids, u32 blocks; i64 document ids; one u8 for each document, 1 where its id is null; u32 ids of each document; u64
bit offset of each block; code bits. A segment decodes with the codebook alone, and each block on its own.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import LibraryPairs, binaries, worker_coder
from .frames import lean
from .huffman import LIMIT, Codebook, code_lengths
from .textops import slices
from .workspace import new_folder, remove_folder

#: Ids after which a segment ends, with the document that reaches them; what a task holds.
SEGMENT = 1 << 20

_HEAD = "<4sIQI"
_STAGED = "k long, ids binary"
_SEGMENTS = "part int, seq int, first long, n_docs long, n_tokens long, data binary"


def cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each cell ends, from 0) of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def pack_segment(book: Codebook, keys: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    starts, data = book.encode(ids)
    return b"".join([struct.pack(_HEAD, b"TOK1", len(keys), len(ids), len(starts)), keys.astype("<i8").tobytes(), nulls.astype("u1").tobytes(), counts.astype("<u4").tobytes(), starts.astype("<u8").tobytes(), data])


def read_segment(book: Codebook, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, nulls, ids of each document, all ids)."""
    magic, docs, n, blocks = struct.unpack_from(_HEAD, data)
    if magic != b"TOK1":
        raise ValueError("not a token segment")
    at, out = struct.calcsize(_HEAD), []
    for kind, count in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u8", blocks)):
        out.append(np.frombuffer(data, dtype=kind, count=count, offset=at))
        at += out[-1].nbytes
    return out[0], out[1].astype(bool), out[2], book.decode(out[3], data[at:], n)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> None:
    """Encode every whole text, end it with ``end_id``, and write the ids under ``folder``.

    Null counts as the empty text (its end id only). Null ids come first; rows that repeat an id follow each other in the
    order of their ids' bytes. An empty table gives an empty codebook and no segments. Other columns don't take part,
    whatever their names. A text of any length is one row; a task holds the ids of one Arrow batch and one segment.

    Documents are encoded once, into a table of the shared folder, since the code needs the counts of all ids. Spark deals
    that table out by ranges of ids and sorts it, with its own spilling; the sorted rows are coded as they stream by.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        bytes_ = f.read()
    source = spark.sparkContext.broadcast(bytes_)  # a file of one vocabulary, whatever the corpus
    unit = 2 if max(end_id + 1, len(LibraryPairs(bytes_, 1).bytes_of)) <= 1 << 16 else 4
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = docs.select(docs[id_col].cast("long").alias("k"), docs[text_col].alias("t"))

    def encoded(batches):
        for batch in batches:
            coder = worker_coder(LibraryPairs, source.value)
            for a, b, raw, off in slices(batch.column(1)):
                ids, counts = coder.encode_bytes(raw, off)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(f"<u{unit}")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), binaries(ids.view(np.uint8), ids.itemsize * np.r_[0, ends + np.arange(1, b - a + 1)])], names=["k", "ids"])

    staged = new_folder(spark, "token-stage")
    docs.mapInArrow(lean(encoded), _STAGED).write.option("compression", "zstd").parquet(staged)
    held = spark.read.schema(_STAGED).parquet(staged)

    def counted(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            c = np.bincount(cells(batch.column(0))[0].view(f"<u{unit}"))
            total = np.pad(total, (0, max(0, len(c) - len(total))))
            total[: len(c)] += c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = held.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # at most a row for each id of the vocabulary
    weight = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, dtype=np.int64)
    weight[counts["id"].to_numpy(dtype=np.int64)] = counts["n"].to_numpy(dtype=np.int64)
    lengths = code_lengths(weight, limit)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, bits int").coalesce(1).write.parquet(f"{folder}/codebook")
    shipped = spark.sparkContext.broadcast(lengths)

    def segments(batches):
        book, part = Codebook(shipped.value), TaskContext.get().partitionId()
        seq = before = 0
        keys, nulls, counts, ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)

        def out(n):
            nonlocal keys, nulls, counts, ids, seq, before
            size = int(counts[:n].sum())
            data = pack_segment(book, keys[:n], nulls[:n], counts[:n], ids[:size])
            row = pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in ((part, pa.int32()), (seq, pa.int32()), (before, pa.int64()), (n, pa.int64()), (size, pa.int64()), (data, pa.binary()))], names=["part", "seq", "first", "n_docs", "n_tokens", "data"])
            keys, nulls, counts, ids, seq, before = keys[n:], nulls[n:], counts[n:], ids[size:], seq + 1, before + size
            return row

        for batch in batches:
            data, ends = cells(batch.column(1))
            keys = np.r_[keys, np.array(batch.column(0).fill_null(0), dtype=np.int64)]
            nulls = np.r_[nulls, np.array(batch.column(0).is_null())]
            counts = np.r_[counts, np.diff(ends) // unit]
            ids = np.r_[ids, data.view(f"<u{unit}")]
            while len(ids) >= SEGMENT:
                yield out(int(np.searchsorted(np.cumsum(counts), SEGMENT)) + 1)
        if len(keys):
            yield out(len(keys))

    ordered = held.repartitionByRange(parts, F.asc_nulls_first("k")).sortWithinPartitions(F.asc_nulls_first("k"), "ids")
    ordered.mapInArrow(lean(segments), _SEGMENTS).write.option("compression", "none").parquet(f"{folder}/segments")
    remove_folder(spark, staged)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start long, n_tokens long, ids binary: little-endian unsigned 32-bit) of each document, read from the files."""
    rows = spark.read.schema("id int, bits int").parquet(f"{folder}/codebook").collect()  # at most a row for each id of the vocabulary
    lengths = np.zeros(max([r.id for r in rows], default=0) + 1, dtype=np.uint8)
    for r in rows:
        lengths[r.id] = r.bits
    kept = spark.read.schema(_SEGMENTS).parquet(f"{folder}/segments")
    before, base = 0, {}
    for part, n in sorted(tuple(r) for r in kept.groupBy("part").agg(F.sum("n_tokens")).collect()):  # a row for each part, of which there are as many as shuffle partitions
        base[part] = before
        before += n
    shipped = spark.sparkContext.broadcast((lengths, base))

    def decoded(batches):
        lengths, base = shipped.value
        book, now, at = Codebook(lengths), None, 0
        for batch in batches:
            for part, start, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                keys, nulls, counts, ids = read_segment(book, data.as_py())
                ends = np.r_[0, np.cumsum(counts.astype(np.int64))]
                raw = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array(keys, mask=nulls), pa.array(base[part] + start + ends[:-1]), pa.array(counts, type=pa.int64()), binaries(raw.view(np.uint8), 4 * ends)], names=["doc_id", "start", "n_tokens", "ids"])

    return kept.select("part", "first", "data").mapInArrow(lean(decoded), "doc_id long, start long, n_tokens long, ids binary")


def checksums(decoded: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids' bytes."""
    return decoded.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

