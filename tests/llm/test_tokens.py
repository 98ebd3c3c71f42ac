"""BPE and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusloom.llm.bpe import BytePairs, LibraryPairs, encode_documents
from corpusloom.llm.huffman import Codebook, code_lengths
from corpusloom.llm.token_files import checksums, read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(2)
    odd = ["", " ", "  a  b\n c", " <|endoftext|> x<|endoftext|>", "a" * 5000, "'s it's \t\r\n  x", "՘ ࢏ \U000107bb", "日本語 テスト 😀 é", " \x85 x\x1cy", "​ a　b", "<|endof text|>", " x   y"]
    return odd + ["".join(rng.choice("abc ' \n\t1é😀st!'LLre") for _ in range(rng.randint(0, 300))) for _ in range(200)]


@pytest.mark.parametrize("kind", [BytePairs, LibraryPairs])
def test_ids_equal_the_library(library, kind):
    with open(PATH, "rb") as f:
        coder = kind(f.read())
    rows = texts()
    ids, counts = coder.encode(rows)
    ends = np.r_[0, np.cumsum(counts)]
    for i, want in enumerate(library.encode_batch(rows, add_special_tokens=False)):
        assert ids[ends[i] : ends[i + 1]].tolist() == want.ids, repr(rows[i])


def rows_for_spark():
    return [*enumerate(texts()), (None, "null id"), (None, None), (7, "again"), (7, "again"), (7, "b"), (900, None)]


def test_documents_round_trip(spark, library):
    rows = rows_for_spark()
    got = encode_documents(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int"), PATH).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), library.decode(ids, skip_special_tokens=False)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded) for r in got], key=key) == sorted(want, key=key)
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


@pytest.mark.parametrize(("n", "v", "limit"), [(0, 5, 20), (1, 1, 20), (100, 3, 20), (300_000, 50_257, 20), (5000, 300, 9)])
def test_huffman_round_trip(n, v, limit):
    ids = np.minimum(np.random.default_rng(n).zipf(1.2, size=n) - 1, v - 1).astype(np.uint32)
    lengths = code_lengths(np.bincount(ids, minlength=1), limit)
    assert lengths.max() <= limit and (n == 0 or sum(2.0 ** -lengths[lengths > 0].astype(float)) <= 1)
    starts, data = (book := Codebook(lengths)).encode(ids)
    assert (book.decode(starts, data, n) == ids).all()


def test_limited_lengths_are_optimal():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21])
    assert int((code_lengths(counts, 20) * counts).sum()) == 132
    best = min(sum(int(c) * b for c, b in zip(counts, bits, strict=True)) for bits in _kraft(8, 4))
    assert int((code_lengths(counts, 4).astype(int) * counts).sum()) == best


def _kraft(n, limit, left=1.0, most=None):
    most = limit if most is None else most
    if n == 0:
        yield ()
        return
    for b in range(1, most + 1):
        if 2.0**-b + (n - 1) * 2.0**-limit <= left + 1e-12:
            for rest in _kraft(n - 1, limit, left - 2.0**-b, b):
                yield (b, *rest)


def test_files_round_trip(spark, library, tmp_path):
    rows = rows_for_spark()
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), str(tmp_path / "f"), PATH, 2)
    got = checksums(read_token_files(spark, str(tmp_path / "f"))).collect()
    want, at = [], 0
    coded = [(i, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes()) for i, t in rows]
    for i, raw in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        want.append((i, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_files_of_an_empty_table(spark, tmp_path):
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "f"), PATH, 2)
    assert read_token_files(spark, str(tmp_path / "f")).collect() == []
