"""Byte-level BPE by backtracking over longest matches, and decoding through an offset table.

A text is cut at special tokens, and before each single space between two characters that are not white space. No
pre-token reaches across such a space, so a piece has the same ids wherever it stands. Pieces are found in the texts'
bytes with arrays, and the ids of short ones are remembered in a table of bounded size, keyed by their bytes; only
pieces that the table lacks are encoded. Inside a piece the vocabulary's pattern gives the pre-tokens. Each is encoded
so: an Aho-Corasick automaton
over the reversed vocabulary names the longest token that starts at each byte; the encoder takes it if the pair
that it makes with the token before survives the merges (a lazily filled pair table), else the next shorter
prefix that is a token, else it drops the token before and marks the position as dead. No position is tried
twice, so the work is linear in the text.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Iterable
from hashlib import sha256
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .frames import lean
from .textops import mix64, slices, take_rows

#: Pieces that a worker remembers: about 70 bytes each.
REMEMBERED = 1 << 20
#: Bytes of a piece that is remembered, in words of 8.
KEY_WORDS = 3
#: Pre-tokens and pairs of tokens that an encoder remembers beside them.
WORDS, PAIRS = 1 << 17, 1 << 17
#: Bytes of new pieces that are encoded as one text.
JOINED = 1 << 17

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Here the pattern means the same to every Unicode version in use; other characters are cut by the tokenizers library.
_STEADY = regex.compile(r"[\x00-ͷЀ-ԯḀ-ỿ -⁤₠-₿←-⇿─-◿ぁ-ゖァ-ヺ一-龥가-힣]*")

_U = np.uint64
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: First bytes of characters that may be white space beyond ASCII.
_MAY_BE_WHITE = np.zeros(256, dtype=bool)
_MAY_BE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=_U)


def ends_white(raw: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the character before each end is, or may be, white space."""
    last = raw[end - 1]
    return _WHITE[last] | (last >= 0x80) & ((raw[np.maximum(end - 2, 0)] == 0xC2) | _MAY_BE_WHITE[raw[np.maximum(end - 3, 0)]])


def cut_pieces(raw: np.ndarray, off: np.ndarray, more: Iterable[int] = ()) -> np.ndarray:
    """Where pieces begin: at each row, before single spaces between other characters, and at ``more`` places."""
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[off] = True
    at = np.flatnonzero(raw == 0x20)
    at = at[~edge[at] & ~edge[at + 1]]
    after = raw[at + 1]
    at = at[~_WHITE[after] & ~_MAY_BE_WHITE[after] & ~ends_white(raw, at)]
    edge[at] = True
    edge[list(more)] = True
    edge[-1] = False
    return np.flatnonzero(edge)


class PieceTable:
    """Ids of short pieces by their bytes: open addressing in arrays, exact keys, of bounded size."""

    def __init__(self, most: int):
        self.most, self.n, self.n_ids = most, 0, 0
        self.keys = np.zeros((KEY_WORDS, 1 << 10), dtype=_U)
        self.first, self.count = np.zeros(1 << 10, dtype=np.int32), np.zeros(1 << 10, dtype=np.uint8)
        self.ids = np.zeros(1 << 12, dtype=np.uint32)
        self.slots = np.full(1 << 11, -1, dtype=np.int32)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys[0] * _U(0x9E3779B97F4A7C15)
        for w in range(1, KEY_WORDS):
            mixed = (mixed ^ keys[w]) * _U(0xD6E8FEB86659FD93)
        return (mix64(mixed) & _U(len(self.slots) - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1."""
        out = np.full(keys.shape[1], -1, dtype=np.int64)
        at, left = self._home(keys), np.arange(keys.shape[1])
        while len(left):
            entry = self.slots[at]
            same = entry >= 0
            for w in range(KEY_WORDS):
                same &= self.keys[w][entry] == keys[w]
            out[left[same]] = entry[same]
            more = ~same & (entry >= 0)
            left, keys, at = left[more], keys[:, more], (at[more] + 1) & (len(self.slots) - 1)
        return out

    def _place(self, entries: np.ndarray) -> None:
        at = self._home(self.keys[:, entries])
        while len(entries):
            free = self.slots[at] < 0
            self.slots[at[free]] = entries[free]
            lost = self.slots[at] != entries
            entries, at = entries[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def lend(self, ids: np.ndarray) -> int:
        """Where these ids now stand, behind those that are kept; until the next call."""
        need = self.n_ids + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.n_ids], np.zeros(need * 3 // 2 - self.n_ids, dtype=np.uint32)])
        self.ids[self.n_ids : need] = ids
        return self.n_ids

    def keep(self, keys: np.ndarray, count: np.ndarray) -> None:
        """Keep new keys whose ids were lent first, in this order, as far as there is room."""
        m = min(keys.shape[1], self.most - self.n)
        if m <= 0:
            return
        a, b = self.n, self.n + m
        if b > len(self.count):
            size = min(self.most, max(b, 2 * len(self.count)))
            grown = np.zeros((KEY_WORDS, size), dtype=_U)
            grown[:, :a] = self.keys[:, :a]
            self.keys, self.first, self.count = grown, np.resize(self.first, size), np.resize(self.count, size)
        self.keys[:, a:b], self.count[a:b] = keys[:, :m], count[:m]
        ends = np.cumsum(count[:m])
        self.first[a:b] = self.n_ids + ends - count[:m]
        self.n, self.n_ids = b, self.n_ids + int(ends[-1])
        if 2 * b > len(self.slots):
            self.slots = np.full(1 << (2 * b).bit_length(), -1, dtype=np.int32)
            self._place(np.arange(b))
        else:
            self._place(np.arange(a, b))


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def take(blob: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges blob[start : start + size], one after the other."""
    size = size.astype(np.int64)
    shift = start - np.r_[0, np.cumsum(size)[:-1]] if len(size) else start
    return blob[np.repeat(shift, size) + np.arange(int(size.sum()))]


class BytePairs:
    """Encoder and decoder of one vocabulary file in the tokenizers library's JSON form."""

    def __init__(self, source: bytes, remembered: int = REMEMBERED):
        spec = json.loads(source)
        letter = {c: b for b, c in enumerate(byte_letters())}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.pieces: list[bytes] = [b""] * size
        for word, i in vocab.items():
            if all(c in letter for c in word):
                self.pieces[i] = bytes(letter[c] for c in word)
            else:
                self.pieces[i] = word.encode()
        for word, i in self.special.items():
            self.pieces[i] = word.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: rank of a token: of the merge that makes it; bytes come before all merges
        self.rank = [-1] * size
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for k, (a, b) in enumerate(merges):
            made = vocab[a + b]
            self.merged[vocab[a], vocab[b]] = made
            if made not in self.halves:
                self.halves[made] = vocab[a], vocab[b]
                self.rank[made] = k
        plain = {self.pieces[i]: i for i in vocab.values() if i not in self.special.values()}
        automaton = ahocorasick.Automaton()
        for piece, i in plain.items():
            automaton.add_word(piece[::-1].decode("latin-1"), i)
        automaton.make_automaton()
        self.automaton = automaton
        #: the longest proper prefix of a token that is a token
        self.shorter = [-1] * size
        for piece, i in plain.items():
            for n in range(len(piece) - 1, 0, -1):
                if (j := plain.get(piece[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.size = [len(p) for p in self.pieces]
        self.fits: dict[tuple[int, int], bool] = {}
        self.cut = regex.compile(PATTERN)
        self.blob = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)
        self.length = np.array(self.size, dtype=np.int64)
        self.offset = np.r_[0, np.cumsum(self.length)[:-1]]
        numerals = [b"%d," % i for i in range(size)]
        self.digits = np.array([len(x) for x in numerals], dtype=np.int64)
        self.numerals, self.numeral_at = np.frombuffer(b"".join(numerals), dtype=np.uint8), np.r_[0, np.cumsum(self.digits)[:-1]]
        self.words: dict[str, list[int]] = {}
        self._outside = None
        self._source = source
        self.bytes_of = self.length
        self.remember(remembered)

    def remember(self, most: int) -> None:
        """Begin a table of at most so many pieces."""
        self.known = PieceTable(most)
        names = sorted((x.encode() for x in self.special), key=len, reverse=True)
        self.at_special = regex.compile(b"|".join(map(regex.escape, names))) if names else None
        self.special_bytes = {x.encode(): i for x, i in self.special.items()}

    def pair_fits(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens apart when they stand side by side.

        Undo merges from the boundary outwards, the latest first. The pair breaks up if the two parts that face each
        other ever merge before one of the merges undone so far.
        """
        if (known := self.fits.get((left, right))) is not None:
            return known
        rank, merged, halves = self.rank, self.merged, self.halves
        a, b, bound, good = left, right, len(rank) * 2 + 2, True
        # doubled ranks: a merge of equal rank comes first on the left side
        while True:
            both = merged.get((a, b))
            if both is not None and 2 * rank[both] < bound:
                good = False
                break
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                bound, a = 2 * ra, halves[a][1]
            else:
                bound, b = 2 * rb + 1, halves[b][0]
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        self.fits[left, right] = good
        return good

    def encode_word(self, word: bytes) -> list[int]:
        n = len(word)
        longest = [0] * n
        seen = -1
        for end, token in self.automaton.iter(word[::-1].decode("latin-1")):
            if end != seen:  # the longest of those that end here comes first
                longest[n - 1 - end] = token
                seen = end
        if self.size[longest[0]] == n:
            return [longest[0]]
        size, shorter, fits, known = self.size, self.shorter, self.pair_fits, self.fits
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + size[token]
            good = alive[end]
            if good and out:
                good = known.get((out[-1], token))
                if good is None:
                    good = fits(out[-1], token)
            if good:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                alive[at] = 0
                token = out.pop()
                at -= size[token]

    def _pretokens(self, piece: str) -> Iterable[str]:
        if _STEADY.fullmatch(piece):
            return self.cut.findall(piece)
        if self._outside is None:
            from tokenizers import Tokenizer

            self._outside = Tokenizer.from_str(self._source.decode()).pre_tokenizer
        return [piece[a:b] for _, (a, b) in self._outside.pre_tokenize_str(piece)]

    def ids_of(self, words: Iterable[str]) -> list[int]:
        ids: list[int] = []
        for word in words:
            if (known := self.words.get(word)) is None:
                known = self.encode_word(word.encode())
                if len(self.words) < WORDS:
                    self.words[word] = known
            ids += known
        return ids

    def ids_joined(self, text: str) -> list[int]:
        """Ids of pieces in a row."""
        return self.ids_of(self.cut.findall(text) if _STEADY.fullmatch(text) else self._pretokens(text))

    def ids_alone(self, pieces: list[str]) -> list[list[int]]:
        return [self.ids_of(self._pretokens(p)) for p in pieces]

    def learn(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many are each piece's) of pieces of ``raw``. Those that begin with their space and don't end with white
        space are encoded many in a text, and its ids cut where the pieces' bytes end."""
        second = raw[np.minimum(start + 1, len(raw) - 1)]
        joined = (size > 1) & (raw[start] == 0x20) & ~_WHITE[second] & ~_MAY_BE_WHITE[second] & ~ends_white(raw, start + size)
        got: list[np.ndarray] = []
        which: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        alone = np.flatnonzero(~joined)
        joined = np.flatnonzero(joined)
        group = np.cumsum(size[joined]) // JOINED
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(joined) else np.zeros(1, dtype=np.int64)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            part = joined[a:b]
            ids = np.array(self.ids_joined(raw[take_rows(start[part], size[part])].tobytes().decode()), dtype=np.uint32)
            upto, ends = np.cumsum(self.bytes_of[ids]), np.cumsum(size[part])
            cut = np.searchsorted(upto, ends)
            if len(ids) and cut[-1] == len(ids) - 1 and (upto[cut] == ends).all():
                got.append(ids)
                which.append(part)
                counts.append(np.diff(cut + 1, prepend=0))
            else:  # a special token that begins with a space
                alone = np.r_[alone, part]
        if len(alone):
            texts = [raw[a : a + n].tobytes() for a, n in zip(start[alone], size[alone], strict=True)]
            plain = [t for t in texts if t not in self.special_bytes]
            plain = iter(self.ids_alone([t.decode() for t in plain]))
            own = [[self.special_bytes[t]] if t in self.special_bytes else next(plain) for t in texts]
            got.append(np.fromiter(chain.from_iterable(own), dtype=np.uint32))
            which.append(alone)
            counts.append(np.array([len(x) for x in own], dtype=np.int64))
        order, count = np.concatenate(which), np.concatenate(counts)
        flat = np.concatenate(got)
        at = np.argsort(order)
        return flat[take_rows((np.cumsum(count) - count)[at], count[at])], count[at]

    def encode_bytes(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, ids in each row) of the texts that stand between the offsets."""
        more: list[int] = []
        if self.at_special and self.at_special.search(whole := raw.tobytes()):
            more = [x for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True) for m in self.at_special.finditer(whole, a, b) for x in m.span()]
        start = cut_pieces(raw, off, more)
        size = np.diff(np.r_[start, len(raw)])
        padded = np.r_[raw, np.zeros(8 * KEY_WORDS, dtype=np.uint8)]
        eights = np.ndarray((len(raw) + 8 * KEY_WORDS - 7,), dtype="<u8", buffer=padded, strides=(1,))
        keys = np.stack([eights[start + 8 * w] & _MASKS[np.clip(size - 8 * w, 0, 8)] for w in range(KEY_WORDS)])
        short = size <= 8 * KEY_WORDS
        nil = np.flatnonzero(raw == 0)
        if len(nil):  # they don't show in a key
            short[np.searchsorted(start, nil, side="right") - 1] = False
        entry = np.full(len(start), -1, dtype=np.int64)
        entry[short] = self.known.find(keys[:, short])
        first, count = self.known.first[entry].astype(np.int64), self.known.count[entry].astype(np.int64)
        new = np.flatnonzero(entry < 0)
        if len(new):
            brief = new[short[new]]
            brief = brief[np.lexsort(keys[:, brief])]
            change = np.r_[True, (keys[:, brief[1:]] != keys[:, brief[:-1]]).any(axis=0)] if len(brief) else np.zeros(0, dtype=bool)
            long = new[~short[new]]
            names: dict[bytes, int] = {}
            same = [names.setdefault(raw[a : a + n].tobytes(), len(names)) for a, n in zip(start[long], size[long], strict=True)]
            _, of_long = np.unique(np.array(same, dtype=np.int64), return_index=True)
            one = np.r_[brief[change], long[of_long]]
            ids, n = self.learn(raw, start[one], size[one])
            at = self.known.lend(ids) + np.cumsum(n) - n
            number = np.r_[np.cumsum(change) - 1, int(change.sum()) + np.array(same, dtype=np.int64)].astype(np.int64)
            every = np.r_[brief, long]
            first[every], count[every] = at[number], n[number]
        out = self.known.ids[take_rows(first, count)]
        if len(new):
            self.known.keep(keys[:, brief[change]], n[: int(change.sum())])
        ends = np.r_[0, np.cumsum(count)]
        return out, np.diff(ends[np.searchsorted(start, off)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids in each text)."""
        got = [self.encode_bytes(raw, off) for _, _, raw, off in slices(pa.array(texts, type=pa.string()))]
        return (np.concatenate([x[i] for x in got]) for i in (0, 1)) if got else (np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids' pieces. As text, decode them with errors="replace"."""
        return take(self.blob, self.offset[ids], self.length[ids]).tobytes()

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, each with a comma behind it."""
        return take(self.numerals, self.numeral_at[ids], self.digits[ids]).tobytes()


class LibraryPairs(BytePairs):
    """The same cuts and bookkeeping, with the tokenizers library in place of the backtracking encoder."""

    def __init__(self, source: bytes, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already take all cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.library.model._resize_cache(0)  # it remembers pre-tokens, but each piece comes here once
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        letter = set(byte_letters())
        vocab = self.library.get_vocab()
        self.bytes_of = np.zeros(1 + max(vocab.values()), dtype=np.int64)
        for word, i in vocab.items():
            self.bytes_of[i] = len(word) if letter.issuperset(word) else len(word.encode())
        self.remember(remembered)

    def ids_joined(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def ids_alone(self, pieces: list[str]) -> list[list[int]]:
        return [got.ids for got in self.library.encode_batch_fast(pieces, add_special_tokens=False)]


def worker_coder(kind: type, source: bytes, remembered: int = REMEMBERED):
    """The coder of this worker process, which keeps its bounded table of pieces from one task to the next."""
    kept = sys.__dict__.setdefault("_corpusloom_coders", {})
    key = kind.__name__, sha256(source).hexdigest(), remembered
    if key not in kept:
        kept.clear()
        kept[key] = kind(source, remembered)
    return kept[key]


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The stretches of ``data`` (bytes) between these ends, as binary cells."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype("<i8").tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """(id, ids binary: little-endian unsigned 32-bit, n_tokens long, ids_sha256 string, decoded string) of every row.

    ids_sha256 is of the decimal ids joined by commas.

    Null counts as the empty text, which has no ids and decodes to "". Repeated rows give repeated results, a null
    id stays null, an empty table gives an empty one. Other columns of ``docs`` don't take part.
    """
    with open(vocabulary, "rb") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())  # a file of one vocabulary, whatever the corpus

    def run(batches):
        for batch in batches:
            coder = worker_coder(BytePairs, source.value, remembered)
            keys = batch.column(0)
            for a, b, text, off in slices(batch.column(1)):
                ids, counts = coder.encode_bytes(text, off)
                ends = np.r_[0, np.cumsum(counts)]
                raw, whole, decimal = ids.astype("<u4"), coder.decode(ids), coder.decimal(ids)
                size = np.r_[0, np.cumsum(coder.length[ids])][ends]
                digits = np.r_[0, np.cumsum(coder.digits[ids])][ends]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(a, b - a),
                        binaries(raw, 4 * ends),
                        pa.array(counts, type=pa.int64()),
                        pa.array([sha256(decimal[i : max(i, j - 1)]).hexdigest() for i, j in zip(digits, digits[1:], strict=False)], type=pa.string()),
                        pa.array([whole[i:j].decode("utf-8", "replace") for i, j in zip(size, size[1:], strict=False)], type=pa.string()),
                    ],
                    names=["id", "ids", "n_tokens", "ids_sha256", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(lean(run), f"id {kind}, ids binary, n_tokens long, ids_sha256 string, decoded string").withColumnRenamed("id", id_col)
