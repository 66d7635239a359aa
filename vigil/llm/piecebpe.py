"""SentencePiece encoding and decoding, for BPE models that leave characters as they are.

The words of a batch that a task has not met yet are encoded together.  Their symbols lie in one flat array.  In each
round every word finds the lowest rank among its neighbouring pairs (a segmented minimum) and merges all places of that
rank from the left; the array is then compacted, and words without a pair leave it, until none remains.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._common import without
from ._text import batches_by_bytes
from .bpe import _Numbers

#: The letter that stands for a space in pieces.
MARK = "▁"
#: Bytes of texts taken together and above which a text is cut; characters of the words that a task remembers; texts looked at together.
BATCH_BYTES, PIECE_BYTES, CACHE_CHARS, TEXTS = 1_000_000, 500_000, 4_000_000, 2000
#: Spaces with what follows them.  No piece reaches from a letter to a space behind it, so these are encoded one by one.
_WORD = regex.compile(" ( *[^ ]*)")
_GAP = regex.compile("(?<=[^ ])(?= )")
_NONE = np.int64(1) << 30
#: Places of one rank in a word above which a round for each would take too long; see one_by_one.
QUEUE = 16
#: Letters of a word above which it is cut where no piece reaches over; letters whose pairs have a table of their own.
LONG, FEW = 64, 512
#: Kinds of pieces, and field numbers, in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message: integers, or the bytes of anything else."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = buf[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(buf):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, buf[at : at + size]
            at += size


class PieceBPE:
    """A SentencePiece BPE model from its file.  Models that change characters, or that join over spaces, are refused."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(fields(f.read()))
        pieces = [dict(fields(v)) for k, v in model if k == 1]
        trainer, normal = (dict(next((fields(v) for k, v in model if k == part), ())) for part in (2, 3))
        names = [p[1].decode() for p in pieces]
        kinds = [p.get(3, NORMAL) for p in pieces]
        scores = np.array([struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces])
        plain = trainer.get(3) == 2 and not trainer.get(24) and not normal.get(2) and normal.get(3, 1) and not normal.get(4, 1) and normal.get(5, 1)
        if not plain or {USER_DEFINED, UNUSED} & set(kinds) or kinds.count(BYTE) != 256 or any(MARK in n.lstrip(MARK) for n, k in zip(names, kinds) if k == NORMAL):
            raise ValueError("only BPE models with bytes for unknown characters, words that begin with a mark, and no changes of characters are known here")
        symbol = {n: i for i, n in enumerate(names) if kinds[i] == NORMAL}
        letters = sorted(set("".join(symbol)))
        lone = [c for c in letters if c not in symbol]  # in pieces only, and no piece themselves
        self.n, self.base = len(names), np.int64(len(names) + len(lone))
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        every = symbol | {c: self.n + i for i, c in enumerate(lone)}
        cuts = [(every[z[:k]], every[z[k:]], i) for z, i in symbol.items() for k in range(1, len(z)) if z[:k] in every and z[k:] in every]
        left, right, merged = np.array(cuts, np.int64).reshape(-1, 3).T
        order = np.argsort(left * self.base + right)
        self.keys, self.merged = (left * self.base + right)[order], merged[order]
        self.ranks = rank[self.merged]
        #: Pieces of which a longer piece has a rank as good or better: one such merge can go before others of its own rank.
        self.early = np.zeros(int(self.base), bool)
        for part in (left, right):
            own = part[part < self.n]
            better = rank[merged[part < self.n]] <= rank[own]
            self.early[own[better & (np.fromiter((len(names[i]) > 1 for i in own), bool, len(own)))]] = True
        self.letters = np.full(0x110000, -1, np.int32)
        self.letters[[ord(c) for c in letters]] = [every[c] for c in letters]
        first = self.letters[:FEW].astype(np.int64)
        self.first_rank, self.first_at = (x.astype(np.int32) for x in self.pair(np.repeat(first, FEW), np.tile(first, FEW), np.ones(FEW * FEW, bool)))
        inner = np.unique([ord(a) << 32 | ord(b) for z in symbol for a, b in itertools.pairwise(z)])
        self.inner = inner.astype(np.int64)  # neighbouring letters that some piece holds; nothing joins others
        by_value = {int(names[i][3:5], 16): i for i in range(self.n) if kinds[i] == BYTE}
        self.bytes = np.array([by_value[b] for b in range(256)], np.int64)
        surface = trainer.get(44, " ⁇ ".encode())
        self.surface = [surface if k == UNKNOWN else b"" if k == CONTROL else bytes([int(n[3:5], 16)]) if k == BYTE else n.replace(MARK, " ").encode() for n, k in zip(names, kinds)]
        self.forget()

    def forget(self) -> None:
        """Begins the numbers of known words, and their ids, anew."""
        self.numbers, self.ids, self.chars = _Numbers(), [], 0

    def pair(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the table) of each pair; no rank where nothing is merged, for unknown letters, or between two words."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(same & (left >= 0) & (right >= 0) & (self.keys[at] == key), self.ranks[at], _NONE), at

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The packed ids of each word, in which MARK stands for spaces; all words go through the merge rounds together."""
        if not words:
            return []
        text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        begins = np.cumsum([0, *map(len, words)])
        sizes = np.diff(begins)
        sym = self.letters[text].astype(np.int64)
        fresh = np.zeros(len(text), bool)
        fresh[begins[:-1]] = True
        long = np.flatnonzero(np.repeat(sizes > LONG, sizes)[1:])
        fresh[1 + long] |= ~np.isin(text[long].astype(np.int64) << 32 | text[long + 1], self.inner)
        part, place = np.cumsum(fresh), np.arange(len(text))
        rank, at = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)
        table = text[:-1].astype(np.int64) * FEW + text[1:]
        few = (text[:-1] < FEW) & (text[1:] < FEW)
        cell = table[few]
        rank[:-1][few], at[:-1][few] = self.first_rank[cell], self.first_at[cell]
        rest = np.flatnonzero(~few)
        rank[rest], at[rest] = self.pair(sym[rest], sym[rest + 1], np.ones(len(rest), bool))
        rank[:-1][fresh[1:]] = _NONE
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            lengths = np.diff(np.r_[starts, len(sym)])
            least = np.minimum.reduceat(rank, starts)
            hits = rank == np.repeat(least, lengths)
            count = np.add.reduceat(hits, starts, dtype=np.int64)
            # where a merge can make a pair of as good a rank, only the first place may be merged now
            wait = (count > 1) & (least < _NONE) & np.logical_or.reduceat(hits & self.early[self.merged[at]], starts)
            if wait.any():
                found = np.flatnonzero(hits)
                later = np.r_[False, part[found[1:]] == part[found[:-1]]]
                hits[found[later & np.repeat(wait, lengths)[found]]] = False
            one = wait & (count > QUEUE)
            for i in np.flatnonzero(one):
                own = slice(starts[i], starts[i] + lengths[i])
                kept, ids = self.one_by_one(sym[own])
                done.append((place[own][kept], ids))
            if ((out := least == _NONE) | one).any():
                over, gone = np.repeat(out, lengths), np.repeat(out | one, lengths)
                done.append((place[over], sym[over]))
                sym, part, place, rank, at, hits = (x[~gone] for x in (sym, part, place, rank, at, hits))
            places = np.flatnonzero(hits)
            # places side by side share a symbol: every other one from the left counts
            run = np.r_[True, np.diff(places) != 1][: len(places)]
            offset = np.arange(len(places)) - np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
            places = places[offset % 2 == 0]
            sym[places] = self.merged[at[places]]
            keep = np.ones(len(sym), bool)
            keep[places + 1] = False
            sym, part, place, rank, at = (x[keep] for x in (sym, part, place, rank, at))
            now = places - np.arange(len(places))
            changed = np.r_[now, now[now > 0] - 1]
            behind = np.minimum(changed + 1, len(sym) - 1)
            rank[changed], at[changed] = self.pair(sym[changed], sym[behind], (part[changed] == part[behind]) & (changed != behind)) if len(sym) else (rank, at)
        where, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(where)
        where, ids = where[order], ids[order]
        # a letter that is no piece gives its bytes
        odd = np.flatnonzero((ids < 0) | (ids >= self.n))
        if len(odd):
            raw = [self.bytes[list(chr(c).encode())] for c in text[where[odd]]]
            sizes = np.ones(len(ids), np.int64)
            sizes[odd] = list(map(len, raw))
            where, ids, first = np.repeat(where, sizes), np.repeat(ids, sizes), np.cumsum(sizes) - sizes
            for i, r in zip(first[odd], raw):
                ids[i : i + len(r)] = r
        packed = ids.astype("<u4").tobytes()
        ends = 4 * np.searchsorted(where, begins)
        return [packed[a:b] for a, b in itertools.pairwise(ends.tolist())]

    def one_by_one(self, sym: np.ndarray) -> tuple[list[int], np.ndarray]:
        """(places, ids) of what remains of one word, merged in strict order of rank and place.

        For words with many places of a rank that cannot be merged at once, such as long runs of spaces: a queue does in
        n log n what rounds would do in n * n.
        """
        s, n = sym.tolist(), len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            pairs = [(i, after[i]) for i in lefts if i >= 0 and after[i] < n]
            if pairs:
                a, b = (np.array([s[p[k]] for p in pairs]) for k in (0, 1))
                rank, at = self.pair(a, b, np.ones(len(pairs), bool))
                for (i, j), r, m in zip(pairs, rank.tolist(), self.merged[at].tolist()):
                    if r < _NONE:
                        heapq.heappush(heap, (r, i, s[i], s[j], m))

        offer(list(range(n - 1)))
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if j >= n or s[i] != a or s[j] != b:  # one of the two has been merged since
                continue
            s[i], s[j], after[i] = m, -2, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer([before[i], i])
        kept = [i for i in range(n) if s[i] != -2]
        return kept, np.array([s[i] for i in kept], np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers, without begin and end."""
        out: list[list[bytes]] = [[] for _ in texts]
        for batch in batches_by_bytes([" " + t.replace(MARK, " ") if t else "" for t in texts], BATCH_BYTES, PIECE_BYTES, _GAP):
            if self.chars > CACHE_CHARS:
                self.forget()
            look = self.numbers.__getitem__
            # words go without the space in front; further spaces in front stay
            found = [list(map(look, piece[1:].split(" ") if piece and "  " not in piece and piece[-1] != " " else _WORD.findall(piece))) for _, piece in batch]
            new, self.numbers.fresh = self.numbers.fresh, []
            self.chars += sum(map(len, new))
            self.ids += self.encode_words([MARK + w.replace(" ", MARK) for w in new])
            for (i, _), numbers in zip(batch, found):
                out[i].append(b"".join(map(self.ids.__getitem__, numbers)))
        return [b"".join(x) for x in out]

    def decode(self, ids: bytes) -> str:
        """The text of ids that encode() made; control ids give nothing, bytes that are no UTF-8 become U+FFFD."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        text = b"".join(map(self.surface.__getitem__, numbers)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text  # the space that encoding puts in front


@functools.lru_cache(maxsize=1)
def model_of(path: str) -> PieceBPE:
    return PieceBPE(path)


def _lists(packed: list[bytes]) -> pa.Array:
    """Packed ids as an array of lists."""
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))


def _each(b: pa.RecordBatch, schema: T.StructType, new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([new[f.name] if f.name in new else b.column(f.name) for f in schema.fields], names=schema.names)


def encode_texts(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """df with ids_col: the ids of the text's pieces, array<int>, without begin and end ids.

    path: a model file, which every executor has.  A null or empty text has no ids.  Characters that no piece has become
    ids of their UTF-8 bytes.  Texts are encoded whole; a long one passes through in pieces cut in front of spaces.
    Repeated rows and all other columns pass; a column named ids_col is replaced; an empty table gives an empty result.
    """
    df = df if text_col.lower() == ids_col.lower() else without(df, ids_col)
    schema = T.StructType([*(f for f in df.schema.fields if f.name != ids_col), T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches):
        model = model_of(path)
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            yield _each(b, schema, {ids_col: _lists(model.encode([t or "" for t in b.column(text_col).to_pylist()]))})

    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """df with text_col: the text of the ids in ids_col; null or no ids give the empty text.

    Other columns pass; a column named text_col is replaced; an empty table gives an empty result.
    """
    df = without(df, text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches):
        model = model_of(path)
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            texts = [model.decode(np.array(x or [], "<u4").tobytes()) for x in b.column(ids_col).to_pylist()]
            yield _each(b, schema, {text_col: pa.array(texts, pa.string())})

    return df.mapInArrow(run, schema)


def roundtrip(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """encode_texts and decode_ids in one pass over the rows: columns ids and decoded are added; null texts are empty ones.

    Repeated rows and all other columns pass, columns named as the new ones are replaced; an empty table gives an empty result.
    """
    df = without(df, *[c for c in ("ids", "decoded") if c != text_col])
    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches):
        model = model_of(path)
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            packed = model.encode([t or "" for t in b.column(text_col).to_pylist()])
            yield _each(b, schema, {"ids": _lists(packed), "decoded": pa.array(list(map(model.decode, packed)), pa.string())})

    return df.mapInArrow(run, schema)
