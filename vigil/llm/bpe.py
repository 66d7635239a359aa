"""BPE encoding and decoding.

Texts are cut at spaces, and chunks that a task has not met yet into words by the vocabulary's pattern.  New words are
encoded together: the symbols of all of them lie in one flat array, the rank of a neighbouring pair is found by binary
search over the sorted pair keys, and each round merges all places of every word's lowest rank at once.
"""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._common import without
from ._text import batches_by_bytes

#: Fixed value: the pattern by which byte-level vocabularies of this family split text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of texts taken together, and above which a text is cut at a safe boundary; words, and characters of chunks, that a task remembers.
BATCH_BYTES, PIECE_BYTES, CACHE_WORDS, CACHE_CHARS = 1_000_000, 500_000, 100_000, 2_000_000
#: Texts that a task looks at together.
TEXTS = 2000
#: Punctuation that often ends a word; it holds no apostrophe, which may begin a word of its own.
_STOPS = ".,;:!?"
_NONE = np.int64(1) << 40


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Numbers(dict):
    """Numbers its keys in order of their first use; `fresh` lists those not yet looked at."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.fresh.append(key)
        return n


class ByteBPE:
    """A byte-level BPE vocabulary from a tokenizer's JSON file.  label: a number for each chunk, which count() adds up."""

    def __init__(self, path: str, label: Callable[[str], int] | None = None):
        self.label = label
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer is known here")
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.pattern = regex.compile(PATTERN)
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes[i] = bytes(map(back.__getitem__, token)) if all(c in back for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.base = np.int64(len(self.bytes))
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.known: dict[str, bytes] = {"": b""}
        self.forget()

    def ranks_of(self, pair: np.ndarray, same: np.ndarray) -> np.ndarray:
        """The rank of each pair key, by binary search; none where there is no merge or the symbols are of two words."""
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(same & (self.keys[at] == pair), self.ranks[at], _NONE)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word; all words go through the merge rounds together.

        A merge changes the ranks of the pairs beside it and no others, so later rounds search for those alone.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        rank = np.full(len(sym), _NONE)
        rank[:-1] = self.ranks_of(sym[:-1] * self.base + sym[1:], word[:-1] == word[1:])
        done_word, done_sym = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(sym)])
            if (least == _NONE).any():
                over = np.repeat(least == _NONE, lengths)
                done_word.append(word[over])
                done_sym.append(sym[over])
                sym, word, rank = sym[~over], word[~over], rank[~over]
                least, lengths = least[least != _NONE], lengths[least != _NONE]
            places = np.flatnonzero(rank == np.repeat(least, lengths))
            # places side by side share a symbol (a pair of two equal symbols): every other one from the left counts
            run = np.r_[True, np.diff(places) != 1]
            offset = np.arange(len(places)) - np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
            places = places[offset % 2 == 0]
            sym[places] = self.merged[rank[places]]
            keep = np.ones(len(sym), bool)
            keep[places + 1] = False
            sym, word, rank = sym[keep], word[keep], rank[keep]
            now = places - np.arange(len(places))
            changed = np.r_[now, now[now > 0] - 1]
            after = np.minimum(changed + 1, len(sym) - 1)
            rank[changed] = self.ranks_of(sym[changed] * self.base + sym[after], (word[changed] == word[after]) & (changed != after))
        if not done_word:
            return [b""] * len(words)
        w, s = np.concatenate(done_word), np.concatenate(done_sym)
        packed = s[np.argsort(w, kind="stable")].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(w, minlength=len(words)))
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def encode_pattern(self, texts: list[str]) -> list[bytes]:
        """Each text's packed ids, from the words that special strings and the pattern leave."""
        special = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        parts, at = [], []
        for i, text in enumerate(texts):
            for p in self.split.split(text) if self.split is not None and any(s in text for s in special) else (text,):
                words = [p] if p in special else self.pattern.findall(p)
                parts += words
                at += [i] * len(words)
        self._know(w for w in parts if w not in special)
        out: list[list[bytes]] = [[] for _ in texts]
        for i, w in zip(at, parts):
            out[i].append(special[w] if w in special else self.known[w])
        return [b"".join(x) for x in out]

    def _know(self, words) -> None:
        """Encodes those of the words that are new."""
        new = list(set(words).difference(self.known))
        self.known.update(zip(new, self.encode_words([w.encode() for w in new])))

    def _learn(self) -> None:
        """Encodes the fresh chunks.  A chunk of letters, with or without punctuation behind them, has the pattern's words at once."""
        new, self.numbers.fresh = self.numbers.fresh, []
        spaced = [c[1:] if c[:1] == " " else " " + c for c in new]
        cores = [c.rstrip(_STOPS) for c in spaced]
        plain = [(core[1:] if core[:1] == " " else core).isalpha() for core in cores]
        ends = [c[len(w) :] for c, w in zip(spaced, cores)]
        self._know(itertools.chain(itertools.compress(cores, plain), itertools.compress(ends, plain)))
        others = iter(self.encode_pattern([c for c, p in zip(spaced, plain) if not p]))
        known = self.known
        ids = [known[w] + known[e] if p else next(others) for w, e, p in zip(cores, ends, plain)]
        self.ids += ids
        self.sizes = np.r_[self.sizes, np.fromiter(map(len, ids), np.int64, len(ids)) // 4]
        if self.label is not None:
            self.labels = np.r_[self.labels, np.fromiter(map(self.label, new), np.int64, len(new))]
        self.odd = np.r_[self.odd, np.fromiter((c == "" or c[0] != " " and c[0].isspace() for c in new), bool, len(new))]
        self.chars += sum(map(len, new))

    def chunks(self, texts: list[str]) -> Iterator[tuple[list[int], list[str], list[list[int]]]]:
        """(numbers of texts, their pieces, numbers of the chunks of each piece), for some pieces at a time.

        A text is cut at its spaces.  A space before a character that is no white space begins a word of the pattern, so
        the ids of a text are those of its chunks, each with its space in front.  Where white space follows a space, the
        chunk is `odd`, and the piece has to be encoded as a whole.
        """
        for batch in batches_by_bytes(texts, BATCH_BYTES, PIECE_BYTES):
            if self.chars > CACHE_CHARS:
                self.forget(self.often(CACHE_CHARS // 2))
            if len(self.known) > CACHE_WORDS:
                self.known = {"": b""}
            look, found = self.numbers.__getitem__, []
            for _, piece in batch:
                first, *others = piece.split(" ")
                found.append([look(" " + first), *map(look, others)])  # a key with a space in front: none before the chunk
            if self.numbers.fresh:
                self._learn()
            yield [i for i, _ in batch], [p for _, p in batch], found

    def often(self, chars: int) -> np.ndarray:
        """The numbers of the chunks that count() met more than once since the last forget(), the most frequent ones up to `chars` characters."""
        again = np.flatnonzero(self.uses > 1)
        again = again[np.argsort(-self.uses[again], kind="stable")]
        lengths = np.fromiter(map(len, self.numbers), np.int64, len(self.numbers))
        return np.sort(again[np.cumsum(lengths[again]) <= chars])

    def forget(self, but: np.ndarray | None = None) -> None:
        """Forgets all chunks but those of these numbers, which are numbered anew."""
        if but is None:
            self.numbers, self.ids, self.chars = _Numbers(), [], 0
            self.sizes, self.labels, self.odd, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
            return
        chunks, ids, self.numbers = list(self.numbers), self.ids, _Numbers()
        kept = [chunks[i] for i in but.tolist()]
        self.numbers.update(zip(kept, range(len(kept))))
        self.ids, self.chars, self.uses = [ids[i] for i in but.tolist()], sum(map(len, kept)), np.zeros(0, np.int64)
        self.sizes, self.odd = self.sizes[but], self.odd[but]
        self.labels = self.labels[but] if self.label is not None else self.labels

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for at, pieces, found in self.chunks(texts):
            odd = set(np.flatnonzero(self.odd).tolist())
            for i, piece, numbers in zip(at, pieces, found):
                out[i].append(self.encode_pattern([piece])[0] if odd and not odd.isdisjoint(numbers) else b"".join(map(self.ids.__getitem__, numbers)))
        return [b"".join(x) for x in out]

    def count(self, texts: list[str], labels: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(the number of ids of each text, how many of its chunks have each label below `labels`: a row for each text)."""
        n, seen = np.zeros(len(texts), np.int64), np.zeros((len(texts), labels), np.int64)
        for at, pieces, found in self.chunks(texts):
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            numbers = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(sizes.sum()))
            uses = np.bincount(numbers, minlength=len(self.sizes))
            uses[: len(self.uses)] += self.uses
            self.uses = uses
            starts = np.cumsum(sizes) - sizes
            ids = np.add.reduceat(self.sizes[numbers], starts)
            odd = np.flatnonzero(np.logical_or.reduceat(self.odd[numbers], starts))
            ids[odd] = [len(x) // 4 for x in self.encode_pattern([pieces[j] for j in odd])]
            np.add.at(n, at, ids)
            if labels:
                low, high = at[0], at[-1] + 1
                cell = np.repeat(np.array(at) - low, sizes) * labels + self.labels[numbers]
                seen[low:high] += np.bincount(cell, minlength=(high - low) * labels).reshape(-1, labels)
        return n, seen

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)  # with its words, one vocabulary takes about 100 MB of a worker that later stages use again
def vocabulary(path: str, label: Callable[[str], int] | None = None) -> ByteBPE:
    return ByteBPE(path, label)


def _with(batch: pa.RecordBatch, columns: list[tuple[str, pa.Array]]) -> pa.RecordBatch:
    new = {n.lower() for n, _ in columns}
    old = [(f.name, batch.column(i)) for i, f in enumerate(batch.schema) if f.name.lower() not in new]
    return pa.RecordBatch.from_arrays([c for _, c in old + columns], names=[n for n, _ in old + columns])


def encode_texts(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """df with ids_col: the text's token ids, packed as little-endian unsigned 32-bit integers (binary).

    path: the vocabulary file, which every executor has.  A null text is encoded as the empty one (no ids).  Texts are
    encoded whole; a long one passes through in pieces cut at boundaries between words.  Special strings in a text
    become their special ids.  Repeated rows and all other columns pass; a column named ids_col is replaced; an empty
    table gives an empty result.
    """
    df = df if text_col.lower() == ids_col.lower() else without(df, ids_col)
    schema = T.StructType([*df.schema.fields, T.StructField(ids_col, T.BinaryType())])

    def run(batches):
        bpe = vocabulary(path)
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            yield _with(b, [(ids_col, pa.array(bpe.encode(texts), pa.binary()))])

    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """df with text_col: the text of the packed ids; null ids give the empty text.

    Repeated rows and all other columns pass; a column named text_col is replaced; an empty table gives an empty result.
    """
    df = without(df, text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches):
        bpe = vocabulary(path)
        for b in batches:
            yield _with(b, [(text_col, pa.array([bpe.decode(x or b"") for x in b.column(ids_col).to_pylist()], pa.string()))])

    return df.mapInArrow(run, schema)


def roundtrip(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """encode_texts and decode_ids in one pass over the rows: columns ids and decoded are added.

    A null text is encoded as the empty one.  Texts of any length are encoded and decoded whole.  Repeated rows and all
    other columns pass, columns named as the new ones are replaced; an empty table gives an empty result.
    """
    df = without(df, *[c for c in ("ids", "decoded") if c != text_col])
    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches):
        bpe = vocabulary(path)
        for b in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            ids = bpe.encode([t or "" for t in b.column(text_col).to_pylist()])
            yield _with(b, [("ids", pa.array(ids, pa.binary())), ("decoded", pa.array(list(map(bpe.decode, ids)), pa.string()))])

    return df.mapInArrow(run, schema)
