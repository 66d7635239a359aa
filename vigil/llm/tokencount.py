"""Token counts.

Texts are encoded in Arrow functions that return lengths only.  The texts of an Arrow batch are dealt into calls of about
equal bytes, and long texts are split at boundaries where the vocabulary itself never joins what stands on both sides.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._common import without
from ._text import SAFE, batches_by_bytes, n_bytes

#: Bytes in one call of the library, and bytes above which a text is split.
CALL_BYTES, PIECE_BYTES = 400_000, 100_000
#: One space between ASCII letters or digits.  The space itself goes: the vocabularies cut here drop it, or stand for it by a mark at the next word's start.
WORD_GAP = regex.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def _gap_is_safe(pattern: str) -> bool:
    """Whether no word of a pattern reaches over the space between two ASCII letters or digits."""
    words, ends = regex.compile(pattern), "azAZ019"
    return not any(any(c.isspace() for c in w) for a in ends for b in ends for w in words.findall(f"x{a} {b}x"))


def json_boundary(spec: dict) -> regex.Pattern | None:
    """Where texts may be split for a tokenizer's JSON: byte-level ones, and ones that keep the words of a pattern and drop white space."""
    special = [t["content"] for t in spec.get("added_tokens", [])]
    pre, plain = spec.get("pre_tokenizer") or {}, not any(c.isspace() or c.isdigit() for s in special for c in s)
    if pre.get("type") == "ByteLevel" and not spec.get("normalizer") and not pre.get("add_prefix_space") and plain:
        return SAFE
    first = (pre.get("pretokenizers") or [pre])[0]
    normal = spec.get("normalizer") or {}
    steps = {n.get("type") for n in normal.get("normalizers", [normal])}
    if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "Regex" in first["pattern"] and plain and steps <= {None, "NFC", "NFD", "Replace", "Lowercase"}:
        return WORD_GAP if _gap_is_safe(first["pattern"]["Regex"]) else None
    return None


def model_boundary(model) -> regex.Pattern | None:
    """Where texts may be split for a sentencepiece model: at word ends, if words start with a mark and no piece reaches over one."""
    marked = model.encode("a", out_type=str)[0].startswith("\u2581")
    inner = any("\u2581" in model.id_to_piece(i).lstrip("\u2581") for i in range(model.get_piece_size()))
    return WORD_GAP if marked and not inner else None


@functools.cache
def counter(path: str) -> tuple[Callable[[list[str]], list[int]], regex.Pattern | None]:
    """(function from texts to numbers of tokens, where texts may be split) of a vocabulary file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], model_boundary(model)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    with open(path, encoding="utf-8") as f:
        boundary = json_boundary(json.load(f))
    return lambda texts: [len(x) for x in t.encode_batch_fast(texts, add_special_tokens=False)], boundary


def count_tokens(df: DataFrame, path: str, text_col: str = "text", limit: int = 512) -> DataFrame:
    """df with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    path: a tokenizer's .json or .model file, which every executor has.  No begin, end or other special tokens are
    added, and nothing is truncated or padded.  A null text counts as the empty one: 0 bytes, 0 tokens.  A long text is
    split where that cannot change its count, and else counted in one call.  Repeated rows and other columns pass;
    columns named as the new ones are replaced; an empty table gives an empty result.
    """
    df = without(df, "n_bytes", "n_tokens", "over_limit")
    new = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    schema = T.StructType([*df.schema.fields, *new])

    def run(batches):
        count, safe = counter(path)
        count, boundary = counter(path)
        for b in batches:
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            n = [0] * len(texts)
            for part in batches_by_bytes(texts, CALL_BYTES, PIECE_BYTES, boundary):
                for (i, _), k in zip(part, count([p for _, p in part])):
                    n[i] += k
            columns = [pa.array(list(map(n_bytes, texts)), pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, *(f.name for f in new)])

    return df.mapInArrow(run, schema)
