"""Fill-in-the-middle transformation.

A text is cut into prefix, middle and suffix at two drawn places.  Sentinels go into a bytearray in front of the three
blocks, and blocks change places by three reversals.  The same rotation the other way gives the text back.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentinels before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
NEW = ("n", "form", "prefix_chars", "middle_chars", "output")


def check_marks(marks: tuple[str, str, str]) -> None:
    """Sentinels must be found again in any text that has none of them: none may begin with an end of another, or lie in it."""
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            ends = range(1, min(len(a), len(b)) + (i != j))
            if not a or (i != j and a in b) or any(a[-k:] == b[:k] for k in ends):
                raise ValueError(f"sentinels {a!r} and {b!r} are empty, equal or overlap")


def offsets(text: bytes, cuts: Iterable[int]) -> list[int]:
    """The byte offsets of cuts that are counted in code points."""
    if text.isascii():
        return list(cuts)
    starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return [int(starts[c]) if c < len(starts) else len(text) for c in cuts]


def rotate(buf: bytearray, low: int, mid: int, high: int) -> None:
    """Exchanges the neighbouring blocks buf[low:mid] and buf[mid:high] in place, by three reversals."""
    for a, b in ((low, mid), (mid, high), (low, high)):
        buf[a:b] = buf[a:b][::-1]


def arrange(text: bytes, first: int, second: int, form: str, marks: list[bytes]) -> bytes:
    """The text in its form, cut at two byte offsets."""
    if form == "plain":
        return text
    p, s, m = marks
    buf = bytearray(text)
    buf[second:second], buf[first:first], buf[:0] = s, m, p  # one after the other, from the right
    middle, suffix = first + len(p), second + len(p) + len(m)
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))
    return bytes(buf)


def restore(output: bytes, form: str, marks: list[bytes]) -> bytes:
    """The text from its output and form; an output without its form's sentinels is an error."""
    if form == "plain":
        return output
    p, s, m = marks
    buf = bytearray(output)
    if form == "psm":
        at = buf.index(s)
        end = buf.index(m, at)
        rotate(buf, at, end, len(buf))
        middle, suffix = at, at + len(buf) - end
    else:
        at = buf.index(p)
        end = buf.index(m, at)
        rotate(buf, 0, at, len(buf))
        middle, suffix = end - at, len(buf) - at
    del buf[suffix : suffix + len(s)], buf[middle : middle + len(m)], buf[: len(p)]
    return bytes(buf)


def _draws(seed: int, id_: Column) -> list[Column]:
    """Four unsigned 32-bit integers from the digest of seed and id; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, rate: int = 90, spm_rate: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """df with n (code points), form (plain, psm or spm), prefix_chars and middle_chars (null if plain), and output.

    `rate` per cent of the ids are cut, `spm_rate` per cent of these put the suffix first.  Empty texts, and texts that
    hold a sentinel, stay plain; a null text is an empty one.  Cuts lie between code points of the whole text, however
    long; equal ids are cut at the same draws, null ids together.  Repeated rows and other columns pass; columns named as
    the new ones are replaced; an empty table gives an empty result.
    """
    check_marks(marks)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    n = F.length(text).cast("long")
    h1, h2, h3, h4 = _draws(seed, F.col(f"`{id_col}`"))
    held = F.lit(False)
    for mark in marks:
        held = held | F.contains(text, F.lit(mark))
    form = F.when((n == 0) | held | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    first, second = F.least(h1 % (n + 1), h2 % (n + 1)), F.greatest(h1 % (n + 1), h2 % (n + 1))
    packed = [m.encode() for m in marks]

    @F.arrow_udf("string")
    def arranged(texts: pa.Array, forms: pa.Array, lows: pa.Array, highs: pa.Array) -> pa.Array:
        out = []
        for t, f, a, b in zip(texts, forms.to_pylist(), lows.to_pylist(), highs.to_pylist()):
            t = t.as_py().encode()
            out.append(arrange(t, *(offsets(t, (a, b)) if f != "plain" else (0, 0)), f, packed))
        return pa.array(out, pa.binary()).cast(pa.string())

    others = [f"`{c}`" for c in df.columns if c.lower() not in NEW]
    cut = lambda c: F.when(form != "plain", c)
    return df.select(*others, n.alias("n"), form.alias("form"), cut(first).alias("prefix_chars"), cut(second - first).alias("middle_chars"), arranged(text, form, first, second).alias("output"))


def restored(df: DataFrame, output_col: str = "output", form_col: str = "form", name: str = "restored", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """df with `name`: the text that transform() had, from its output and form alone.

    A null output is an empty one, a null form plain.  Other columns pass; an empty table gives an empty result.
    """
    check_marks(marks)
    packed = [m.encode() for m in marks]

    @F.arrow_udf("string")
    def back(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return pa.array([restore(t.as_py().encode(), f, packed) for t, f in zip(outputs, forms.to_pylist())], pa.binary()).cast(pa.string())

    made = back(F.coalesce(F.col(f"`{output_col}`"), F.lit("")), F.coalesce(F.col(f"`{form_col}`"), F.lit("plain")))
    others = [f"`{c}`" for c in df.columns if c.lower() != name.lower()]
    return df.select(*others, made.alias(name))
