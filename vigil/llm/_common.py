"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import cut, release, shared_dir, shared_path, staged  # noqa: F401  used by the operators

#: ASCII upper case to lower case only; `lower()` would also change other letters.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


#: Bits of an id filter for each id, and in all at most (8 MB); bits of one row of it.
ID_BITS, MOST_BITS, ROW_BITS = 16, 1 << 26, 1 << 15


def with_filter(df: DataFrame, id_col: str, ids: DataFrame, name: str) -> DataFrame:
    """df with boolean `name`: true wherever id_col is among `ids` (one column), and for about one in ID_BITS of the other rows.

    So rows that a join with ids would drop, or leave as they are, mostly need no shuffle; the join still has to decide on
    the true ones.  A bitmap of hashes goes to every task, in rows of 4 KB; where MOST_BITS are few for the ids, more rows
    are true.  `ids` is read twice and should be cut.  Null ids are false.
    """
    bits = min(MOST_BITS, max(ROW_BITS, 1 << (ids.count() * ID_BITS).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    at, row, held, here = fresh(df.columns, "_at", "_at_row", "_held", "_here")
    placed = ids.toDF(at).where(F.col(at).isNotNull()).select(place(at).alias(at)).withColumn(row, F.floor(F.col(at) / ROW_BITS))
    # dealt by row first: each task would send 4 KB for every row that it has an id of
    rows = placed.repartition(row).groupBy(row).agg(F.bitmap_construct_agg(F.col(at) % ROW_BITS).alias(held))
    marked = df.withColumn(here, place(id_col)).join(F.broadcast(rows), F.floor(F.col(here) / ROW_BITS) == F.col(row), "left")
    byte = F.conv(F.hex(F.substring(held, (F.floor(F.col(here) % ROW_BITS / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    one = F.get(F.array(*[F.lit(1 << i) for i in range(8)]), (F.col(here) % 8).cast("int"))
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(byte.bitwiseAND(one) != 0, F.lit(False)).alias(name))


def fresh(taken, *names: str) -> list[str]:
    """Each name, with underscores in front until no column has it (column names ignore case)."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns of these names, which an operator is about to write itself."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])
