"""Column expressions and table helpers the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space the operators know: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
#: A word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def whole(text) -> Column:
    """A text, null counting as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(*frames: DataFrame) -> str:
    """A column prefix that no frame uses, so that a join never meets a clashing name."""
    taken = {c.lower() for f in frames for c in f.columns}
    while True:
        name = f"x{uuid.uuid4().hex[:8]}_"
        if not any(c.startswith(name) for c in taken):
            return name


def floor_of_most(counts: DataFrame, most: int) -> int:
    """A count ``n`` that at most ``most`` rows reach. The cuts are those of six leading bits, so the
    rows are counted in some two thousand cells and the last, partly fitting cell is left out."""
    cell = F.expr("shiftleft(shiftright(n, greatest(length(bin(n)) - 6, 0)), greatest(length(bin(n)) - 6, 0))")
    cells = counts.groupBy(cell.alias("least")).agg(F.count(F.lit(1)).alias("rows")).collect()
    cut, total = 1 << 62, 0
    for r in sorted(cells, key=lambda r: -r["least"]):
        total += r["rows"]
        if total > most:
            break
        cut = r["least"]
    return cut


#: Bits of the filter below: four megabytes once they are grouped in words.
FILTER_BITS = 1 << 24


def likely_among(rows: DataFrame, key: Column, ids: DataFrame, id_column: str) -> DataFrame:
    """The rows whose ``key`` may be among ``ids``, and some others: those whose hash meets no bit of
    any id go before they are shuffled. The filter's size is fixed, so it can be broadcast however
    many ids there are; with very many it lets more through. An exact join has to follow."""
    p = fresh(rows, ids)
    place = F.pmod(F.xxhash64(F.col(id_column)), F.lit(FILTER_BITS))
    words = ids.select(place.alias("at")).groupBy(F.floor(F.col("at") / 64).alias(p + "word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias(p + "bits"))
    own = rows.withColumn(p + "at", F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)))
    own = own.join(F.broadcast(words), F.floor(F.col(p + "at") / 64) == F.col(p + "word"))
    hit = F.expr(f"({p}bits & shiftleft(1L, cast({p}at % 64 as int))) != 0")
    return own.filter(hit).select(*rows.columns)
