"""Sharding along a Hilbert curve; DataFrame functions only.

Several metadata dimensions are quantised to ``BITS`` bits each, the cell of a row is
its index on the Hilbert curve through that grid, rows are ordered by cell and the
order is cut into runs of equal length.  Neighbours on the curve are neighbours in
every dimension, so each shard spans a narrow range of all of them and a reader can
skip whole shards by any of the dimensions.

The index is a walk of a state machine, one step per bit level: (state, octant) ->
(digit, next state).  A state is the pair (entry corner, direction) of a sub-cube;
its table is built by rule from the Gray code (``curve_tables``).

Global order without a global sort or a single task: rows are grouped by (cell,
bucket, salt).  Buckets split a cell by the text's checksum, so equal texts stay
close; salts split a bucket by doc_id, so that a cell, or one group of copies, with
a third of all rows is spread over many tasks.  The place of a row is

    rows in smaller cells + rows in smaller groups of its cell + its number in the group

The first term is a running sum over at most 2**(BITS * 3) cells (one small task,
bounded by the grid, not by the data), the second a running sum over at most
BUCKETS * SALTS groups within each cell, the third a window over one group.

Law ``rows``: shard = floor(place * shards / n), so counts differ by one at most;
slot = place minus the shard's first place, gapless from 0.  grown_shard is null
(the law of this operator is not ``key``).

Shuffles: only (id, size, checksum, cell, bucket, salt) is shuffled, never a text; the
text is read once and the small table of these columns is stored in the shared
folder between the count and the numbering.

Defined results: a null text counts as empty (size 1, checksum 0), null metadata as
the empty string; null ids come first within equal checksums; rows that agree in every ordering column (repeated rows) take
successive places, equal up to their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.frames import stored

BITS = 4
BUCKETS = 16
SALTS = 64


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """(digit, next state) by state * 2**dims + octant; state = entry * dims + direction."""
    size = 1 << dims
    gray = [i ^ (i >> 1) for i in range(size)]
    place = {g: i for i, g in enumerate(gray)}

    def turn(x: int, by: int) -> int:  # rotate dims bits to the left
        by %= dims
        return ((x << by) | (x >> (dims - by))) & (size - 1)

    def trailing_ones(i: int) -> int:
        n = 0
        while i & 1:
            i, n = i >> 1, n + 1
        return n

    entry = [0 if i == 0 else gray[2 * ((i - 1) // 2)] for i in range(size)]
    axis = [0 if i == 0 else (trailing_ones(i - 1) if i % 2 == 0 else trailing_ones(i)) % dims
            for i in range(size)]
    digit, follow = [], []
    for e in range(size):
        for d in range(dims):
            for octant in range(size):
                w = place[turn(octant ^ e, dims - d - 1)]
                digit.append(w)
                follow.append((e ^ turn(entry[w], d + 1)) * dims + (d + axis[w] + 1) % dims)
    return digit, follow


def hilbert_index(dimensions: list[Column], bits: int = BITS) -> Column:
    """Index on the curve of a point whose coordinates have ``bits`` bits each."""
    dims = len(dimensions)
    digit, follow = curve_tables(dims)
    digits, follows = (F.expr("array(" + ",".join(map(str, v)) + ")") for v in (digit, follow))
    point = F.array(*[c.cast("int") for c in dimensions])
    levels = F.array(*[F.lit(b) for b in reversed(range(bits))])
    octants = F.transform(levels, lambda b: _octant(point, b, dims))

    def step(a: Column, octant: Column) -> Column:
        at = a["s"] * (1 << dims) + octant
        return F.struct(F.get(follows, at).alias("s"),
                        (a["h"] * (1 << dims) + F.get(digits, at)).alias("h"))

    start = F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(octants, start, step, lambda a: a["h"])


def _octant(p: Column, b: Column, dims: int) -> Column:
    out = F.lit(0)
    for i in range(dims):
        bit = F.pmod(F.floor(F.get(p, F.lit(i)) / F.pow(F.lit(2), b)).cast("int"), F.lit(2))
        out = out + bit * (1 << (dims - 1 - i))
    return out


def checksum(c: Column) -> Column:
    """crc32 of a value written as text; null counts as empty."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def hashed(c: Column, bits: int = BITS) -> Column:
    """A category as a coordinate; null counts as the empty string."""
    return F.pmod(checksum(c), F.lit(1 << bits)).cast("int")


def magnitude(c: Column, bits: int = BITS) -> Column:
    """A positive size as a coordinate: powers of two, the last one open."""
    return F.least(F.length(F.bin(c)) - 1, F.lit((1 << bits) - 1)).cast("int")


def hilbert_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                   text_col: str = "text", categories: tuple[str, ...] = ("lang", "source"),
                   ) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, curve) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    meta = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        checksum(F.col(text_col)).alias("crc"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(categories)])
    point = [hashed(F.col(f"c{i}")) for i in range(len(categories))] + [magnitude(F.col("size"))]
    meta = meta.select("id", "size", "crc", hilbert_index(point).alias("curve"))
    group = (F.pmod("crc", F.lit(BUCKETS)) * SALTS
             + F.pmod(checksum(F.col("id")), F.lit(SALTS))).cast("int")
    meta = stored(meta.withColumn("grp", group), "hilbert")

    counts = meta.groupBy("curve", "grp").agg(F.count(F.lit(1)).alias("n"))
    # One row per cell: at most 2**(BITS * dims) rows, whatever the data.
    cells = counts.groupBy("curve").agg(F.sum("n").alias("n"))
    cells = cells.select(
        "curve", (F.sum("n").over(Window.orderBy("curve")) - F.col("n")).alias("cell_first"))
    in_cell = Window.partitionBy("curve").orderBy("grp")
    groups = counts.withColumn("group_first", F.sum("n").over(in_cell) - F.col("n")).join(
        cells, "curve").select("curve", "grp", (F.col("cell_first") + F.col("group_first")).alias("first"))
    total = meta.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    number = F.row_number().over(Window.partitionBy("curve", "grp").orderBy("crc", "id", "size"))
    placed = meta.withColumn("number", number).join(groups, ["curve", "grp"]).withColumn(
        "place", F.col("first") + F.col("number") - 1)
    shard = F.expr(f"cast((place * {shards}L) div {max(1, total)}L AS int)")
    first = F.expr(f"((cast(shard AS bigint) * {total}L) + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", (F.col("place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve")
