"""Target-distribution importance resampling over hashed word runs.

The features of a text are all runs of one to three consecutive words; each falls into
one of ``buckets`` by the crc32 of its bytes.  A bucket's gain is the log ratio of its
smoothed share among the target texts and among all documents; a document's weight is
the sum of its features' gains.  Adding Gumbel noise that depends on the id alone and
taking the highest scores draws documents without replacement in proportion to their
importance.

1. One narrow pass counts features by bucket (arrays of ``buckets`` counts per task,
   added up by Spark); the gains, ``buckets`` integers, are broadcast.
2. A second narrow pass scores every document with the array of gains.  Scores, ids and
   counts are stored; texts are not read again.
3. The cut-off of the draw is found by bisection of the numeric range: repeated jobs
   count exactly, over the stored columns, how many rows lie at or before each of a few
   pivots.  Where rows tie on the score, the ids of the tied rows are bisected, then
   the text hash and the stored row number, so exactly the wanted number is drawn.
   Nothing is sorted for this, whatever the number of rows or ties.
4. Only the drawn rows are range-partitioned and sorted; a row's rank is the number of
   drawn rows in earlier partitions plus its place in its own.

The crc32 of a run of words comes from the crc32 of its words: appending n bytes is a
linear map that depends on n alone, so whole blocks are combined with table lookups.

Defined results: null and empty texts have no words, weight 0 and are never drawn (nor
counted among the N).  Repeated rows are rows of their own; equal ids with equal scores
rank by text hash, identical rows in any order.  A null id takes the noise of the empty
string and ranks after other ids of its score.  Other columns are not looked at.  An
empty table gives no rows; an empty target gives gains from the smoothing alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.frames import stored, tidy

PIVOTS = 15      # counted in one bisection job
LONG_WORD = 64   # bytes; longer words are hashed one by one


# ------------------------------------------------------------------ crc32 of word runs
def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


CRC = _byte_table()


def _append(table: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The map of a (4, 256) table on 32-bit values."""
    return (table[0][v & 255] ^ table[1][(v >> 8) & 255] ^ table[2][(v >> 16) & 255]
            ^ table[3][v >> 24])


@lru_cache(maxsize=4096)
def _shift(n: int) -> np.ndarray:
    """What appending ``n`` bytes does to a crc, by byte of the crc."""
    if n <= 1:
        v = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32))
        return v if n == 0 else CRC[v & 255] ^ (v >> 8)
    half = _shift(n // 2)
    out = _append(half, half)
    return _append(_shift(1), out) if n % 2 else out


def _joined(left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of two strings in a row, from theirs and the size of the second."""
    if not len(left):
        return left
    known, which = np.unique(sizes, return_inverse=True)
    tables = np.stack([_shift(int(n)) for n in known])
    return (tables[which, 0, left & 255] ^ tables[which, 1, (left >> 8) & 255]
            ^ tables[which, 2, (left >> 16) & 255] ^ tables[which, 3, left >> 24]) ^ right


def _word_crcs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    order = np.argsort(-size, kind="stable")
    n_long = int(np.searchsorted(-size[order], -LONG_WORD, side="left"))
    rest = order[n_long:]
    at, c = start[rest], out[rest]
    steps = -size[rest]
    for p in range(int(size[rest[0]]) if len(rest) else 0):
        live = int(np.searchsorted(steps, -p, side="left"))  # words of more than p bytes
        c[:live] = CRC[(c[:live] ^ data[at[:live] + p]) & 255] ^ (c[:live] >> 8)
    out[rest] = c ^ np.uint32(0xFFFFFFFF)
    for i in order[:n_long].tolist():
        out[i] = zlib.crc32(data[start[i]:start[i] + size[i]].tobytes())
    return out


def run_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int,
                longest: int = 3) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(words per document, [(bucket, document row) of the runs of 1, 2, ... words])."""
    from stratum.llm.textops import ALNUM, LOWER, Words

    words = Words(data, offsets, ALNUM, hashes=False)
    size = words.end - words.start
    one = _word_crcs(LOWER[data], words.start, size)
    spaced = _joined(np.full(len(one), zlib.crc32(b" "), np.uint32), one, size)
    crc, doc = one, words.doc
    out = [((crc % np.uint32(buckets)).astype(np.int64), doc)]
    for k in range(1, longest):
        same = words.doc[k:] == words.doc[:-k] if len(words) > k else np.zeros(0, dtype=bool)
        crc = _joined(crc[:len(same)], spaced[k:], size[k:] + 1)
        out.append(((crc[same] % np.uint32(buckets)).astype(np.int64), words.doc[k:][same]))
    return np.diff(words.first), out


# ------------------------------------------------------------------------- the passes
def bucket_counts(docs: DataFrame, buckets: int, text_col: str = "text") -> np.ndarray:
    """Features by bucket over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            data, off = flat(b.column("text"))
            for i, j in blocks(off):
                for found, _ in run_buckets(data[off[i]:off[j]], off[i:j + 1] - off[i], buckets)[1]:
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])],
                                         names=["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(tidy(run), "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(everywhere: np.ndarray, target: np.ndarray) -> np.ndarray:
    buckets = len(everywhere)
    s_all, t_all = float(everywhere.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log(
        (t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
        for s, t in zip(everywhere.tolist(), target.tolist())], dtype=np.int64)


def _noise(id_text: Column, seed: int) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, gain: np.ndarray, seed: int = 42, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score, tie) of every row: one narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        value = shared.value
        for b in batches:
            data, off = flat(b.column("text"))
            n = len(off) - 1
            n_words, n_features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for i, j in blocks(off):
                n_words[i:j], runs = run_buckets(data[off[i]:off[j]], off[i:j + 1] - off[i], len(value))
                for found, doc in runs:
                    n_features[i:j] += np.bincount(doc, minlength=j - i)
                    weight[i:j] += np.bincount(doc, weights=value[found], minlength=j - i).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n_words), pa.array(n_features), pa.array(weight), b.column("tie")],
                names=["id", "n_words", "n_features", "weight", "tie"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("tie"))
    out = rows.mapInArrow(tidy(run), "id long, n_words long, n_features long, weight long, tie long")
    id_text = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return out.withColumn("score", F.col("weight") + _noise(id_text, seed))


# ---------------------------------------------------------------- cut-off by bisection
def _bisect(rows: DataFrame, column: Column, k: int) -> tuple[int, int, int]:
    """(v, rows before v, rows at v): v is the least value with ``k`` rows at or before it."""
    ends = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    lo, hi = int(ends["lo"]), int(ends["hi"])  # the answer lies in [lo, hi]
    while lo < hi:
        width = hi - lo
        pivots = sorted({lo + width * i // (PIVOTS + 1) for i in range(1, PIVOTS + 1)} | {lo})
        found = rows.agg(*[F.count_if(column <= F.lit(p)).alias(f"p{i}")
                           for i, p in enumerate(pivots)]).first()
        enough = [p for i, p in enumerate(pivots) if found[f"p{i}"] >= k]
        short = [p for i, p in enumerate(pivots) if found[f"p{i}"] < k]
        lo, hi = (max(short) + 1 if short else lo), (min(enough) if enough else hi)
    last = rows.agg(F.count_if(column < F.lit(lo)).alias("b"), F.count_if(column == F.lit(lo)).alias("a")).first()
    return lo, last["b"], last["a"]


def first_rows(rows: DataFrame, order: Sequence[Column], k: int) -> Column:
    """A condition true for exactly the ``k`` first of ``rows`` by ``order`` (integer columns,
    ascending, the last one unique)."""
    if k <= 0:
        return F.lit(False)
    cuts, tied = [], rows
    for column in order:
        v, before, at = _bisect(tied, column, k)
        cuts.append(v)
        if before + at == k:
            break
        k -= before
        tied = tied.filter(column == F.lit(v))
    inside = order[len(cuts) - 1] <= F.lit(cuts[-1])
    for column, v in reversed(list(zip(order, cuts))[:-1]):
        inside = (column < F.lit(v)) | ((column == F.lit(v)) & inside)
    return inside


def ranked(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, ... by ``order``: range partitions, then one sum of sizes."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()), "drawn")  # partition << 33 | row
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row a partition
    ahead, total = [], 0
    for r in sizes:
        ahead.append((r["part"], total))
        total += r["count"]
    starts = rows.sparkSession.createDataFrame(ahead, "part long, ahead long")
    return placed.withColumn("part", part).join(F.broadcast(starts), "part").withColumn(
        "rank", F.col("ahead") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20,
             buckets: int = 10000, seed: int = 42, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank null where undrawn."""
    gain = gains(bucket_counts(docs, buckets, text_col), bucket_counts(target, buckets, text_col))
    rows = stored(scored(docs, gain, seed, id_col, text_col).withColumn(
        "row", F.monotonically_increasing_id()), "scores")
    long_enough = F.col("n_words") >= least_words
    order = [-F.col("score"), F.col("id").isNull().cast("int"), F.coalesce("id", F.lit(0)),
             F.col("tie"), F.col("row")]
    fit = rows.filter(long_enough)
    inside = long_enough & first_rows(fit, order, percent * fit.count() // 100)
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score", "rank"]
    drawn = ranked(rows.filter(inside), order).select(*columns)
    return drawn.unionByName(rows.filter(~inside).withColumn(
        "rank", F.lit(None).cast("long")).select(*columns))
