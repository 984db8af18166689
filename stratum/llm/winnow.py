"""Benchmark decontamination by winnowing.

An item's windows are its runs of WINDOW consecutive words; a document word inside any
occurrence of a window is hit.  Both sides are fingerprinted alike: the hash of every
run of K words, of which each stretch of W = WINDOW - K + 1 hashes keeps its smallest
(the leftmost of equals).  The choice depends on the stretch alone, so every
occurrence of a window, being K + W - 1 words long, has a kept fingerprint in the
document that the item keeps at the same place of the window: no shared window is
missed.  A match of fingerprints is an anchor; it is extended word by word to both
sides, and all words of a common run of WINDOW words or more are hit.

Items of fewer words are one window each.  They are too short for winnowing, so the
hash of the whole item is looked up at every document position (one hash per
distinct short length).

Spark plan.
1. The benchmark is fingerprinted and stored (item fingerprints, each with the WINDOW - K
   words around it).  A bitmap of FILTER_BITS bits of their hashes is built by a
   bit_or aggregate and broadcast: its size is fixed (2 MB), whatever the benchmark.
2. One pass over the documents returns one row per document with its word count and
   those kept fingerprints whose bit is set (false hits fall out in step 3), again
   with the words around.  This table is stored once.
3. Fingerprints join on their hash; the extension is an expression on the two word
   lists.  Items that hold the same words around a fingerprint are one passage class,
   so an occurrence is one row however many items hold the passage.  Intervals are made
   distinct, then merged per document with a window; the names of a document's distinct
   classes are put together at the end, listed and hashed.

Words are compared by 64-bit hashes of their bytes.  Texts are never shuffled.

Defined results: null and empty texts have no words; documents are told apart by id
and text hash, so repeated ids with different texts are judged apart and repeated
rows get the same values; an item without an id hits as any other and is only not
listed or counted among the items.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.frames import carried, quoted, released, stored, tidy, without_keys

WINDOW = 13
K = 7
FILTER_BITS = 1 << 24

_PRINTS = "array<struct<h:long,at:int,size:int,around:array<long>>>"
_PRINT_TYPE = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("size", pa.int32()),
                                  ("around", pa.list_(pa.int64()))]))
_EDGE_DOC, _EDGE_ITEM = 1, 2  # what stands beyond the ends of a text; never equal


def kept_prints(codes: np.ndarray, doc: np.ndarray, window: int, k: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word index) of the kept k-word runs of all documents of a block."""
    from stratum.llm.textops import run_hash, sliding_min

    h = run_hash(codes, k)
    if len(codes) < window:
        return h[:0], np.zeros(0, dtype=np.int64)
    low = np.uint64((1 << 24) - 1)
    spot = np.arange(len(h), dtype=np.uint64)
    order = (h & ~low) | spot if len(h) <= 1 << 24 else None
    w = window - k + 1
    inside = doc[:len(codes) - window + 1] == doc[window - 1:]
    if order is None:  # a single text of over 16 million words: in two halves that overlap
        half = len(codes) // 2
        a = kept_prints(codes[:half + window - 1], doc[:half + window - 1], window, k)
        b = kept_prints(codes[half:], doc[half:], window, k)
        at = np.unique(np.concatenate([a[1], b[1] + half]))
        return h[at], at
    least = sliding_min(order, w)[inside]
    at = np.unique((least & low).astype(np.int64))
    return h[at], at


def _words(data: np.ndarray, offsets: np.ndarray):
    from stratum.llm.textops import ALNUM, Words

    return Words(data, offsets, ALNUM)


def _around(codes: np.ndarray, first: np.ndarray, doc: np.ndarray, at: np.ndarray, k: int,
            side: int, edge: int) -> np.ndarray:
    """The k words at each anchor with ``side`` words on both sides; edges are marked."""
    pos = at[:, None] + np.arange(-side, k + side)
    lo, hi = first[doc[at]][:, None], first[doc[at] + 1][:, None]
    inside = (pos >= lo) & (pos < hi)
    out = codes[np.clip(pos, 0, len(codes) - 1)].astype(np.int64)
    return np.where(inside, out, edge)


def _print_rows(h, at, size, around, owner: np.ndarray, n: int) -> pa.Array:
    """List column: the fingerprints of each of ``n`` rows; ``owner`` is sorted."""
    cut = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    flat_around = pa.array(around.ravel(), pa.int64())
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(len(h) + 1, dtype=np.int32) * (around.shape[1] if len(h) else 0)), flat_around)
    rows = pa.StructArray.from_arrays(
        [pa.array(h.astype(np.int64)), pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32)),
         lists], names=["h", "at", "size", "around"])
    return pa.ListArray.from_arrays(pa.array(cut), rows)


def _tagged(h: np.ndarray, size: int) -> np.ndarray:
    """Short windows of different lengths, and anchors, live in separate hash ranges."""
    from stratum.llm.textops import mix

    return mix(h + np.uint64(size)).astype(np.int64)


def _collect(words, spots: list[tuple[np.ndarray, np.ndarray, int, bool]], window: int, k: int,
             edge: int, n: int) -> pa.Array:
    """spots: (hash, word index, size, anchor?)."""
    side = window - k
    width = window + side
    hs, ats, sizes, rows = [], [], [], []
    for h, at, size, anchor in spots:
        hs.append(h)
        ats.append(at)
        sizes.append(np.full(len(at), size))
        rows.append(_around(words.code, words.first, words.doc, at, k, side, edge) if anchor and len(at)
                    else np.zeros((len(at), width), dtype=np.int64))
    h, at, size = np.concatenate(hs), np.concatenate(ats), np.concatenate(sizes)
    around = np.concatenate(rows)
    owner = words.doc[at] if len(at) else np.zeros(0, dtype=np.int64)
    o = np.argsort(owner, kind="stable")
    local = at[o] - words.first[owner[o]] if len(at) else at
    return _print_rows(h[o], local, size[o], around[o], owner[o], n)


def item_prints(items: DataFrame, window: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, h, at, size, around): the fingerprints of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat, run_hash

        for b in batches:
            data, off = flat(b.column("t"))
            for i, j in blocks(off):
                words = _words(data[off[i]:off[j]], off[i:j + 1] - off[i])
                count = np.diff(words.first)
                h, at = kept_prints(words.code, words.doc, window, k)
                spots = [(_tagged(h, window), at, window, True)]
                for size in np.unique(count[(count > 0) & (count < window)]).tolist():
                    at = words.first[:-1][count == size]
                    spots.append((_tagged(run_hash(words.code, size)[at], size), at, size, False))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(i, j - i), _collect(words, spots, window, k, _EDGE_ITEM, j - i)],
                    names=["item_id", "prints"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.mapInArrow(tidy(run), f"item_id {kind}, prints {_PRINTS}")
    return rows.select("item_id", F.inline("prints"))


def _bitmap(prints: DataFrame, bits: int) -> np.ndarray:
    """Set bits of the fingerprint hashes: ``bits`` / 64 words at most reach the driver."""
    slot = F.pmod("h", F.lit(bits))
    rows = prints.select(F.floor(slot / 64).cast("int").alias("w"),
                         F.expr(f"shiftleft(1L, cast(pmod(h, {bits}L) % 64 AS int))").alias("b"))
    got = rows.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[got["w"].to_numpy(dtype=np.int64)] = got["b"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def document_prints(docs: DataFrame, bitmap: np.ndarray, short: list[int], window: int, k: int,
                    id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n_words, prints): fingerprints that may occur in the benchmark."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat, run_hash

        bits = np.uint64(len(shared.value) * 64)

        def known(h: np.ndarray) -> np.ndarray:
            s = (h % np.int64(bits)).astype(np.uint64)  # non-negative, as pmod
            return (shared.value[s >> np.uint64(6)] >> (s & np.uint64(63))) & np.uint64(1) != 0

        for b in batches:
            data, off = flat(b.column("t"))
            for i, j in blocks(off):
                words = _words(data[off[i]:off[j]], off[i:j + 1] - off[i])
                h, at = kept_prints(words.code, words.doc, window, k)
                h = _tagged(h, window)
                ok = known(h)
                spots = [(h[ok], at[ok], window, True)]
                for size in short:
                    h = run_hash(words.code, size)
                    at = np.flatnonzero(words.doc[:len(h)] == words.doc[size - 1:]) if len(h) else \
                        np.zeros(0, dtype=np.int64)
                    h = _tagged(h[at], size)
                    ok = known(h)
                    spots.append((h[ok], at[ok], size, False))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(i, j - i), b.column("text_hash").slice(i, j - i),
                     pa.array(np.diff(words.first)),
                     _collect(words, spots, window, k, _EDGE_DOC, j - i)],
                    names=[id_col, "text_hash", "n_words", "prints"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("t"),
                       F.xxhash64(text).alias("text_hash")).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, text_hash long, n_words long, prints {_PRINTS}")


def _common(around_a: Column, around_b: Column, k: int, side: int) -> tuple[Column, Column]:
    """How far an anchor extends to the left and right (0 to ``side`` words)."""
    same = F.zip_with(around_a, around_b, lambda x, y: x == y)

    def run(start: int, step: int) -> Column:
        # The first differing word ends the run; ``side`` when none differs.
        seq = F.array(*[F.get(same, F.lit(start + step * i)) for i in range(side)])
        gap = F.array_position(seq, False)
        return F.when(gap == 0, F.lit(side)).otherwise(gap - 1).cast("int")

    return run(side - 1, -1), run(side + k, 1)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", with_key: bool = False) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated.

    ``with_key`` adds text_hash, which tells documents with one id apart.
    """
    # A passage class: items that have a fingerprint with the same words around it.
    prints = stored(item_prints(items, window, k, item_col, item_text_col).groupBy("h", "size", "around").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("names")).withColumn(
        "passage", F.monotonically_increasing_id()), "items")
    short = [r["size"] for r in prints.filter(F.col("size") < window).select("size").distinct().collect()]
    table = stored(document_prints(docs, _bitmap(prints, FILTER_BITS), sorted(short), window, k,
                                   id_col, text_col), "winnowed")
    key = [id_col, "text_hash"]
    anchors = table.filter(F.size("prints") > 0).select(*key, F.inline("prints")).withColumnRenamed(
        "around", "doc_around")
    side = window - k
    left, right = _common(F.col("doc_around"), F.col("around"), k, side)
    met = anchors.join(prints.select("passage", "h", "size", "around"), ["h", "size"])
    whole = F.col("size") < window
    met = met.withColumn("left", F.when(whole, 0).otherwise(left)).withColumn(
        "right", F.when(whole, 0).otherwise(right))
    same_anchor = whole | F.expr(f"slice(doc_around, {side + 1}, {k}) = slice(around, {side + 1}, {k})")
    met = met.filter(same_anchor).select(
        *key, "passage", (F.col("at") - F.col("left")).alias("start"),
        F.when(whole, F.col("at") + F.col("size")).otherwise(
            F.col("at") + k + F.col("right")).alias("end"), whole.alias("whole"))
    met = stored(met.filter(F.col("whole") | (F.col("end") - F.col("start") >= window)).drop("whole"),
                 "hits")

    before = F.max("end").over(Window.partitionBy(*key).orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, -1))
    spans = met.select(*key, "start", "end").distinct().withColumn("before", before)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("before", F.lit(0))))
    hit = spans.groupBy(*key).agg(F.sum(fresh).alias("n_hit"))
    listed = met.select(*key, "passage").distinct().join(prints.select("passage", "names"), "passage").groupBy(
        *key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("items"))
    found = hit.join(listed, [hit[c].eqNullSafe(listed[c]) for c in key]).select(
        *[hit[c].alias(f"_{c}") for c in key], "n_hit", "items")
    out = table.join(found, [table[c].eqNullSafe(found[f"_{c}"]) for c in key], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(id_col, F.col("n_words").cast("long"), n_hit.alias("n_hit"),
                      F.size(names).cast("long").alias("n_items"),
                      F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                      ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
                      *(["text_hash"] if with_key else []))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    rows = carried(docs, id=F.col(quoted(id_col)), text=F.col(quoted(text_col)),
                   text_hash=F.xxhash64(F.coalesce(F.col(quoted(text_col)), F.lit(""))))
    bad = stored(contamination(rows.select("id", "text"), items, id_col="id", with_key=True).filter(
        "contaminated").select("id", "text_hash"), "contaminated")
    return released(without_keys(rows, bad), docs.columns)
