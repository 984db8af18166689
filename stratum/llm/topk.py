"""Exact top-k by inner product: block-at-a-time pruning.

Documents (here integer vectors; a term is a signed dimension) are ordered by a
cheap key that puts similar ones together and cut into blocks of consecutive
documents.  A block keeps a forward index (the weights of its documents) and the
largest and smallest weight of every term.  For one query the summed term maxima

    bound(q, block) = sum over terms of max(q_t * max_t, q_t * min_t)

bound every score in the block.  Blocks are visited in falling order of the bound and
scored through their forward indexes until the bound falls below the query's k-th
score so far; an equal bound is still visited, because ties go to the smaller id.

Spark layout.  ``slices`` of consecutive blocks (RANGE_ROWS documents at most) and
``groups`` of queries (QUERY_ROWS at most) form a grid; one task works on one cell
(one slice, one group), so its memory is bounded whatever the number of documents
and queries.  Every cell returns at most k rows per query; a last window over
(query) keeps the best k.  This compares a stated query set with all rows in
blocks: a document is sent once per query group, a query once per slice.

Exactness: scores are computed in float64 where every partial sum is below 2**53, in
64-bit integers below 2**63, else in Python integers (only cells that hold such weights).
A weight beyond +-LARGEST counts as that, a score beyond 64 bits as the end of the range.

Defined results: vectors that are null, or hold null or non-finite components, take
no part; a term that a vector lacks (unequal lengths) weighs 0; an empty vector
scores 0 with all.  A null id takes no part.  Repeated rows are separate candidates;
a query leaves out every row with its own id, and a repeated query id asks once,
with its smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.frames import stored

BLOCK_ROWS = 256
RANGE_ROWS = 1 << 14
QUERY_ROWS = 1024
LARGEST = 9.2e18


def weights(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            scale: int = 64) -> DataFrame:
    """(id, w array<int>) with w = floor(scale * x), x as double; unusable rows left out."""
    x = F.col(vector_col).cast("array<double>")
    usable = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v)
                                       | (F.abs(v) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & usable)
    held = lambda v: F.least(F.greatest(v * scale, F.lit(-LARGEST)), F.lit(LARGEST))
    return rows.select(F.col(id_col), F.transform(x, lambda v: F.floor(held(v)).cast("long")).alias("w"))


def _signature(w: Column) -> Column:
    """A key that brings similar vectors together: the strongest signed dimensions."""
    strength = F.transform(w, lambda v, i: F.struct(F.abs(v).alias("a"), i.alias("i"), F.signum(v).alias("s")))
    top = F.slice(F.sort_array(strength, asc=False), 1, 3)
    return F.array_join(F.transform(top, lambda t: F.concat(
        F.lpad(t["i"].cast("string"), 6, "0"), F.when(t["s"] < 0, "-").otherwise("+"))), "")


def _matrix(lists, dims: int) -> np.ndarray:
    out = np.zeros((len(lists), dims), dtype=np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


_PACKED = "part long, n int, dims int, width int, ids binary, weights binary"
_WIDTHS = {4: np.int32, 8: np.int64}


def _packed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows (part, id, w) as one row: a forward index."""
    dims = max((len(v) for v in pdf["w"]), default=0)
    m = _matrix(pdf["w"].tolist(), dims)
    width = 4 if np.abs(m).max(initial=0) < 1 << 31 else 8
    return pd.DataFrame({
        "part": [int(pdf["part"].iloc[0])], "n": [len(pdf)], "dims": [dims], "width": [width],
        "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
        "weights": [m.astype(_WIDTHS[width]).tobytes()]})


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Consecutive rows of each partition, ``block_rows`` together."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame()
        for pdf in batches:
            held = pd.concat([held, pdf], ignore_index=True)
            full = len(held) // block_rows * block_rows
            for at in range(0, full, block_rows):
                yield _packed(held.iloc[at:at + block_rows])
            held = held.iloc[full:]
        if len(held):
            yield _packed(held)

    return rows.mapInPandas(pack, _PACKED)


def _unpack(pdf: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(r.ids, np.int64),
             np.frombuffer(r.weights, _WIDTHS[r.width]).reshape(r.n, r.dims)) for r in pdf.itertuples()]


def _wide(m: np.ndarray, dims: int, dtype) -> np.ndarray:
    out = np.zeros((m.shape[0], dims), dtype=dtype)
    out[:, :m.shape[1]] = m
    return out


def _in_range(scores: np.ndarray) -> np.ndarray:
    """Python integers held within 64 bits (the least is kept free); others as they are."""
    if scores.dtype != object:
        return scores
    return np.clip(scores, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)


def search_cell(queries: list[tuple[np.ndarray, np.ndarray]],
                blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> pd.DataFrame:
    """Best ``k`` documents of the blocks for every query; ties to the smaller id."""
    dims = max([m.shape[1] for _, m in queries + blocks] + [1])
    qid = np.concatenate([i for i, _ in queries])
    q = np.concatenate([_wide(m, dims, np.int64) for _, m in queries])
    top = np.array([[m.max(axis=0, initial=0), m.min(axis=0, initial=0)]
                    for m in (_wide(b, dims, np.int64) for _, b in blocks)])
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(top).max(initial=0)) * dims
    kind = np.float64 if largest < 2.0 ** 53 else np.int64 if largest < 2.0 ** 62 else object
    q = q.astype(kind)
    docs = [(ids, _wide(m, dims, kind)) for ids, m in blocks]
    high = np.array([m.max(axis=0) for _, m in docs]).T
    low = np.array([m.min(axis=0) for _, m in docs]).T
    bound = _in_range(np.maximum(q, 0) @ high + np.minimum(q, 0) @ low)  # (queries, blocks)
    order = np.argsort(-bound, axis=1, kind="stable")
    n = len(q)
    none = np.iinfo(np.int64).min
    score = np.full((n, k), none, dtype=np.int64)
    found = np.zeros((n, k), dtype=np.int64)
    live = np.arange(n)
    for turn in range(len(docs)):
        b = order[live, turn]
        live_mask = bound[live, b] >= np.where(score[live, -1] == none, -np.inf, score[live, -1])
        live, b = live[live_mask], b[live_mask]
        if not len(live):
            break
        for block in np.unique(b):
            rows = live[b == block]
            ids, m = docs[block]
            s = _in_range(q[rows] @ m.T).astype(np.int64)
            usable = (ids[None, :] != qid[rows][:, None]) & (s >= score[rows, -1][:, None])
            r, c = np.nonzero(usable)
            if not len(r):
                continue
            touched = np.unique(r)
            # Rows already held and the new ones, best first within each query.
            held = score[rows[touched]] != none
            hr, hc = np.nonzero(held)
            who = np.concatenate([touched[hr], r])
            val = np.concatenate([score[rows[touched]][hr, hc], s[r, c]])
            doc = np.concatenate([found[rows[touched]][hr, hc], ids[c]])
            o = np.lexsort((doc, -val, who))
            who, val, doc = who[o], val[o], doc[o]
            first = np.searchsorted(who, who, side="left")
            rank = np.arange(len(who)) - first
            keep = rank < k
            score[rows[who[keep]], rank[keep]] = val[keep]
            found[rows[who[keep]], rank[keep]] = doc[keep]
    r, c = np.nonzero(score != none)
    return pd.DataFrame({"query_id": qid[r], "vec_id": found[r, c], "score": score[r, c]})


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
          range_rows: int = RANGE_ROWS, query_rows: int = QUERY_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, id, score): for every query row its ``k`` best other rows.

    ``vectors`` has (id, w), see ``weights``; ``is_query`` is a condition on them.
    """
    base = stored(vectors.select(F.col(id_col).cast("long").alias("id"), "w",
                                 F.coalesce(is_query, F.lit(False)).alias("asked")), "vectors")
    sizes = base.agg(F.count(F.lit(1)).alias("n"),
                     F.count_if("asked").alias("asked")).first()
    slices = max(1, -(-sizes["n"] // range_rows))
    groups = max(1, -(-sizes["asked"] // query_rows))
    ranged = base.select("id", "w", _signature(F.col("w")).alias("sig")).repartitionByRange(
        slices, "sig", "id").sortWithinPartitions("sig", "id").select(
        "id", "w", F.spark_partition_id().cast("long").alias("part"))
    blocks = stored(_blocks(ranged, block_rows), "blocks")
    parts = (blocks.agg(F.max("part").alias("top")).first()["top"] or 0) + 1
    left = blocks.withColumn("slice", F.expr(f"part * {min(slices, parts)}L div {parts}L")).withColumn(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # One query per id; a repeated id asks with its smallest vector.
    asked = base.filter("asked").groupBy("id").agg(F.min("w").alias("w")).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.lit(groups)))
    packs = asked.groupBy("part").applyInPandas(_packed, _PACKED)
    right = packs.withColumnRenamed("part", "grp").withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(min(slices, parts) - 1))))

    def work(doc_rows: pd.DataFrame, query_pdf: pd.DataFrame) -> pd.DataFrame:
        if not len(doc_rows) or not len(query_pdf):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
        return search_cell(_unpack(query_pdf), _unpack(doc_rows), k)

    columns = [F.col("slice").cast("long"), F.col("grp").cast("long"), "n", "dims", "width", "ids", "weights"]
    left, right = left.select(*columns), right.select(*columns)
    best = left.groupBy("slice", "grp").cogroup(right.groupBy("slice", "grp")).applyInPandas(
        work, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(
        F.desc("score"), F.asc("vec_id")))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")
