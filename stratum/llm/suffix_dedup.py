"""Removal of repeated strings of SPAN bytes by external induced sorting.

A byte is removed when a SPAN-byte string that covers it starts at two or more places
of the corpus (inside documents).  In suffix terms: the suffix at a start has a
neighbour in suffix order with a common prefix of SPAN bytes or more.

Sorting all suffixes of a corpus needs queue entries of many bytes for every text
byte.  Only suffixes that can have such a neighbour are sorted here, in groups that
are independent of each other:

1. Anchors.  Among the K-byte strings inside each SPAN-byte window the one of least
   hash (the leftmost of equals) is the window's anchor.  It depends on the window's
   bytes alone, so equal windows have equal anchors at equal offsets, and consecutive
   windows share one: about two anchors per SPAN - K bytes.  An anchor with its run
   of window starts is one tuple (hash, lo, hi): the windows start lo to hi bytes
   before it.
2. Tuples whose anchor hash occurs once are dropped.  The rest are grouped by
   (hash, lo, hi, hash of all their bytes): copies of a passage, however many, become one
   class with a count (combined before the shuffle).  A class with a count of two or
   more is repeated at all its starts.
3. Classes with a count of one meet the other classes of their anchor.  The suffixes of
   such a group are sorted by induction (``repeated_starts``): all contexts are
   aligned at the anchor; the order at one byte position is induced from the order
   one position later by distributing it, in order, over the preceding byte, and the
   common-prefix values are carried along (one more than the least value between
   the two inducing suffixes, zero where the bytes differ).  At each start position a
   suffix is repeated when a neighbour's value reaches SPAN.  Bytes are compared,
   not hashes.
4. Larger than memory.  The queue of tuples is Spark's own: a shuffle by anchor, sorted
   within partitions, spilled to disk by Spark and streamed through the tasks,
   which hold BATCH_ROWS tuples at a time.  A group of more than GROUP_ROWS classes
   is not loaded but split by recursion: its range of starts is halved, each half
   has a longer common core, and the tuples are grouped anew by that core, where equal
   contexts become classes again.  At the end of the recursion a range is one start,
   the core is the whole window and the count alone decides, so no group, however
   hot, has to fit a task.
5. The repeated start ranges are collected per document (bounded by its length) and
   joined to the texts of those documents only.

Shuffles: 20 to 40 bytes per anchor; contexts of the classes that have to be sorted;
the texts of documents with such classes or with removed bytes (found with a bitmap of
fixed size before they leave the scan).

Defined results: null and empty texts have no bytes; a text shorter than SPAN keeps
all; rows are told apart by id and text hash, repeated rows are separate documents (so
each repeats the other) with equal results.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.frames import may_contain, stored, tidy

SPAN = 400
K = 100
GROUP_ROWS = 4096
BATCH_ROWS = 8192
SCAN_BYTES = 1 << 19
HOT_CLASSES = 4096

_ANCHORS = "array<struct<h:long,c:long,at:long,lo:int,hi:int>>"


def find_anchors(data: np.ndarray, offsets: np.ndarray, span: int, k: int) -> dict[str, np.ndarray]:
    """Anchors of a run of documents: row, place in the row, hash, lo, hi, hash of the context."""
    from stratum.llm.textops import mix, prefix_hash, sliding_min, span_hash

    names = ("row", "at", "h", "lo", "hi", "c")
    if len(data) < span:
        return {x: np.zeros(0, dtype=np.int64) for x in names}
    if len(data) > 1 << 24:  # positions must fit 24 bits: halves that overlap by a window
        return _in_halves(data, offsets, span, k)
    prefix = prefix_hash(data)
    place = np.arange(len(data) - k + 1)
    h = span_hash(prefix, place, place + k)
    low = np.uint64((1 << 24) - 1)
    least = sliding_min((h & ~low) | place.astype(np.uint64), span - k + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(row[:len(data) - span + 1] == row[span - 1:])
    at = (least[start] & low).astype(np.int64)
    first = np.ones(len(start), dtype=bool)
    first[1:] = (at[1:] != at[:-1]) | (row[start[1:]] != row[start[:-1]])
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(start)) - 1
    s1, s2, at = start[begin], start[end], at[begin]
    owner = row[s1]
    c = mix(span_hash(prefix, s1, s2 + span) ^ np.uint64(0x2545F4914F6CDD1D))
    return {"row": owner, "at": at - offsets[owner], "h": h[at].view(np.int64), "lo": at - s2,
            "hi": at - s1, "c": c.view(np.int64)}


def _in_halves(data: np.ndarray, offsets: np.ndarray, span: int, k: int) -> dict[str, np.ndarray]:
    """A very long text in two parts; a run of starts may be cut in two there."""
    half = len(data) // 2
    parts = []
    for a, b in ((0, half + span - 1), (half, len(data))):
        inner = np.clip(offsets, a, b) - a
        p = find_anchors(data[a:b], inner, span, k)
        p["at"] = p["at"] + np.maximum(0, a - offsets[p["row"]])
        parts.append(p)
    return {x: np.concatenate([p[x] for p in parts]) for x in parts[0]}


def _scan(docs: DataFrame, span: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """(id, th, anchors) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        for b in batches:
            data, off = flat(b.column("t"))
            for i, j in blocks(off, SCAN_BYTES):
                part, bounds = data[off[i]:off[j]], off[i:j + 1] - off[i]
                a = find_anchors(part, bounds, span, k)
                o = np.argsort(a["row"], kind="stable")
                cut = np.searchsorted(a["row"][o], np.arange(j - i + 1)).astype(np.int32)
                rows = pa.StructArray.from_arrays(
                    [pa.array(a[x][o].astype(t)) for x, t in
                     (("h", np.int64), ("c", np.int64), ("at", np.int64), ("lo", np.int32), ("hi", np.int32))],
                    names=["h", "c", "at", "lo", "hi"])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(i, j - i), b.column("th").slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(cut), rows)],
                    names=["id", "th", "anchors"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(
        tidy(run), f"id {kind}, th long, anchors {_ANCHORS}")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("t"))


def repeated_starts(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, context: np.ndarray,
                    offsets: np.ndarray, span: int) -> np.ndarray:
    """flags[i, l]: the window of row i that starts l bytes before the anchor is repeated.

    ``group`` is non-decreasing; row i's context holds the bytes from hi[i] before its
    anchor to the end of the window that starts lo[i] before it.
    """
    m, top = len(group), int(hi.max(initial=0))
    width, edge = top + span, 256
    cells = np.full((m, width), edge, dtype=np.int16)
    size = np.diff(offsets)
    row = np.repeat(np.arange(m), size)
    cells[row, np.arange(len(context)) - offsets[row] + (top - hi)[row]] = context
    columns = np.ascontiguousarray(cells.T)
    base = np.unique(group, return_inverse=True)[1].astype(np.int64) * (edge + 1)
    order = np.arange(m)
    common = np.zeros(m + 1, dtype=np.int32)  # with the suffix before; one sentinel
    flags = np.zeros((m, top + 1), dtype=bool)
    for j in range(width - 1, -1, -1):
        byte = columns[j][order]
        key = base + byte  # each group keeps its place in the order
        same = np.empty(m - 1, dtype=bool)
        if (key[1:] >= key[:-1]).all():
            np.equal(key[1:], key[:-1], out=same)
            same &= byte[1:] != edge
            common[1:m] = np.where(same, common[1:m] + 1, 0)
        else:
            move = np.argsort(key, kind="stable")
            key, byte, order = key[move], byte[move], order[move]
            np.equal(key[1:], key[:-1], out=same)
            same &= byte[1:] != edge
            a, b = move[:-1], move[1:]
            value = np.where(same, common[np.minimum(b, m - 1)] + 1, 0)
            far = np.flatnonzero(same & (b != a + 1))
            if len(far):
                pairs = np.empty(2 * len(far), dtype=np.int64)
                pairs[0::2], pairs[1::2] = a[far] + 1, b[far] + 1
                value[far] = np.minimum.reduceat(common, pairs)[0::2] + 1
            common[1:m] = value
            common[0] = 0
        np.minimum(common, span, out=common)
        if j <= top:
            long = common[1:m] >= span
            hit = np.zeros(m, dtype=bool)
            hit[1:] |= long
            hit[:-1] |= long
            flags[order[hit], top - j] = True
    return flags


_CONTEXT = "h long, n long, id {kind}, th long, at long, lo int, hi int, b binary"


def _induced(rows: DataFrame, span: int, kind: str) -> DataFrame:
    """Repeated start ranges (id, th, s1, s2) of the rows with a count of one.

    Rows arrive sorted by group; complete groups are worked on, BATCH_ROWS rows at once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            h = table["h"].to_numpy()
            cut = len(h) if last else int(np.searchsorted(h, h[-1]))
            # Whole groups, about BATCH_ROWS rows together.
            at = 0
            while at < cut:
                end = min(cut, at + BATCH_ROWS)
                if end < cut:
                    low = int(np.searchsorted(h, h[end], side="left"))
                    end = low if low > at else int(np.searchsorted(h, h[end], side="right"))
                yield solve(table.slice(at, end - at))
                at = end
            rest = table.slice(cut)
            held[:] = rest.combine_chunks().to_batches() if len(rest) else []

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) >= 2 * BATCH_ROWS:
                yield from flush(False)
        if held:
            yield from flush(True)

    def solve(table: pa.Table) -> pa.RecordBatch:
        from stratum.llm.textops import flat

        lo, hi = table["lo"].to_numpy().astype(np.int64), table["hi"].to_numpy().astype(np.int64)
        context, offsets = flat(table["b"])
        flags = repeated_starts(table["h"].to_numpy(), lo, hi, context, offsets, span)
        flags &= (table["n"].to_numpy() == 1)[:, None]
        edge = np.zeros((len(lo), flags.shape[1] + 1), dtype=bool)
        edge[:, 1:-1] = flags[:, 1:] != flags[:, :-1]
        edge[:, 0], edge[:, -1] = flags[:, 0], flags[:, -1]
        row, l = np.nonzero(edge)
        row, l1, l2 = row[0::2], l[0::2], l[1::2] - 1
        at = table["at"].to_numpy()[row]
        picked = table.select(["id", "th"]).take(pa.array(row)).combine_chunks()
        one = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        return pa.RecordBatch.from_arrays(
            [one(picked["id"]), one(picked["th"]), pa.array(at - l2), pa.array(at - l1)],
            names=["id", "th", "s1", "s2"])

    # The queue: tuples in group order, spilled and merged by Spark's sort.
    queue = rows.repartition("h").sortWithinPartitions("h")
    return queue.mapInArrow(tidy(run), f"id {kind}, th long, s1 long, s2 long")


def _halved(rows: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """One step of the recursion for the rows of oversized groups (ga, gb: the range).

    Returns the rows of the next level, counts refreshed (one row stands for a class of
    equal contexts), and the ranges (id, th, s1, s2) of rows that turned out repeated.
    """
    mid = F.floor((F.col("ga") + F.col("gb")) / 2).cast("int")
    halves = F.array(F.struct(F.col("ga").alias("a"), mid.alias("z")),
                     F.struct((mid + 1).alias("a"), F.col("gb").alias("z")))
    rows = rows.withColumn("half", F.explode(halves)).filter("half.a <= half.z")
    rows = rows.withColumn("lo2", F.greatest("lo", "half.a")).withColumn(
        "hi2", F.least("hi", "half.z")).filter("lo2 <= hi2")
    rows = rows.withColumn("b", F.expr(f"substring(b, hi - hi2 + 1, hi2 - lo2 + {span})"))
    core = F.expr(f"substring(b, hi2 - half.a + 1, {span} - (half.z - half.a))")
    rows = rows.select(F.xxhash64("h", "half.a", "half.z", core).alias("h"), "n", "id", "th", "at",
                       F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "b",
                       F.col("half.a").alias("ga"), F.col("half.z").alias("gb"),
                       F.sha2("b", 256).alias("d"))
    rows = stored(rows, "halves")
    same = ["h", "lo", "hi", "d"]
    # One row per class; a row is known by (id, th, at), so the smallest of these stays.
    total = rows.groupBy(*same).agg(F.sum("n").alias("total"))
    once = rows.join(total.filter("total = 1").select(*same), same)
    many = total.filter("total > 1")
    repeated = rows.join(many.select(*same), same).filter("n = 1").select(
        "id", "th", (F.col("at") - F.col("hi")).alias("s1"), (F.col("at") - F.col("lo")).alias("s2"))
    partner = rows.join(many.select(*same), same).groupBy(*same).agg(
        F.lit(2).cast("long").alias("n"), *[F.first(c).alias(c) for c in ("id", "th", "at", "b", "ga", "gb")])
    names = ["h", "n", "id", "th", "at", "lo", "hi", "b", "ga", "gb"]
    return once.select(*names).unionByName(partner.select(*names)), repeated


def repeated_ranges(table: DataFrame, docs: DataFrame, span: int = SPAN, k: int = K,
                    id_col: str = "doc_id", text_col: str = "text",
                    group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, th, s1, s2): every window start in s1..s2 of the document is repeated."""
    kind = table.schema["id"].dataType.simpleString()
    tuples = table.select("id", "th", F.inline("anchors"))
    again = table.select(F.explode("anchors.h").alias("h")).groupBy("h").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    tuples = may_contain(tuples, "h", stored(again, "again"), bits=1 << 24)
    classes = tuples.groupBy("h", "lo", "hi", "c").agg(
        F.count(F.lit(1)).alias("n"), F.first("id").alias("id"), F.first("th").alias("th"),
        F.first("at").alias("at"))
    classes = stored(classes, "classes")
    groups = classes.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least"))
    groups = stored(groups, "groups")
    # Copies: every start of a class with a count of two or more.  Classes with more than
    # 1/HOT_CLASSES of the tuples number fewer than HOT_CLASSES and are broadcast, so the
    # tuples of a passage that very many documents share do not meet in one task.
    key = ["h", "lo", "hi", "c"]
    total = classes.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_CLASSES > total
    many = classes.filter("n > 1").select(*key, hot.alias("hot"))
    probe = may_contain(tuples, "h", many.select("h"), bits=1 << 24).join(
        F.broadcast(many.filter("hot")), key, "left")
    met = probe.filter("hot").drop("hot").unionByName(
        probe.filter("hot IS NULL").drop("hot").join(many.filter("NOT hot").select(*key), key))
    copies = met.select(
        "id", "th", (F.col("at") - F.col("hi")).alias("s1"), (F.col("at") - F.col("lo")).alias("s2"))
    found = [copies]

    # Groups with a class to decide and another to compare it with.
    open_groups = groups.filter("size > 1 AND least = 1").select("h", "size")
    ask = classes.join(open_groups, "h")
    per_doc = ask.groupBy("id", "th").agg(F.collect_list(
        F.struct("h", "n", "at", "lo", "hi", "size")).alias("asks"))
    texts = may_contain(_texts(docs, id_col, text_col), "th", per_doc.select("th"))
    texts = texts.select(F.col("id").alias("_id"), F.col("th").alias("_th"),
                         F.col("t").cast("binary").alias("t")).dropDuplicates(["_id", "_th"])
    met = per_doc.join(texts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    rows = met.select("id", "th", F.expr(
        "inline(transform(asks, x -> named_struct('h', x.h, 'n', x.n, 'at', x.at, 'lo', x.lo, "
        f"'hi', x.hi, 'size', x.size, 'b', substring(t, cast(x.at - x.hi + 1 AS int), "
        f"x.hi - x.lo + {span}))))"))
    rows = stored(rows, "contexts")
    names = ["h", "n", "id", "th", "at", "lo", "hi", "b"]
    found.append(_induced(rows.filter(F.col("size") <= group_rows).select(*names), span, kind))
    large = rows.filter(F.col("size") > group_rows).select(
        *names, F.lit(0).alias("ga"), F.lit(span - k).alias("gb"))
    while not large.isEmpty():
        level, repeated = _halved(large, span)
        level = stored(level, "level")
        found.append(repeated)
        sizes = level.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least")).filter(
            "size > 1 AND least = 1").select("h", "size")
        level = stored(level.join(sizes, "h"), "level")
        found.append(_induced(level.filter(F.col("size") <= group_rows).select(*names), span, kind))
        large = level.filter(F.col("size") > group_rows).select(*names, "ga", "gb")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def remove_repeats(docs: DataFrame, span: int = SPAN, k: int = K, id_col: str = "doc_id",
                   text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) of every document.

    The digest is that of the remaining bytes; ``kept_text`` is their text, without
    characters that lost a part of their bytes.  Documents that lose nothing are answered
    by their own scan.
    """
    table = stored(_scan(docs, span, k, id_col, text_col), "anchors")
    ranges = repeated_ranges(table, docs, span, k, id_col, text_col, group_rows)
    per_doc = stored(ranges.groupBy("id", "th").agg(
        F.collect_set(F.struct("s1", "s2")).alias("ranges")), "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import flat

        for b in batches:
            data, off = flat(b.column("t"))
            removed, spans, sha, kept = [], [], [], []
            for i, ranges in enumerate(b.column("ranges")):
                text = data[off[i]:off[i + 1]]
                delta = np.zeros(len(text) + 1, dtype=np.int32)
                for r in ranges.as_py() or []:
                    delta[r["s1"]] += 1
                    delta[r["s2"] + span] -= 1
                gone = np.cumsum(delta[:-1]) > 0
                rest = text[~gone].tobytes()
                removed.append(int(gone.sum()))
                spans.append(int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(off), pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    kind = table.schema["id"].dataType.simpleString()
    marked = may_contain(_texts(docs, id_col, text_col), "th", per_doc.select("th"), mark="met")
    none = F.lit(0).cast("long")
    whole = marked.filter("NOT met").select(
        F.col("id").alias(id_col), F.octet_length("t").cast("long").alias("n_bytes"), none.alias("n_removed"),
        none.alias("n_spans"), F.sha2(F.col("t").cast("binary"), 256).alias("kept_sha256"),
        F.col("t").alias("kept_text"))
    known = per_doc.select(F.col("id").alias("known_id"), F.col("th").alias("known_th"), "ranges")
    met = marked.filter("met").join(known, F.col("id").eqNullSafe(F.col("known_id"))
                                    & (F.col("th") == F.col("known_th")), "left")
    done = met.select("id", "t", "ranges").mapInArrow(
        tidy(cut), f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                   "kept_text string")
    return whole.unionByName(done)
