"""Near-duplicate classes by b-bit MinHash.

A document's set is its distinct 5-word shingles.  Per set PERMUTATIONS minima of
32-bit permutations are taken; BANDS bands of ROWS minima each (all bits) generate
candidates, and the low B bits of all minima are packed into a signature of
PERMUTATIONS * B / 64 longs.  Two signatures agree by chance in a share C = 2**-B of
places, so the similarity estimate is corrected: (agreement - C) / (1 - C), with the
agreement counted by ``bit_count`` of the folded xor.  Candidates whose estimate is
MARGIN standard errors below the threshold go; the rest are confirmed on full sets.

With 25 bands of 5 minima a pair of similarity 0.85 is missed by all bands with
probability 4e-7 (0.8: 5e-5, 0.9: 2e-10).

From candidates to components, without all pairs of any group:
1. Documents with equal sets (count and two 64-bit sums) form a class: a partial
   aggregate, so thousands of exact copies cost one row.  Only representatives go on.
2. Star round: in every band bucket each document is compared with the bucket's
   smallest document.  The pairs are linear in the bucket sizes; a tight group of any
   size becomes one component here.  (The bucket's smallest document comes from an
   aggregate and a join, which adaptive execution splits on a hot bucket.)
3. Rest: buckets that still hold two or more components beside the document that the
   star round compared with all; of several buckets with the same members one is
   taken.  Members are compared across components only, by signature first, then
   (those with a plausible partner) on full sets.  Buckets are cut into parts of PART
   members; a group is one pair of parts.  Groups stream through the tasks in order;
   a union-find emits a spanning forest, fewer links than members.
4. Components over both kinds of links (``components.connected``).

Links inside a component that is already connected are not looked for; no component
loses a member that a bucket connects.

Shuffles: band keys and ids (200 bytes per distinct document), signatures of
bucket members, and full sets of the documents with plausible partners only; their
texts are found with a bounded bitmap before they leave the scan.

Defined results: documents without words (null, empty, white space) have an empty
set and are linked with nothing; fewer than five words give one shingle; rows with
one doc_id are one document; rows with a null doc_id are linked with nothing, their
component_id is null and they are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.components import connected
from stratum.llm.frames import carried, may_contain, quoted, released, stored, tidy, without_keys

SHINGLE = 5
PERMUTATIONS = 128
B = 2
BANDS, ROWS = 25, 5
MARGIN = 5.0
PART = 1024
WORDS64 = PERMUTATIONS * B // 64

_rng = np.random.RandomState(97)
_MUL = (_rng.randint(0, 1 << 31, size=PERMUTATIONS).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _rng.randint(0, 1 << 32, size=PERMUTATIONS, dtype=np.uint64).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, row), each pair once, ordered by row and hash."""
    from stratum.llm.textops import NON_SPACE, Words, mix, run_hash

    words = Words(data, offsets, NON_SPACE)
    count = np.diff(words.first)
    hs, rows = [], []
    h = run_hash(words.code, k)
    if len(h):
        ok = words.doc[:len(h)] == words.doc[k - 1:]
        hs.append(mix(h[ok] + np.uint64(k)))
        rows.append(words.doc[:len(h)][ok])
    for size in range(1, k):
        short = np.flatnonzero(count == size)
        if len(short):
            hs.append(mix(run_hash(words.code, size)[words.first[short]] + np.uint64(size)))
            rows.append(short)
    if not hs:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    h, row = np.concatenate(hs), np.concatenate(rows)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def sketch(h: np.ndarray, row: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Counts, set digests, band keys and packed signatures of ``n`` rows."""
    from stratum.llm.textops import mix

    count = np.bincount(row, minlength=n)
    full = np.flatnonzero(count)
    starts = np.concatenate([[0], np.cumsum(count[full])[:-1]]).astype(np.int64)
    g1, g2 = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    keys = np.zeros((n, BANDS), dtype=np.uint64)
    signature = np.zeros((n, WORDS64), dtype=np.uint64)
    if len(full):
        g1[full] = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), starts)
        g2[full] = np.bitwise_xor.reduceat(mix(h + np.uint64(0x14057B7EF767814F)), starts)
        x = (h >> np.uint64(32)).astype(np.uint32)
        low = np.empty((PERMUTATIONS, len(full)), dtype=np.uint32)
        for p in range(PERMUTATIONS):
            low[p] = np.minimum.reduceat(x * _MUL[p] + _ADD[p], starts)
        for band in range(BANDS):
            key = np.full(len(full), band + 1, dtype=np.uint64)
            for p in range(band * ROWS, (band + 1) * ROWS):
                key = mix(key ^ low[p])
            keys[full, band] = key
        per = 64 // B
        for p in range(PERMUTATIONS):
            bits = low[p].astype(np.uint64) & np.uint64((1 << B) - 1)
            signature[full, p // per] |= bits << np.uint64(B * (p % per))
    return {"n": count, "g1": g1, "g2": g2, "keys": keys, "signature": signature}


def _sketch_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        lists = lambda m: pa.ListArray.from_arrays(
            pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]),
            pa.array(m.view(np.int64).ravel()))
        for b in batches:
            data, off = flat(b.column("t"))
            for i, j in blocks(off):
                s = sketch(*shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i]), j - i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(i, j - i), pa.array(s["n"].astype(np.int64)),
                     pa.array(s["g1"].view(np.int64)), pa.array(s["g2"].view(np.int64)),
                     lists(s["keys"]), lists(s["signature"])],
                    names=["id", "n", "g1", "g2", "keys", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(
        tidy(run), "id long, n long, g1 long, g2 long, keys array<long>, sig array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, s): sorted shingle hashes of the documents whose id is in ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stratum.llm.textops import blocks, flat

        for b in batches:
            data, off = flat(b.column("t"))
            for i, j in blocks(off):
                h, row = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i])
                cut = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(h.view(np.int64)))],
                    names=["id", "s"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # The bitmap lets a few unwanted ids through; the joins with ``s`` drop them.
    return may_contain(texts, "id", wanted).mapInArrow(tidy(run), "id long, s array<long>")


def least_estimate(threshold: float, margin: float = MARGIN) -> float:
    """Estimates below this are ``margin`` standard errors under the threshold."""
    c = 2.0 ** -B
    p = c + (1 - c) * threshold
    return threshold - margin * float(np.sqrt(p * (1 - p) / PERMUTATIONS)) / (1 - c)


def _estimate(a: str, b: str) -> Column:
    """Collision-corrected similarity of two packed signatures, by bit counts."""
    low = sum(1 << (B * i) for i in range(64 // B))
    parts = []
    for w in range(WORDS64):
        x = f"({a}[{w}] ^ {b}[{w}])"
        folded = " | ".join([x] + [f"shiftrightunsigned({x}, {s})" for s in range(1, B)])
        parts.append(f"bit_count(({folded}) & {low}L)")
    c = 2.0 ** -B
    return F.expr(f"((1D - ({' + '.join(parts)}) / {PERMUTATIONS}D) - {c}D) / {1 - c}D")


def _close(na: str, nb: str, percent: int) -> Column:
    """The smaller set can reach the threshold with the larger one."""
    return F.expr(f"100 * least({na}, {nb}) >= {percent} * greatest({na}, {nb})")


SMALL = 24  # members; groups up to this size are compared together, by size


def _agreement(sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of rows a and b of the packed signatures."""
    low = np.uint64(sum(1 << (B * i) for i in range(64 // B)))
    x = sig[a] ^ sig[b]
    folded = x.copy()
    for s in range(1, B):
        folded |= x >> np.uint64(s)
    c = 2.0 ** -B
    return ((1 - np.bitwise_count(folded & low).sum(axis=-1) / PERMUTATIONS) - c) / (1 - c)


def plausible_pairs(start: np.ndarray, half: np.ndarray, comp: np.ndarray, n: np.ndarray,
                    sig: np.ndarray, percent: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of one group, from different components, that may be similar.

    ``start`` bounds the groups.  Within a group pairs are taken between the halves, or
    among all members when there is one half.  Yields arrays of at most some million pairs.
    """
    def picked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = (comp[a] != comp[b]) & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
        a, b = a[ok], b[ok]
        ok = _agreement(sig, a, b) >= least
        return a[ok], b[ok]

    size = np.diff(start)
    first = start[:-1]
    split = np.maximum.reduceat(half, first) != np.minimum.reduceat(half, first)
    for m in np.unique(size[(size <= SMALL) & (size > 1) & ~split]).tolist():
        groups = first[(size == m) & ~split]
        i, j = np.triu_indices(m, 1)
        step = max(1, (1 << 20) // len(i))
        for at in range(0, len(groups), step):
            g = groups[at:at + step, None]
            yield picked((g + i).ravel(), (g + j).ravel())
    for g in np.flatnonzero((size > SMALL) | split):
        rows = np.arange(start[g], start[g + 1])
        lower = half[rows] == half[rows].min()
        left, right = rows[lower], rows[~lower]
        if not len(right):
            for k in range(len(left) - 1):
                yield picked(np.full(len(left) - k - 1, left[k]), left[k + 1:])
        else:
            for x in left:
                yield picked(np.full(len(right), x), right)


def _groupwise(rows: DataFrame, percent: int, least: float, use_sets: bool) -> DataFrame:
    """Works through groups (key, pair) that arrive complete and in order.

    Without sets: (key, rep) of members with a plausible partner.  With sets: confirmed
    links (a, b); a union-find over the components of the batch skips pairs that are
    connected already, so a group yields fewer links than members.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.nbytes for x in held) < 1 << 22:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key, pair = table["key"].to_numpy(), table["pair"].to_numpy()
            last = np.flatnonzero((key != key[-1]) | (pair != pair[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield solve(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    def solve(table: pa.Table) -> pa.RecordBatch:
        key, pair, rep, comp, n, half = (table[c].to_numpy().astype(np.int64) for c in
                                         ("key", "pair", "rep", "comp", "n", "half"))
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])
        start = np.append(np.flatnonzero(new), len(key))
        lists = lambda c: table[c].combine_chunks() if isinstance(table[c], pa.ChunkedArray) else table[c]
        sig = lists("sig")
        if isinstance(sig, pa.ChunkedArray):
            sig = sig.chunk(0)
        sig = sig.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, WORDS64)
        found = plausible_pairs(start, half, comp, n, sig, percent, least)
        if not use_sets:
            hit = np.zeros(len(key), dtype=bool)
            for a, b in found:
                hit[a] = hit[b] = True
            return pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(rep[hit])], names=["key", "rep"])
        sets = lists("s")
        if isinstance(sets, pa.ChunkedArray):
            sets = sets.chunk(0)
        off = sets.offsets.to_numpy().astype(np.int64)
        values = sets.values.to_numpy(zero_copy_only=False).view(np.uint64)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links = []
        for a, b in found:
            for i, j in zip(a.tolist(), b.tolist()):
                x, y = root(int(comp[i])), root(int(comp[j]))
                if x == y:
                    continue
                s, t = values[off[i]:off[i + 1]], values[off[j]:off[j + 1]]
                common = np.count_nonzero(t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s)
                if 100 * common >= percent * (len(s) + len(t) - common):
                    parent[max(x, y)] = min(x, y)
                    links.append((int(rep[i]), int(rep[j])))
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())],
            names=["a", "b"])

    columns = ["key", "pair", "rep", "comp", "n", "half", "sig"] + (["s"] if use_sets else [])
    ordered = rows.select(*columns).repartition("key", "pair").sortWithinPartitions("key", "pair")
    return ordered.mapInArrow(tidy(run), "a long, b long" if use_sets else "key long, rep long")


def _member_parts(members: DataFrame, part: int) -> DataFrame:
    """Members (key, rep, ...) once per pair of parts of their bucket: (key, pair, half).

    Parts are chosen by hash and hold about ``part`` members; a bucket with p parts
    has p * (p + 1) / 2 pairs, and a member takes part in p of them.
    """
    count = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / part).cast("long").alias("parts"))
    rows = members.join(count, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pair = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    return rows.withColumn("pair", pair).withColumn(
        "half", (F.col("own") > F.col("other")).cast("int")).drop("parts", "own", "other")


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document.

    Links have 100 * intersection >= ``percent`` * union, on full shingle sets.
    """
    least = least_estimate(percent / 100)
    table = stored(_sketch_rows(docs, id_col, text_col), "sketches")
    some = table.filter((F.col("n") > 0) & F.col("id").isNotNull())
    # Classes of equal sets; the members agree in keys and signature.
    classes = stored(some.groupBy("n", "g1", "g2").agg(
        F.min("id").alias("rep"), F.first("keys").alias("keys"), F.first("sig").alias("sig")), "classes")
    member = some.select("id", "n", "g1", "g2").join(
        classes.select("n", "g1", "g2", "rep"), ["n", "g1", "g2"]).select("id", "rep")
    member = stored(member.distinct(), "members")
    # An id that occurs with several sets ties their classes together.
    twice = member.groupBy("id").agg(F.min("rep").alias("m"), F.max("rep").alias("x")).filter("m <> x")
    tied = member.join(twice, "id").filter("rep <> m").select(F.col("rep").alias("a"), F.col("m").alias("b"))

    bands = classes.select("rep", F.explode("keys").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last"))
    shared = stored(bands.join(buckets.filter("center <> last"), "key").select(
        "key", "rep", "center"), "buckets")

    info = classes.select("rep", "n", "sig")
    stars = shared.filter("rep <> center").select("rep", "center").distinct()
    stars = stars.join(info, "rep").join(
        info.select(F.col("rep").alias("center"), F.col("n").alias("cn"), F.col("sig").alias("csig")),
        "center")
    stars = stored(stars.filter(_close("n", "cn", percent) & (_estimate("sig", "csig") >= least)).select(
        "rep", "center"), "stars")
    wanted = stars.select("rep").union(stars.select("center"))
    sets = stored(_full_sets(docs, wanted, id_col, text_col), "sets")
    confirmed = stars.join(sets.withColumnRenamed("id", "rep"), "rep").join(
        sets.select(F.col("id").alias("center"), F.col("s").alias("cs")), "center")
    common = F.size(F.array_intersect("s", "cs"))
    confirmed = confirmed.filter(
        common * 100 >= (F.size("s") + F.size("cs") - common) * percent).select(
        F.col("rep").alias("a"), F.col("center").alias("b"))
    first = stored(connected(confirmed.unionByName(tied), "first"), "first")

    # Buckets that still hold several components beside their smallest document, whose
    # pairs the star round has decided; of buckets with the same members one is enough.
    others = shared.filter("rep <> center").join(
        first.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = others.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"),
        F.bit_xor(F.xxhash64("rep")).alias("x1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x2")).filter(
        "lo <> hi").groupBy("m", "x1", "x2").agg(F.min("key").alias("key"))
    rest = stored(others.join(mixed.select("key"), "key").join(info, "rep"), "rest")
    near = _groupwise(_member_parts(rest, PART), percent, least, False)
    near = stored(near.distinct(), "plausible")
    sets = _full_sets(docs, near.select("rep").distinct(), id_col, text_col)
    chosen = rest.join(near, ["key", "rep"]).join(sets.withColumnRenamed("id", "rep"), "rep")
    more = _groupwise(_member_parts(stored(chosen, "chosen"), PART), percent, least, True)
    links = first.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)
    final = connected(links, "final")

    found = member.join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("id").alias("_id"), F.coalesce("component", "rep").alias("component")).groupBy("_id").agg(
        F.min("component").alias("component"))
    out = table.select("id", "n").join(found, F.col("id") == F.col("_id"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, text, key): all columns in ``row``; ``key`` tells documents apart.

    The key is the id.  Rows whose id is null or occurs more than once are told apart by
    their texts: equal (id, text) are one document, and each gets a number beyond the
    greatest id.
    """
    rows = carried(docs, id=F.col(quoted(id_col)).cast("long"), text=F.col(quoted(text_col)),
                   th=F.xxhash64(F.coalesce(F.col(quoted(text_col)), F.lit(""))))
    odd = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("id IS NULL OR n > 1").select("id")
    marked = may_contain(rows, "id", stored(odd, "repeated"), mark="odd")
    numbers = stored(marked.filter("odd").select("id", "th").distinct().withColumn(
        "number", F.monotonically_increasing_id()), "numbers").select(
        F.col("id").alias("own"), F.col("th").alias("own_th"), "number")
    top = rows.agg(F.max("id")).first()[0] or 0
    same = F.col("id").eqNullSafe(F.col("own")) & (F.col("th") == F.col("own_th"))
    again = marked.filter("odd").join(numbers, same).select(
        "row", "text", (F.col("number") + F.lit(top + 1)).alias("key"), F.lit(True).alias("odd"))
    return marked.filter("NOT odd").select("row", "text", F.col("id").alias("key"), "odd").unionByName(again)


def drop_near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text", by_text: bool = False) -> DataFrame:
    """One document of each class, with all its columns: the one of least id.

    Of rows that share an id the one with the smallest text stays; rows with a null id stay.
    With ``by_text`` rows that share an id (or have none) are documents of their own where
    their texts differ, and one document where they agree; documents with a unique id go
    before them.  Only rows that go, or whose id repeats, are shuffled.
    """
    if by_text:
        rows = _numbered(docs, id_col, text_col)
        least = F.xxhash64("row"),
    else:
        rows = carried(docs, key=F.col(quoted(id_col)), text=F.col(quoted(text_col)))
        least = F.xxhash64("text"), F.col("text")
    decided = near_duplicates(rows.select(F.col("key").alias("id"), "text"), percent, "id", "text")
    gone = stored(decided.filter("NOT kept").select(F.col("id").alias("key")).distinct(), "gone")
    left = without_keys(rows, gone)
    if not by_text:
        repeated = rows.filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        left = may_contain(left, "key", stored(repeated.select("key"), "repeated"), mark="odd").withColumn(
            "odd", F.coalesce(F.col("odd"), F.lit(False)) & F.col("key").isNotNull())
    one = F.row_number().over(Window.partitionBy("key").orderBy(*least))
    single = left.filter("odd").withColumn("n", one).filter("n = 1")
    kept = left.filter("NOT odd").select("row").unionByName(single.select("row"))
    return released(kept, docs.columns)
