"""Vector code compression: product codebooks by member-resident Lloyd rounds.

Every vector becomes integers floor(scale * x) and is cut into ``parts`` equal
consecutive parts; a part is coded by the index of the nearest entry of its
position's codebook.  The parts live with their owners: blocks of members dealt by
(position, entry, salt).  In one round

* every owner compares its resident members with the codebook of the round.  Members
  that keep their entry stay where they are (rewritten by the task that read them,
  without a shuffle); only members that change entry are shuffled to the new owner;
* owners sum their residents while they write them; a small aggregate of these sums
  gives the next codebook.  Entries without members stay.

The salt spreads an entry that holds a large share of all parts over many owners, and
a block holds at most BLOCK_BYTES of parts, so neither tasks nor rows grow with the
number of members.  What reaches the driver is the codebook's size: one sum for each
position, entry, component and 31-bit limb.  Each round's residents are files below
spark.checkpoint.dir, so a lost executor costs one round's reading at most; the files
of a finished round are removed.  The last assignment is a narrow pass over the
vectors themselves: codes and errors need no shuffle.

All arithmetic is exact: float64 products while every partial result is below 2**53,
64-bit integers beyond, Python integers for components of any finite size (only the
rows and entries that need them).

Defined results: vectors that are null or hold null or non-finite components are left
out.  Repeated rows and repeated ids are vectors of their own; the starting entries
are the rows of least id (null ids last, ties by the vector).  With fewer than
``entries`` vectors the codebooks have that many entries.  Vectors of unequal length,
or of a length that ``parts`` does not divide, are filled up with zeros to the longest
one's next multiple.  An error beyond 64 bits is null, and so is the label_error of
its label.  Other columns are not looked at.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.frames import stored, tidy
from stratum.session import work_path

BLOCK_BYTES = 1 << 18   # of 64-bit components in one block of members
OWNER_PARTS = 1 << 16   # members of one owner when all entries are alike
HOT_LABELS = 64         # labels with more than 1/64 of the rows are joined by broadcast
LIMB = 31

_SUMS = pa.list_(pa.struct([("d", pa.int32()), ("limb", pa.int32()), ("v", pa.int64())]))
_FIELDS = [("pos", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("moved", pa.bool_()),
           ("n", pa.int32()), ("members", pa.binary()), ("sums", _SUMS)]
_BLOCK = ("pos int, entry int, salt int, moved boolean, n int, members binary, "
          "sums array<struct<d:int,limb:int,v:bigint>>")


# ---------------------------------------------------------------- exact arithmetic
def _peak(m: np.ndarray) -> int:
    return max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0


def as_integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles; Python integers where 62 bits do not hold them."""
    with np.errstate(over="ignore"):
        v = np.floor(values * float(scale))
    if not len(v) or np.abs(v).max() < 2.0 ** 62:
        return v.astype(np.int64)
    # From 2**53 on a double is an integer itself, so its product is exact there.
    return np.array([int(x) * scale if abs(x) >= 2.0 ** 53 else int(f)
                     for x, f in zip(values.tolist(), v.tolist())], dtype=object)


def _fit(m: np.ndarray) -> np.ndarray:
    """As 64-bit integers where they fit."""
    return m.astype(np.int64) if m.dtype == object and _peak(m) < 1 << 62 else m


def _plain(m: np.ndarray, c: np.ndarray, kind) -> np.ndarray:
    x, y = m.astype(kind), c.astype(kind)
    return (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :]


def nearest(m: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every row of ``m``; ties to the lower entry."""
    n, d = m.shape
    room = max(_peak(m), _peak(c))
    room = 4 * room * room * max(d, 1)
    if room < 1 << 62:
        dist = _plain(m, c, np.float64 if room < 1 << 53 else np.int64)
        e = dist.argmin(axis=1)
        return e, dist[np.arange(n), e].astype(np.int64)
    # Some rows or entries are very large: only these are compared as Python integers.
    limit = int(np.sqrt((1 << 59) / max(d, 1)))
    tall = np.array([_peak(r) > limit for r in m])
    far = [j for j in range(len(c)) if _peak(c[j]) > limit]
    near = [j for j in range(len(c)) if _peak(c[j]) <= limit]
    entry = np.zeros(n, dtype=np.int64)
    best = np.empty(n, dtype=object)
    low = np.flatnonzero(~tall)
    if len(near) and len(low):
        e, s = nearest(_fit(m[low]), _fit(c[near]))
        entry[low] = np.array(near)[e]
        best[low] = s.astype(object)
    top = max((best[i] for i in low), default=0) if len(near) else None
    reach = _peak(m[low]) if len(low) else 0
    for j in range(len(c)):
        rows = np.arange(n)
        if j in near:
            rows = np.flatnonzero(tall)
        elif top is not None and (_peak(c[j]) - reach) ** 2 > top:
            rows = np.flatnonzero(tall)  # further from every small row than its entry
        for i in rows:
            s = sum((int(a) - int(b)) ** 2 for a, b in zip(m[i], c[j]))
            if best[i] is None or s < best[i] or (s == best[i] and j < entry[i]):
                best[i], entry[i] = s, j
    return entry, best


# ----------------------------------------------------------------- blocks of members
def _pack(m: np.ndarray) -> bytes:
    if m.dtype == object:
        return b"t" + json.dumps([[int(v) for v in r] for r in m]).encode()
    peak = _peak(m)
    code, kind = (b"2", np.int16) if peak < 1 << 15 else (
        (b"4", np.int32) if peak < 1 << 31 else (b"8", np.int64))
    return code + m.astype(kind).tobytes()


def _unpack(raw: bytes, n: int, dims: int) -> np.ndarray:
    if raw[:1] == b"t":
        return np.array(json.loads(raw[1:]), dtype=object).reshape(n, dims)
    kind = {b"2": np.int16, b"4": np.int32, b"8": np.int64}[raw[:1]]
    return np.frombuffer(raw, kind, offset=1).reshape(n, dims).astype(np.int64)


def _sums(m: np.ndarray) -> list[dict]:
    out = [{"d": -1, "limb": 0, "v": len(m)}]
    wide = _peak(m) * max(len(m), 1) >= 1 << 62
    total = (m.astype(object) if wide else m).sum(axis=0)
    for d, v in enumerate(total.tolist()):
        v, limb = int(v), 0
        while v not in (0, -1) and limb < 64:
            out.append({"d": d, "limb": limb, "v": v & ((1 << LIMB) - 1)})
            v >>= LIMB
            limb += 1
        if v == -1:  # the rest of a negative number
            out.append({"d": d, "limb": limb, "v": -1})
        elif v:
            raise OverflowError("component sum beyond 64 limbs")
    return out


class _Owners:
    """Gathers members by owner and gives out full blocks."""

    def __init__(self, dims: int):
        self.room = max(64, BLOCK_BYTES // (8 * max(dims, 1)))
        self.held: dict[tuple, list[np.ndarray]] = {}
        self.size: dict[tuple, int] = {}

    def add(self, owner: tuple, m: np.ndarray):
        """``owner``: (position, entry, salt, moved)."""
        if not len(m):
            return
        self.held.setdefault(owner, []).append(m)
        self.size[owner] = self.size.get(owner, 0) + len(m)
        if self.size[owner] >= self.room:
            yield from self.flush([owner])

    def flush(self, owners=None):
        for o in list(self.held) if owners is None else owners:
            held = self.held.pop(o)
            self.size.pop(o)
            wide = any(h.dtype == object for h in held)
            m = np.concatenate([h.astype(object) if wide else h for h in held])
            for at in range(0, len(m), self.room):
                b = _fit(m[at:at + self.room])
                yield (*o, len(b), _pack(b), None if o[3] else _sums(b))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_FIELDS)],
        names=[n for n, _ in _FIELDS])


def _in_batches(rows: Iterator[tuple], size: int = 16) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _matrix(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to ``width`` components."""
    n = len(column)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = as_integers(column.flatten().to_numpy(zero_copy_only=False), scale)
    out = np.zeros((n, width), dtype=values.dtype)
    row = np.repeat(np.arange(n), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    x = F.col(vector_col).cast("array<double>")
    usable = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v)
                                       | (F.abs(v) == float("inf")))
    return vectors.filter(usable).select(F.col(id_col).alias("id"), x.alias("x"),
                                         F.col(label_col).alias("label"))


def _move(residents: DataFrame, centres: list[np.ndarray], dims: int) -> DataFrame:
    """Members that stay (same owner) and members that change entry, told by ``moved``."""
    shared = residents.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            owners = _Owners(dims)
            for b in batches:
                for r in b.to_pylist():
                    m = _unpack(r["members"], r["n"], dims)
                    e, _ = nearest(m, shared.value[r["pos"]])
                    for to in np.unique(e).tolist():
                        owner = (r["pos"], to, r["salt"], to != r["entry"])
                        yield from owners.add(owner, m[e == to])
            yield from owners.flush()

        yield from _in_batches(rows())

    return residents.mapInArrow(tidy(run), _BLOCK)


def _settle(blocks: DataFrame, partitions: int, dims: int) -> DataFrame:
    """Moved members brought to their owners: the only shuffle of a round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            owners = _Owners(dims)
            last = None
            for b in batches:
                for r in b.to_pylist():
                    owner = (r["pos"], r["entry"], r["salt"], False)
                    if last not in (None, owner):
                        yield from owners.flush()
                    last = owner
                    yield from owners.add(owner, _unpack(r["members"], r["n"], dims))
            yield from owners.flush()

        yield from _in_batches(rows())

    return blocks.repartition(partitions, "pos", "entry", "salt").sortWithinPartitions(
        "pos", "entry", "salt").mapInArrow(tidy(run), _BLOCK)


def _new_centres(residents: DataFrame, centres: list[np.ndarray]) -> list[np.ndarray]:
    """floor(sum / count) of every entry's resident members; unused entries stay."""
    rows = residents.select("pos", "entry", F.inline("sums")).groupBy(
        "pos", "entry", "d", "limb").agg(F.sum("v").alias("v")).collect()
    total: dict[tuple, int] = {}
    for r in rows:
        key = (r["pos"], r["entry"], r["d"])
        total[key] = total.get(key, 0) + (r["v"] << (LIMB * r["limb"]))
    out = []
    for p, c in enumerate(centres):
        m = c.astype(object)
        for e in range(len(c)):
            n = total.get((p, e, -1), 0)
            if n:
                m[e] = [total.get((p, e, d), 0) // n for d in range(c.shape[1])]
        out.append(_fit(m))
    return out


def _remove(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fit_codebooks(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6,
                  scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str = "label", owner_parts: int = OWNER_PARTS) -> list[np.ndarray]:
    """The codebook of every position: an integer matrix (entry, component)."""
    spark = vectors.sparkSession
    kept = _kept(vectors, id_col, vector_col, label_col)
    shape = kept.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("longest")).first()
    dims = -(-(shape["longest"] or 0) // parts)
    width = dims * parts
    first = kept.orderBy(F.col("id").asc_nulls_last(), "x").select("x").limit(entries).toArrow()
    start = _matrix(first["x"].combine_chunks(), width, scale) if len(first) else np.zeros((0, width), np.int64)
    centres = [_fit(start[:, p * dims:(p + 1) * dims]) for p in range(parts)]
    if not shape["n"]:
        return centres
    salts = max(4, -(-shape["n"] // (entries * owner_parts)))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                     -(-parts * shape["n"] // (4 * owner_parts)))
    shared = spark.sparkContext.broadcast(centres)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def rows():
            owners, turn = _Owners(dims), TaskContext.get().partitionId()
            for b in batches:
                m = _matrix(b.column("x"), width, scale)
                for p in range(parts):
                    x = _fit(m[:, p * dims:(p + 1) * dims])
                    e, _ = nearest(x, shared.value[p])
                    for to in np.unique(e).tolist():
                        turn += 1
                        yield from owners.add((p, to, turn % salts, True), x[e == to])
            yield from owners.flush()

        yield from _in_batches(rows())

    folder = work_path(spark, "llm", "lloyd", unique=True)
    read = lambda path: spark.read.schema(_BLOCK).parquet(path)
    _settle(kept.select("x").mapInArrow(tidy(deal), _BLOCK), partitions, dims).drop(
        "moved").write.parquet(f"{folder}/0/arrived")
    residents = read(f"{folder}/0/arrived")
    for r in range(rounds):
        centres = _new_centres(residents, centres)
        if r == rounds - 1:
            break
        at, done = f"{folder}/{r + 1}", f"{folder}/{r}"
        _move(residents, centres, dims).write.partitionBy("moved").parquet(f"{at}/compared")
        compared = read(f"{at}/compared")
        _settle(compared.filter("moved"), partitions, dims).drop("moved").write.parquet(f"{at}/arrived")
        residents = compared.filter("NOT moved").unionByName(read(f"{at}/arrived"))
        _remove(spark, done)
    _remove(spark, folder)
    return centres


def codebook_digest(centres: list[np.ndarray]) -> str:
    """sha256 of all components in decimal, by part, entry and position within the part."""
    return hashlib.sha256(",".join(
        str(int(v)) for c in centres for row in c for v in row).encode()).hexdigest()


def encode(vectors: DataFrame, centres: list[np.ndarray], scale: int = 4096,
           id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """(id, label, code, error) of every usable vector: one narrow pass."""
    parts, dims = len(centres), centres[0].shape[1]
    kept = _kept(vectors, id_col, vector_col, label_col)
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("x"), parts * dims, scale)
            codes, error = np.zeros((len(m), parts), np.uint8), np.zeros(len(m), dtype=object)
            for p in range(parts):
                e, s = nearest(_fit(m[:, p * dims:(p + 1) * dims]), shared.value[p])
                codes[:, p] = e
                error = error + s.astype(object)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array([v if v < 1 << 63 else None for v in error], pa.int64())],
                names=["id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    return kept.select("id", "label", "x").mapInArrow(
        tidy(run), f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Errors summed over equal labels (nulls together), without a task per label.

    Labels with more than 1/HOT_LABELS of the rows number fewer than HOT_LABELS, so they
    are broadcast; the rows of every other label are few and joined by a shuffle.
    """
    total = coded.count()
    sums = coded.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("error").isNull()).alias("lost"),
        F.sum(F.col("error").cast("decimal(19,0)")).alias("s"))
    sums = sums.select(F.col("label").alias("lab"), (F.col("n") * HOT_LABELS > total).alias("hot"),
                       F.expr("CASE WHEN lost = 0 THEN try_cast(s AS bigint) END").alias("label_error"))
    same = F.col("label").eqNullSafe(F.col("lab"))
    hot = F.broadcast(sums.filter("hot"))
    columns = ["id", "code", "error", "label_error"]
    out = coded.join(hot, same).select(*columns)
    rest = coded.join(hot.select("lab"), same, "left_anti")
    return out.unionByName(rest.join(sums.filter("NOT hot"), same).select(*columns))


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6,
             scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label", owner_parts: int = OWNER_PARTS) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every usable vector.

    ``entries`` is at most 256 (two hex digits an index).
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    centres = fit_codebooks(vectors, parts, entries, rounds, scale, id_col, vector_col,
                            label_col, owner_parts)
    coded = stored(encode(vectors, centres, scale, id_col, vector_col, label_col), "codes")
    return _with_label_error(coded).select(
        F.col("id").alias(id_col), "code", "error", "label_error",
        F.lit(codebook_digest(centres)).alias("codebooks_sha256"))
