"""A key-bucketed table with one manifest per version: upserts that write what changed.

Layout below ``path``::

    _manifests/v000003.json       which writes make up version 3, and for which buckets
    data/w=<id>/_bucket=<b>/...   one folder per write and bucket, never changed again

Rows belong to a bucket by the hash of the ``bucket_by`` columns (the keys, or some of
them).  The unit of an upsert is a key with all its rows: a later write that holds a key
replaces the rows that earlier writes hold for it.

* An upsert writes the source's keys only, as a *delta* of the touched buckets.  A
  bucket whose deltas hold more than ``compact_at`` of its rows is rewritten as one
  *base* in the same upsert, so a merge of one percent of the keys writes one percent of
  the rows, and the rewriting paid later is in proportion to the rows merged.
* Reading takes the bases of all buckets; only buckets with deltas are joined with the
  keys of those deltas (an anti join whose right side the planner broadcasts or shuffles
  by its size), so untouched buckets are plain scans.
* A version is published by creating its manifest, which fails if the file exists: readers
  always see one whole version, a concurrent writer gets an error instead of lost rows, and
  an attempt that died leaves files that no manifest names (``vacuum`` removes them).

The manifest holds numbers per bucket, so it is bounded by the bucket count, not by the
rows.  Keys are compared null-safe.  A hot bucket column value lands in one bucket: choose
``bucket_by`` so that it is spread, or unique.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.scd import latest_per_key
from stratum.session import work_path
from stratum.sources.evolution import common_schema, conform

BUCKET = "_bucket"
BUCKETS = 32          # default; choose it so that a bucket holds some hundred MB
OPEN_BUCKETS = 8      # up to so many buckets, a task writes to all of them
COMPACT_AT = 0.25     # delta bytes of a bucket, as a share of its base bytes
MAX_WRITES = 24       # live writes; beyond, the oldest deltas' buckets are rewritten too
_NAME = re.compile(r"^v(\d{6})\.json$")
_FOLDER = re.compile(rf"/{BUCKET}=(\d+)/part-")


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/_manifests"


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _path(spark, _manifests(path))
    if not fs.exists(p):
        return []
    found = (_NAME.match(st.getPath().getName()) for st in fs.listStatus(p))
    return sorted(int(m.group(1)) for m in found if m)


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The manifest of ``version`` (default: the newest), or None for an absent table."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    fs, p = _path(spark, f"{_manifests(path)}/v{version:06d}.json")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


class VersionConflict(RuntimeError):
    """Another writer published this version first; read again and repeat the upsert."""


def _publish(spark: SparkSession, path: str, m: dict) -> None:
    """Write the manifest aside and rename it: it appears whole, and only once."""
    fs, final = _path(spark, f"{_manifests(path)}/v{m['version']:06d}.json")
    _, aside = _path(spark, f"{_manifests(path)}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(m, sort_keys=True).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(aside, final):
        fs.delete(aside, False)
        raise VersionConflict(f"version {m['version']} of {path} exists")


@contextmanager
def unsorted_writes(spark: SparkSession, folders: int) -> Iterator[None]:
    """Writes by partition column keep up to ``folders`` files open in a task instead of
    sorting its rows by that column first: the sort spills once a task holds many rows."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(folders))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared work folder and read back: later steps that
    use it several times, or after an executor is lost, read files."""
    path = work_path(df.sparkSession, "staged", name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------------------ reading
def _schema(m: dict) -> T.StructType:
    return T.StructType.fromJson(m["schema"])


def _write_frame(spark: SparkSession, path: str, w: dict) -> DataFrame:
    """The rows of one write that the manifest still names, with their bucket."""
    schema = T.StructType.fromJson(w["schema"])
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(
        f"{path.rstrip('/')}/data/w={w['id']}")
    return df if w["whole"] else df.filter(F.col(BUCKET).isin(w["buckets"]))


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the table's schema and the bucket: missing ones null, narrower types widened."""
    return conform(df, T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]))


def _same(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    cond = left[BUCKET] == right[BUCKET]
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"__k_{k}"])
    return cond


def _without(rows: DataFrame, newer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``newer``."""
    seen = newer.select(BUCKET, *[F.col(k).alias(f"__k_{k}") for k in keys]).distinct()
    return rows.join(seen, _same(keys, rows, seen), "left_anti")


def _resolve(spark: SparkSession, path: str, m: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    """Current rows (with their bucket) of a version, of the given buckets or of all."""
    schema, keys = _schema(m), m["keys"]
    part = None if buckets is None else set(buckets)
    pick = lambda df: df if part is None else df.filter(F.col(BUCKET).isin(sorted(part)))
    live = [w for w in m["writes"] if part is None or part & set(w["buckets"])]
    bases = [w for w in live if w["kind"] == "base"]
    deltas = [w for w in live if w["kind"] == "delta"]
    frames = {w["id"]: pick(_aligned(_write_frame(spark, path, w), schema)) for w in live}
    dirty = sorted(set().union(*[set(w["buckets"]) for w in deltas]) & (part or set(range(m["n_buckets"])))) \
        if deltas else []
    out: DataFrame | None = None

    def add(df: DataFrame) -> None:
        nonlocal out
        out = df if out is None else out.unionByName(df)

    for w in bases:
        if not deltas:
            add(frames[w["id"]])
            continue
        clean = [b for b in w["buckets"] if b not in set(dirty)]
        if clean:
            add(frames[w["id"]].filter(F.col(BUCKET).isin(clean)))
    # Newest first: a write's rows count unless a newer write of the bucket holds their key.
    newer: DataFrame | None = None
    for w in reversed(deltas):
        df = frames[w["id"]]
        add(df if newer is None else _without(df, newer, keys))
        keyed = df.select(BUCKET, *keys)
        newer = keyed if newer is None else newer.unionByName(keyed)
    if newer is not None:
        held = None
        for w in bases:
            mine = [b for b in w["buckets"] if b in set(dirty)]
            if mine:
                df = frames[w["id"]].filter(F.col(BUCKET).isin(mine))
                held = df if held is None else held.unionByName(df)
        if held is not None:
            add(_without(held, newer, keys))
    if out is None:
        empty = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return spark.createDataFrame([], empty)
    return out


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The rows of a version (default: the newest); None for an absent table."""
    m = manifest(spark, path, version)
    return None if m is None else _resolve(spark, path, m).drop(BUCKET)


def read_keys(spark: SparkSession, path: str, keys: DataFrame, version: int | None = None) -> DataFrame | None:
    """Rows whose values in the columns of ``keys`` occur there; reads their buckets only.

    The columns of ``keys`` must include the table's ``bucket_by`` columns.
    """
    m = manifest(spark, path, version)
    if m is None:
        return None
    keyed = keys.withColumn(BUCKET, _bucket_of(m["bucket_by"], m["n_buckets"]))
    # At most n_buckets numbers; only they are shuffled for it, not the keys.
    touched = [r[BUCKET] for r in keyed.select(BUCKET).distinct().collect()]
    rows = _resolve(spark, path, m, touched)
    names = keys.columns
    seen = keyed.distinct().select(BUCKET, *[F.col(k).alias(f"__k_{k}") for k in names])
    return rows.join(seen, _same(names, rows, seen), "left_semi").drop(BUCKET)


# ------------------------------------------------------------------------------ writing
def key_hash(columns: Sequence[str]) -> Column:
    # Text form: a key that comes as int in one source and as bigint in another is the same.
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _bucket_of(columns: Sequence[str], n: int) -> Column:
    return F.pmod(key_hash(columns), F.lit(n)).cast("int").alias(BUCKET)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name != BUCKET])


def _write(df: DataFrame, path: str, kind: str, n_buckets: int) -> dict | None:
    """One write: folders by bucket; returns its manifest entry (None when empty)."""
    spark = df.sparkSession
    wid = uuid.uuid4().hex[:12]
    folder = f"{path.rstrip('/')}/data/w={wid}"
    # With few buckets every task writes its rows of all of them: rows do not move, and the
    # write has as many tasks as the rows before it.  Many buckets would make many small files.
    rows = df if n_buckets <= OPEN_BUCKETS else df.repartition(BUCKET)
    with unsorted_writes(spark, min(n_buckets, BUCKETS)):
        rows.write.partitionBy(BUCKET).parquet(folder)
    schema = _nullable(df.schema)
    sizes = _sizes(spark, folder)
    if not sizes:
        return None
    return {"id": wid, "kind": kind, "buckets": sorted(sizes), "bytes": [sizes[b] for b in sorted(sizes)],
            "whole": True, "schema": json.loads(schema.json())}


def _sizes(spark: SparkSession, folder: str) -> dict[int, int]:
    """Bytes by bucket of a write: one listing, at most ``n_buckets`` entries."""
    fs, p = _path(spark, folder)
    found, out = fs.listFiles(p, True), {}
    while found.hasNext():
        st = found.next()
        bucket = _FOLDER.search(st.getPath().toString())
        if bucket:
            b = int(bucket.group(1))
            out[b] = out.get(b, 0) + st.getLen()
    return out


def _shrunk(w: dict, gone: set[int]) -> dict | None:
    """A write without the buckets that a newer base replaces."""
    rest = [(b, n) for b, n in zip(w["buckets"], w["bytes"]) if b not in gone]
    if len(rest) == len(w["buckets"]):
        return w
    return {**w, "buckets": [b for b, _ in rest], "bytes": [n for _, n in rest], "whole": False} if rest else None


def _bytes_by_bucket(writes: Sequence[dict], kind: str) -> dict[int, int]:
    out: dict[int, int] = {}
    for w in writes:
        if w["kind"] == kind:
            for b, n in zip(w["buckets"], w["bytes"]):
                out[b] = out.get(b, 0) + n
    return out


def replace(path: str, rows: DataFrame, keys: Sequence[str], bucket_by: Sequence[str] | None = None,
            n_buckets: int = BUCKETS, compact_at: float = COMPACT_AT, tag: int | None = None) -> int:
    """Replace the rows of every key that occurs in ``rows`` by its rows there; new keys are
    added, other keys stay.  Returns the new version.

    ``n_buckets`` and ``bucket_by`` count when the table is made.  ``tag`` is kept in the
    manifest: a caller that repeats a batch (a stream) recognises its own work by it.  Without
    rows, and without a new tag, no version is made.
    """
    spark = rows.sparkSession
    keys = list(keys)
    old = manifest(spark, path)
    if old is not None and old["keys"] != keys:
        raise ValueError(f"{path} is keyed by {old['keys']}, not {keys}")
    by = old["bucket_by"] if old else list(bucket_by or keys)
    if not set(by) <= set(keys):
        raise ValueError("bucket_by must be among the keys")
    n = old["n_buckets"] if old else n_buckets
    schema = common_schema(_schema(old), _nullable(rows.schema)) if old else _nullable(rows.schema)
    writes = list(old["writes"]) if old else []
    based = set(_bytes_by_bucket(writes, "base"))
    # Rows go in the table's types, so that a key is one value whatever its source.
    fresh = _aligned(rows.withColumn(BUCKET, _bucket_of(by, n)), schema)
    entry = _write(fresh, path, "delta" if writes else "base", n)
    if entry is not None:
        writes.append(entry)
    elif old is not None and tag in (None, old["tag"]):
        return old["version"]
    m = {"version": (old["version"] if old else 0) + 1, "keys": keys, "bucket_by": by, "n_buckets": n,
         "schema": json.loads(schema.json()), "tag": tag if tag is not None else (old or {}).get("tag"),
         "writes": writes}
    if old is not None:
        base, delta = _bytes_by_bucket(writes, "base"), _bytes_by_bucket(writes, "delta")
        due = {b for b, k in delta.items() if b not in based or k > compact_at * base.get(b, 0)}
        if len(writes) > MAX_WRITES:
            # The oldest deltas and the smallest bases are joined, so few folders are read.
            deltas = [w for w in writes if w["kind"] == "delta"]
            bases = sorted((w for w in writes if w["kind"] == "base"), key=lambda w: sum(w["bytes"]))
            for w in [*deltas[:len(deltas) // 2], *bases[:len(bases) // 2]]:
                due |= set(w["buckets"])
        if due:
            compacted = _write(_resolve(spark, path, m, sorted(due)), path, "base", n)
            rest = [s for s in (_shrunk(w, due) for w in writes) if s]
            m["writes"] = ([w for w in rest if w["kind"] == "base"] + ([compacted] if compacted else [])
                           + [w for w in rest if w["kind"] == "delta"])
    _publish(spark, path, m)
    return m["version"]


def upsert(path: str, source: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = (),
           compete: bool = False, **options) -> int:
    """Type-1 merge: the latest source row of every key replaces the stored one.

    With ``compete=True`` a stored row that is later by ``order_by`` (ties: by all other
    columns) stays: late rows never overwrite newer ones, whatever the order of arrival.
    """
    spark = source.sparkSession
    src = latest_per_key(source, keys, order_by)
    if compete and is_bucketed(spark, path):
        src = staged(src, "upsert")  # read for its buckets, its keys and its rows
        m = manifest(spark, path)
        held = read_keys(spark, path, src.select(*m["bucket_by"]))
        schema = common_schema(_schema(m), _nullable(src.schema))
        names = [c for c in schema.fieldNames() if c not in keys]
        # A key's stored row and its source row: at most two rows a key; equal ones stay.
        both = conform(src, schema).withColumn("__held", F.lit(0)).unionByName(
            conform(held, schema).withColumn("__held", F.lit(1)))
        src = latest_per_key(both, keys, [*order_by, *names, "__held"]).filter("__held = 0").drop("__held")
    return replace(path, src, keys, **options)


def live_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all live writes, those that a newer write replaces included: a plain scan."""
    m = manifest(spark, path)
    if m is None or not m["writes"]:
        return None
    frames = [_aligned(_write_frame(spark, path, w), _schema(m)).drop(BUCKET) for w in m["writes"]]
    return reduce(DataFrame.unionByName, frames)


def merge(path: str, source: DataFrame, keys: Sequence[str], combine: Callable[[DataFrame], DataFrame],
          bucket_by: Sequence[str] | None = None, n_buckets: int = BUCKETS,
          compact_at: float = COMPACT_AT, tag: int | None = None) -> int:
    """Put ``combine(source and the stored rows of its keys)`` in place of these stored rows.

    ``source`` holds a row per key.  ``combine`` maps rows to rows of their keys, and rows of a key that ``source`` does not
    hold to themselves.  A source of more than ``compact_at`` of the bytes of the buckets it
    touches is combined with all their rows, and the result becomes their base: every row
    moves once, where a delta would be compacted at once anyway.  A smaller one is combined
    with the stored rows of its keys alone and written as a delta.
    """
    spark, keys = source.sparkSession, list(keys)
    old = manifest(spark, path)
    if old is None:
        return replace(path, source, keys, bucket_by=bucket_by, n_buckets=n_buckets,
                       compact_at=compact_at, tag=tag)
    if old["keys"] != keys:
        raise ValueError(f"{path} is keyed by {old['keys']}, not {keys}")
    by, n = old["bucket_by"], old["n_buckets"]
    schema = common_schema(_schema(old), _nullable(source.schema))
    folder = work_path(spark, "staged", "merge", unique=True)
    conform(source, schema).write.parquet(folder)
    src = spark.read.schema(schema).parquet(folder)
    touched = sorted(r[BUCKET] for r in src.select(_bucket_of(by, n)).distinct().collect())
    held = sum(size for w in old["writes"] for b, size in zip(w["buckets"], w["bytes"]) if b in set(touched))
    fs, p = _path(spark, folder)
    if not touched or fs.getContentSummary(p).getLength() <= compact_at * held:
        mine = read_keys(spark, path, src.select(*keys))
        return replace(path, combine(src.unionByName(conform(mine, schema))), keys,
                       compact_at=compact_at, tag=tag)
    stored = conform(_resolve(spark, path, old, touched).drop(BUCKET), schema)
    rows = combine(src.unionByName(stored)).withColumn(BUCKET, _bucket_of(by, n))
    base = _write(_aligned(rows, schema), path, "base", n)
    rest = [s for s in (_shrunk(w, set(touched)) for w in old["writes"]) if s]
    m = {**old, "version": old["version"] + 1, "schema": json.loads(schema.json()),
         "tag": tag if tag is not None else old["tag"],
         "writes": [w for w in rest if w["kind"] == "base"] + [base] + [w for w in rest if w["kind"] == "delta"]}
    _publish(spark, path, m)
    return m["version"]


def select_text(path: str, m: dict) -> str:
    """SQL of the current rows of a version that has no deltas (``compact_at=0``)."""
    if any(w["kind"] == "delta" for w in m["writes"]):
        raise ValueError("the version has deltas; merge with compact_at=0")
    parts = []
    for w in m["writes"]:
        have = {f.name: f.dataType for f in T.StructType.fromJson(w["schema"]).fields}
        columns = ", ".join(
            (f"CAST(`{f.name}` AS {f.dataType.simpleString()})" if f.name in have
             else f"CAST(NULL AS {f.dataType.simpleString()})") + f" AS `{f.name}`" for f in _schema(m).fields)
        part = f"SELECT {columns} FROM parquet.`{path.rstrip('/')}/data/w={w['id']}`"
        parts.append(part if w["whole"] else part + f" WHERE {BUCKET} IN ({', '.join(map(str, w['buckets']))})")
    return " UNION ALL ".join(parts)


def vacuum(spark: SparkSession, path: str, keep: int = 10) -> list[str]:
    """Remove manifests older than the newest ``keep`` and the writes no manifest names.

    Not for use while an upsert of the same table runs (its files have no manifest yet).
    Returns the removed write ids.
    """
    known = versions(spark, path)
    fs, _ = _path(spark, path)
    named = {w["id"] for v in known[-keep:] for w in manifest(spark, path, v)["writes"]}
    for v in known[:-keep]:
        fs.delete(_path(spark, f"{_manifests(path)}/v{v:06d}.json")[1], False)
    gone = []
    data = _path(spark, f"{path.rstrip('/')}/data")[1]
    for st in fs.listStatus(data) if fs.exists(data) else []:
        wid = st.getPath().getName().removeprefix("w=")
        if wid not in named:
            fs.delete(st.getPath(), True)
            gone.append(wid)
    return sorted(gone)


def bytes_written(spark: SparkSession, path: str, version: int) -> int:
    """Bytes of the writes that ``version`` added."""
    before = {w["id"] for w in manifest(spark, path, version - 1)["writes"]} if version > 1 else set()
    total = 0
    for w in manifest(spark, path, version)["writes"]:
        if w["id"] not in before:
            fs, p = _path(spark, f"{path.rstrip('/')}/data/w={w['id']}")
            total += fs.getContentSummary(p).getLength()
    return total
