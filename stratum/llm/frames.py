"""Small DataFrame helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.session import work_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared work folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the
    Python pass that made them.  Every call has its own folder.
    """
    spark = df.sparkSession
    path = work_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(run):
    """A task function that returns freed memory to the system when its partition ends."""
    def task(batches):
        from stratum.llm.textops import give_back

        yield from run(batches)
        give_back()

    return task


_shipped: set[str] = set()


def ship_package(spark) -> None:
    """Hand this package to the executors, once per application.

    Tasks import the package by name; on a cluster the executors may not have it
    installed.  Spark's own file distribution carries the (small) zip.
    """
    import os
    import tempfile
    import zipfile

    import stratum

    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(stratum.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="stratum-py-"), "stratum_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them (case does not count)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def quoted(name: str) -> str:
    """A column name as SQL text: dots and backticks are part of it."""
    return "`" + name.replace("`", "``") + "`"


def carried(df: DataFrame, row: str = "row", **more: Column) -> DataFrame:
    """All columns of ``df`` in one struct, beside the columns ``more``: names of a caller's
    table cannot meet those of an operator.  ``released`` is the way back."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(row),
                     *[c.alias(n) for n, c in more.items()])


def released(df: DataFrame, columns: list[str], row: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{row}.{quoted(c)}").alias(c) for c in columns])


def may_contain(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 1 << 23,
                mark: str | None = None) -> DataFrame:
    """The rows whose key may be in ``wanted`` (one column of keys).

    A bitmap of ``bits`` bits over key hashes, built by a bit_or aggregate, is
    broadcast: its size is fixed (16 bytes for each 64 bits, 2 MB by default), whatever
    the number of keys.  Rows with other keys never leave their scan; a few may stay
    by chance, so the caller joins exactly afterwards.  With ``mark`` all rows stay and
    that boolean column tells them apart.
    """
    s, w, b = free_names(rows, "_s", "_w", "_b")
    slot = lambda c: F.pmod(F.xxhash64(F.col(quoted(c))), F.lit(bits))
    word = F.floor(F.col(s) / 64).cast("int").alias(w)
    keys = wanted.select(slot(wanted.columns[0]).alias(s))
    words = keys.groupBy(word).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({s} % 64 AS int))")).alias(b))
    marked = rows.withColumn(s, slot(key)).withColumn(w, word)
    hit = F.expr(f"(shiftright({b}, cast({s} % 64 AS int)) & 1L) = 1L")
    columns = [F.col(quoted(c)) for c in rows.columns]
    if mark:
        met = marked.join(F.broadcast(words), w, "left")
        return met.select(*columns, F.coalesce(hit, F.lit(False)).alias(mark))
    return marked.join(F.broadcast(words), w).filter(hit).select(*columns)


def without_keys(rows: DataFrame, drop: DataFrame) -> DataFrame:
    """Rows whose key columns (those of ``drop``, compared null-safe) are not in ``drop``.

    Only rows that the bitmap of the last key column lets through are shuffled; all
    others stay in their scan.
    """
    names = drop.columns
    [may] = free_names(rows, "_may")
    dropped = dict(zip(names, free_names(rows, *[f"_drop_{c}" for c in names])))
    marked = may_contain(rows, names[-1], drop.select(names[-1]), mark=may)
    keys = drop.distinct().select(*[F.col(quoted(c)).alias(d) for c, d in dropped.items()])
    condition = F.lit(True)
    for c, d in dropped.items():
        condition = condition & F.col(quoted(c)).eqNullSafe(F.col(quoted(d)))
    exact = marked.filter(F.col(may)).join(keys, condition, "left_anti")
    return marked.filter(~F.col(may)).unionByName(exact).drop(may)
