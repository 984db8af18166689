"""Landing-folder scans (JSON lines, CSV) with lineage columns.

Schemas are declared: inference costs a full extra pass over the folder and
changes types between runs (a postcode ``06133`` would become 6133).
``infer=True`` is available for exploration only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import work_path
from stratum.sources.tables import table_exists

# Options that keep blanks as written (CSV trims by default when writing).
CSV_WRITE_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
                     "ignoreTrailingWhiteSpace": "false"}
CSV_READ_OPTIONS = {"header": "true", "mode": "PERMISSIVE"}
# Full microsecond precision for timestamps in text files (the default keeps
# milliseconds only).
TEXT_TIME_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                     "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
# Bumped when the layout of landing copies changes (old copies are ignored).
LANDING_LAYOUT = "v6"
# Most rows of one file of ``write_landing_split``.
FILE_ROWS = 500_000


def read_landing(spark: SparkSession, path: str, fmt: str,
                 schema: T.StructType | None = None, infer: bool = False,
                 multiline: bool = False, recursive: bool = True,
                 rescue_col: str | None = None) -> DataFrame:
    """Batch scan of a landing folder: every file in it, at any depth (one
    sub-folder per delivery is common).

    ``rescue_col`` keeps the raw text of a malformed record in that column
    (null for good records) instead of silently turning it into a row of
    nulls; a DQ rule such as ``Rule("parsed", "_rescued is null", "drop")``
    can then warn, drop or fail on it.  Spark refuses raw-file queries that
    read only that column, so evaluate such a rule on the written bronze table
    (or together with data columns).
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", str(recursive).lower())
    if schema is not None and rescue_col:
        schema = T.StructType([*schema.fields, T.StructField(rescue_col, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", rescue_col)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    else:
        raise ValueError("declare a schema, or pass infer=True explicitly")
    if fmt in ("json", "csv"):
        reader = reader.options(**TEXT_TIME_OPTIONS)
    if fmt == "json":
        reader = reader.option("multiLine", str(multiline).lower())
    if fmt == "csv":
        reader = reader.options(**CSV_READ_OPTIONS)
    return reader.load(path)


def with_lineage(df: DataFrame, ingested_col: str = "_ingested_at",
                 source_col: str = "_source_file") -> DataFrame:
    """Ingestion time (one value per query) and the source file name.

    ``_metadata.file_name`` is the hidden per-file column of file sources
    (batch and streaming); it costs no extra scan.
    """
    return df.withColumns({
        ingested_col: F.current_timestamp(),
        source_col: F.col("_metadata.file_name"),
    })


def write_landing(df: DataFrame, path: str, fmt: str, files: int | None = None) -> str:
    """Write ``df`` as landing files (test and replay helper)."""
    if files:
        df = df.repartition(files)
    w = df.write.mode("overwrite").format(fmt)
    if fmt in ("json", "csv"):
        w = w.options(**TEXT_TIME_OPTIONS)
    if fmt == "csv":
        w = w.options(**CSV_WRITE_OPTIONS)
    w.save(path)
    return path


def write_landing_split(df: DataFrame, path: str, fmt: str, files: int) -> str:
    """Write ``df`` as at least ``files`` landing files (rows permitting) without a shuffle.

    Every task cuts its own rows into files of equal row numbers, at most ``FILE_ROWS``, so
    the number of files grows with the rows.  The files are compressed: text of this kind
    shrinks to about a tenth, and a reader takes each file whole.
    """
    each = max(1, min(FILE_ROWS, -(-df.count() // files)))
    w = df.write.mode("overwrite").format(fmt).option("maxRecordsPerFile", each)
    w = w.options(compression="gzip", **TEXT_TIME_OPTIONS)
    if fmt == "csv":
        w = w.options(**CSV_WRITE_OPTIONS)
    w.save(path)
    return path


def landing_copy(spark: SparkSession, base: str, entity: str,
                 df: DataFrame | Callable[[], DataFrame], fmt: str, files: int | None = None,
                 write: Callable[..., str] = write_landing) -> str:
    """A landing folder holding ``df`` in ``fmt``, written once per input.

    The folder lives below the shared checkpoint folder and is keyed by the
    input folder, so repeated queries reuse it.  ``df`` may be a function,
    called only where the copy is missing.
    """
    key = hashlib.sha1(base.rstrip("/").encode()).hexdigest()[:12]
    path = work_path(spark, "landing", LANDING_LAYOUT, key, f"{entity}.{fmt}")
    if table_exists(spark, f"{path}/_SUCCESS"):
        return path
    # Write aside, then move into place unless a concurrent writer won: a
    # reader never sees a half-written copy, and two writers never share files.
    tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
    write(df if isinstance(df, DataFrame) else df(), tmp, fmt, files)
    jvm = spark.sparkContext._jvm
    dst = jvm.org.apache.hadoop.fs.Path(path)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(dst):
        fs.rename(jvm.org.apache.hadoop.fs.Path(tmp), dst)
    return path
