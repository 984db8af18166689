"""File streams with an inferred schema that is kept and widened over restarts.

The schema lives in a folder of its own (beside the checkpoint), one JSON file per
version.  The first start infers it from the files present; every later start infers from
the files that came since, and joins both by ``sources.evolution`` (int and double become
double, anything else that differs becomes text; new fields are added).  A version is
written only when something changed, so the folder tells the schema's history.

Within a run the schema is fixed.  What it does not know is kept, not lost: a rescue
column holds the fields of a record that the schema lacks, or whose value does not
fit its type, as JSON text (of CSV rows: the raw line when it has other columns than the
schema).  After a restart such fields are columns of their own for the files that follow.

Inference reads whole files in Spark, JSON by field name, CSV by header: a CSV column
may be added at the end, files that rename or reorder columns are refused.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sinks.bucketed import _path
from stratum.sources.evolution import common_schema
from stratum.sources.landing import TEXT_TIME_OPTIONS

RESCUED = "_rescued"
# Files may become visible a while after their modification time.
OVERLAP = _dt.timedelta(hours=1)
_NAME = re.compile(r"^v(\d{6})\.json$")


def schema_versions(spark: SparkSession, location: str) -> list[int]:
    fs, p = _path(spark, location)
    if not fs.exists(p):
        return []
    found = (_NAME.match(st.getPath().getName()) for st in fs.listStatus(p))
    return sorted(int(m.group(1)) for m in found if m)


def _load(spark: SparkSession, location: str, version: int) -> dict:
    fs, p = _path(spark, f"{location.rstrip('/')}/v{version:06d}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def stored_schema(spark: SparkSession, location: str, version: int | None = None) -> T.StructType | None:
    """The schema of a version (default: the newest); None before the first start."""
    known = schema_versions(spark, location)
    if not known:
        return None
    return T.StructType.fromJson(_load(spark, location, known[-1] if version is None else version)["schema"])


def _save(spark: SparkSession, location: str, version: int, schema: T.StructType, seen: str) -> None:
    fs, final = _path(spark, f"{location.rstrip('/')}/v{version:06d}.json")
    _, aside = _path(spark, f"{location.rstrip('/')}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps({"schema": json.loads(schema.json()), "seen": seen}).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(aside, final):
        fs.delete(aside, False)
        raise RuntimeError(f"schema version {version} at {location} was written by another start")


def _options(fmt: str) -> dict[str, str]:
    return {"json": {}, "csv": {"header": "true", "inferSchema": "true"}}[fmt]


def _infer(spark: SparkSession, path: str, fmt: str, after: str | None) -> T.StructType | None:
    reader = spark.read.format(fmt).options(recursiveFileLookup="true", **_options(fmt), **TEXT_TIME_OPTIONS)
    if after is not None:
        reader = reader.option("modifiedAfter", after)
    if fmt == "csv":
        return _infer_csv(spark, path, after)
    try:
        schema = reader.load(path).schema
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return schema if schema.fields else None


def _infer_csv(spark: SparkSession, path: str, after: str | None) -> T.StructType | None:
    """CSV files by their headers: files of one header are inferred together."""
    lines = spark.read.format("text").option("recursiveFileLookup", "true")
    if after is not None:
        lines = lines.option("modifiedAfter", after)
    try:
        rows = lines.option("wholetext", "false").load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    heads = rows.select(F.col("_metadata.file_path").alias("f"), "_metadata.file_block_start", "value").filter(
        "file_block_start = 0").groupBy("f").agg(F.first("value").alias("head"))
    # One row per distinct header reaches the driver, with one of its files.
    kinds = heads.groupBy("head").agg(F.min("f").alias("f")).collect()
    out = None
    for k in sorted(kinds, key=lambda r: len(r["head"])):
        files = [r["f"] for r in heads.filter(F.col("head") == k["head"]).select("f").collect()]
        s = spark.read.options(**_options("csv"), **TEXT_TIME_OPTIONS).csv(files).schema
        if out is not None and s.fieldNames()[:len(out.fields)] != out.fieldNames():
            raise ValueError(f"CSV header {s.fieldNames()} does not begin with {out.fieldNames()}")
        out = s if out is None else common_schema(out, s)
    return out


def current_schema(spark: SparkSession, path: str, fmt: str, location: str) -> T.StructType:
    """The stored schema, widened by the files that came since it was last looked at."""
    known = schema_versions(spark, location)
    now = _dt.datetime.now(_dt.timezone.utc)
    old, after = None, None
    if known:
        kept = _load(spark, location, known[-1])
        old = T.StructType.fromJson(kept["schema"])
        after = (_dt.datetime.fromisoformat(kept["seen"]) - OVERLAP).strftime("%Y-%m-%dT%H:%M:%S")
    new = _infer(spark, path, fmt, after)
    if old is None and new is None:
        raise ValueError(f"no files at {path} to infer a schema from")
    if old is None or new is None:
        schema = old or new
    else:
        if fmt == "csv":
            a, b = sorted((old.fieldNames(), new.fieldNames()), key=len)
            if b[:len(a)] != a:
                raise ValueError(f"CSV header {new.fieldNames()} does not agree with {old.fieldNames()}")
        schema = common_schema(old, new)
    if old is None or schema.json() != old.json():
        _save(spark, location, (known[-1] if known else 0) + 1, schema, now.isoformat())
    return schema


def _json_rows(lines: DataFrame, schema: T.StructType, lineage: list) -> DataFrame:
    """Typed columns of JSON lines and the rescue column."""
    fields = F.from_json("value", T.MapType(T.StringType(), T.StringType()), dict(TEXT_TIME_OPTIONS))
    parsed = lines.select(*lineage, "value", F.from_json("value", schema, dict(TEXT_TIME_OPTIONS)).alias("__r"),
                          fields.alias("__m"))
    names = schema.fieldNames()
    # Kept: fields the schema lacks, and values that their column's type could not hold.
    unfit = F.filter(F.array(*[F.when(F.col("__m").getItem(n).isNotNull() & F.col(f"__r.`{n}`").isNull(), F.lit(n))
                               for n in names]), lambda x: x.isNotNull())
    parsed = parsed.withColumn("__unfit", unfit)
    lost = F.map_filter("__m", lambda k, v: ~k.isin(names) | F.array_contains(F.col("__unfit"), k))
    rescued = F.when(F.col("__m").isNull(), F.col("value")).when(F.size(lost) > 0, F.to_json(lost))
    kept = [c for c in parsed.columns if c not in ("value", "__r", "__m", "__unfit")]
    return parsed.select(*[F.col(f"__r.`{n}`").alias(n) for n in names], rescued.alias(RESCUED), *kept)


def stream_inferred(spark: SparkSession, path: str, fmt: str, location: str,
                    max_files_per_trigger: int | None = None, lineage: bool = False) -> DataFrame:
    """A file stream (``json`` lines or ``csv``) with the kept, widened schema of ``location``.

    Columns: the schema's, ``_rescued``, and with ``lineage`` the ingestion time and file name.
    """
    if fmt not in ("json", "csv"):
        raise ValueError("schemas are inferred for json and csv")
    schema = current_schema(spark, path, fmt, location)
    stamps = [F.current_timestamp().alias("_ingested_at"),
              F.col("_metadata.file_name").alias("_source_file")] if lineage else []
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "json":
        return _json_rows(reader.format("text").load(path), schema, stamps)
    full = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    rows = reader.format("csv").schema(full).options(
        header="true", mode="PERMISSIVE", columnNameOfCorruptRecord=RESCUED, enforceSchema="true",
        **TEXT_TIME_OPTIONS).load(path)
    return rows.select(*[F.col(f"`{n}`") for n in schema.fieldNames()], RESCUED, *stamps)
