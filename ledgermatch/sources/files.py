"""File sources and sinks (SC7, SK1-SK4).

Files live in the cluster's shared folder (``session.shared_dir``); nothing is
written to a machine-local path unless the session names none (tests).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgermatch.functions.scalars import lenient_timestamp
from ledgermatch.session import materialize


def read_csv_lenient(spark: SparkSession, path: str, schema: str, date_columns: dict[str, str]) -> DataFrame:
    """SC7: CSV with a declared all-text schema; date columns parsed leniently.

    ``date_columns`` maps column -> format; unparseable values become null
    instead of failing the job (F9).
    """
    df = spark.read.schema(schema).option("header", True).csv(path)
    for c, fmt in date_columns.items():
        df = df.withColumn(c, F.to_date(lenient_timestamp(c, fmt)))
    return df


def write_results(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """SK1-SK3: write a results table (maps become JSON text for CSV)."""
    if fmt == "csv":
        cols = [F.to_json(c).alias(c) if t.startswith("map") or t.startswith("array") else F.col(c)
                for c, t in df.dtypes]
        df.select(*cols).write.mode(mode).option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode(mode).json(path)
    else:
        df.write.mode(mode).parquet(path)


@dataclass(frozen=True)
class CsvSource:
    """A CSV source that was read: its rows, and what of it could not be parsed.

    ``rejects`` has one row per unparseable cell, and one per record that does
    not fit the schema (``column_name`` null): file, column_name, value (the
    cell's or the whole record's text). The rows are all records, with nulls
    in the place of what was rejected.
    """
    rows: DataFrame
    rejects: DataFrame


BAD_RECORD = "__bad_record"


def read_csv_source(spark: SparkSession, path: str, schema: str, date_columns: Mapping[str, str]) -> CsvSource | None:
    """SC7: a CSV file or folder with a channel for bad data; None if it is absent.

    Records are parsed permissively; date columns (name -> format) are read as
    text and parsed leniently. The parsed table is written once to the shared
    folder: rows and rejects read that, never the text again.
    """
    try:
        read = spark.read.schema(f"{schema}, {BAD_RECORD} string").option("header", True).option("mode", "PERMISSIVE") \
                         .option("columnNameOfCorruptRecord", BAD_RECORD).csv(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    columns = [c for c in read.columns if c != BAD_RECORD]
    parsed = read.select("*", F.col("_metadata.file_path").alias("__file"),
                         *[F.to_date(lenient_timestamp(c, f)).alias(f"__d_{c}") for c, f in date_columns.items()])
    parsed = materialize(parsed, "csv-source")
    rows = parsed.select(*[F.col(f"__d_{c}").alias(c) if c in date_columns else F.col(c) for c in columns])
    bad = [F.when(F.col(c).isNotNull() & F.col(f"__d_{c}").isNull(), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))) for c in date_columns]
    bad.append(F.when(F.col(BAD_RECORD).isNotNull(), F.struct(F.lit(None).cast("string").alias("column_name"), F.col(BAD_RECORD).alias("value"))))
    rejects = parsed.select(F.col("__file").alias("file"), F.explode(F.array_compact(F.array(*bad))).alias("r")).select("file", "r.*")
    return CsvSource(rows, rejects)


def read_csv_sources(spark: SparkSession, folder: str, specs: Mapping[str, tuple[str, str, Mapping[str, str]]]) -> dict[str, CsvSource]:
    """The sources that exist in a folder: alias -> (file name, schema, date columns).

    An absent file is an absent key. A calendar may call its day
    ``calendar_date`` or ``report_date``; it comes out as ``report_date``.
    """
    found = {alias: read_csv_source(spark, f"{folder.rstrip('/')}/{name}", schema, dates) for alias, (name, schema, dates) in specs.items()}
    out = {}
    for alias, source in found.items():
        if source is None:
            continue
        rows = source.rows
        if "calendar_date" in rows.columns and "report_date" not in rows.columns:
            rows = rows.withColumnRenamed("calendar_date", "report_date")
        out[alias] = CsvSource(rows, source.rejects)
    return out


def reject_counts(sources: Mapping[str, CsvSource], expected: list[str]) -> DataFrame:
    """Per expected source: whether it is present, its rows, and the rejected
    values per column (null: whole records; a source without rejects has one row of 0)."""
    parts = []
    for alias in expected:
        if alias not in sources:
            continue
        s = sources[alias]
        total = s.rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("source", F.lit(alias))
        per = s.rejects.groupBy("column_name").agg(F.count(F.lit(1)).alias("rejected"))
        listed = per.agg(F.collect_list(F.struct("column_name", "rejected")).alias("rejects")).withColumn("source", F.lit(alias))   # a row per column
        one = total.unionByName(listed, allowMissingColumns=True).groupBy("source").agg(F.max("rows").alias("rows"), F.max("rejects").alias("rejects"))
        parts.append(one.select("source", "rows", F.explode_outer("rejects").alias("r")).select(
            "source", F.lit(True).alias("present"), "rows", "r.column_name", F.coalesce("r.rejected", F.lit(0)).cast("bigint").alias("rejected")))
    spark = next(iter(sources.values())).rows.sparkSession if sources else SparkSession.active()
    absent = spark.createDataFrame([(a, False, None, None, None) for a in expected if a not in sources],
                                   "source string, present boolean, rows bigint, column_name string, rejected bigint")
    for p in parts:
        absent = absent.unionByName(p)
    return absent


def write_observed(df: DataFrame, path: str, fmt: str = "parquet") -> dict[str, object]:
    """SC9/SK1: writes ``df`` and returns what went through the writer (rows,
    and per column nulls, smallest and largest value), observed on the way:
    the data is neither scanned nor computed a second time."""
    seen = Observation("written")
    ordered = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    aggs = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in df.columns],
            *[F.min(c).alias(f"min:{c}") for c in ordered], *[F.max(c).alias(f"max:{c}") for c in ordered]]
    write_results(df.observe(seen, *aggs), path, fmt)
    return seen.get
