"""Reading and writing bar lakes: scans, day-partitioned sinks, manifests, incremental plans."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions.scalars import nan_to_null, partition_columns
from tsforge.operators.policy import with_decision_schema
from tsforge.operators.quality import assert_unique

ROW_GROUP_BYTES = 64 * 1024 * 1024


def scan(spark: SparkSession, path: str | list[str], cols: list[str] | None = None, merge_schema: bool = False, ts: str | None = "ts") -> DataFrame:
    """Parquet files or globs; only ``cols`` are read. NaN becomes NULL, ``ts`` a UTC timestamp.

    With ``merge_schema`` files of different columns are aligned by name.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    if cols:
        df = df.select(*cols)
    if ts and ts in df.columns:
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return nan_to_null(df)


def scan_days(spark: SparkSession, path: str, start: str, end: str, cols: list[str] | None = None) -> DataFrame:
    """Rows of [start, end) of a y/m/d lake: the partition filter is derived from the time range."""
    df = spark.read.parquet(path)
    day = F.make_date(*[F.col(c).cast("int") for c in "ymd"])
    last = F.lit(end).cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")
    df = df.where((day >= F.to_date(F.lit(start))) & (day <= F.to_date(last)))
    df = df.where((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp")))
    return df.select(*cols) if cols else df


def named_view(df: DataFrame, name: str) -> DataFrame:
    """Register a temporary view and return its count and time range."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"SELECT count(*) AS n, min(ts) AS min_ts, max(ts) AS max_ts FROM {name}")


def rows_per_group(row_bytes: float, target: int = ROW_GROUP_BYTES) -> int:
    """Rows of a row group of about ``target`` bytes, between 50 thousand and one million."""
    return int(min(max(target / max(row_bytes, 1.0), 50_000), 1_000_000))


def row_width(df: DataFrame) -> int:
    """Bytes of a row by its types: 8 per number or time, 20 per text, 64 per nested value."""
    widths = {"string": 20, "binary": 20}
    return sum(64 if f.dataType.simpleString().startswith(("array", "map", "struct")) else widths.get(f.dataType.simpleString(), 8) for f in df.schema.fields)


def _write_parts(df: DataFrame, path: str, by: list[str], order: list[str], mode: str) -> None:
    """Partitioned files of at most a row group's rows: Spark splits large parts and joins small ones by size."""
    spread = df.hint("rebalance", *by).sortWithinPartitions(*by, *order)
    (
        spread.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("maxRecordsPerFile", rows_per_group(row_width(df)))
        .partitionBy(*by)
        .parquet(path)
    )


def write_daily(df: DataFrame, path: str, key: str | list[str] = "symbol", ts: str = "ts", mode: str = "overwrite", check_keys: bool = True) -> None:
    """Write y/m/d partitions, replacing whole days, sorted by time inside each file.

    Files hold about one row group. A day, or a hot key in it, is spread over as many tasks as
    its size needs.
    """
    keys = [key] if isinstance(key, str) else key
    if check_keys:
        assert_unique(df, [*keys, ts])
    _write_parts(df.withColumns({n: c for n, c in zip("ymd", partition_columns(ts))}), path, ["y", "m", "d"], [ts, *keys], mode)


def append_rows(spark: SparkSession, new: DataFrame, path: str, keys: list[str], ts: str = "ts") -> None:
    """Add rows to a daily lake: the days they touch are rewritten, a new row replacing the old of its key.

    The touched days, a bounded list, prune the lake's partitions.
    """
    from tsforge.operators.align import keep_last
    from tsforge.session import cut_lineage

    try:
        old = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return write_daily(new, path, keys, ts)
    parts = partition_columns(ts)
    days = [row[0] for row in new.select(F.concat_ws("-", *parts).alias("day")).distinct().collect()]
    touched = old.where(F.concat_ws("-", *old_parts(old)).isin(days)).drop("y", "m", "d")
    both = touched.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    merged = cut_lineage(keep_last(both, [*keys, ts], ["_new"]).drop("_new"))
    return write_daily(merged, path, keys, ts, check_keys=False)


def old_parts(lake: DataFrame) -> list:
    """The partition columns of a read lake as the texts they were written with."""
    return [F.lpad(F.col(c).cast("string"), 4 if c == "y" else 2, "0") for c in "ymd"]


def build_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(y, m, d, name, sha256, rows, cols) for every data file of a daily lake."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    hashes = files.select(F.col("path"), F.sha2("content", 256).alias("sha256"))
    data = spark.read.parquet(path)
    width = len(data.columns) - 3
    counts = data.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    # The two sources spell the same file address with one and with three slashes.
    plain = lambda df: df.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    d = plain(hashes).join(plain(counts), "path").select("path", "sha256", "rows", F.lit(width).alias("cols"))
    parts = {p: F.regexp_extract("path", rf"/{p}=(\d+)/", 1) for p in "ymd"}
    return d.select(*[c.alias(p) for p, c in parts.items()], F.element_at(F.split("path", "/"), -1).alias("name"), "sha256", "rows", "cols")


def complete_days(manifest: DataFrame) -> DataFrame:
    """Days a manifest vouches for."""
    return manifest.select(F.to_date(F.concat_ws("-", "y", "m", "d")).alias("day")).distinct()


def day_range(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per day from start to end, both included."""
    return spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}')) AS day")


def plan_days(all_days: DataFrame, done: DataFrame | None, refresh_tail: int = 2, force: bool = False) -> DataFrame:
    """Days to (re)build: those not done, plus always the last ``refresh_tail`` days."""
    if force or done is None:
        return all_days.select("day").distinct()
    last = all_days.agg(F.max("day")).first()[0]
    tail = all_days.where(F.col("day") > F.date_sub(F.lit(last), refresh_tail))
    return all_days.join(done.select("day"), "day", "left_anti").select("day").union(tail.select("day")).distinct()


def islands(df: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """Runs of consecutive days as half-open spans (keys, start, end, days).

    A run starts at a day whose predecessor is absent and ends where the successor is
    absent; starts and ends are then paired by their order among the few run edges.
    """
    from pyspark.sql import Window

    days = df.select(*keys, F.to_date(day).alias("_d")).distinct()
    shifted = lambda n: days.select(*keys, F.date_add("_d", n).alias("_d"))
    starts = days.join(shifted(1), [*keys, "_d"], "left_anti")
    ends = days.join(shifted(-1), [*keys, "_d"], "left_anti")
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))).orderBy("_d")
    a = starts.select(*keys, F.col("_d").alias("start"), F.row_number().over(w).alias("_i"))
    b = ends.select(*keys, F.date_add("_d", 1).alias("end"), F.row_number().over(w).alias("_i"))
    return a.join(b, [*keys, "_i"]).drop("_i").withColumn("days", F.datediff("end", "start"))


def time_slices(df: DataFrame, start: str, end: str, every: str = "INTERVAL 30 DAYS") -> DataFrame:
    """Cut each [start, end) into slices of ``every``; the last one is clipped."""
    step = F.expr(every)
    begin = F.explode(F.filter(F.sequence(start, end, step), lambda t: t < F.col(end)))
    return df.withColumn("slice_start", begin).withColumn("slice_end", F.least(F.col("slice_start") + step, F.col(end)))


def write_decisions(df: DataFrame, path: str, mode: str = "append") -> None:
    """Decision rows with the fixed schema, partitioned by date."""
    d = with_decision_schema(df).withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    _write_parts(d, path, ["date"], ["ts", "symbol"], mode)


def read_probs(spark: SparkSession, path: str) -> DataFrame:
    """Probability tables from a directory or a glob; fold numbers from file names when not a column."""
    from tsforge.functions.scalars import extract_fold_id

    df = scan(spark, path)
    if "fold_id" not in df.columns:
        df = df.withColumn("fold_id", extract_fold_id(F.input_file_name()))
    return df


def read_events(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """JSON-lines events and, separately, the lines that did not parse."""
    parsed = parse_events(spark.read.text(path), schema)
    return parsed.where("_corrupt IS NULL").drop("_corrupt"), parsed.where("_corrupt IS NOT NULL").select("_corrupt")


def parse_events(lines: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Typed events of a text column ``value``, batch or stream; ``_corrupt`` holds lines that did not parse."""
    full = T.StructType([*(schema or event_schema()).fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return lines.select(F.from_json("value", full, options).alias("e")).select("e.*")


def event_schema() -> T.StructType:
    """Fields of a scoring or decision event."""
    return T.StructType.fromDDL(
        "ts timestamp, type string, symbol string, throttled boolean, t_feat_ms double, t_nn_ms double, t_policy_ms double, "
        "t_total_ms double, request_id string, candle_close_ts timestamp, p_long double, p_short double"
    )


def write_events(df: DataFrame, path: str) -> None:
    """Append events as JSON lines; a missing time is the time of writing."""
    ts = F.coalesce("ts", F.current_timestamp()) if "ts" in df.columns else F.current_timestamp()
    df.withColumn("ts", ts).write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of a few rows as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    """A profile or lineage table of a few rows as CSV with header."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def lineage(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """(feature, endpoint, notes): where each column of a lake comes from."""
    return spark.createDataFrame(rows, "feature string, endpoint string, notes string")


