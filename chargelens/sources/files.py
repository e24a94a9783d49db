"""File sources and sinks: snapshot folders, usage exports, day partitions, incremental appends."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_COLUMNS = ("statId", "chgerId", "stat", "statUpdDt", "fetchedAt", "snapshotId", "pageNo")
SNAPSHOT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SNAPSHOT_COLUMNS])


def place_in_file() -> Column:
    """A number that rises along the lines of a file, however the file is split: start of the split, then the row's turn in
    its task, which reads a split from front to back. For files below 1 GB (a poll is some megabytes)."""
    turn = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.shiftleft(F.col("_metadata.file_block_start"), 33).bitwiseOR(turn)


def read_snapshots(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Snapshot CSVs of several roots as text columns; of files with one name the first root's counts.

    Only (file name, root rank) pairs are grouped; rows are then kept by a join on that small table. `row_no` orders the
    lines of a file.
    """
    parts = [
        spark.read.schema(SNAPSHOT_SCHEMA).option("header", True).option("recursiveFileLookup", True).csv(root)
        .withColumns({"_file": F.col("_metadata.file_name"), "_root": F.lit(i), "row_no": place_in_file()})
        for i, root in enumerate(roots)
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    first = rows.groupBy("_file").agg(F.min("_root").alias("_root"))
    return rows.join(first, ["_file", "_root"], "left_semi").drop("_file", "_root")


def prefer_live(live: DataFrame, archive: DataFrame, key: str = "tick_ts") -> DataFrame:
    """Live and archived rows, one source per snapshot, live first."""
    return live.unionByName(archive.join(live.select(key).distinct(), key, "left_anti").select(*archive.columns), allowMissingColumns=True)


INFO_NAMES = {"statId": "station_id", "chgerId": "charger_id", "statNm": "station_name", "busiNm": "busi_nm", "chgerType": "chger_type", "limitYn": "limit_yn", "delYn": "del_yn", "useTime": "use_time"}


def read_charger_info(spark: SparkSession, path: str) -> DataFrame:
    """Charger master CSV, every column as text (ids keep leading zeros), renamed to the canonical schema."""
    return spark.read.option("header", True).csv(path).withColumnsRenamed(INFO_NAMES)


def latest_files(spark: SparkSession, root: str, kind: Column) -> DataFrame:
    """Newest file per kind by modification time, then name; file contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "modificationTime")
    return f.withColumn("kind", kind).where("kind <> ''").groupBy("kind").agg(F.max(F.struct("modificationTime", "path")).alias("m"), F.count("*").alias("files")).select("kind", "m.path", "files")


# fixed values: headers of the usage export
USAGE_HEADERS = {"일자": "use_date", "충전소아이디": "station_id", "충전기아이디": "charger_id", "충전기타입": "charger_type", "사용횟수": "sessions", "충전량": "kwh"}
USAGE_ENCODINGS = ("UTF-8", "x-windows-949", "EUC-KR")


def _headers(names: Iterable[str], encoding: str) -> list[str]:
    """Bytes of the names in a code page, one Latin-1 character per byte."""
    return [n.encode(PYTHON_NAMES[encoding]).decode("latin-1") for n in names]


PYTHON_NAMES = {"UTF-8": "utf-8", "x-windows-949": "cp949", "EUC-KR": "euc-kr"}


def usage_encodings(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, encoding) per file: the first encoding in which its first line has the known names, else NULL.

    Lines are read as bytes (Latin-1) in tasks, and only first lines leave them.
    """
    lines = spark.read.schema("line string").option("sep", "\u0001").option("quote", "").option("encoding", "ISO-8859-1").option("recursiveFileLookup", True).csv(path)
    first = lines.select(F.col("_metadata.file_path").alias("file"), place_in_file().alias("at"), "line").groupBy("file").agg(F.min_by("line", "at").alias("header"))
    cells = F.transform(F.split(F.regexp_replace("header", "^\u00ef\u00bb\u00bf", ""), ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    fits = [F.when(F.size(F.array_except(F.array(*[F.lit(h) for h in _headers(USAGE_HEADERS, e)]), cells)) == 0, e) for e in USAGE_ENCODINGS]
    return first.select("file", "header", F.coalesce(*fits).alias("encoding"))


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """Usage CSVs in UTF-8 or a Korean code page, also mixed in one folder, typed; rows without date or station are dropped.

    Each file's encoding comes from its own header; files that share encoding and header are read together, so neither
    code pages nor column orders mix.
    """
    found = usage_encodings(spark, path).groupBy("encoding", "header").agg(F.collect_list("file").alias("files")).orderBy("encoding", "header").collect()  # file names only
    if not found or any(r.encoding is None for r in found):
        raise ValueError(f"usage export header not recognised: {[r.files[0] for r in found if r.encoding is None]}")
    out = None
    for r in found:
        df = spark.read.option("header", True).option("encoding", r.encoding).csv(sorted(r.files))
        df = df.select(*[F.col(f"`{c}`").alias(USAGE_HEADERS[c.strip("\ufeff")]) for c in df.columns if c.strip("\ufeff") in USAGE_HEADERS])
        out = df if out is None else out.unionByName(df)
    typed = out.withColumns({"use_date": F.col("use_date").try_cast("date"), "sessions": F.col("sessions").try_cast("double"), "kwh": F.col("kwh").try_cast("double")})
    return typed.na.drop(subset=["use_date", "station_id"])


LOG_SCHEMA = "batch long, low long, high long, rows long"


def _log(spark: SparkSession, target: str) -> DataFrame:
    """Committed batches, none where there is no target yet."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{target}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def write_batch(source: DataFrame, target: str, key: str = "id") -> tuple[int, int | None]:
    """Writes the rows above the cursor as the next batch, over whatever an interrupted run left there. Returns its number
    and the cursor it started from; nothing counts until `commit_batch`."""
    done = _log(source.sparkSession, target).agg(F.max("batch"), F.max("high")).first()
    number = 0 if done[0] is None else done[0] + 1
    fresh = source if done[1] is None else source.where(F.col(key) > done[1])
    fresh.where(F.col(key).isNotNull()).write.mode("overwrite").parquet(f"{target}/batches/batch={number}")
    return number, done[1]


def commit_batch(spark: SparkSession, target: str, number: int, key: str = "id") -> int:
    """Enters a written batch into the log, with key range and row count as they stand in its files; empty ones are not entered."""
    found = spark.read.parquet(f"{target}/batches/batch={number}").agg(F.min(key).cast("long").alias("low"), F.max(key).cast("long").alias("high"), F.count("*").alias("rows"))
    found.where("rows > 0").select(F.lit(number).cast("long").alias("batch"), "low", "high", "rows").coalesce(1).write.mode("append").parquet(f"{target}/log")
    return number


def read_committed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Rows of the batches in the log."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{target}/batches")
    return rows.join(_log(spark, target).select("batch").distinct(), "batch", "left_semi").select(*schema.names)


def append_new(source: DataFrame, target: str, key: str = "id") -> DataFrame:
    """Appends the source rows above the cursor (greatest key of the log) and returns the target's rows.

    A run that dies between writing and commit leaves files that no reader counts and that the next run overwrites. Rows
    without a key are never appended.
    """
    number, _ = write_batch(source, target, key)
    commit_batch(source.sparkSession, target, number, key)
    return read_committed(source.sparkSession, target, source.schema)


def write_by_date(df: DataFrame, path: str, time: str, *, rows_per_file: int = 5_000_000) -> DataFrame:
    """Parquet partitioned by date. Rows are rebalanced by date, so a heavy date becomes several files, not one task."""
    out = df.withColumn("date", F.to_date(time)).hint("rebalance", "date")
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("date").parquet(path)
    return df.sparkSession.read.parquet(path)


def daily_rollup(events: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows before and after de-duplication per date."""
    a = events.groupBy(F.to_date("tick_ts").alias("date")).agg(F.count("*").alias("raw_rows"), F.count_distinct("tick_ts").alias("snapshots"))
    b = kept.groupBy(F.to_date("tick_ts").alias("date")).agg(F.count("*").alias("dedup_rows"))
    return a.join(b, "date", "left")


def history_records(events: DataFrame, status: Column) -> DataFrame:
    """Export records of the status history: official status, event time (else observed time), observed time."""
    one = events.groupBy("tick_ts", "station_id", "charger_id").agg(F.min_by(F.struct("stat", "stat_updated_at", "fetched_at"), "event_id").alias("r"))
    one = one.select("station_id", "charger_id", "r.*")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+09:00'")
    return one.select(F.col("station_id").alias("stationId"), F.col("charger_id").alias("chargerId"), status.alias("status"), iso(F.coalesce("stat_updated_at", "fetched_at")).alias("statusUpdatedAt"), iso(F.col("fetched_at")).alias("observedAt"))


def inventory(df: DataFrame, time: Column | str) -> DataFrame:
    """Rows, columns, first line and time range per source file."""
    names = df.columns
    line = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names])
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count("*").alias("n_rows"), F.lit(len(names)).cast("long").alias("n_columns"), F.lit(",".join(names)).alias("columns"),
        F.min_by(line, F.col("_metadata.row_index")).alias("head"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))
