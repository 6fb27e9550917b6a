"""Readers and writers: raw JSON, configuration XML and JSON, partitioned logs, archives, exports, state tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as X
from ..plans.shared import written
from ..schema import RAW

DESCRIPTOR = (
    "x_road_instance string, member_class string, member_code string, member_name string, subsystem_code string, subsystem_name map<string,string>, email array<struct<name:string,email:string>>"
)
SHARED_PARAMS = (
    "member array<struct<_id:string,memberClass:struct<code:string>,memberCode:string,name:string>>, "
    "securityServer array<struct<owner:string,serverCode:string,address:string>>, "
    "globalSettings struct<memberClass:array<struct<code:string,description:string>>>"
)


BROKEN = "__broken"


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """line and file of landed files, gzipped or not; blank lines are left out."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")).where("trim(line) <> ''")


def stream_lines(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The same as a stream with a bounded batch."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")).where("trim(line) <> ''")


def parsed_lines(lines: DataFrame, schema: T.StructType = RAW) -> tuple[DataFrame, DataFrame]:
    """(records, quarantined lines): a line that is no JSON object or has a value of a wrong type is quarantined, with its file.

    Every line is in just one of the two.
    """
    whole = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    read = lines.withColumn("r", F.from_json("line", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}))
    good = F.coalesce(F.col(f"r.{BROKEN}").isNull() & F.col("r").isNotNull() & F.ltrim("line").startswith("{"), F.lit(False))
    return read.where(good).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema]), read.where(~good).select("line", "file")


def read_raw(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """Landed records, one JSON object a line; missing fields are null. quarantine: where broken lines go, else they're left out."""
    good, bad = parsed_lines(landed_lines(spark, path))
    if quarantine is not None:
        bad.write.mode("append").parquet(quarantine)
    return good


def stream_raw(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Landed records as a stream with a bounded batch, without broken lines; see `stream_lines` to keep these."""
    return parsed_lines(stream_lines(spark, path, files_per_batch))[0]


def gate_versions(raw: DataFrame, least: Sequence[int] = (7, 6, 2)) -> DataFrame:
    """restPath only where the sender's version is known to fill it right."""
    return raw.withColumn("restPath", F.when(X.version_at_least(F.col("xRoadVersion"), least), F.col("restPath")))


def stamped(raw: DataFrame, now: float) -> DataFrame:
    return raw.withColumns({"insertTime": F.lit(now), "corrected": F.lit(None).cast("boolean")})


def pending(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Records not corrected yet, oldest first."""
    out = raw.where("corrected is null").orderBy("requestInTs")
    return out if limit is None else out.limit(limit)


def faulty(raw: DataFrame) -> DataFrame:
    return raw.where("corrected is null and xRequestId is null and requestInTs is not null and securityServerType is not null")


def since(df: DataFrame, column: str, last: float, now: float) -> DataFrame:
    """Rows of (last, now]."""
    return df.where((F.col(column) > last) & (F.col(column) <= now))


def publishable(clean: DataFrame, last: float, now: float) -> DataFrame:
    return since(clean, "correctorTime", last, now).where("correctorStatus = 'done' and client.clientXRoadInstance is not null")


def normalise_harvested(rows: DataFrame, integers: Sequence[str]) -> DataFrame:
    """The text None becomes null, listed columns longs; what is no number becomes null."""
    cleaned = {c: F.nullif(F.col(c), F.lit("None")) for c, t in rows.dtypes if t == "string"}
    out = rows.withColumns(cleaned)
    return out.withColumns({c: F.expr(f"try_cast({c} as bigint)") for c in integers})


def latest_snapshot(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.orderBy(F.desc(time)).limit(1)


def servers(spark: SparkSession, xml: str) -> DataFrame:
    """Security servers with their owners, from the text of the shared parameters."""
    conf = parsed_params(spark, xml)
    s = conf.select(F.explode("c.securityServer").alias("s")).select("s.*")
    m = conf.select(F.explode("c.member").alias("m")).select(F.col("m._id").alias("owner"), F.col("m.memberClass.code").alias("member_class"), F.col("m.memberCode").alias("member_code"), F.col("m.name").alias("member_name"))
    return s.join(m, "owner")


def parsed_params(spark: SparkSession, xml: str) -> DataFrame:
    return spark.createDataFrame([(xml,)], "xml string").select(F.from_xml("xml", SHARED_PARAMS).alias("c"))


def member_classes(spark: SparkSession, xml: str) -> DataFrame:
    return parsed_params(spark, xml).select(F.explode("c.globalSettings.memberClass").alias("m")).select(F.col("m.code").alias("member_class"), F.col("m.description").alias("description"))


def read_descriptor(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DESCRIPTOR).option("multiLine", True).json(path)


def member_names(descriptor: DataFrame) -> DataFrame:
    return descriptor.select("member_code", "member_name").distinct()


def subsystem(descriptor: DataFrame, instance: str, member_class: str, member_code: str, code: str) -> DataFrame:
    return descriptor.where((F.col("x_road_instance") == instance) & (F.col("member_class") == member_class) & (F.col("member_code") == member_code) & (F.col("subsystem_code") == code))


def schema_of(fields: Mapping[str, str]) -> T.StructType:
    """From names and SQL types, in alphabetical order, without the generated id."""
    return T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in sorted(fields.items()) if k != "id"))


def translated(fields: Sequence[str]) -> list[Column]:
    """Columns from lines `a.b -> c`; blank lines and comments are skipped."""
    pairs = [line.split("->") for line in fields if line.strip() and not line.lstrip().startswith("#")]
    return [F.col(a.strip()).alias(b.strip()) for a, b in pairs]


@dataclass(frozen=True)
class LogTable:
    """Published rows by day, and a log of their schema: columns may be added, their types never change.

    Each version of the schema is a folder of its own that is written once, so that of two writers that add columns at the
    same time one fails. Rows are read by the newest schema; older files give null for columns that they haven't.
    """

    spark: SparkSession
    path: str

    def versions(self) -> list[T.StructType]:
        log = f"{self.path}/_schemas"
        p = self.spark._jvm.org.apache.hadoop.fs.Path(log)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return []
        rows = self.spark.read.text(log).withColumn("version", F.col("version").cast("int")).orderBy("version").collect()  # a row a version
        return [T.StructType.fromJson(json.loads(r.value)) for r in rows]

    def evolved(self, known: T.StructType, new: T.StructType) -> T.StructType:
        """known with the columns that new adds; a column of another type or spelling is an error."""
        types, lower = {f.name: f.dataType for f in known}, {f.name.lower(): f.name for f in known}
        added = []
        for f in new:
            if f.name in types:
                if types[f.name] != f.dataType:
                    raise ValueError(f"column {f.name} is {types[f.name].simpleString()} and can't become {f.dataType.simpleString()}")
            elif f.name.lower() in lower:
                raise ValueError(f"column {f.name} is known as {lower[f.name.lower()]}")
            else:
                added.append(T.StructField(f.name, f.dataType))
        return T.StructType([*known.fields, *added])

    def write(self, rows: DataFrame, time: str = "requestInTs") -> None:
        dated = rows.withColumn("requestInDate", X.to_day(F.col(time)))
        known = self.versions()
        new = self.evolved(known[-1] if known else T.StructType(), dated.schema)
        if not known or new != known[-1]:
            self.spark.createDataFrame([(json.dumps(new.jsonValue()),)], "value string").coalesce(1).write.text(f"{self.path}/_schemas/version={len(known) + 1}")
        dated.hint("rebalance", "requestInDate").write.mode("append").partitionBy("requestInDate").parquet(f"{self.path}/rows")  # few files a day, large days split

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.versions()[-1]).parquet(f"{self.path}/rows")


def write_logs(rows: DataFrame, path: str, time: str = "requestInTs") -> None:
    """Append to the published logs, partitioned by day; columns may be added, see LogTable."""
    LogTable(rows.sparkSession, path).write(rows, time)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return LogTable(spark, path).read()


def export_ndjson(rows: DataFrame, path: str) -> None:
    """Gzipped JSON lines with days as yyyy-MM-dd; nulls are written."""
    days = {c: F.date_format(c, "yyyy-MM-dd") for c, t in rows.dtypes if t == "date"}
    rows.withColumns(days).write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", False).json(path)


def split_archive(df: DataFrame, before: Column) -> tuple[DataFrame, DataFrame]:
    """Rows to archive and rows to keep; where the condition is unknown a row is kept."""
    old = F.coalesce(before, F.lit(False))
    return df.where(old), df.where(~old)


def archive_batch(df: DataFrame, before: Column, least: int, most: int, order: Sequence[str], bucket: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The first `most` old rows to archive, and all others to keep; nothing is archived below `least` old rows.

    order: columns that aren't null, the last of them a key, so that one row parts both. bucket: an expression that never
    falls along this order, such as the day of the time. One aggregation counts old rows by bucket, and only rows of the
    bucket that holds the last one are ordered; without it all old rows are.
    """
    old, _ = split_archive(df, before)
    counts = old.groupBy((F.lit(0) if bucket is None else bucket).alias("bucket")).agg(F.count("*").alias("n"))
    through = counts.withColumn("through", F.sum("n").over(Window.orderBy("bucket")))  # a row a bucket
    full = F.col("through") >= most
    at = through.agg(F.sum("n").alias("n"), F.min(F.when(full, F.col("bucket"))).alias("bucket"), F.min(F.when(full, F.col("through") - F.col("n"))).alias("earlier")).first()
    if most < 1 or (at["n"] or 0) < least:
        return df.limit(0), df
    if at["n"] <= most:
        return split_archive(df, before)
    here = old if bucket is None else old.where(bucket == F.lit(at["bucket"]))
    last = here.select(*order).orderBy(*order).limit(most - at["earlier"]).agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    return split_archive(df, before & (F.struct(*order) <= F.struct(*[F.lit(last[c]).alias(c) for c in order])))


def pointer(pointers: DataFrame, key: Sequence[str], wanted: DataFrame, start: float) -> DataFrame:
    """key and position of each wanted server or consumer; the start for those that have none yet."""
    return wanted.join(pointers, list(key), "left").select(*key, F.coalesce("position", F.lit(start)).alias("position"))


def moved(pointers: DataFrame, positions: DataFrame, key: Sequence[str], batch: int) -> DataFrame:
    """The log of pointers with new positions (key, position) under the number of their batch. Older ones stay in the log."""
    return pointers.unionByName(positions.select(*key, F.col("position").cast("double").alias("position"), F.lit(batch).alias("batch")))


def current(pointers: DataFrame, key: Sequence[str], until: int | None = None) -> DataFrame:
    """The position of each key after the last batch, or after batch `until`: a later one that failed is rolled back so."""
    log = pointers if until is None else pointers.where(F.col("batch") <= until)
    return log.groupBy(*key).agg(F.max_by("position", "batch").alias("position"))


def without_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows but those whose column is one of the values; unknown values stay."""
    return df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False))) if values else df


def of_version(models: DataFrame, name: str, version: int | None = None) -> DataFrame:
    """Rows of the model of that name, of the given version or of the newest."""
    mine = models.where(F.col("model_name") == name)
    return mine.where(F.col("version") == version) if version is not None else latest_rows(mine, "version")


def latest_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows of the greatest value of a column."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def archive(df: DataFrame, before: Column, path: str) -> DataFrame:
    """Write old rows as gzipped JSON and give the rest."""
    old, rest = split_archive(df, before)
    old.write.mode("append").option("compression", "gzip").json(path)
    return rest


def host_logs(raw: DataFrame, path: str, host: str = "securityServerInternalIp", most: int = 1_000_000) -> None:
    """JSON lines by day and host with a bound on a file's records.

    Rows are gathered by folder first, so that not every task opens a file in each; large folders are split over tasks.
    """
    out = raw.withColumns({"date": X.to_day(F.col("requestInTs")), "host": F.coalesce(F.col(host), F.lit("unknown"))})
    out.hint("rebalance", "date", "host").write.mode("append").partitionBy("date", "host").option("maxRecordsPerFile", most).json(path)


#: The four tables of a report: role, name, and what its two keys are.
REPORT_TABLES = {"ps": ("prod_serv", "service", "client"), "pms": ("prod_meta", "service", "client"), "cs": ("cons_serv", "producer", "service"), "cms": ("cons_meta", "producer", "service")}


def report_csv(rows: DataFrame, path: str, start: str, end: str) -> None:
    """A report's four tables as CSV under path/<table>/<start>_<end>, a folder for each subsystem, each with its own header.

    rows: `report.display` rows. Rows of a subsystem stand in the order of their number.
    """
    s = F.col("subsystem")
    flat = rows.withColumn("subsystem", F.concat_ws("/", s["instance"], s["memberClass"], s["memberCode"], s["subsystemCode"])) if dict(rows.dtypes)["subsystem"] != "string" else rows
    flat = written(flat)  # four tables come from rows that are made once
    for role, (table, first, second) in REPORT_TABLES.items():
        own = flat.where(F.col("role") == role).select("subsystem", "no", F.col("key1").alias(first), F.col("key2").alias(second), "succeeded", "failed", "duration_text", "request_text", "response_text")
        own.repartition("subsystem").sortWithinPartitions("subsystem", "no").write.mode("overwrite").partitionBy("subsystem").option("header", True).csv(f"{path}/{table}/{start}_{end}")


def upserted(state: DataFrame, updates: DataFrame, key: Sequence[str], time: str) -> DataFrame:
    """State rows with updates put in: the newest row of each key, updates before state at equal times."""
    both = state.withColumn("__u", F.lit(0)).unionByName(updates.withColumn("__u", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy(*key).orderBy(F.desc_nulls_last(time), F.desc("__u"))
    return both.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", "__u")
