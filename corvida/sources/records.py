"""Sources and sinks: records of several layouts, lexicons, subtitle cues, immutable snapshots, resumable appends."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvida.operators.tables import numbered


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON records, one a line or as one array: the first character of the first file tells. Blank lines are skipped."""
    first = spark.read.text(path).where("trim(value) <> ''").limit(1).collect()
    array = bool(first) and first[0]["value"].lstrip().startswith("[")
    return spark.read.schema(schema).option("multiLine", array).json(path)


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(text, audio, dataset, source_file) of transcript shards whose keys differ; empty texts are dropped."""
    names = ("text", "transcript", "file_name", "audio", "audio_filepath", "dataset")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = read_records(spark, path, schema).withColumn("source_file", F.col("_metadata.file_name"))
    text = F.coalesce(F.when(F.col("text") != "", F.col("text")), F.col("transcript"))
    return rows.select(text.alias("text"), F.coalesce("file_name", "audio", "audio_filepath").alias("audio"), "dataset", "source_file").where("length(text) > 0")


def read_lexicon(spark: SparkSession, path: str, word: str) -> DataFrame:
    """A CSV with a header: trimmed words, blank ones dropped, of equal ones the last row at the place of the first."""
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    clean = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns)).withColumn("_pos", F.monotonically_increasing_id()).withColumn(word, F.trim(word)).where(F.col(word) != "")
    rest = [c for c in clean.columns if c not in (word, "_pos")]
    chosen = clean.groupBy(word).agg(F.max_by(F.struct(*rest), "_pos").alias("row"), F.min("_pos").alias("_pos"))
    return chosen.select(word, *(F.col("row")[c].alias(c) for c in rest), "_pos")


def read_cues(spark: SparkSession, path: str) -> DataFrame:
    """(file, cue, start, end, text) of SRT or VTT files, seconds to the millisecond; cues without text are dropped."""
    stamp = r"(?:(\d+):)?(\d{1,2}):(\d{2})[.,](\d{3})"
    blocks = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.posexplode(F.split(F.regexp_replace("value", "\r", ""), r"\n\s*\n")).alias("cue", "block")
    )
    pattern = rf"{stamp}\s*-->\s*{stamp}[^\n]*\n?((?s:.*))$"
    part = lambda i: F.coalesce(F.regexp_extract("block", pattern, i).try_cast("long"), F.lit(0))
    seconds = lambda i: (((part(i) * 60 + part(i + 1)) * 60 + part(i + 2)) * 1000 + part(i + 3)) / 1000.0
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("block", pattern, 9), "<[^>]*>", ""), r"\s+", " "))
    return blocks.select("file", "cue", seconds(1).alias("start"), seconds(5).alias("end"), text.alias("text")).where("text <> ''")


def _folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the snapshots below a path, by the file system that the path belongs to."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n[4:]) for n in names if n.startswith("ver=") and n[4:].isdigit())


def list_versions(spark: SparkSession, path: str) -> list[int]:
    return _folders(spark, path)


def save_version(df: DataFrame, path: str) -> int:
    """Write an immutable snapshot under the next number. Spark's commit protocol makes it appear whole or not at all."""
    number = max(_folders(df.sparkSession, path), default=0) + 1
    df.write.mode("errorifexists").parquet(f"{path}/ver={number}")
    return number


def load_version(spark: SparkSession, path: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{path}/ver={number}")


def append_missing(new: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the output lacks: a run that was broken off goes on where it ended."""
    spark = new.sparkSession
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    exists = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)
    rows = new.join(spark.read.parquet(path).select(key), key, "left_anti") if exists else new
    rows.write.mode("append").parquet(path)


def log_failures(rows: DataFrame, path: str, task: str) -> None:
    """Append (id, error, model) to the failure log of a task: base ids, errors of 1,000 characters at most."""
    rows.select(F.lit(task).alias("task"), F.substring_index("id", "__", 1).alias("id"), F.substring("error", 1, 1000).alias("error"), "model").write.mode("append").partitionBy("task").json(path)


def read_tolerant(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Records of files of which each may be JSON lines or one array: every file is read in its own mode."""
    parts = [read_records(spark, path, schema) for path in paths]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_grouped_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(text, audio, dataset) of a JSON object from dataset names to lists of records; audio without a path gets data/<dataset>/<audio>."""
    record = "map<string,array<struct<text:string,transcript:string,audio:string,audio_filepath:string>>>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", record).alias("groups"))
    rows = whole.select(F.explode("groups").alias("dataset", "records")).select("dataset", F.explode("records").alias("r"))
    text = F.coalesce(F.when(F.col("r.text") != "", F.col("r.text")), F.col("r.transcript"))
    audio = F.coalesce("r.audio_filepath", F.when(F.col("r.audio").contains("/"), F.col("r.audio")), F.concat_ws("/", F.lit("data"), "dataset", "r.audio"))
    return rows.select(text.alias("text"), audio.alias("audio"), "dataset").where("length(text) > 0")


def union_of_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """The union of the configured sources with their name in `origin`; an error when there is none."""
    if not parts:
        raise ValueError("no corpus source is configured")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("origin", F.lit(name)) for name, df in parts.items()))


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """(word, note) of a JSON array of web candidates; blank words are dropped."""
    rows = spark.read.schema("word string, note string").option("multiLine", True).json(path)
    return rows.select(F.trim("word").alias("word"), F.coalesce("note", F.lit("")).alias("note")).where("word <> ''")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(token) of a file with one token a line: trimmed, lower case, each once."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("token")).where("token <> ''").distinct()


def read_line_files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(system, line, text) of parallel files, one segment a line, numbered from 0; a file is read whole, as its lines count."""
    parts = []
    for system, path in sorted(paths.items()):
        lines = F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")
        parts.append(spark.read.text(path, wholetext=True).select(F.lit(system).alias("system"), F.posexplode(lines).alias("line", "text")))
    return reduce(DataFrame.unionByName, parts)


def read_cached(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Cached results; a corrupt entry is a cache miss, and so is a missing folder."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], schema)
    corrupt = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(corrupt).option("mode", "PERMISSIVE").json(path).where("_corrupt_record is null").drop("_corrupt_record")


def write_csv(df: DataFrame, path: str, order: list[str], number: str | None = None) -> None:
    """A CSV with a header in the given order, nulls as empty cells; `number` names a column of numbers from 1."""
    rows = numbered(df, order, "_n").withColumn(number, F.col("_n") + 1).drop("_n") if number else df
    rows = rows.select(*([number] if number else []), *df.columns)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns]
    rows.orderBy(*order).select(*cells).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_split(df: DataFrame, paths: dict[str, Column | None]) -> None:
    """Several outputs of one pass: all rows, and those for which a condition holds."""
    kept = df.persist()
    try:
        for path, condition in paths.items():
            (kept if condition is None else kept.where(condition)).write.mode("overwrite").json(path)
    finally:
        kept.unpersist()


def publish_version(df: DataFrame, path: str, passed: bool) -> int:
    """A snapshot under the next number and a row of it in the index; a number that another writer took is not reused."""
    for _ in range(10):
        try:
            number = save_version(df, path)
            break
        except AnalysisException:  # the folder appeared in the meantime
            continue
    else:
        raise RuntimeError(f"no free version below {path}")
    rows = df.sparkSession.createDataFrame([(number, df.count(), passed)], "version int, rows long, passed boolean")
    rows.withColumn("written_at", F.current_timestamp()).write.mode("append").json(f"{path}/index")
    return number


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table with the columns that a newer schema adds, null; columns that are there stay. Doing it twice changes nothing."""
    return df.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in df.columns))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """(batch, turn, state) of relay checkpoints: the last state of each batch that was parsed."""
    turns = spark.read.schema("batch long, turn long, state string").json(path).where("state is not null")
    return turns.groupBy("batch").agg(F.max("turn").alias("turn"), F.max_by("state", "turn").alias("state"))


def markdown_table(df: DataFrame, order: list[str]) -> DataFrame:
    """One row, `report`: a small table of metrics as Markdown, in order."""
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns)), F.lit(" |"))
    head = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    lines = df.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, row.alias("_row")))), lambda x: x["_row"]).alias("rows"))
    return lines.select(F.concat_ws("\n", F.lit(head[0]), F.lit(head[1]), "rows").alias("report"))
