"""Transcripts as markdown: rendering, and reading back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.functions import text as X

# How a transcript is written.
ME, THEM = "## Me", "### ChatGPT"
FRONTMATTER = r"(?s)\A---\n.*?\n---\n"
SPEAKER = r"(?m)^(?:## Me|### ChatGPT)$"
SOURCE_NAME = "chatgpt-export"
# End of the fixed values.


def render(rows: DataFrame, turns: DataFrame) -> DataFrame:
    """(file, content): frontmatter, title and turns. rows: conv_no, file, title, conv_date, conversation_id and counts."""
    who = F.when(F.col("role") == "user", ME).otherwise(THEM)
    said = turns.groupBy("conv_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat(who, F.lit("\n\n"), F.col("text"), F.lit("\n")).alias("t")))), lambda x: x["t"]), "\n").alias("said"))
    date = F.when(F.col("conv_date") == "0000-00-00", "unknown").otherwise(F.col("conv_date"))
    head = F.format_string('---\ntitle: "%s"\ndate: "%s"\nsource: "%s"\nconversation_id: "%s"\nuser_turns: %d\nuser_words: %d\ndays_touched: %d\n---\n\n# %s\n\n', "title", date, F.lit(SOURCE_NAME), F.coalesce("conversation_id", F.lit("")), "user_turns", "user_words", "days_touched", "title")
    return rows.join(said, "conv_no").select("file", F.concat(head, "said").alias("content"))


def write_files(files: DataFrame, folder: str) -> None:
    """One text file per row (file, content), written by the tasks; a retried task writes the same bytes again."""

    def put(batches):
        import os

        import pyarrow as pa
        import pyarrow.fs as pafs

        base = folder.removeprefix("file://") if "://" not in folder or folder.startswith("file://") else folder
        fs, root = (pafs.LocalFileSystem(), base) if "://" not in base else pafs.FileSystem.from_uri(base)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_output_stream(os.path.join(root, name)) as out:
                    out.write(content.encode("utf-8"))
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    files.select("file", "content").mapInArrow(put, "n long").agg(F.sum("n")).collect()


def read(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(file, content) of the markdown files of a folder."""
    path = f"{folder}/{pattern}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath):
        return spark.createDataFrame([], "file string, content string")
    return spark.read.text(path, wholetext=True).select(F.regexp_replace(F.col("_metadata.file_path"), r".*/", "").alias("file"), F.col("value").alias("content"))


def dialogue(files: DataFrame, keep_blank: bool = False) -> DataFrame:
    """(file, pos, role, text) of every turn of transcripts; blank turns are dropped unless kept."""
    body = F.regexp_replace("content", FRONTMATTER, "")
    rows = files.withColumn("_body", body)
    speakers = F.regexp_extract_all("_body", F.lit(f"({SPEAKER})"), 1)
    said = F.split("_body", SPEAKER)
    both = F.zip_with(speakers, F.slice(said, F.lit(2), F.greatest(F.size(said) - 1, F.lit(0))), lambda s, t: F.struct(F.when(s == ME, "user").otherwise("assistant").alias("role"), X.strip(t).alias("text")))
    out = rows.select("file", F.posexplode(both).alias("pos", "turn")).select("file", "pos", "turn.role", "turn.text")
    return out if keep_blank else out.where("text <> ''")


def user_turns(files: DataFrame) -> DataFrame:
    """(file, pos, text) of the owner's turns alone, blank ones left out."""
    return dialogue(files).where("role = 'user'").select("file", "pos", "text")


def as_turns(files: DataFrame, keep_blank: bool = True) -> DataFrame:
    """Transcripts as turns (conv_no, pos, role, text, ts), a conversation for each file; times aren't in them."""
    return dialogue(files, keep_blank).select(F.xxhash64("file").alias("conv_no"), "pos", "role", "text", F.lit(None).cast("double").alias("ts"))


def read_index(spark: SparkSession, index: str, transcripts: str | None = None) -> DataFrame:
    """The index that sinks.write_index wrote; ids that an older one lacks come from the heads of the transcripts."""
    rows = spark.read.json(index)
    if "conversation_id" not in rows.columns:
        rows = rows.withColumn("conversation_id", F.lit(None).cast("string"))
    return backfill_ids(rows, read(spark, transcripts)) if transcripts else rows


def backfill_ids(index: DataFrame, files: DataFrame) -> DataFrame:
    """index with missing conversation_ids from the heads of the transcripts of the same file name."""
    from threadmill.operators.review import CONVERSATION_ID

    head = files.select("file", F.nullif(F.trim(F.regexp_extract(F.substring("content", 1, 2000), CONVERSATION_ID, 1)), F.lit("")).alias("_id"))
    return index.join(head, "file", "left").withColumn("conversation_id", F.coalesce(F.nullif("conversation_id", F.lit("")), "_id")).drop("_id")
