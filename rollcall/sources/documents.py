"""Sources and sinks of meeting documents: polymorphic JSON in, CSV and JSON out, versioned writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BALLOT = "id string, meeting_id string, agenda_item variant, frame_number variant, individual_votes variant, result string, vote_tally struct<ayes:int,noes:int,abstentions:int,recused:int,recusals:int>, confidence variant, motion_text string, frame_path string, meta_id string, video_timestamp int, timestamp_estimated boolean"
SESSION = "id string, title string, date string, time string, video_url string, agenda_url string"
ROOT = f"votes array<struct<{', '.join(x.replace(' ', ':', 1) for x in BALLOT.split(', '))}>>, meetings map<string, struct<{', '.join(x.replace(' ', ':', 1) for x in SESSION.split(', '))}>>"


def read_document(spark: SparkSession, path: str, required: tuple[str, ...] = ("votes", "meetings")) -> DataFrame:
    """One row a document; reading one that lacks a required section is an error that names the file and the section."""
    df = spark.read.option("multiLine", True).schema(ROOT).json(path)
    sound = F.lit(True)
    for c in required:
        lacks = F.raise_error(F.concat(F.col("_metadata.file_path"), F.lit(f" lacks {c}"))).cast("boolean")
        sound = sound & F.when(F.col(c).isNotNull(), True).otherwise(lacks)
    return df.where(sound)


def read_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """The document, or an empty frame of its schema where the path does not exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or ():
        return spark.read.option("multiLine", True).schema(ROOT).json(path)
    return spark.createDataFrame([], ROOT)


def text_of(v: Column, *paths: str) -> Column:
    return F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths])


def item_text(v: Column) -> Column:
    """An item that is text, an object {number, description} or null."""
    is_object = F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
    part = lambda path: F.coalesce(text_of(v, path), F.lit(""))
    numbered = F.trim(F.concat(part("$.number"), F.lit(". "), part("$.description")))
    return F.when(is_object, numbered).otherwise(F.try_variant_get(v, "$", "string"))


def choices_of(v: Column) -> Column:
    """Choices as map<member, choice>: of a map, or of a list of {council_member|name, vote} (a later entry wins)."""
    listed = F.from_json(F.to_json(v), "array<struct<council_member:string,name:string,vote:string>>")
    names = F.array_distinct(F.transform(listed, lambda x: F.coalesce(x["council_member"], x["name"])))
    last = F.transform(names, lambda m: F.element_at(F.filter(listed, lambda x: F.coalesce(x["council_member"], x["name"]) == m), -1)["vote"])
    is_list = F.startswith(F.schema_of_variant(v), F.lit("ARRAY"))
    return F.when(is_list, F.map_from_arrays(names, last)).otherwise(F.from_json(F.to_json(v), "map<string,string>"))


def ballots(documents: DataFrame) -> DataFrame:
    """Silver ballots with their input order."""
    rows = documents.select(F.posexplode("votes").alias("in_ord", "v")).select(F.col("in_ord").cast("long"), "v.*")
    return rows.select(
        F.col("id").alias("ballot_id"), F.col("meeting_id").alias("session_id"), item_text(F.col("agenda_item")).alias("item_text"),
        F.expr("try_cast(try_variant_get(frame_number, '$', 'string') as int)").alias("frame_number"), F.col("result").alias("outcome"), "vote_tally",
        F.coalesce("vote_tally.recused", "vote_tally.recusals").alias("recused"), choices_of(F.col("individual_votes")).alias("choices"),
        F.coalesce(F.try_variant_get("confidence", "$", "double"), F.try_variant_get("confidence", "$.overall", "double")).alias("confidence"),
        "motion_text", "frame_path", F.col("meta_id").alias("marker_id"), F.col("video_timestamp").alias("video_ts"), F.col("timestamp_estimated").alias("ts_estimated"), "in_ord",
    )


def sessions(documents: DataFrame) -> DataFrame:
    return documents.select(F.explode("meetings").alias("session_id", "m")).select("session_id", "m.title", "m.date", "m.time", "m.video_url", "m.agenda_url")


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """Session and number of every frame image below a folder; contents are not read."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jpg").load(folder).select("path")
    return names.select(F.regexp_extract("path", r"votable_frames_(\d+)", 1).alias("session_id"), F.expr(r"try_cast(regexp_extract(path, 'frame_(\\d+)[.]jpg', 1) as int)").alias("frame_number"), "path")


def framed_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """session_id of every session that has frames below a folder."""
    return frames(spark, folder).select("session_id").where("session_id <> ''").distinct()


def markers(html: Column) -> Column:
    """Map of marker id to seconds from time/data-id attributes; the last of an id wins."""
    pattern = r'(?s)time="(\d+)".*?data-id="(\d+)"'
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("id"), F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("t"))
    ids = F.array_distinct(F.transform(pairs, lambda x: x["id"]))
    return F.map_from_arrays(ids, F.transform(ids, lambda i: F.element_at(F.filter(pairs, lambda x: x["id"] == i), -1)["t"].cast("int")))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_document(df: DataFrame, path: str, version: str, dry_run: bool = False) -> None:
    """A versioned write that never overwrites an earlier version; a dry run computes everything and writes nothing.

    A version counts once its write has been committed: a run that breaks off leaves the earlier one as the latest."""
    if dry_run:
        df.write.format("noop").mode("overwrite").save()
    else:
        df.write.mode("errorifexists").json(f"{path}/v={version}")


def versions(spark: SparkSession, path: str) -> list[str]:
    """The committed versions below path, ascending by name."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/_SUCCESS")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or ()
    return sorted(x.getPath().getParent().getName().removeprefix("v=") for x in found)


def read_version(spark: SparkSession, path: str, schema: str, version: str | None = None) -> DataFrame:
    """A version of a document (the latest, if none is named); without any, no rows."""
    at = version if version is not None else next(reversed(versions(spark, path)), None)
    return spark.createDataFrame([], schema) if at is None else spark.read.schema(schema).json(f"{path}/v={at}")
