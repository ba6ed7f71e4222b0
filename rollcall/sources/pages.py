"""What is read out of pages and files that are not meeting documents: anchors, times, stream addresses, plain text; and
catalogs of sessions with a fallback, made-up frames for sessions without any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import text as tx

CATALOG = "clip_id string, title string, date string, video_url string, agenda_url string, total_chapters int, votable_chapters int, process_entire_video boolean"
#: Where a stream's address may stand in a page, in order.
STREAMS = (r'"(?:file|src|url)"\s*:\s*"([^"]+\.m3u8[^"]*)"', r'(?:src|href)="([^"]+\.m3u8[^"]*)"', r"'([^']+\.m3u8[^']*)'")


def anchors(html: Column, parameter: str, least: int = 0) -> Column:
    """Array of (id, text) of the links whose address has parameter=<digits>; texts no longer than least are left out."""
    pattern = rf'<a\b[^>]*href="[^"]*\b{parameter}=(\d+)[^"]*"[^>]*>([^<]*)</a>'
    ids, texts = (F.regexp_extract_all(html, F.lit(pattern), F.lit(k)) for k in (1, 2))
    pairs = F.transform(F.arrays_zip(ids.alias("id"), texts.alias("text")), lambda x: F.struct(x["id"].alias("id"), tx.strip(x["text"]).alias("text")))
    return F.filter(pairs, lambda x: F.length(x["text"]) > least)


def times(html: Column) -> Column:
    """All times of a page's chapters, ascending."""
    return F.array_sort(F.transform(F.regexp_extract_all(html, F.lit(r'time="(\d+)"'), F.lit(1)), lambda x: x.cast("int")))


def stream_url(html: Column, host: str) -> Column:
    """The first stream address by the known places, made absolute; null if there is none."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in STREAMS])
    return F.when(F.startswith(found, F.lit("//")), F.concat(F.lit("https:"), found)).when(F.startswith(found, F.lit("/")), F.concat(F.lit(host), found)).otherwise(found)


def text_of_bytes(content: Column) -> Column:
    """Bytes as UTF-8 text; what is none is dropped, a replacement character that the text holds stays."""
    mark = "\ufdd0"  # a noncharacter; where the text holds it, it is doubled by a letter and restored
    held = F.replace(F.replace(content.cast("string"), F.lit(mark), F.lit(f"{mark}a")), F.lit("\ufffd"), F.lit(f"{mark}b"))
    clean = F.replace(F.make_valid_utf8(held), F.lit("\ufffd"), F.lit(""))
    return F.replace(F.replace(clean, F.lit(f"{mark}b"), F.lit("\ufffd")), F.lit(f"{mark}a"), F.lit(mark))


def made_up_frames(catalog: DataFrame, per_chapter: int = 10, step: int = 100) -> DataFrame:
    """clip_id, frame_number: per_chapter frames in each votable chapter, at chapter * 1000 plus multiples of step."""
    chapter = catalog.select("clip_id", F.explode(F.sequence(F.lit(1), F.col("votable_chapters"))).alias("chapter"))
    return chapter.select("clip_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(per_chapter - 1)), lambda k: F.col("chapter") * 1000 + k * step)).alias("frame_number"))


def catalog_of_pages(pages: DataFrame, html: str = "html", low: int = 10_000, high: int = 15_000) -> DataFrame:
    """The catalog that listing pages hold: sessions whose number is likely, each once, with the first of its titles by name."""
    found = pages.select(F.explode(anchors(F.col(html), "clip_id")).alias("a")).select("a.id", "a.text")
    likely = found.where(F.expr(f"coalesce(try_cast(id AS bigint) BETWEEN {low} AND {high}, false)"))
    one = likely.groupBy(F.col("id").alias("clip_id")).agg(F.min(F.nullif("text", F.lit(""))).alias("title"))
    return one.select("clip_id", "title", *[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in CATALOG.split(", ")[2:])])


def catalog(spark: SparkSession, *paths: str, pages: DataFrame | None = None, sample: list[tuple] | None = None) -> DataFrame:
    """The first of the files that is there; without any, what the pages hold; without that, the sample's rows."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(hadoop).exists(where):
            return spark.read.schema(CATALOG).option("multiLine", True).json(path)
    if pages is not None and not (listed := catalog_of_pages(pages)).isEmpty():
        return listed
    return spark.createDataFrame(sample or [], CATALOG)


def write_sessions(results: DataFrame, path: str) -> None:
    """One folder of JSON a session."""
    results.write.mode("overwrite").partitionBy("session_id").json(path)


def mirror(df: DataFrame, path: str, key: str) -> DataFrame:
    """Copies df to path, reads it back and gives one row: rows and distinct keys on both sides, and whether they agree."""
    df.write.mode("errorifexists").parquet(path)
    count = lambda d, k: d.agg(F.count(F.lit(1)).alias(f"rows_{k}"), F.countDistinct(key).alias(f"keys_{k}"))
    both = count(df, "own").crossJoin(count(df.sparkSession.read.schema(df.schema).parquet(path), "copy"))  # single rows
    return both.withColumn("agree", (F.col("rows_own") == F.col("rows_copy")) & (F.col("keys_own") == F.col("keys_copy")))
