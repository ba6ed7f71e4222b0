"""Documents as whole variants: a row a file, checked file by file, and the elements of their lists in (file, place) order.

A file that is no JSON, lacks a section or holds something else than a list where one is read is an error that names the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: what is shown for a ballot without an item.
NO_ITEM = "No agenda item available"


def _or_error(value: Column, *message: Column | str) -> Column:
    return F.coalesce(value, F.raise_error(F.concat(*[F.lit(m) if isinstance(m, str) else m for m in message])))


def variants(spark: SparkSession, path: str) -> DataFrame:
    """file, file_name and doc (variant) of every file at path; a path without files is an error."""
    text = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"))
    return text.select("file", "file_name", _or_error(F.try_parse_json("value"), "no JSON document: ", F.col("file")).alias("doc"))


def present(doc: Column, section: str) -> Column:
    """Whether an object has the key; an explicit null counts as there."""
    return F.try_variant_get(doc, f"$.{section}", "variant").isNotNull()


def with_sections(docs: DataFrame, *required: str) -> DataFrame:
    """The same documents; reading one that lacks a section is an error that names file and section."""
    sound = F.lit(True)
    for section in required:
        sound = sound & F.when(present(F.col("doc"), section), True).otherwise(F.raise_error(F.concat(F.col("file"), F.lit(f" lacks {section}"))).cast("boolean"))
    return docs.where(sound)


def elements(docs: DataFrame, section: str | None = None) -> DataFrame:
    """in_ord (file, place) and v, a row for each element of the document's list, or of the list in a section."""
    path = f"$.{section}" if section else "$"
    listed = _or_error(F.try_variant_get("doc", path, "array<variant>"), F.col("file"), f" holds no list{f' {section}' if section else ''}")
    return docs.select("file_name", "file", F.posexplode(listed).alias("place", "v")).select(F.struct("file_name", "file", "place").alias("in_ord"), "v")


def entries(docs: DataFrame, section: str) -> DataFrame:
    """file, key and v, a row for each entry of an object in a section."""
    mapped = _or_error(F.try_variant_get("doc", f"$.{section}", "map<string,variant>"), F.col("file"), f" holds no object {section}")
    return docs.select("file", F.explode(mapped).alias("key", "v"))


def defaulted(v: Column, key: str, kind: str, default) -> Column:
    """The value of a key; the default only where the key is absent (an explicit null stays null)."""
    return F.when(present(v, key), F.try_variant_get(v, f"$.{key}", kind)).otherwise(F.lit(default).cast(kind))


def is_kind(v: Column, kind: str) -> Column:
    """kind: OBJECT, ARRAY, STRING and so on."""
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit(kind)), F.lit(False))


def shown_item(v: Column, placeholder: str = NO_ITEM) -> Column:
    """An item as it is shown: an object's description, else its number, else the placeholder; a text itself, '' as none."""
    text = lambda path: F.nullif(F.try_variant_get(v, path, "string"), F.lit(""))
    return F.coalesce(F.when(is_kind(v, "OBJECT"), F.coalesce(text("$.description"), text("$.number"))).otherwise(text("$")), F.lit(placeholder))


def counted_choices(v: Column) -> Column:
    """The choice map as it is counted for statistics: a list, or anything that is no object, is empty."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.when(is_kind(v, "OBJECT"), F.try_variant_get(v, "$", "map<string,string>")).otherwise(empty)


CANDIDATE = (
    ("frame_path", "string"), ("frame_name", "string"), ("frame_number", "int"), ("confidence", "double"), ("detection_method", "string"),
    ("raw_text", "string"), ("has_votable_indicators", "boolean"), ("meeting_id", "string"),
)


def candidate_rows(spark: SparkSession, path: str) -> DataFrame:
    """OCR candidates of many files with in_ord; a field of another type is null."""
    rows = elements(variants(spark, path))
    return rows.select("in_ord", *[F.try_variant_get("v", f"$.{name}", kind).alias(name) for name, kind in CANDIDATE])


def choice_rows(spark: SparkSession, path: str) -> DataFrame:
    """in_ord, session, frame and choices of the ballots in many files, ready for an equi-join that the last row wins."""
    from .documents import choices_of

    rows = elements(variants(spark, path))
    return rows.select(
        "in_ord", F.try_variant_get("v", "$.meeting_id", "string").alias("session_id"), F.try_variant_get("v", "$.frame_number", "int").alias("frame_number"),
        choices_of(F.try_variant_get("v", "$.individual_votes", "variant")).alias("choices"),
    )
