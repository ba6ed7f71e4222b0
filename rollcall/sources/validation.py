"""What is wrong with a document: absent keys (a null is there) and wrong kinds, as issue texts, file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .variants import is_kind, present

#: Keys that must be there.
TOP, BALLOT, SESSION = ("votes", "meetings"), ("meeting_id", "agenda_item"), ("title", "date")
#: The stricter set of the last check before a save.
TOP_STRICT = ("votes", "meetings", "metadata")


def _absent(df: DataFrame, place, start: str, keys: tuple[str, ...], end: str = "") -> DataFrame:
    texts = [F.when(~present(F.col("v"), k), F.concat(F.lit(start), place, F.lit(f"Missing required field{end.format(k)}"))) for k in keys]
    return df.select("file", F.explode(F.array_compact(F.array(*texts))).alias("issue"))


def issues(docs: DataFrame) -> DataFrame:
    """file and issue of documents (file, doc): sections, then ballots by place, then sessions by id. A section of another kind has
    no elements to look at."""
    top = _absent(docs.select("file", F.col("doc").alias("v")), F.lit(""), "", TOP, ": {}")
    listed = F.try_variant_get("doc", "$.votes", "array<variant>")
    ballots = docs.select("file", F.posexplode(listed).alias("place", "v"))
    mapped = F.try_variant_get("doc", "$.meetings", "map<string,variant>")
    sessions = docs.select("file", F.explode(mapped).alias("key", "v"))
    of_ballots = _absent(ballots, F.concat(F.col("place").cast("string"), F.lit(": ")), "Vote ", BALLOT, " '{}'")
    of_sessions = _absent(sessions, F.concat("key", F.lit(": ")), "Meeting ", SESSION, " '{}'")
    return top.union(of_ballots).union(of_sessions)


def first_fault(docs: DataFrame) -> DataFrame:
    """file and fault (null if there is none) of the strict check: sections there, ballots a list of objects with their keys."""
    ballots = docs.select("file", F.posexplode_outer(F.try_variant_get("doc", "$.votes", "array<variant>")).alias("place", "v"))
    number = F.col("place").cast("string")
    texts = [F.when(~is_kind(F.col("v"), "OBJECT"), F.concat(F.lit("Vote "), number, F.lit(" must be a dictionary")))]
    texts += [F.when(~present(F.col("v"), k), F.concat(F.lit("Vote "), number, F.lit(f" missing required key: {k}"))) for k in BALLOT]
    worst = ballots.where("place is not null").withColumn("t", F.coalesce(*texts)).where("t is not null").groupBy("file").agg(F.min_by("t", "place").alias("of_ballots"))
    top = F.coalesce(*[F.when(~present(F.col("doc"), k), F.lit(f"Missing required key: {k}")) for k in TOP_STRICT])
    kind = F.when(~is_kind(F.try_variant_get("doc", "$.votes", "variant"), "ARRAY"), "Votes must be a list")
    return docs.join(worst, "file", "left").select("file", F.coalesce(top, kind, "of_ballots").alias("fault"))
