"""The CSV and JSON exports as one ordered document each.

A document is a folder of text parts; read in the order of their names they are the document, byte by byte, with a line feed at its end.
Rows are dealt to parts by ranges of their order, so every task writes its own stretch and none holds the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import api

ORDER = ["session_id", "in_ord"]


def _placed(lines: DataFrame, head: list[str], tail: list[str] = ()) -> DataFrame:
    """lines with what stands before and after them: part 0, 1 and 2 of the document."""
    spark = lines.sparkSession
    rows = lines.select(F.lit(1).alias("part"), *[F.col(c).cast("string" if c == "session_id" else "long").alias(c) for c in ORDER], "line")
    ends = [(p, "", k, line) for p, more in ((0, head), (2, tail)) for k, line in enumerate(more)]
    return rows.unionByName(spark.createDataFrame(ends, "part int, session_id string, in_ord long, line string"))


def write_document(placed: DataFrame, path: str, parts: int | None = None) -> None:
    """Writes the lines in their order; an existing document is an error."""
    n = [] if parts is None else [parts]
    placed.repartitionByRange(*n, "part", *ORDER).sortWithinPartitions("part", *ORDER).select("line").write.text(path)


def csv_document(ballots: DataFrame, sessions: DataFrame) -> DataFrame:
    """The header and a line a ballot."""
    return _placed(api.csv_rows(ballots, sessions), [",".join(api.CSV_HEADERS)])


def _json(value: Column) -> Column:
    """A value as JSON text; null as null."""
    held = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNull(), "null").otherwise(F.substring(held, F.lit(6), F.length(held) - 6))


def _object(fields: list[tuple[str, Column]], indent: int) -> Column:
    """An object over several lines, its fields indented."""
    pad = " " * indent
    parts = [F.concat(F.lit(f'{pad}  "{name}": '), value) for name, value in fields]
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *parts), F.lit(f"\n{pad}}}"))


def _choices(choices: Column, indent: int) -> Column:
    pad = " " * indent
    entries = F.transform(F.map_entries(choices), lambda e: F.concat(F.lit(f"{pad}  "), _json(e["key"]), F.lit(": "), _json(e["value"])))
    full = F.concat(F.lit("{\n"), F.array_join(entries, ",\n"), F.lit(f"\n{pad}}}"))
    return F.when(choices.isNull(), "null").when(F.size(choices) == 0, "{}").otherwise(full)


def json_document(ballots: DataFrame, sessions: DataFrame, export_date: str) -> DataFrame:
    """{export_date, total_votes, votes} with the thirteen fields of every ballot, indented by two. Runs one job, which counts
    the ballots and finds the last, as all others are followed by a comma."""
    rows = ballots.join(sessions.select("session_id", "date", "time", "video_url", "agenda_url"), "session_id", "left")
    tally = F.col("tally")
    names = ("ayes", "noes", "abstentions")
    fields = [
        ("meeting_id", _json(F.col("session_id"))), ("date", _json(F.col("date"))), ("time", _json(F.col("time"))), ("agenda_item", _json(F.col("item_text"))), ("result", _json(F.col("outcome"))),
        ("vote_tally", F.when(tally.isNull(), "null").otherwise(_object([(c, _json(tally[c])) for c in names], 6))), ("individual_votes", _choices(F.col("choices"), 6)),
        ("video_timestamp", _json(F.col("video_ts"))), ("video_url", _json(F.col("video_url"))), ("agenda_url", _json(F.col("agenda_url"))), ("meta_id", _json(F.col("marker_id"))),
        ("frame_number", _json(F.col("frame_number"))), ("timestamp_estimated", _json(F.col("ts_estimated"))),
    ]
    found = ballots.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(*ORDER)).alias("last")).first()
    total, last = found.n, found.last
    line = F.concat(F.lit("    "), _object(fields, 4))
    if total:
        is_last = F.col("session_id").eqNullSafe(F.lit(last[0])) & F.col("in_ord").eqNullSafe(F.lit(last[1]))
        line = F.concat(line, F.when(is_last, "").otherwise(","))
    head = ["{", f'  "export_date": "{export_date}",', f'  "total_votes": {total},', '  "votes": [' if total else '  "votes": []']
    tail = ["  ]", "}"] if total else ["}"]
    return _placed(rows.select(*ORDER, line.alias("line")), head, tail)
