"""Records of one large CSV or JSON file, read by all tasks.

A record may span lines, and whether a line end or comma ends one depends on all
quotes and brackets before it. So Spark's text reader cuts files into byte
ranges at a separator (line ends for CSV, commas for JSON), from any store, and
each range is read twice. The first reading says what the range does from each
state it may begin in: inside or outside of quotes, how deep the brackets go,
how many records end at each depth. Put one after the other for each file (one
small row a range), these give the true state and record number at the start of
every range. The second reading cuts the records; what the ends of two ranges
share is put together by its number.

No row holds more than one record, and nothing but the rows of the ranges is
gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.session import fits, materialise

#: Ranges of all files; their rows, some 100 bytes each, are broadcast.
MAX_RANGES = 1 << 20
_JSON_MARKS = re.compile(r'\\.|["\[\]{}]', re.DOTALL)


class Format(NamedTuple):
    """How records are cut: the separator, whether JSON, and the bracket depth up to which separators end a record."""

    separator: str
    json: bool
    depth: int


CSV = Format("\n", False, 0)
JSON_ARRAY = Format(",", True, 1)
JSON_COLUMNS = Format(",", True, 2)


def _after_csv(piece: str, inside: bool) -> tuple[bool, int]:
    """Whether a line ends inside quotes, from whether it begins there."""
    if '"' not in piece:
        return inside, 0
    at = 0
    while True:
        if not inside:
            if not piece.startswith('"', at):
                at = piece.find(",", at) + 1
                if not at:
                    return False, 0
                continue
            at, inside = at + 1, True
        at = piece.find('"', at)
        if at < 0:
            return True, 0
        if piece.startswith('"', at + 1):  # a doubled quote
            at += 2
            continue
        inside = False
        at = piece.find(",", at + 1) + 1
        if not at:
            return False, 0


def _after_json(piece: str, inside: bool) -> tuple[bool, int]:
    """Whether a piece ends inside a string, and how much deeper it ends."""
    deeper = 0
    for mark in _JSON_MARKS.finditer(piece):
        char = mark.group()
        if char == '"':
            inside = not inside
        elif not inside:
            deeper += 1 if char in "[{" else -1 if char in "]}" else 0
    return inside, deeper


def _pieces(spark: SparkSession, path: str, form: Format) -> DataFrame:
    """(file, range, value) in the order of the file within each range."""
    rows = spark.read.option("lineSep", form.separator).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value")


def _runs(batches: Iterator[pa.RecordBatch], *extra: str) -> Iterator[tuple]:
    """(file, range, extra, value) of all rows of a task."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("file", "range", *extra, "value")))


def _starts(pieces: DataFrame, form: Format) -> DataFrame:
    """(file, range, inside, level, number, member, crlf): the state in which each range begins, and whether the file's first line ends with a carriage return."""
    after = _after_json if form.json else _after_csv

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, states = None, []

        def row() -> pa.RecordBatch:
            columns = [[own[0]], [own[1]], [crlf]]
            for inside, level, ends in states:
                columns += [[inside], [level], [list(ends)], [list(ends.values())]]
            types = [pa.string(), pa.int64(), pa.bool_()] + 2 * [pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for file, start, value in _runs(batches):
            if (file, start) != own:
                if own:
                    yield row()
                own, states, crlf = (file, start), [(False, 0, {}), (True, 0, {})], not form.json and value.endswith("\r")
            for k, (inside, level, ends) in enumerate(states):
                inside, deeper = after(value, inside)
                level += deeper
                if not inside:
                    ends[level] = ends.get(level, 0) + 1
                states[k] = inside, level, ends
        if own:
            yield row()

    sides = [f"{side}_{what}" for side in ("out", "in") for what in ("inside", "level", "depths", "counts")]
    names = ["file", "range", "crlf", *sides]
    kinds = {"inside": "boolean", "level": "long", "depths": "array<long>", "counts": "array<long>"}
    summary = pieces.mapInArrow(read, ", ".join(["file string", "range long", "crlf boolean", *(f"{s} {kinds[s.split('_')[1]]}" for s in sides)]))

    def composed(table: pa.Table) -> pa.Table:
        inside, level, number, member, out = False, 0, 0, 0, []
        rows = table.sort_by("range").to_pylist()
        for row in rows:
            out.append((row["file"], row["range"], inside, level, number, member, rows[0]["crlf"]))
            side = "in" if inside else "out"
            for depth, n in zip(row[f"{side}_depths"], row[f"{side}_counts"]):
                number += n if level + depth <= form.depth else 0
                member += n if level + depth == 1 else 0
            inside, level = row[f"{side}_inside"], level + row[f"{side}_level"]
        types = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], ["file", "range", *state])

    state = ("inside", "level", "number", "member", "crlf")
    fields = "file string, range long, inside boolean, level long, number long, member long, crlf boolean"
    return summary.groupBy("file").applyInArrow(composed, fields)


def records(spark: SparkSession, path: str, form: Format) -> DataFrame:
    """(file, number, member, text, last): the records of each file, numbered from 0.

    ``member`` counts the separators at depth 1 before a record. ``last`` marks
    the record in which a JSON file's brackets are closed.
    """
    pieces = _pieces(spark, path, form)
    starts = materialise(_starts(pieces, form), "ranges")
    if not fits(starts, MAX_RANGES):
        raise ValueError(f"more than {MAX_RANGES} ranges: raise spark.sql.files.maxPartitionBytes")
    after = _after_json if form.json else _after_csv
    fields = "file string, number long, member long, range long, whole boolean, last boolean, text string"
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
    state = ("inside", "level", "number", "member", "crlf")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, out, first = None, [], [], True

        def left() -> list[tuple]:
            """What a range ends with: the beginning of a record, or nothing."""
            return [(*own[:1], number, begun, own[1], False, form.json and level == 0 and not inside, form.separator.join(held))] if held else []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = [f.split()[0] for f in fields.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

        for file, start, *begin, value in _runs(batches, *state):
            if (file, start) != own:
                if own:
                    out += left()
                own, held, first = (file, start), [], True
                inside, level, number, member, crlf = begin
                begun = member
            held.append(value.removesuffix("\r") if crlf else value)
            inside, deeper = after(value, inside)
            level += deeper
            # the end of a JSON file has no separator after it
            if not inside and level <= form.depth and (level > 0 or not form.json):
                out.append((file, number, begun, start, not first, False, form.separator.join(held)))
                number, held, first = number + 1, [], False
                member += level == 1
                begun = member
                if len(out) >= 5000:
                    yield batch_of(out)
                    out = []
        if own:
            out += left()
        if out:
            yield batch_of(out)

    found = pieces.join(F.broadcast(starts), ["file", "range"]).select("file", "range", *state, "value").mapInArrow(cut, fields)
    whole = found.where("whole").select("file", "number", "member", "text", "last")
    parts = found.where("NOT whole").groupBy("file", "number").agg(
        F.min("member").alias("member"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range", "text"))), lambda p: p["text"]), form.separator).alias("text"),
        F.max("last").alias("last"),
    )
    return whole.unionByName(parts)


def has_large_files(spark: SparkSession, path: str) -> bool:
    """Whether some file is more than Spark would give to one task; reads the listing only."""
    files = spark.read.format("binaryFile").load(path).select("length")
    return bool(files.where(F.col("length") > _task_bytes(spark)).limit(1).count())


def _task_bytes(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)
