"""Large JSON arrays read in parts: Spark splits the file, a prefix state says where in the text each part begins."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.storage import materialize

#: Fragments end at this character, which every record holds; Spark's text source splits files there.
END = "}"
#: Parts of files (of spark.sql.files.maxPartitionBytes each) whose states go to every task: about 100 bytes a part.
MOST_PARTS = 500_000
#: Rows that a task holds as Python's objects at a time.
ROWS = 256
ESCAPED = re.compile(r"\\.", re.DOTALL)
NESTING = re.compile(r"[{}\[\],]")
TOKEN = re.compile(r'\\.|["{}\[\],]', re.DOTALL)
SUMMARY = "path string, part long, flips boolean, depths array<long>, commas array<map<long,long>>"
STATE = "path string, part long, in_string boolean, depth long, element long"


def _rows(batches) -> Iterator[tuple]:
    """Rows of batches, ROWS of them at a time as Python's objects."""
    for batch in batches:
        for s in range(0, batch.num_rows, ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(s, ROWS).columns), strict=True)


def _parts(batches, names: int) -> Iterator[tuple[tuple, Iterator[str]]]:
    """Fragments in order, grouped by the first `names` columns (each part's rows come one after the other); never a whole part at once."""
    for key, rows in groupby(_rows(batches), key=lambda r: r[:names]):
        yield key, (r[names] for r in rows)


def _summaries(batches):
    """Of each part, begun outside (0) or inside (1) a string: the change of depth, and the commas at each depth over the first."""
    schema = pa.schema([("path", pa.string()), ("part", pa.int64()), ("flips", pa.bool_()), ("depths", pa.list_(pa.int64())), ("commas", pa.list_(pa.map_(pa.int64(), pa.int64())))])
    for (path, part), fragments in _parts(batches, 2):
        inside, depth, commas = 0, [0, 0], [Counter(), Counter()]
        for fragment in fragments:
            text = fragment + END
            pieces = (ESCAPED.sub("", text) if "\\" in text else text).split('"')
            for k, piece in enumerate(pieces):
                of = (inside + k) % 2  # what is outside strings under one hypothesis is inside under the other
                for c in NESTING.findall(piece):
                    if c == ",":
                        commas[of][depth[of]] += 1
                    else:
                        depth[of] += 1 if c in "{[" else -1
            inside = (inside + len(pieces) - 1) % 2
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([part]), pa.array([bool(inside)]), pa.array([depth], pa.list_(pa.int64())), pa.array([[list(c.items()) for c in commas]], schema.field("commas").type)], schema=schema)


def _states(pdf):
    """Where each part of one file begins, from the parts before it."""
    import pandas as pd

    inside, depth, element, out = False, 0, 0, []
    for r in pdf.sort_values("part").itertuples():
        out.append((r.path, r.part, inside, depth, element))
        element += dict(r.commas[int(inside)]).get(1 - depth, 0)
        depth += int(r.depths[int(inside)])
        inside ^= bool(r.flips)
    return pd.DataFrame(out, columns=["path", "part", "in_string", "depth", "element"])


def _cutter(whole: bool):
    """The elements that lie in a part (whole), or the pieces of those that go beyond it."""
    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("part", pa.int64()), ("text", pa.string())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches):
        for (path, part, in_string, depth, element), fragments in _parts(batches, 5):
            if in_string is None:
                raise RuntimeError("the files were split in another way than before: set spark.sql.files.minPartitionNum where executors come and go")
            rows: list[tuple] = []
            held: list[str] = []
            begun = depth < 1  # whether the element at hand began in this part
            for fragment in fragments:
                text, start = fragment + END, 0
                for m in TOKEN.finditer(text):
                    c = m.group()
                    if len(c) == 2:
                        continue
                    if c == '"':
                        in_string = not in_string
                    elif in_string:
                        continue
                    elif c in "{[":
                        depth += 1
                        if depth == 1:
                            start, held, begun = m.end(), [], True
                    else:
                        depth -= c != ","
                        if depth == (1 if c == "," else 0):  # an element ends here
                            held.append(text[start : m.start()])
                            if whole == begun:
                                rows.append((path, element, part, "".join(held)))
                            element, held, start, begun = element + 1, [], m.end(), c == ","
                if depth >= 1 and whole <= begun:
                    held.append(text[start:])
                if len(rows) >= ROWS:
                    yield batch_of(rows)
                    rows = []
            if depth >= 1 and not whole:
                rows.append((path, element, part, "".join(held)))
            if rows:
                yield batch_of(rows)

    return run


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """path, place, item: the objects of JSON files that each hold one array, in any number of tasks a file.

    item is the JSON text of an element and place its number in the array, from 0; elements that
    are no objects are left out. What is not an array has no elements or wrong ones: check a
    feed's files with the strict reader, readers.json_items, where they are small.

    Spark's text source splits the files, with "}" as the end of a line. One pass sums up
    each part under both hypotheses, that it begins inside and outside a string: how
    the depth changes and how many commas it has at each depth. A file's parts, a row each, are then
    folded in order, which gives each part the state that it begins in. A second pass cuts the
    elements; those that cross into another part are put together from their pieces, at most
    two a part (an element over many parts has one in each). Strings may hold brackets, quotes and escapes.
    """
    text = spark.read.option("lineSep", END).text(path)
    raw = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("part"), "value")
    states = raw.mapInArrow(_summaries, SUMMARY).groupBy("path").applyInPandas(_states, STATE)
    states = materialize(states, "parts")
    n = states.count()
    if n > MOST_PARTS:
        raise ValueError(f"{n} parts of files: set spark.sql.files.maxPartitionBytes so that there are at most {MOST_PARTS}")
    placed = raw.join(F.broadcast(states), ["path", "part"], "left").select("path", "part", "in_string", "depth", "element", "value")
    out = "path string, place long, part long, text string"
    pieces = placed.mapInArrow(_cutter(False), out).groupBy("path", "place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "").alias("text"))
    items = placed.mapInArrow(_cutter(True), out).select("path", "place", "text").union(pieces)
    return items.select("path", "place", F.trim("text", F.lit(" \t\r\n")).alias("item")).where(F.col("item").startswith("{"))


def land_arrays(rows: DataFrame, path: str) -> None:
    """Write rows (one column, JSON text) as JSON arrays, a file a task."""

    def bracketed(batches):
        began = False
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                texts = [f"{',' if began or k else '['}\n{x}" for k, x in enumerate(batch.column(0).slice(s, ROWS).to_pylist())]
                began = True
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["\n]" if began else "[]"])], ["value"])

    rows.toDF("value").mapInArrow(bracketed, "value string").write.option("lineSep", " ").text(path)
