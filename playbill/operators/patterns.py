"""Many substrings sought at once: one Aho-Corasick automaton a task, whatever the number of patterns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of patterns in one automaton (about 60 bytes each in a task); more are sought in further passes over the texts.
PASS_CHARS = 2_000_000


def _finder(patterns, schema: pa.Schema):
    def run(batches):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for number, pattern in patterns.value:
            automaton.add_word(pattern, number)
        automaton.make_automaton()
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if text:
                    mine = {n for _, n in automaton.iter(text)}
                    rows += [row] * len(mine)
                    found += mine
            keys = batch.select(range(batch.num_columns - 1)).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(found, pa.int64())], schema=schema)

    return run


def find_patterns(texts: DataFrame, text_col: str, keys: list[str], patterns: DataFrame, pattern_col: str = "pattern", pass_chars: int = PASS_CHARS) -> DataFrame:
    """keys and pattern: each pattern that is a substring of a row's text, once a row.

    Equal to a join on contains(text, pattern), but the time follows the texts and the finds, not
    the number of patterns: a text is read once by an automaton of all. Null and empty patterns and
    null texts match nothing; equal patterns are one. Patterns are cut into parts of at most
    pass_chars characters (counted), each a pass over the texts with an automaton of its own, so that
    what a task holds is bounded however many there are.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType

    spark = texts.sparkSession
    words = patterns.select(F.col(pattern_col).cast("string").alias("pattern")).where("pattern <> ''").distinct().withColumn("h", F.xxhash64("pattern"))
    chars = words.agg(F.coalesce(F.sum(F.length("pattern")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * int(chars) // pass_chars)) if chars > pass_chars else 1
    rows = texts.select(*keys, F.col(text_col).alias("_text"))
    schema = rows.drop("_text").schema.add("_number", LongType())
    out = None
    for part in range(parts):
        mine = words.where(F.pmod("h", F.lit(parts)) == part).select("pattern").toArrow()["pattern"].to_pylist()
        if not mine:
            continue
        known = spark.sparkContext.broadcast(list(enumerate(mine)))
        found = rows.mapInArrow(_finder(known, to_arrow_schema(schema)), schema)
        names = F.array(*map(F.lit, mine)) if len(mine) < 64 else None
        if names is None:
            table = spark.createDataFrame(pa.table({"_number": pa.array(range(len(mine)), pa.int64()), "pattern": mine}))
            found = found.join(F.broadcast(table), "_number")  # at most pass_chars characters
        else:
            found = found.withColumn("pattern", F.get(names, F.col("_number").cast("int")))
        found = found.select(*keys, "pattern")
        out = found if out is None else out.union(found)
    return out if out is not None else rows.select(*keys, F.lit("").alias("pattern")).limit(0)
