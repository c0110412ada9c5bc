"""Filter interaction audit: what each filter removes, at each place of each order of the filters."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: Filters at most: orders and masks grow fast with them, and every part has a row for each order and step.
MOST_FILTERS = 7


def masks(k: int) -> np.ndarray:
    """(2^k, k): whether mask m fails filter f."""
    return (np.arange(1 << k)[:, None] >> np.arange(k)) & 1 == 1


def positions(k: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of k filters, and the (k, orders) matrix of each filter's place: the inverse permutations."""
    orders = list(permutations(range(k)))
    return orders, np.argsort(np.array(orders), axis=1).T


def removal_steps(fails: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The min-plus product: for each mask and order the least place of a filter that fails, k if none does."""
    k = len(place)
    cost = np.where(fails, 0, k)  # adding k makes every place at least k
    return np.minimum.reduce([cost[:, f, None] + place[f] for f in range(k)], initial=k)


def tally(weights: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """Counts by order and step from (3, 2^k) weights of the masks: of all documents, of good ones and of toxic ones."""
    orders, place = positions(k)
    fails = masks(k)
    gone = removal_steps(fails, place)
    lost = np.zeros((3, len(orders), k + 1), np.int64)  # by order and removal step; step k is kept for good
    at = np.broadcast_to(np.arange(len(orders)), gone.shape)
    for w, table in zip(weights, lost, strict=True):
        np.add.at(table, (at, gone), np.broadcast_to(w[:, None], gone.shape))
    late = np.zeros((len(orders), k), np.int64)
    for f in range(k):
        m = np.flatnonzero(fails[:, f])
        late[np.arange(len(orders)), place[f]] += (weights[0][m, None] * (gone[m] < place[f])).sum(axis=0)
    letters = np.array(orders)
    total = np.zeros(k, np.int64)
    np.add.at(total, letters, lost[0][:, :k])
    return {
        "kept": weights[0].sum() - np.cumsum(lost[0][:, :k], axis=1),
        "removed": lost[0][:, :k],
        "redundant": late,
        "unique_fails": weights[0][1 << letters],
        "good_lost": lost[1][:, :k],
        "toxic_lost": lost[2][:, :k],
        "shapley": total[letters],
    }


def _tables(filters: str, schema: pa.Schema):
    k = len(filters)
    orders = np.repeat(["".join(filters[f] for f in o) for o in positions(k)[0]], k)
    steps = np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders) // k)

    def run(batches):
        for batch in batches:
            for part, cells in zip(batch.column(0), batch.column(1), strict=True):
                weights = np.zeros((3, 1 << k), np.int64)
                for c in cells.as_py():
                    weights[:, c["mask"]] += np.array([c["n"], c["n"] * c["good"], c["n"] * c["toxic"]], np.int64)
                made = tally(weights, k)
                columns = [pa.array([part.as_py()] * len(orders), pa.string()), pa.array(orders.tolist(), pa.string()), pa.array(steps), *(pa.array(made[c].ravel()) for c in COUNTS)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def interaction_audit(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """part, filter_order, step and counts for every order of the filters (a letter each) and every step of it.

    cells: part (string), mask (bit f is set where filter f fails), good and toxic (booleans) and
    n, how many documents are alike in all of these; rows may repeat a combination.
    Counts within the part: kept after the step; removed in it; redundant, failing its filter but
    removed before; unique_fails, failing its filter alone; good_lost and toxic_lost among the
    removed; shapley, the filter's removed over all orders. Nulls in good and toxic are false, in part
    an empty string. No rows in, no rows out.

    Documents are summed up to at most 4 * 2^k rows a part before anything meets, so a part of a
    third of all documents is no hot task. Each part's removal steps are the min-plus
    product of the masks with the filters' places, into which its weights are scattered.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    if not filters or len(set(filters)) != len(filters) or len(filters) > MOST_FILTERS:
        raise ValueError(f"filters are 1 to {MOST_FILTERS} different letters")
    keys = (F.coalesce("part", F.lit("")).alias("part"), F.col("mask").cast("int").alias("mask"), F.coalesce("good", F.lit(False)).cast("int").alias("good"), F.coalesce("toxic", F.lit(False)).cast("int").alias("toxic"))
    summed = cells.groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))
    parts = summed.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    schema = _parse_datatype_string("part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
    return parts.mapInArrow(_tables(filters, to_arrow_schema(schema)), schema)


def text_failures(text: Column, words: Column) -> Column:
    """Bits of the filters on one text: 1 short, 2 repetitive, 4 capitals, 8 symbols."""
    n, chars = F.size(words), F.length(text)
    capitals = chars - F.length(F.regexp_replace(text, "[A-Z]", ""))
    failing = (n < 200, F.size(F.array_distinct(words)) * 100 < n * 50, capitals.cast("long") * 100 > chars.cast("long") * 3, text.rlike("[#$%&*|]"))
    bits = [F.when(f, F.lit(1 << k)).otherwise(0) for k, f in enumerate(failing)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def document_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, mask, good, toxic and n for the five filters of text_failures and, as bit 16, a repeated text.

    A text is repeated if a smaller id has it, anywhere in docs; null and empty texts are the
    same. Rows without an id are no copies and have none. A document is good (toxic) if any of
    its label rows has quality 1 (toxic 1); documents without one are neither. Rows that repeat an id count each.

    Texts leave their task as 32 bytes of SHA-256. Copies of a text are alike in all but their id
    and labels, so they are summed before they meet: a text of a third of all rows costs a row a task and kind.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    split = base.withColumn("words", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = split.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("key"), text_failures(F.col("text"), F.col("words")).alias("mask"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    seen = rows.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    kind = ["key", "mask", "part", "good", "toxic"]
    ids = seen.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    known = F.col("doc_id").isNotNull()
    alike = ids.groupBy(*kind).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known"), F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("key"))
    alike = alike.withColumn("copies", F.col("known") - F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0))
    both = F.array(F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")), F.struct((F.col("mask") + 16).alias("mask"), F.col("copies").alias("n")))
    return alike.select("part", "good", "toxic", F.inline(both)).where("n > 0")


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """All orders of the five filters over documents, by language."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return interaction_audit(document_cells(docs.select("doc_id", "text", "lang"), labels))


OP12_SQL = r"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
flags as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         case when len(w) < 200 then 'A' else '' end
         || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
         || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) then 'C' else '' end
         || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
         || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as fails
  from texts left join marks using (doc_id)),
cells as (select part, fails, good, toxic, count(*) as n from flags group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where b.x <> a.x and c.x not in (a.x, b.x) and d.x not in (a.x, b.x, c.x) and e.x not in (a.x, b.x, c.x, d.x)),
grid as (
  select *, substr(filter_order, step, 1) as letter, contains(fails, substr(filter_order, step, 1)) as failing
  from cells, orders, (select unnest([1, 2, 3, 4, 5])::integer as step)),
gone as (select *, min(step) filter (failing) over (partition by part, fails, good, toxic, filter_order) as first from grid),
counts as (
  select part, filter_order, step, letter,
         coalesce(sum(n) filter (first is null or first > step), 0)::bigint as kept,
         coalesce(sum(n) filter (first = step), 0)::bigint as removed,
         coalesce(sum(n) filter (failing and first < step), 0)::bigint as redundant,
         coalesce(sum(n) filter (fails = letter), 0)::bigint as unique_fails,
         coalesce(sum(n) filter (first = step and good), 0)::bigint as good_lost,
         coalesce(sum(n) filter (first = step and toxic), 0)::bigint as toxic_lost
  from gone group by all)
select * exclude (letter), (sum(removed) over (partition by part, letter))::bigint as shapley from counts
"""
