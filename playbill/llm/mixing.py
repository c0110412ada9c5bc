"""Mixing sources to target weights: hash thresholds found by nested histograms, without sorting documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from playbill.storage import discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a document's place in its source, and those that one histogram tells apart (at most 2^12 rows a source).
PLACE_BITS, STEP_BITS = 60, 12
SOURCE = ["named", "name"]


def _place(doc_id: Column, text: Column) -> Column:
    """A document's place, 60 bits of an MD5 of its id and text: the same in every run and partitioning."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(whole), 1, PLACE_BITS // 4), 16, 10).cast("long")


def weighted(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """sizes (named, name, source_size) with weight: the weights in turn, by the names' code points, null last.

    Sources are sorted by ranges and written with their places in a range; of each range one
    number comes to the driver, so any number of sources will do.
    """
    laid = sizes.orderBy(F.desc("named"), "name").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    laid = materialize(laid, "sources")
    start, counts = 0, []
    for part, n in sorted((r[0], r[1]) for r in laid.groupBy("part").count().collect()):
        counts += [F.lit(part), F.lit(start)]
        start += n
    if not counts:
        return laid.select(*sizes.columns, F.lit(0).alias("weight"))
    rank = F.create_map(*counts)[F.col("part")] + F.col("at")
    return laid.select(*sizes.columns, F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights)).cast("int") + 1).alias("weight"))


def targets(sources: DataFrame, most: int) -> DataFrame:
    """sources (source_size, weight) with target: all sizes shared by weight, at most `most` times a source's size.

    What is above goes to the others by weight until none is above. The common level
    rest / weights rises in steps (Newton's on a concave, piecewise linear function); each is one
    aggregate of one row, and comparisons are in whole numbers.
    """
    def above(rest: int, weights: int) -> Column:
        return F.col("weight").cast("decimal(10,0)") * F.lit(rest).cast("decimal(20,0)") > F.col("source_size").cast("decimal(20,0)") * F.lit(most * weights).cast("decimal(14,0)")

    total, weights = (int(x or 0) for x in sources.agg(F.sum("source_size"), F.sum("weight")).first())
    rest = total
    while weights:
        over = above(rest, weights)
        held, free = (int(x or 0) for x in sources.agg(F.sum(F.when(over, F.col("source_size") * most)), F.sum(F.when(over, 0).otherwise(F.col("weight")))).first())
        if (total - held, free) == (rest, weights):
            break
        rest, weights = total - held, free
    share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weights or 1))
    return sources.withColumn("target", F.when(above(rest, weights), (F.col("source_size") * most).cast("double")).otherwise(share))


def thresholds(measured: DataFrame, plan: DataFrame) -> DataFrame:
    """named, name, at, left, tied: the place in each source at which its further words (plan.further) are used up.

    Sizes are summed by source and the leading bits of the place; in the bucket where the budget
    runs out, and in it alone, the next bits are looked at, until it holds one place only
    (five histograms at most). left of the words there, tied in all, are within the budget.
    """
    edge = plan.where("further > 0").select(*SOURCE, F.lit(0).cast("long").alias("at"), F.col("further").alias("left"), F.lit(0).cast("long").alias("tied"), F.lit(False).alias("found"))
    for shift in range(PLACE_BITS - STEP_BITS, -1, -STEP_BITS):
        wide = edge.where("not found").select(*SOURCE, F.col("at").alias("prefix"), "left")
        inside = measured.withColumn("prefix", F.shiftright("place", shift + STEP_BITS)).join(wide, [*SOURCE, "prefix"])
        buckets = inside.groupBy(*SOURCE, "left", F.shiftright("place", shift).alias("bucket")).agg(F.sum("size").alias("tied"), F.min("place").alias("low"), F.max("place").alias("high"))
        upto = F.sum("tied").over(Window.partitionBy(*SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        crossing = buckets.withColumn("upto", upto).where("upto >= left and upto - tied < left")
        one = F.col("low") == F.col("high")
        after = crossing.select(*SOURCE, F.when(one, F.col("low")).otherwise(F.col("bucket")).alias("at"), (F.col("left") - F.col("upto") + F.col("tied")).alias("left"), "tied", one.alias("found"))
        edge = materialize(edge.where("found").union(after), "thresholds")
        if not edge.where("not found").limit(1).count():
            break
    return edge.select(*SOURCE, "at", "left", "tied")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (1, 2, 3), most: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of docs, and those of its columns that keep names.

    size counts words (stretches without ASCII white space; a null text has none). Sources, by the
    code points of their names and null last, weigh `weights` in turn; an empty name is a source of its own. They share the sum of all sizes by weight; no target is more
    than `most` times its source's size, and the excess goes to the others. taken is the words that the mix takes of
    the row: the whole text as often as the whole source fits its target, once more if its
    place, a hash of id and text, is under the source's threshold. The document at the
    threshold is cut there, so that a source's words are its target, rounded. Rows of equal id and
    text have equal places: at the threshold each is cut in proportion (each rounded down). Rows
    that repeat an id count each. An empty source has target 0; no rows in, no rows out.
    A kept column named like one of the results is left out.

    Texts are read once; id, source, size and place (some 40 bytes a row) are written. All
    else are sums by source and bucket, combined before they meet, so that a source of a third
    of all rows is no hot task; no documents are sorted. Only DataFrame functions are used.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = F.col(f"`{source_col}`").cast("string")
    own = ["doc_id", "size", "source_size", "target", "taken"]
    kept = [c for c in dict.fromkeys(keep) if c not in own]
    carried = {c: f"kept_{k}" for k, c in enumerate(kept)}
    measured = docs.select(F.col(f"`{id_col}`").alias("doc_id"), source.isNotNull().alias("named"), F.coalesce(source, F.lit("")).alias("name"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), _place(F.col(f"`{id_col}`"), text).alias("place"), *(F.col(f"`{c}`").alias(x) for c, x in carried.items()))
    measured = materialize(measured, "measured")
    sizes = measured.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    plan = targets(weighted(sizes, weights), most).withColumn("budget", F.floor(F.col("target") + 0.5))
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    plan = plan.withColumn("whole", whole).withColumn("further", F.col("budget") - F.col("whole") * F.col("source_size"))
    plan = materialize(plan, "plan")
    cut = materialize(plan.join(thresholds(measured, plan), SOURCE, "left").select(*SOURCE, "source_size", "target", "whole", "at", "left", "tied"), "cuts")
    part = F.expr("cast(left as decimal(18,0)) * cast(size as decimal(18,0)) div tied")
    further = F.when(F.col("place") < F.col("at"), F.col("size")).when(F.col("place") == F.col("at"), part).otherwise(0)
    taken = (F.col("whole") * F.col("size") + further).cast("long")
    return measured.join(cut, SOURCE).select("doc_id", "size", "source_size", "target", taken.alias("taken"), *(F.col(x).alias(c) for c, x in carried.items()))


def mixed_texts(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The mix itself: rows of mix_sources (which kept text_col) as often as they are taken, with copy from 1.

    A last copy that isn't whole holds the first words only, joined by single spaces. Rows of which nothing is taken, as those without words, are absent.
    """
    words = F.filter(F.split(text_col, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    copies = mixed.where("taken > 0").withColumn("copy", F.explode(F.expr("sequence(1, int(ceil(taken / size)))")))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    return copies.withColumn(text_col, F.when(left >= F.col("size"), F.col(text_col)).otherwise(F.array_join(F.slice(words, F.lit(1), left.cast("int")), " ")))


def op13_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))


OP13_SQL = r"""
with measured as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint as place
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight from measured group by source),
level as (
  select a.source, a.weight * ((select sum(source_size) from sources) - coalesce(sum(3 * b.source_size) filter (b.source_size * a.weight < a.source_size * b.weight), 0))
         > 3 * a.source_size * coalesce(sum(b.weight) filter (b.source_size * a.weight >= a.source_size * b.weight), 0) as above
  from sources a, sources b group by a.source, a.weight, a.source_size),
shares as (
  select s.*, above, sum(source_size) over () - coalesce(sum(3 * source_size) filter (above) over (), 0) as rest, sum(weight) filter (not above) over () as free
  from sources s join level l on l.source is not distinct from s.source),
plan as (select source, source_size, case when above then (3 * source_size)::double else rest::double * weight / free::double end as target from shares),
budgets as (
  select *, floor(target + 0.5)::bigint as budget, case when source_size > 0 then floor(target + 0.5)::bigint // source_size else 0 end as whole from plan),
places as (
  select m.doc_id, m.size, b.source_size, b.target, b.whole, b.budget - b.whole * b.source_size as further,
         sum(m.size) over (partition by m.source order by m.place range between unbounded preceding and current row) as upto, sum(m.size) over (partition by m.source, m.place) as tied
  from measured m join budgets b on m.source is not distinct from b.source)
select doc_id, size, source_size, target,
       (whole * size + case when upto <= further then size when upto - tied >= further or tied = 0 then 0 else (further - upto + tied) * size // tied end)::bigint as taken
from places
"""
