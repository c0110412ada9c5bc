"""The weekly report: what is on next week by city and category, ranked by what people search for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.functions.dates import display_date
from playbill.functions.rules import SEARCHED_TREND_CATEGORIES, TREND_CATEGORIES
from playbill.functions.text import tokens, trend_fold
from playbill.operators.filters import in_next_week

# The report's cities in their order.
CITIES = ["İstanbul", "İzmir", "Ankara", "Bursa", "Eskişehir", "Antalya", "Denizli"]


# Where each kind of trend answer has its lists, and the periods that can be asked for.
ANSWER_LISTS = {
    "trending_now": {"": "$.trending_searches"}, "interest_over_time": {"": "$.interest_over_time.timeline_data"},
    "related_topics": {"top": "$.related_topics.top", "rising": "$.related_topics.rising"}, "google_events": {"": "$.events_results"},
}
WEEK, MONTH = "now 7-d", "today 1-m"


def period(days) -> Column:
    """The period by which a look-back of so many days is asked for."""
    return F.when(F.col(days) <= 7, WEEK).otherwise(MONTH) if isinstance(days, str) else F.lit(WEEK if days <= 7 else MONTH)


def answer_items(answers: DataFrame, scan: str, body: str = "body") -> DataFrame:
    """Items of landed answers of a kind (ANSWER_LISTS): the answers' other columns, list, place and item as JSON text.

    Each answer is parsed once. Answers that are no JSON, or without the list, have no items; elements of any kind stay.
    """
    parsed = answers.withColumn("_v", F.try_parse_json(body)).drop(body)
    lists = F.array(*(F.struct(F.lit(name).alias("list"), F.try_variant_get("_v", path, "array<variant>").alias("items")) for name, path in ANSWER_LISTS[scan].items()))
    each = parsed.select(*(c for c in parsed.columns if c != "_v"), F.inline(lists))
    return each.select(*(c for c in each.columns if c != "items"), F.posexplode("items").alias("place", "_item")).withColumn("item", F.to_json("_item")).drop("_item")


def overlap_scores(rows: DataFrame, wanted: DataFrame, id_col: str, text_col: str, wanted_col: str) -> DataFrame:
    """id and score: how many distinct tokens each row shares with any of the wanted texts; rows without one are absent."""
    words = wanted.select(F.explode(tokens(wanted_col)).alias("token")).distinct()
    return rows.select(id_col, F.explode(tokens(text_col)).alias("token")).join(words, "token").groupBy(id_col).agg(F.count("*").alias("score"))


def plan(spark, cities: list[str] = CITIES, categories: list[str] = TREND_CATEGORIES) -> DataFrame:
    """city_rank, city, category_rank, category, searched: the report's cells, a small product of two lists."""
    a = spark.createDataFrame(list(enumerate(cities)), "city_rank int, city string")
    b = spark.createDataFrame([(i, c, c in SEARCHED_TREND_CATEGORIES) for i, c in enumerate(categories)], "category_rank int, category string, searched boolean")
    return a.crossJoin(b)


def weekly(cells: DataFrame, candidates: DataFrame, searches: DataFrame, as_of, k: int = 5, topics: int = 5) -> DataFrame:
    """city, category, is_trending, trending_topics and events of each cell.

    candidates: city, category, ordinal, id, title, next_date. searches: city, category, position,
    title. Candidates of next week are scored by the tokens their folded titles share with the
    cell's searches, and the k best (order of candidates among equals) are the cell's events; if
    none shares a token, the first k of the week are, and the cell isn't trending. Topics are the
    first searches that share a token with a chosen event.
    """
    week = candidates.where(in_next_week("next_date", as_of)).withColumn("token", F.explode_outer(tokens(trend_fold("title"))))
    wanted = searches.select("city", "category", "position", F.col("title").alias("topic"), F.explode(tokens(trend_fold("title"))).alias("token"))
    words = wanted.select("city", "category", "token").distinct().withColumn("hit", F.lit(1))
    scored = week.join(words, ["city", "category", "token"], "left").groupBy("city", "category", "ordinal", "id", "title", "next_date").agg(F.coalesce(F.sum("hit"), F.lit(0)).alias("score"))
    per_cell = Window.partitionBy("city", "category")
    best = scored.withColumn("is_trending", F.max("score").over(per_cell) > 0)
    # with any match only matching candidates count, else all in their order
    best = best.where((F.col("score") > 0) | ~F.col("is_trending")).withColumn("place", F.row_number().over(per_cell.orderBy(F.desc("score"), "ordinal"))).where(F.col("place") <= k)
    shown = best.groupBy("city", "category").agg(F.max("is_trending").alias("is_trending"), F.transform(F.array_sort(F.collect_list(F.struct("place", "id", "title", "next_date"))), lambda e: F.struct(e["id"].alias("id"), e["title"].alias("title"), e["next_date"].alias("next_date"))).alias("events"))
    chosen = best.select("city", "category", F.explode(tokens(trend_fold("title"))).alias("token")).distinct()
    hits = wanted.join(chosen, ["city", "category", "token"], "left_semi").select("city", "category", "position", "topic").distinct()
    first = hits.withColumn("n", F.row_number().over(per_cell.orderBy("position"))).where(F.col("n") <= topics)
    named = first.groupBy("city", "category").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "topic"))), lambda x: x["topic"]).alias("trending_topics"))
    none = F.array().cast("array<string>")
    return cells.join(shown, ["city", "category"], "left").join(named, ["city", "category"], "left").withColumn("trending_topics", F.coalesce("trending_topics", none)).withColumn("is_trending", F.coalesce("is_trending", F.lit(False)))


def markdown(report: DataFrame) -> DataFrame:
    """One row (value): the report as text, by the cells' ranks. A report has as many rows as cells."""
    lines = F.transform("events", lambda e: F.concat(F.lit("- "), display_date(F.to_date(e["next_date"])), F.lit(" "), e["title"]))
    block = F.concat_ws("\n", F.concat(F.lit("### "), "category"), F.when(F.size("trending_topics") > 0, F.concat(F.lit("Trend: "), F.array_join("trending_topics", ", "))), F.array_join(lines, "\n"))
    cities = report.where("events is not null").groupBy("city_rank", "city").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("category_rank", block.alias("b")))), lambda x: x["b"]), "\n\n").alias("b"))
    return cities.groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("city_rank", F.concat(F.lit("## "), "city", F.lit("\n\n"), "b").alias("b")))), lambda x: x["b"]), "\n\n").alias("value"))
