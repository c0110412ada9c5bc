"""A data source of landed API answers, page by page, with pushed filters; and the scan that a feed makes of it."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from playbill.functions.columns import filled
from playbill.operators.dedup import first_by
from playbill.schema import number_rows

SCHEMA = "country string, segment string, segment_rank int, page int, place int, id string, event_date string, item string"
#: The folder levels of landed pages, as Spark's partitioned writers name them.
LEVELS = ("country", "segment", "page")


#: At most so many partitions: of more pages each reads several, as starting a task costs more than reading a page.
MOST_PARTITIONS = 64


@dataclass
class Page(InputPartition):
    country: str
    segment: str
    rank: int
    page: int
    path: str
    #: Pages that the same task reads after this.
    more: list[Page] = field(default_factory=list)


def _date(item: dict) -> str | None:
    """The local date of an item, as the feed sorts by it."""
    start = (item.get("dates") or {}).get("start") if isinstance(item.get("dates"), dict) else None
    found = start.get("localDate") if isinstance(start, dict) else item.get("date")
    return str(found) if found else None


def _items(answer: object) -> list[dict]:
    held = answer.get("_embedded") if isinstance(answer, dict) else None
    events = held.get("events") if isinstance(held, dict) else None
    return events if isinstance(events, list) else []


class PageReader(DataSourceReader):
    """Plans the pages that can hold a wanted row, a partition each, or several where there are many.

    Countries and segments that the query doesn't ask for are not listed. A segment ends before
    its first missing page, at totalPages of its first page, and at max_pages. Pages are in
    order of date, so for a bound on event_date the first and the last page are found by binary search.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"].rstrip("/")
        self.max_pages = int(options.get("max_pages", 0))
        self.order = [s for s in options.get("segments", "").split(",") if s]
        self.by_date = options.get("sorted", "true").lower() == "true"
        self.wanted: dict[str, set] = {}
        self.low: list[tuple[str, bool]] = []
        self.high: list[tuple[str, bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            values = set(f.value) if isinstance(f, In) else {getattr(f, "value", None)}
            if name in ("country", "segment") and isinstance(f, EqualTo | In) and None not in values:
                self.wanted[name] = self.wanted.get(name, values) & values
            elif name == "event_date" and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual) and isinstance(f.value, str):
                if not isinstance(f, LessThan | LessThanOrEqual):
                    self.low.append((f.value, not isinstance(f, GreaterThan)))
                if not isinstance(f, GreaterThan | GreaterThanOrEqual):
                    self.high.append((f.value, not isinstance(f, LessThan)))
            else:
                yield f

    @cached_property
    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def _folders(self, base: str, level: str) -> dict[str, str]:
        from urllib.parse import unquote

        from pyarrow import fs

        found = self._fs[0].get_file_info(fs.FileSelector(base, allow_not_found=True))
        named = {unquote(x.base_name.split("=", 1)[1]): x.path for x in found if x.type == fs.FileType.Directory and x.base_name.startswith(f"{level}=")}
        return {k: v for k, v in named.items() if level not in self.wanted or k in self.wanted[level]}

    def _answer(self, folder: str) -> object:
        from pyarrow import fs

        files = sorted(x.path for x in self._fs[0].get_file_info(fs.FileSelector(folder)) if x.type == fs.FileType.File and not x.base_name.startswith(("_", ".")))
        raw = b"".join(self._fs[0].open_input_stream(f).readall() for f in files)
        try:
            return json.loads(raw)
        except ValueError:
            return None

    def _within(self, day: str | None) -> bool:
        if not self.low and not self.high:
            return True
        return day is not None and all(day > v or (eq and day == v) for v, eq in self.low) and all(day < v or (eq and day == v) for v, eq in self.high)

    def _span(self, folders: list[str]) -> tuple[int, int]:
        """The pages, from and up to, that can hold a date within the bounds."""

        def first(test, lo: int, hi: int) -> int:
            while lo < hi:
                mid = (lo + hi) // 2
                days = [d for x in _items(self._answer(folders[mid])) if isinstance(x, dict) and (d := _date(x))]
                if not days:
                    raise LookupError
                lo, hi = (lo, mid) if test(days) else (mid + 1, hi)
            return lo

        try:
            start = first(lambda days: all(days[-1] >= v for v, _ in self.low), 0, len(folders)) if self.low else 0
            end = first(lambda days: any(days[0] > v for v, _ in self.high), start, len(folders)) if self.high else len(folders)
        except LookupError:  # a page without dates tells nothing
            return 0, len(folders)
        return start, end

    def partitions(self) -> list[Page]:
        made: list[Page] = []
        for country, at in sorted(self._folders(self._fs[1], "country").items()):
            segments = self._folders(at, "segment")
            ordered = [s for s in self.order if s in segments] if self.order else sorted(segments)
            for segment in ordered:
                pages = self._folders(segments[segment], "page")
                folders: list[str] = []
                while str(len(folders)) in pages and not 0 < self.max_pages <= len(folders):
                    folders.append(pages[str(len(folders))])
                if not folders:
                    continue
                answer = self._answer(folders[0])
                told = answer.get("page") if isinstance(answer, dict) else None
                total = told.get("totalPages") if isinstance(told, dict) else None
                if isinstance(total, int):
                    folders = folders[: max(total, 1)]
                start, end = self._span(folders) if self.by_date and (self.low or self.high) else (0, len(folders))
                rank = self.order.index(segment) if self.order else ordered.index(segment)
                made += [Page(country, segment, rank, n, folders[n]) for n in range(start, end)]
        size = max(1, -(-len(made) // MOST_PARTITIONS))
        return [replace(made[i], more=made[i + 1 : i + size]) for i in range(0, len(made), size)] or [Page("", "", 0, 0, "")]

    def read(self, partition: Page) -> Iterator[tuple]:
        for page in (partition, *partition.more):
            if page.path:
                yield from self._rows(page)

    def _rows(self, page: Page) -> Iterator[tuple]:
        items = _items(self._answer(page.path))
        here = (page.country, page.segment, page.rank, page.page)
        if not items:
            yield (*here, -1, None, "", None)  # a date that no filter takes for a missing one
        for place, item in enumerate(items):
            if isinstance(item, dict) and self._within(day := _date(item)):
                known = item.get("eventId") or item.get("id")
                yield (*here, place, str(known) if known else None, day, json.dumps(item, ensure_ascii=False))


class PagedAnswers(DataSource):
    """spark.read.format("paged_answers").option("path", ...): a row an item; an empty or broken page is one row without item.

    Answers lie in country=C/segment=S/page=N folders. Options: segments (their order, by commas;
    others are left out; default all by name), max_pages (0: no bound), sorted (false where pages aren't in order of date).
    """

    @classmethod
    def name(cls) -> str:
        return "paged_answers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let Spark offer it the query's filters."""
    spark.dataSource.register(PagedAnswers)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def discovery_items(spark: SparkSession, path: str, condition: Column | None = None, segments: list[str] | None = None, max_pages: int = 0) -> DataFrame:
    """Items of all segments as a feed's client takes them: up to each segment's first empty page, the first of each id.

    First is by segment, page and place. Items without an id are dropped. condition (on country,
    segment and event_date) reaches the reader, so that pages without a wanted row aren't read;
    nor is it noticed then that one of those is empty.
    """
    register(spark)
    read = spark.read.format("paged_answers").option("path", path).option("max_pages", max_pages)
    rows = (read.option("segments", ",".join(segments)) if segments else read).load()
    rows = rows.where(condition) if condition is not None else rows
    ends = rows.where("item is null").groupBy("country", "segment").agg(F.min("page").alias("end"))
    live = rows.where("item is not null and id is not null").join(ends, ["country", "segment"], "left").where("end is null or page < end").drop("end")
    return first_by(live, ["country", "id"], "segment_rank", "page", "place")


def land_pages(items: DataFrame, path: str, size: int, *order: str) -> None:
    """Write items (country, segment, item as JSON text, and the columns of order) as answers of `size` items a page.

    Items are numbered over all segments at once, by ranges, so that a large segment is no large task.
    """
    numbered = number_rows(items, "country", "segment", *order)
    sizes = numbered.groupBy("country", "segment").agg(F.min("ordinal").alias("first"), F.count("*").alias("n"))
    paged = numbered.join(sizes, ["country", "segment"]).withColumn("page", F.floor((F.col("ordinal") - F.col("first")) / size))
    pages = paged.groupBy("country", "segment", "page", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "item"))), lambda x: x["item"]), ",").alias("items"))
    total = F.ceil(F.col("n") / size).cast("string")
    answer = F.concat(F.lit('{"_embedded":{"events":['), filled("items"), F.lit(']},"page":{"number":'), F.col("page").cast("string"), F.lit(',"totalPages":'), total, F.lit("}}"))
    pages.select(*LEVELS, answer.alias("value")).write.partitionBy(*LEVELS).text(path)
