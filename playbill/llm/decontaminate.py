"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, banded alignment to verify."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.common import small_batches

#: Characters of a q-gram, of one for items too short for it, and edits allowed for each character of an item.
Q, SMALL_Q, MAX_EDITS = 8, 5, 0.1
#: Characters of benchmark items handled in one pass over the documents; more take more passes.
PASS_CHARS = 4_000_000
#: Characters of text looked at together; longer texts are looked at in overlapping pieces.
TEXT_CHARS = 1 << 19
#: Shared q-grams looked at together.
HITS = 1 << 17
BITS = 22
BASE = 0xD1342543DE82EF95


def normal(text: str | None) -> str:
    """Lower-cased, with runs of white space made one space and none at the ends."""
    return " ".join((text or "").lower().split())


def letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each run of q characters."""
    if len(chars) < q:
        return np.empty(0, np.uint64)
    x = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    h = np.zeros(len(chars) - q + 1, np.uint64)
    for k in range(q):
        h = h * np.uint64(BASE) + x[k : len(x) - q + 1 + k]
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


class Items:
    """The benchmark's q-grams with their places, and for each item its edit budget and count bound."""

    def __init__(self, ids: list[int], texts: list[str], q: int, max_edits: float) -> None:
        self.q, self.ids, self.chars = q, ids, [letters(normal(t)) for t in texts]
        self.length = np.array([len(c) for c in self.chars], np.int64)
        # as many edits as asked for, but so few that a match shares at least one q-gram
        self.budget = np.minimum((self.length * max_edits).astype(np.int64), np.maximum(self.length - q, 0) // q)
        self.bound = self.length - q + 1 - self.budget * q
        # bands start every `step` diagonals and overlap by the budget
        self.step = np.array([1 << max(3, int(b).bit_length()) for b in self.budget], np.int64)
        hashes = [gram_hashes(c, q) for c in self.chars]
        every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else item
        # places of a gram within one step of an item meet a text in at most two bands: their ends will do
        order = np.lexsort((place, item, every))
        every, item, place = every[order], item[order], place[order]
        cell = place // self.step[item] if len(item) else place
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])
        at = np.flatnonzero(new)
        self.item, self.low, self.high = item[at], place[at], place[np.append(at[1:], len(every)) - 1] if len(at) else place
        self.grams, first = np.unique(every[at], return_index=True)
        self.first = np.append(first, len(at))
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(self.grams >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def hits(self, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, least and greatest diagonal) of the q-grams that text and items share, at most HITS at a time.

        A diagonal is the place in the text less that in the item. A gram that an item has at many
        places counts once for each step of it.
        """
        h = gram_hashes(chars, self.q)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - BITS)).astype(np.int64)])
        g = np.searchsorted(self.grams, h[at])
        g[g == len(self.grams)] = 0
        same = self.grams[g] == h[at] if len(self.grams) else np.zeros(0, bool)
        at, g = at[same], g[same]
        n = self.first[g + 1] - self.first[g]
        total = np.cumsum(n)
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + HITS, side="right")))
            part = n[i:j]
            row = np.repeat(self.first[g[i:j]] - (np.cumsum(part) - part), part) + np.arange(part.sum())
            place = np.repeat(at[i:j], part)
            yield self.item[row], place - self.high[row], place - self.low[row]
            i = j

    def candidates(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, first diagonal) of the bands with as many shared q-grams as a match must have.

        What is counted are text places with a gram of the item in the band, no fewer than a match
        shares. Counts of a step of the text are added to those before, so memory follows the bands.
        """
        shift, none = np.int64(1 << 40), np.empty(0, np.int64)
        keys, counts = none, none
        for item, least, most in self.hits(chars):
            step = self.step[item]
            low, high = least // step, most // step
            over = least - low * step <= self.budget[item]  # in the band before as well
            base = item * shift + (1 << 39)
            two = high > low
            new, n = np.unique(np.concatenate([base + low, (base + high)[two], (base + low)[over] - 1]), return_counts=True)
            keys, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        found = keys // shift
        keep = counts >= self.bound[found]
        found, band = found[keep], (keys[keep] % shift) - (1 << 39)
        return found, band * self.step[found]

    def edits(self, chars: np.ndarray, item: np.ndarray, diagonal: np.ndarray, low: np.ndarray, high: np.ndarray, at_once: int = 256) -> np.ndarray:
        """Fewest edits that turn each item into a part of chars[low:high], on its band's diagonals only."""
        out = np.full(len(item), 1 << 30, np.int64)
        order = np.argsort(self.length[item], kind="stable")
        for i in range(0, len(order), at_once):
            part = order[i : i + at_once]
            width = int((self.step[item[part]] + self.budget[item[part]]).max()) + 1
            longest = int(self.length[item[part]].max())
            pattern = np.zeros((len(part), longest), np.uint32)
            for r, p in enumerate(part):
                pattern[r, : self.length[item[p]]] = self.chars[item[p]]
            k, first, last = np.arange(width), low[part][:, None], high[part][:, None]
            cost = np.zeros((len(part), width), np.int64)  # an item can begin on any diagonal
            for j in range(longest):
                place = diagonal[part][:, None] + k + j
                beyond = place >= last
                inside = ~beyond & (place >= first)
                same = inside & (chars[np.minimum(np.maximum(place, 0), len(chars) - 1)] == pattern[:, j : j + 1])
                step = np.minimum(cost + ~same, np.concatenate([cost[:, 1:], np.full((len(part), 1), 1 << 30)], axis=1) + 1)
                step[beyond] = 1 << 30
                cost = np.minimum.accumulate(step - k, axis=1) + k
                ends = np.flatnonzero(self.length[item[part]] == j + 1)
                out[part[ends]] = cost[ends].min(axis=1)
        return out

    def matches(self, text: str) -> dict[int, int]:
        """Fewest edits of each item that is in the (normalised) text within its budget."""
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[dict[int, int]]:
        """matches() of several texts, looked at as one with separators that no item has."""
        found: list[dict[int, int]] = [{} for _ in texts]
        reach = int((self.length + self.budget + self.step).max(initial=1))
        group, size = [], 0
        for i, text in enumerate(texts):
            if len(text) > TEXT_CHARS:
                for a in range(0, len(text), TEXT_CHARS - 2 * reach if TEXT_CHARS > 4 * reach else 2 * reach):
                    self._look([(i, text[a : a + max(TEXT_CHARS, 4 * reach)])], found)
                continue
            group.append((i, text))
            size += len(text)
            if size >= TEXT_CHARS:
                self._look(group, found)
                group, size = [], 0
        if group:
            self._look(group, found)
        return found

    def _look(self, group: list[tuple[int, str]], found: list[dict[int, int]]) -> None:
        gap = "\0" * (self.q + 1)
        chars = letters(gap.join(t for _, t in group))
        begin = np.cumsum([0] + [len(t) + len(gap) for _, t in group])
        item, diagonal = self.candidates(chars)
        if not len(item):
            return
        # a band can touch several texts: it is aligned within each
        reach = self.length[item] + self.budget[item] + self.step[item]
        first = np.maximum(np.searchsorted(begin, diagonal, side="right") - 1, 0)
        last = np.minimum(np.searchsorted(begin, diagonal + reach, side="right") - 1, len(group) - 1)
        n = np.maximum(last - first + 1, 0)
        band = np.repeat(np.arange(len(item)), n)
        text = first[band] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        size = np.array([len(t) for _, t in group])
        band, text = band[size[text] > 0], text[size[text] > 0]
        item = item[band]
        cost = self.edits(chars, item, diagonal[band], begin[text], begin[text] + size[text])
        ok = cost <= self.budget[item]
        for t, k, c in zip(text[ok].tolist(), item[ok].tolist(), cost[ok].tolist(), strict=True):
            mine = found[group[t][0]]
            mine[k] = min(c, mine.get(k, c))


#: Rows of a batch whose texts are Python objects at one time.
ROWS = 512
MATCHES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int64())])


class Part:
    """One part of the benchmark: items by the q-gram size that serves their length, and the very short ones by their text."""

    def __init__(self, ids: list[int], texts: list[str], q: int, max_edits: float) -> None:
        by_q: dict[int, tuple[list[int], list[str]]] = {}
        self.short: dict[str, list[int]] = {}
        for i, t in zip(ids, texts, strict=True):
            n = len(normal(t))
            own = next((k for k in (q, SMALL_Q) if k <= q and n >= k * (int(n * max_edits) + 1)), 0)
            if own:
                kept = by_q.setdefault(own, ([], []))
                kept[0].append(i)
                kept[1].append(t)
            elif n:
                self.short.setdefault(normal(t), []).append(i)
        self.items = [Items(*kept, own, max_edits) for own, kept in by_q.items()]

    def many(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """(item, edits) of every item that each (normalised) text holds."""
        found = [[(i, 0) for i in self.short.get(t, [])] for t in texts]
        for items in self.items:
            for rows, match in zip(found, items.many(texts), strict=True):
                rows += [(items.ids[k], c) for k, c in sorted(match.items())]
        return found


def _matcher(shared):
    def run(batches):
        part = shared.value
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            ids, texts = batch.column(0).to_pylist(), [normal(t.as_py()) for t in batch.column(1)]
            rows = [(d, i, c) for d, m in zip(ids, part.many(texts), strict=True) for i, c in m]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=MATCHES)

    return run


def _item_passes(benchmark: DataFrame, id_col: str, text_col: str, q: int, max_edits: float):
    """The benchmark in parts of at most about PASS_CHARS characters."""
    ids, texts, size = [], [], 0
    known = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    for i, text in known.toLocalIterator():
        ids.append(i)
        texts.append(text)
        size += len(text)
        if size >= PASS_CHARS:
            yield Part(ids, texts, q, max_edits)
            ids, texts, size = [], [], 0
    if ids:
        yield Part(ids, texts, q, max_edits)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_col: str = "text", q: int = Q, max_edits: float = MAX_EDITS) -> DataFrame:
    """doc_id, item_id and edits: a row for each row of docs and item that its text holds.

    Texts and items are lower-cased with white space runs made one space. An item is held if some
    part of the text is at most max_edits edits a character of the item away (rounded down).
    Items too short for a match to share one of the q-grams are looked for by q-grams of SMALL_Q
    characters; where even these say nothing (under SMALL_Q characters, by default), the item is
    held by texts that equal it. Items without id, null or empty are never held; null and empty
    texts hold nothing. Ids are numbers. Repeated rows of docs each return; repeated items too.
    No rows or no items, no rows out.

    Whole texts are read. The benchmark goes to the tasks in parts of bounded size, each with a
    pass of its own over the documents; nothing is shuffled. Memory follows a text's bands, not
    how often its q-grams repeat.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], "doc_id long, item_id long, edits long")
    for i, part in enumerate(_item_passes(benchmark, item_id_col, item_col, q, max_edits)):
        found = rows.mapInArrow(_matcher(spark.sparkContext.broadcast(part)), "doc_id long, item_id long, edits long")
        out = found if not i else out.union(found)
    return out


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """doc_id, item_id, edits of every benchmark item in every document."""
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
