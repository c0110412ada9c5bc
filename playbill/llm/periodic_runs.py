"""Periodic run detection: stretches of words that repeat with a short period, found by string synchronising sets."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUNS = "array<struct<start:long,length:long,period:long>>"
#: Periods below it are compared directly; it is the first dyadic scale.
FIRST_SCALE = 8
#: Text that is worked on at once, in bytes; a longer text is worked on alone.
BATCH_BYTES = 4 << 20
LAST = np.uint64(2**64 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that looks random."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _doubled(h: np.ndarray, tau: int) -> np.ndarray:
    """Hashes of the stretches of 2 tau words from those of tau words."""
    with np.errstate(over="ignore"):
        return _mix(h[:-tau] * np.uint64(0x9E3779B97F4A7C15) + h[tau:])


def _window_least(keys: np.ndarray, tau: int) -> np.ndarray:
    """Least key of each tau + 1 neighbours (tau a power of two)."""
    step = 1
    while step < tau:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    return np.minimum(keys[:-1], keys[1:])


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal runs of True of at least that length."""
    edge = np.flatnonzero(np.diff(same.view(np.int8), prepend=0, append=0))
    start, size = edge[::2], edge[1::2] - edge[::2]
    return start[size >= least], size[size >= least]


def _extent(x: np.ndarray, i: int, d: int, step: int) -> tuple[int, int]:
    """The maximal stretch [s, e) around i of places j with x[j] = x[j + d]; steps double, so it costs its own length."""
    end, go = i, step
    while True:
        upto = min(end + go, len(x) - d)
        differ = np.flatnonzero(x[end:upto] != x[end + d : upto + d])
        if len(differ) or upto == len(x) - d:
            end = end + int(differ[0]) if len(differ) else upto
            break
        end, go = upto, 2 * go
    start, go = i, step
    while start:
        low = max(0, start - go)
        differ = np.flatnonzero(x[low:start] != x[low + d : start + d])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, go = low, 2 * go
    return start, end


def synchronising(h: np.ndarray, tau: int, periodic: np.ndarray) -> np.ndarray:
    """Places i such that the least hash of the tau-word stretches from i to i + tau is the first or the last of them.

    Stretches marked periodic take no part, so that highly periodic regions don't fill the set.
    Whether i is chosen depends on the 2 tau words from i alone.
    """
    keys = np.where(periodic[: len(h)], LAST, h)
    least = _window_least(keys, tau)
    at = np.flatnonzero((least == keys[: len(least)]) | (least == keys[tau : tau + len(least)]))
    return at[least[at] != LAST]


def periodic_stretches(x: np.ndarray, longest: np.ndarray, exponent: float) -> np.ndarray:
    """(start, length, period) of all maximal stretches of x with length >= exponent * period, smallest periods only.

    longest: ends of the places that can hold a stretch, for texts laid one after the other with
    the longest first: longest[k] belongs to scale FIRST_SCALE << k.
    """
    found: list[np.ndarray] = []

    def add(start, length, period) -> None:
        if len(start):
            found.append(np.stack([start, length, np.broadcast_to(period, len(start))], axis=1))

    for p in range(1, min(FIRST_SCALE, len(x))):
        start, size = _stretches(x[:-p] == x[p:], max(1, int(np.ceil(exponent * p)) - p))
        add(start, size + p, p)
    h, tau = _mix(x.astype(np.uint64)), 1
    while tau < FIRST_SCALE and len(h) > tau:
        h, tau = _doubled(h, tau), 2 * tau
    for upto in longest:
        h = h[: max(0, upto - tau + 1)]
        if len(h) <= 2 * tau:
            break
        covers = np.zeros(upto + 1, np.int32)  # places whose tau words have a period of tau / 4 or less
        for known in found:
            s, n, p = known.T
            of = (p <= tau // 4) & (n >= tau) & (s < upto)
            np.add.at(covers, s[of], 1)
            np.add.at(covers, np.minimum(s[of] + n[of] - tau + 1, upto), -1)
        sync = synchronising(h, tau, np.cumsum(covers[:-1]) > 0)
        h = _doubled(h, tau)  # now of 2 tau words: the contexts
        sync = sync[sync < len(h)]
        order = np.argsort(h[sync], kind="stable")
        context, place = h[sync][order], sync[order]
        apart = np.diff(place)
        near = np.flatnonzero((context[1:] == context[:-1]) & (apart >= tau) & (apart < 2 * tau))
        place, apart = place[near], apart[near]
        mine: list[tuple[int, int, int]] = []
        d = last = -1
        for k in np.lexsort((place, apart)).tolist():
            i = int(place[k])
            if int(apart[k]) != d:
                d, last = int(apart[k]), -1
            if i < last:  # within the stretch that was just looked at
                continue
            s, last = _extent(x, i, d, 4 * tau)
            if last - s + d >= exponent * d:
                mine.append((s, last - s + d, d))
        if mine:
            found.append(np.array(mine, np.int64))
        tau *= 2
    if not found:
        return np.empty((0, 3), np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)  # of equal stretches the smallest period
    return runs[first]


def runs_of_texts(texts: list[list[bytes]], min_length: int, exponent: float) -> list[np.ndarray]:
    """For each text, given as words, its runs (start, length, period) by start, then period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    number = defaultdict(count(len(texts)).__next__)
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    ends = np.cumsum(sizes + 1)
    total = int(ends[-1]) if len(ends) else 0
    # a number of its own ends each text, so nothing repeats across texts
    x = np.fromiter(chain.from_iterable(chain(map(number.__getitem__, texts[k]), (at,)) for at, k in enumerate(order)), np.int64, total)
    longest, tau = [], FIRST_SCALE
    while len(sizes) and sizes[0] >= exponent * tau:
        longest.append(int(ends[np.count_nonzero(sizes >= exponent * tau) - 1]))
        tau *= 2
    runs = periodic_stretches(x, np.array(longest, np.int64), exponent)
    runs = runs[runs[:, 1] >= min_length]
    of = np.searchsorted(ends, runs[:, 0], side="right")
    out = [runs[:0]] * len(texts)
    cuts = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(runs))
    for a, b in pairwise(cuts.tolist()):
        mine = runs[a:b] - [int(ends[of[a]] - sizes[of[a]] - 1), 0, 0]
        out[order[of[a]]] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, (np.cumsum(change)[:-1] == 0).tolist()))


def _portions(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > BATCH_BYTES:
            yield held
            held, size = [], 0
        held.append(raw.split())  # bytes are split at ASCII white space only
        size += len(raw)
    if held:
        yield held


def _worker(min_length: int, exponent: float, schema: pa.Schema):
    kind = schema.field("runs").type

    def run(batches):
        for batch in batches:
            at = 0
            for texts in _portions(batch.column(1)):
                runs = runs_of_texts(texts, min_length, exponent)
                flat = np.concatenate([*runs, np.empty((0, 3), np.int64)])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
                structs = pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(flat.T)], fields=list(kind.value_type))
                kept = pa.array([b" ".join(collapse(w, r)) for w, r in zip(texts, runs, strict=True)], pa.binary()).cast(pa.string())
                arrays = [batch.column(0).slice(at, len(texts)), pa.array([len(w) for w in texts], pa.int64()), pa.ListArray.from_arrays(offsets, structs, type=kind), kept]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                at += len(texts)

    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, exponent: float = 4) -> DataFrame:
    """id_col, n_words, runs (start, length, period; by start, then period) and collapsed of every row of docs.

    Words are maximal stretches without ASCII white space, numbered from 0; words are equal if
    their bytes are. A run is a maximal stretch of words whose smallest period q it holds at least
    `exponent` times (4 or more) and that has at least min_length words. collapsed is the text
    without the words that a run contains after its first q, joined by single spaces.

    Periods under 8 are looked for directly. For each scale t = 8, 16, ... a synchronising set
    is chosen by hashes of t words, without regard to regions of a period up to t / 4, which the
    smaller scales have found. A run of period q in t to 2t has a chosen place among its first t words, and
    the next place with the same 2t words is q further on: such pairs propose, and the words
    themselves decide, so no false run comes out. A run could be missed only where two unequal
    stretches of a batch share a hash of 64 bits. The work is n log n for n words, whatever they are.

    A text is worked on whole, within the task of its row; nothing is shuffled. A null or empty
    text has no words, no runs and collapses to an empty text; null ids, repeated ids and
    repeated rows stay rows of their own; other columns of docs are left out, whatever their
    names. No rows in, no rows out.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    if exponent < 4:
        raise ValueError("runs of an exponent under 4 need more proposals than one a scale")
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    made = _parse_datatype_string(f"n_words long, runs {RUNS}, collapsed string")
    schema = StructType([StructField(id_col, rows.schema[0].dataType), *made.fields])
    return rows.mapInArrow(_worker(min_length, exponent, to_arrow_schema(schema)), schema)


def looped(text: Column, doc_id: Column) -> Column:
    """The text, but for a tenth of the ids the words from some place on repeat those of a short period there.

    h = crc32 of the decimal id and g = h div 10: where h % 10 = 0 each word from a = g % n on, of n words, becomes
    word a + (i - a) % p with p = 1 + (n - a) div (3 + g % 8). Such a text's words are joined by single spaces.
    A null text is empty, and a null id leaves its text alone.
    """
    text = F.coalesce(text, F.lit(""))
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Of every document: its number of runs, that of the greatest exponent, and digests of all runs and of the collapsed text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text"))
    found = find_runs(docs)
    # the first of the greatest length / period: runs are in order of start and period
    better = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    best = F.reduce("runs", F.lit(None).cast(RUNS[6:-1]), better)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP11_SQL = r"""
with numbered as (
  select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
             lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) as h
  from documents),
shape as (select rid, doc_id, len(w) as n, h % 10 = 0 as looped, (h // 10) % greatest(len(w), 1) as a, (h // 10) % 8 as f from numbered),
periods as (select *, 1 + (n - a) // (3 + f) as p from shape),
plain as (select rid, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from numbered),
words as (
  select t.rid, t.i, d.n, coalesce(s.word, t.word) as word
  from plain t join periods d using (rid) left join plain s on s.rid = t.rid and d.looped and t.i >= d.a and s.i = d.a + (t.i - d.a) % d.p),
grams as (
  select rid, i, n, word, lead(word, 1) over o as w1, lead(word, 2) over o as w2, lead(word, 3) over o as w3, lead(word, 4) over o as w4
  from words window o as (partition by rid order by i)),
candidates as (
  select x.rid, y.i - x.i as p
  from grams x join grams y on x.rid = y.rid and x.word = y.word and x.w1 = y.w1 and x.w2 = y.w2 and x.w3 = y.w3 and x.w4 = y.w4 and y.i > x.i and 4 * (y.i - x.i) <= x.n
  group by 1, 2 having count(*) >= greatest(1, 3 * (y.i - x.i) - 4)),
same as (
  select c.rid, c.p, x.i, x.i - row_number() over (partition by c.rid, c.p order by x.i) as island
  from candidates c join words x on x.rid = c.rid join words y on y.rid = c.rid and y.i = x.i + c.p and y.word = x.word),
stretches as (select rid, p, min(i) as s, count(*) + p as l from same group by rid, p, island having count(*) + p >= greatest(6, 4 * p)),
runs as (select rid, s, l, min(p) as p from stretches group by rid, s, l),
covered as (select distinct w.rid, w.i from words w join runs r on r.rid = w.rid and w.i >= r.s + r.p and w.i < r.s + r.l),
kept as (select rid, string_agg(word, ' ' order by i) as text from words anti join covered using (rid, i) group by rid),
totals as (
  select rid, count(*) as n_runs, string_agg(s || ',' || l || ',' || p || chr(10), '' order by s, p) as lines,
         first({'s': s, 'l': l, 'p': p} order by l::double / p desc, s, p) as best
  from runs group by rid)
select doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, best.l as length, best.p as period, 1000 * best.l // best.p as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
from shape left join totals using (rid) left join kept using (rid)
"""
