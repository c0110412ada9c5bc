"""Periodic runs, filter audit and mixing against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from playbill.llm import filter_audit, mixing, periodic_runs

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, runs string, size string, taken string, mask string, part string"


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def slow_runs(w, min_length=6, exponent=4):
    n, best = len(w), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(min_length, exponent * p) and j > i:
                best.setdefault((i, j - i + p), p)  # periods rise
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def periodic_words(rng, n, letters):
    out = []
    while len(out) < n:
        kind = rng.random()
        if kind < 0.4:
            p = rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 33, 64, 70])
            unit = rng.choices(letters, k=p)
            m = int(p * rng.choice([2, 3, 3.9, 4, 4.1, 5, 8.5])) + rng.randint(0, 2)
            out += (unit * (m // p + 1))[:m]
        elif kind < 0.6 and len(out) > 50:
            a = rng.randrange(len(out) - 20)
            out += out[a : a + rng.randint(5, 200)] * rng.choice([1, 4, 5])
        else:
            out += rng.choices(letters, k=rng.randint(1, 30))
    return out[:n]


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [[c.encode() for c in periodic_words(rng, rng.choice([0, 1, 5, 30, 100, 400, 900]), "abcdefghij"[: rng.choice([1, 2, 3, 10])])] for _ in range(rng.randint(1, 8))]
    for exponent in (4, 5.5):
        for w, got in zip(texts, periodic_runs.runs_of_texts(texts, 6, exponent)):
            want = slow_runs(w) if exponent == 4 else [r for r in slow_runs(w) if r[1] >= exponent * r[2]]
            assert [tuple(r) for r in got.tolist()] == want


def test_runs_of_long_texts():
    """A million words: of one kind, of one period, and runs within runs; in time that doesn't follow their length squared."""
    rng = random.Random(1)
    unit = [b"%d" % rng.randrange(3000) for _ in range(370)]
    loop = unit * 3 + [b"x", b"y"]
    texts = [[b"a"] * 1_000_000, unit * 2700, loop * 600 + unit * 5, [b"%d" % rng.randrange(500) for _ in range(600_000)]]
    got = [r.tolist() for r in periodic_runs.runs_of_texts(texts, 6, 4)]
    assert got[:3] == [[[0, 1_000_000, 1]], [[0, 370 * 2700, 370]], [[0, len(loop) * 600 + 3 * 370, len(loop)], [len(loop) * 600, 5 * 370, 370]]]
    assert all(p < 8 for _, _, p in got[3])


def test_synchronising_sets_are_local_and_dense():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, 5000)
    x[3000:3400] = x[1000:1400]
    h, tau = periodic_runs._mix(x.astype(np.uint64)), 1
    while tau < 16:
        h, tau = periodic_runs._doubled(h, tau), 2 * tau
    sync = set(periodic_runs.synchronising(h, tau, np.zeros(len(x), bool)).tolist())
    assert {i - 2000 for i in sync if 3000 <= i <= 3400 - 2 * tau} == {i for i in sync if 1000 <= i <= 1400 - 2 * tau}
    assert all(any(i + d in sync for d in range(tau)) for i in range(0, len(x) - 3 * tau))
    assert len(sync) < 6 * len(x) / tau


def small_texts():
    rng = random.Random(3)
    out = [None, "", " ", "\n\t", "one", "a a a a a", "a a a a a a", "a b a b a b a b", "x  y\tx y\nx\x0by x\x0cy tail", "é é é é é é é", "a a " * 6, "#" * 50]
    out += [" ".join(periodic_words(rng, rng.choice([20, 150, 700]), "abcdefgh")) for _ in range(25)]
    out += ["SHOUT " * 300, "SHOUT " * 300, " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(400)), "costs 5 & 6 " + " ".join(f"v{i}" for i in range(250))]
    out.append(" ".join(f"z{i % 500}" for i in range(5_000)))
    return out


@pytest.fixture(scope="module")
def rows():
    made = [(None if i == 9 else i, t, [None, "", "en", "de"][i % 4], [None, "", "b", "a", "ü", "a b"][i % 6], "c", "c", "c", "c", "c", "c") for i, t in enumerate(small_texts())]
    return [*made, made[12], made[12], made[37], (12, "another text under a known id", "en", "a", *"cccccc"), (900, made[37][1], None, "b", *"cccccc"), (None, made[37][1], "en", None, *"cccccc")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_find_runs(docs, rows, none):
    got = periodic_runs.find_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = []
    for doc_id, text, *_ in rows:
        w = words(text)
        runs = slow_runs(w)
        kept = [x for i, x in enumerate(w) if not any(s + p <= i < s + n for s, n, p in runs)]
        want.append((doc_id, len(w), [tuple(r) for r in runs], " ".join(kept)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert periodic_runs.find_runs(none).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, exponent=3)


def test_looped(spark):
    import zlib

    rng = random.Random(8)
    made = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([0, 1, 2, 3, 40, 300]))) + rng.choice(["", " ", "\n"])) for i in range(-50, 600)] + [(None, "a b c")]
    got = {r.doc_id: r.t for r in spark.createDataFrame(made, "doc_id long, text string").select("doc_id", periodic_runs.looped(F.col("text"), F.col("doc_id")).alias("t")).collect()}
    touched = 0
    for doc_id, text in made:
        w, h = words(text), zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if doc_id is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            touched += 1
            assert got[doc_id] == " ".join(w)
        else:
            assert got[doc_id] == text
    assert touched > 30


def test_exact_exponents(spark, tmp_path):
    """Of runs of nearly the same exponent the exactly greatest counts; of equal ones the first."""
    ids = [i for i in range(200) if __import__("zlib").crc32(str(i).encode()) % 10]  # texts that stay as they are
    one, two, gap = ["a", "b", "c"], ["d", "e"], ["x", "y"]
    texts = [one * 4 + gap + two * 4, two * 4 + ["d"] + gap + one * 4 + ["a"], one * 4 + ["a"] + gap + two * 4 + ["d"]]
    spark.createDataFrame([(i, " ".join(t)) for i, t in zip(ids, texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.start, r.length, r.period, r.exponent_milli) for r in periodic_runs.op11_periodic_runs(spark, str(tmp_path)).collect()}
    want = [max(slow_runs(t), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) for t in texts]
    assert [got[i] for i in ids[:3]] == [(*r, 1000 * r[1] // r[2]) for r in want] == [(0, 12, 3, 4000), (0, 9, 2, 4500), (15, 9, 2, 4500)]


def slow_audit(rows, labels):
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    cells = []
    for doc_id, text, lang, *_ in rows:
        text, w = text or "", words(text)
        fails = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), any(c in "#$%&*|" for c in text), doc_id is not None and doc_id > least[text])
        marks = [(q, t) for d, q, t in labels if d == doc_id and d is not None]
        cells.append((lang or "", {x for x, f in zip("ABCDE", fails) if f}, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    out = {}
    for part in {c[0] for c in cells}:
        mine = [c for c in cells if c[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                gone, left = [c for c in left if x in c[1]], [c for c in left if x not in c[1]]
                before = sum(x in c[1] for c in mine) - len(gone)
                out[part, order, step] = [len(left), len(gone), before, sum(c[1] == {x} for c in mine), sum(c[2] for c in gone), sum(c[3] for c in gone)]
        for x in "ABCDE":
            total = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == x)
            for (p, o, s), v in out.items():
                if p == part and o[s - 1] == x:
                    v.append(total)
    return out


def test_filter_audit(spark, docs, rows, none):
    labels = [(i, [1, 0, None][i % 3], [0, 1, 0, None][i % 4]) for i in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1), (7777, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.interaction_audit(filter_audit.document_cells(docs, marks)).collect()
    assert {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got} == slow_audit(rows, labels)
    assert len(got) == 3 * 120 * 5
    assert filter_audit.interaction_audit(filter_audit.document_cells(none, marks)).collect() == []


def test_audit_of_other_filters(spark):
    cells = spark.createDataFrame([("p", 0, True, False, 5), ("p", 3, None, True, 2), ("p", 3, None, True, 1), (None, 2, True, None, 4)], "part string, mask int, good boolean, toxic boolean, n long")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.interaction_audit(cells, "xy").collect()}
    assert got["p", "xy", 1] == (5, 3, 0, 0, 0, 3, 3) and got["p", "xy", 2] == (5, 0, 3, 0, 0, 0, 3)
    assert got["", "yx", 1] == (0, 4, 0, 4, 4, 0, 8) and len(got) == 8
    for bad in ("", "xx", "abcdefgh"):
        with pytest.raises(ValueError):
            filter_audit.interaction_audit(cells, bad)


def slow_targets(sizes, weights=(1, 2, 3), most=3):
    """Exact water level: shares by weight, the excess over the limit dealt again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in held]
        if not free:
            return {s: Fraction(most * sizes[s]) for s in names}
        level = Fraction(total - sum(most * sizes[s] for s in held), sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return {s: level * weight[s] if s in free else Fraction(most * sizes[s]) for s in names}
        held |= over


def test_mixing(docs, rows, none):
    mixed = mixing.mix_sources(docs, keep=("text", "source", "size"))
    got = mixed.collect()
    assert mixed.columns == ["doc_id", "size", "source_size", "target", "taken", "text", "source"]
    assert sorted((r.doc_id, r.text, r.source, r.size) for r in got if r.doc_id is not None and r.text and r.source) == sorted((d, t, s, len(words(t))) for d, t, _, s, *_ in rows if d is not None and t and s)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = slow_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
    for s, t in taken.items():
        assert t == round(float(want[s])) or abs(t - want[s]) <= 3  # tied rows are each rounded down
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.size, r.taken) for r in again if r.doc_id is not None) == sorted((r.doc_id, r.size, r.taken) for r in got if r.doc_id is not None)
    assert mixing.mix_sources(none).collect() == []
    texts = mixing.mixed_texts(mixed).collect()
    assert sum(len(words(r.text)) for r in texts) == sum(taken.values())
    assert len({(r.doc_id, r.text, r.copy) for r in texts}) >= len({(r.doc_id, r.text) for r in got if r.taken})


def test_mixing_extremes(spark):
    """Only empty texts; one source; many sources of which most are small; a hot tie at the threshold."""
    frame = lambda made: spark.createDataFrame(made, "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mixing.mix_sources(frame([(1, None, "a"), (2, "", None)])).collect()} == {(0.0, 0)}
    assert {(r.doc_id, r.target, r.taken) for r in mixing.mix_sources(frame([(1, "a b", "s"), (2, "c", "s")])).collect()} == {(1, 3.0, 2), (2, 3.0, 1)}
    rng = random.Random(2)
    made = [(k, "w " * rng.choice([0, 1, 5, 50, 400]), f"s{min(rng.randrange(300), rng.randrange(300))}") for k in range(2000)]
    sizes, taken = {}, {}
    for r, (_, _, s) in zip(sorted(mixing.mix_sources(frame(made)).collect()), made):
        sizes[s], taken[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken
    want = slow_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= Fraction(1, 2) for s in sizes)
    tied = frame([(None, "a b c d e f g h", "x")] * 500 + [(k, "q " * 10, "y") for k in range(500)])
    got = mixing.mix_sources(tied).collect()
    assert {r.taken for r in got if r.size == 8} == {6} and sum(r.taken for r in got if r.size == 10) == 6000
