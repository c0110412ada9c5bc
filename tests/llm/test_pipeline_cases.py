"""Each stage of the pipeline, and all of them, on nulls, empty and long texts, ties, repeated rows, an empty table and clashing columns, by brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from playbill.storage import materialize

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = corpus_pipeline.COLUMNS
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, component_id long, score double, keep string, node string, n_lines long"
CLASH = ("c", 1, 0.5, "c", "c", 7)


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *CLASH)


def odd_rows(benchmark):
    shared = "a line that very many of these documents hold"
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
    near = [f"near{i}" for i in range(200)]
    rows = [row(None, None), row(None, "a text without an id"), row(90_001, None), row(90_002, ""), row(90_003, " \n "), row(90_004, "x"), row(90_005, long), row(90_006, long)]
    rows += [row(90_010 + i, f"own line {i}\n  {shared.upper()}\t\nsecond own line {i}", None if i % 2 else "en", None if i % 3 else "s") for i in range(12)]
    rows += [row(90_030, " ".join(near)), row(90_031, " ".join(near[:195] + ["other"])), row(90_032, " ".join(near[:100] + [f"far{i}" for i in range(100)])), row(90_033, " ".join(near))]
    rows += [row(90_033, " ".join(near))] * 2  # the same row three times
    rows += [row(90_040, f"before {benchmark} after"), row(90_041, benchmark), row(None, benchmark)]
    return rows


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Tables of the smallest size with the odd rows among the documents."""
    at = tmp_path_factory.mktemp("pipeline")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{at}/{table}.parquet")
    text = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=len)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    odd = spark.createDataFrame(odd_rows(text), SCHEMA)
    docs.unionByName(odd, allowMissingColumns=True).select(*odd.columns).repartition(5).write.parquet(f"{at}/documents.parquet")
    return str(at)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def count(rows):
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in rows)


def test_quality(spark, docs, sf_dir):
    got = STAGES["quality classifier"](spark, docs, sf_dir)
    assert got.columns == list(COLUMNS)
    kept, given = count(got.collect()), count(docs.collect())
    assert all(n == given[k] for k, n in kept.items())  # whole rows, and equal rows together
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    ids = {k[0] for k in kept}
    assert len(good & ids) > 0.95 * len(good)


def test_lines(spark, docs, sf_dir):
    got = STAGES["line dedup"](spark, docs, sf_dir)
    rows = docs.collect()
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for r in rows:
        for line in (r.text or "").split("\n"):
            holders.setdefault(key(line), set()).add(r.doc_id)
    gone = {k for k, ids in holders.items() if k and len(ids) >= 10}
    want = Counter()
    for r in rows:
        text = "\n".join(x for x in (r.text or "").split("\n") if key(x) not in gone)
        want[r.doc_id, text, r.lang, r.source, len(text)] += 1
    assert got.columns == list(COLUMNS) and any("very many" in k for k in gone)
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in got.collect()) == want


def test_near_copies(spark, docs, sf_dir):
    got = STAGES["SimHash near-dedup"](spark, docs, sf_dir)
    rows = docs.collect()
    sets = {}
    for r in rows:
        w = (r.text or "").encode().lower().split()
        if r.doc_id is not None:
            sets.setdefault(r.doc_id, set()).add(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    leader = {d: d for d in sets}

    def find(x):
        while leader[x] != x:
            x = leader[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(len(x & y) >= 0.8 * len(x | y) for x in sets[a] for y in sets[b] if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y))):
                x, y = find(a), find(b)
                leader[max(x, y)] = min(x, y)
    want = Counter({k: n for k, n in count(rows).items() if k[0] is None or find(k[0]) == k[0]})
    left = count(got.collect())
    assert left == want and {90_031, 90_033, 90_006}.isdisjoint(k[0] for k in left) and 90_032 in {k[0] for k in left}


def test_benchmark(spark, docs, sf_dir):
    got = count(STAGES["benchmark decontamination"](spark, docs, sf_dir).collect())
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    given = count(docs.collect())
    assert all(n == given[k] for k, n in got.items())
    for k, n in given.items():
        if k[0] is not None and any(x in (k[1] or "") for x in items):
            assert k not in got
    assert {90_001, 90_002, 90_003, 90_004, 90_005, 90_030, 90_032} <= {k[0] for k in got} and (None, None, "en", "s") in got


def test_packing(spark, docs, sf_dir):
    import public_tokenizers

    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = STAGES["packing"](spark, rows, sf_dir).collect()
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows.collect():
        pieces = sorted((p.start, p.length) for p in got if p.doc_id == r.doc_id)
        ends = [0]
        for start, length in pieces:
            assert start == ends[-1] and length > 0
            ends.append(start + length)
        if r.doc_id >= 90_000:
            assert ends[-1] == len(encode.encode(r.text or "", add_special_tokens=False).ids) + 1
    places = sorted((p.sequence_id, p.offset, p.length) for p in got)
    for a, b in zip(places, places[1:]):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0) and b[1] + b[2] <= 4096


def test_no_documents(spark, docs, sf_dir):
    none = materialize(docs.limit(0), "none")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, sf_dir)
        assert out.collect() == []
        if name != "packing":
            assert out.columns == list(COLUMNS)


def test_chain(spark, docs, sf_dir):
    """run() is its stages one after the other."""
    held = docs
    for name, stage in corpus_pipeline.STAGES:
        held = materialize(stage(spark, held, sf_dir), "stage")
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.start, r.length)
    got, want = (sorted((key(r) for r in d.collect())) for d in (corpus_pipeline.run(spark, sf_dir), held))
    whole = lambda rows: Counter((r[0], r[1]) for r in rows)
    assert {k: sum(r[3] for r in got if r[:2] == k) for k in whole(got)} == {k: sum(r[3] for r in want if r[:2] == k) for k in whole(want)}
