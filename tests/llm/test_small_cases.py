"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, by brute force."""

import hashlib
import random
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from playbill.llm import components, decontaminate, embeddings, licenses, line_dedup, near_copies, packing, quality, simhash, suffix_dedup, token_store, tokens, warc
from playbill.storage import scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, _kept string"


def texts():
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "straße", "ñandú", "epsilon", "zeta", "eta", "Theta"]
    line = lambda n: " ".join(rng.choices(words, k=n))
    common = "  Shared LINE of all \t"
    out = [None, "", " ", "\n\n", "one", "one two three", common, "x" * 3000]
    for i in range(30):
        out.append("\n".join([line(rng.randint(1, 40)), common if i % 2 else line(3), line(60)]))
    base = line(300)
    out += [base, base, base + " tail", "head " + base, base.replace("alpha", "omega", 1), line(4000)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 9 else i, t, None if i % 7 == 0 else "en", f"s{i % 3}", None if i % 5 == 0 else len(t or ""), "clash", "clash") for i, t in enumerate(texts())]
    rows += [rows[12], rows[12], (12, "another text under a known id", "en", "s", 5, "c", "c")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by(rows):
    return sorted(rows, key=repr)


def groups(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 180)] + [(None, 3), (5, None)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups(200, [(a, b) for a, b in edges if a is not None and b is not None])
    assert got == {n: want[n] for n in {x for e in edges if None not in e and e[0] != e[1] for x in e}}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("limit", [10_000, 0])
def test_lines(docs, none, limit):
    rows, df = docs
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate({c: c + 32 for c in range(65, 91)})
    seen = {}
    for d, t, *_ in rows:
        for x in (t or "").split("\n"):
            seen.setdefault(key(x), set()).add(d)
    gone = {k for k, v in seen.items() if k and len(v) >= 4}
    want = [(d, "\n".join(x for x in (t or "").split("\n") if key(x) not in gone), lang, len((t or "").split("\n")), sum(key(x) in gone for x in (t or "").split("\n")), k) for d, t, lang, _, _, _, k in rows]
    out = line_dedup.dedup_lines(df, min_docs=4, broadcast_lines=limit)
    assert by(tuple(r) for r in out.select("doc_id", "text", "lang", "n_lines", "n_dropped", "_kept").collect()) == by(want)
    assert line_dedup.dedup_lines(none).count() == 0


@pytest.mark.parametrize("words,distance,ratio,least,block", [(4, 4, 0.0, 0, 1024), (5, 12, 0.8, 16, 1024), (4, 4, 0.0, 0, 2), (5, 12, 0.8, 16, 2)])
def test_simhash(docs, none, words, distance, ratio, least, block, monkeypatch):
    rows, df = docs
    monkeypatch.setattr(simhash, "REFINE", 2)
    monkeypatch.setattr(simhash.links, "__defaults__", (0.0, block))
    prints, sizes = [], []
    for _, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sh = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
        sizes.append(len(h))
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    low = {p: min(n for q, n in zip(prints, sizes) if q == p) for p in prints}
    near = lambda a, b: a == b or ((a ^ b).bit_count() <= distance and min(low[a], low[b]) >= least and min(low[a], low[b]) >= ratio * max(low[a], low[b]))
    label = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if near(prints[i], prints[j])])
    ids = [r[0] for r in rows]
    least_id = {x: min((ids[i] for i in range(len(rows)) if label[i] == x and ids[i] is not None), default=None) for x in label}
    want = [(ids[i], f"{prints[i]:016x}", sizes[i], least_id[label[i]]) for i in range(len(rows))]
    out = simhash.simhash_groups(df, words=words, max_distance=distance, min_ratio=ratio, min_shingles=least)
    assert by(tuple(r) for r in out.collect()) == by(want)
    assert simhash.simhash_groups(none).count() == 0


def test_ring():
    """Ring and Hamming check together equal the plain distance."""
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, (4000, near_copies.PARTS)).astype(np.uint64)
    flips = np.packbits(rng.random((4000, 64 * near_copies.PARTS)) < rng.uniform(0, 0.5, (4000, 1)), axis=1).view(np.uint64)
    far = np.bitwise_count(flips).sum(axis=1)
    for most in (0, 5, 40, 72):
        assert (near_copies.ring_near(a ^ (a ^ flips), most) == (far <= most)).all()
    assert near_copies.ring_near(flips[:0], 72).tolist() == []


@pytest.mark.parametrize("block", [1024, 3])
def test_near_copies(spark, docs, none, block, monkeypatch):
    """The components of all pairs of Jaccard similarity 0.8, and of no others, by brute force."""
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "SET_BLOCK", block)
    rng = random.Random(17)
    made = []
    for size in [5, 12, 19, 40, 68, 84, 200, 200, 200, 600]:  # variants at many similarities, some only linked by a chain
        words = [f"w{rng.randrange(5000)}" for _ in range(size)]
        made += [" ".join(words), " ".join(words), " ".join([*words[:-1], "end"])]
        for edits in (1, 2, 3, 4, 4, 4, 5, 8, 16):
            mine = list(words)
            for at in rng.sample(range(size), min(size, edits)):
                mine[at] = "changed" + str(rng.randrange(5000))
            made.append(" ".join(mine))
    for size in range(60, 400, 10):  # pairs at 0.80 to 0.85, by other words at the end
        words = [f"p{rng.randrange(9000)}" for _ in range(size)]
        cut = (size - 4) - int((size - 4) * rng.uniform(0.893, 0.915))
        made += [" ".join(words), " ".join(words[:-cut] + [f"q{rng.randrange(9000)}" for _ in range(cut)])]
        made.append(" ".join(words * 2))  # repeats count once
    rows = [r for r in docs[0] if r[0] is not None] + [(1000 + i, t) + (None,) * 5 for i, t in enumerate(rng.sample(made, len(made)))]
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t, *_ in rows]
    like = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    filled = [i for i in range(len(rows)) if sets[i]]
    pairs = {(i, j): like(i, j) for i in filled for j in filled if j < i}
    label = groups(len(rows), [(i, j) for (i, j), s in pairs.items() if s >= 0.8 or rows[i][0] == rows[j][0]])
    least = {x: min(rows[i][0] for i in filled if label[i] == x) for x in {label[i] for i in filled}}
    got = near_copies.near_copies(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert by(tuple(r) for r in got) == by((rows[i][0], least[label[i]]) for i in filled)
    assert sum(0.8 <= s < 0.85 for s in pairs.values()) > 20 and sum(0.6 < s < 0.8 for s in pairs.values()) > 20
    assert near_copies.near_copies(none).count() == 0


def test_near_copy_blocks(spark, monkeypatch):
    """Large groups that hang together are shipped once; all pairs of different parts meet, those of the largest part don't."""
    monkeypatch.setattr(near_copies, "SET_BLOCK", 10)
    shapes = {1: [200], 2: [150, 3, 1], 3: [4, 4, 4, 4], 4: [30, 25, 1], 5: [7]}
    rows = [(c * 1000 + i, c * 1000, c * 1000 + 100 + k) for c, sizes in shapes.items() for i, k in enumerate(k for k, n in enumerate(sizes) for _ in range(n))]
    crowd = spark.createDataFrame(rows, "node long, component long, part long")
    first = near_copies.first_blocks(crowd.drop("part")).toPandas()
    assert len(first) <= 1.2 * len(rows) and set(first.node) == {r[0] for r in rows} and first.groupby(["component", "block_a"]).size().max() < 40
    part = {n: k for n, _, k in rows}
    later = near_copies.further_blocks(crowd).toPandas()
    assert set(later.component) == {2000, 3000, 4000} and (later.component == 2000).sum() < 250
    met = set()
    for _, block in later.groupby(["component", "block_a", "block_b"]):
        got = list(zip(block.node, block.side))
        for i, (x, a) in enumerate(got):
            for y, b in got[:i]:
                if block.block_a.iloc[0] == block.block_b.iloc[0] or a != b:
                    met.add((min(x, y), max(x, y)))
    want = {(x, y) for x, c, k in rows for y, d, j in rows if x < y and c == d and k != j}
    assert want <= met and not any(part[x] == part[y] == 2100 for x, y in met)


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows = [(i, v.tolist(), "x") for i, v in enumerate(np.concatenate([base, base[:20] + 0.1 * rng.standard_normal((20, 16)), base[:10]]))]
    rows += [(100, None, "x"), (101, [0.0] * 16, "x"), (102, [float("nan")] + [1.0] * 15, "x"), (103, [None] + [1.0] * 15, "x"), (104, [], "x"), (105, [1.0, 2.0], "x"), (106, [2.0, 4.0], "x"), (None, rows[3][1], "x"), rows[5], rows[5]]
    valid = [i for i, (_, v, _) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    linked = []
    for i in valid:
        for j in valid:
            a, b = rows[i][1], rows[j][1]
            if i < j and len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9 - 1e-12:
                linked.append((i, j))
    label = groups(len(rows), linked)
    ids = [r[0] for r in rows]
    want = []
    for i in range(len(rows)):
        c = min((ids[j] for j in range(len(rows)) if label[j] == label[i] and ids[j] is not None), default=None)
        want.append((ids[i], sum(i in e for e in linked), c, ids[i] is not None and ids[i] == c))
    got = embeddings.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string"))
    assert by(tuple(r) for r in got.collect()) == by(want)
    assert embeddings.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def at_cosine(rng, a, low, high):
    """Partners of unit vectors at a cosine between low and high."""
    noise = rng.standard_normal(a.shape)
    noise -= (noise * a).sum(axis=1, keepdims=True) * a
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cosine = rng.uniform(low, high, (len(a), 1))
    return a * cosine + noise * np.sqrt(1 - cosine**2)


@pytest.mark.parametrize("share", [0.0, 0.7, 0.8, 0.9, "clusters"])
def test_embedding_recall(spark, share):
    """Against brute force, at the threshold itself, for vectors with a common mean and in clusters."""
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    own = unit(rng.standard_normal((1200, 64)))
    if share == "clusters":
        a = unit(np.sqrt(0.8) * unit(rng.standard_normal((12, 64)))[rng.integers(0, 12, 1200)] + np.sqrt(0.2) * own)
    else:
        a = unit(np.sqrt(share) * unit(rng.standard_normal((1, 64))) + np.sqrt(1 - share) * own)
    x = np.concatenate([a, at_cosine(rng, a, 0.9001, 0.95)])
    out = embeddings.embedding_groups(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"))
    near = x @ x.T >= 0.9
    got = {r.vec_id: r.n_links for r in out.collect()}
    true = int(near.sum()) - len(x)
    assert 0.95 * true <= sum(got.values()) <= true
    assert all(got[i] <= int(near[i].sum()) - 1 for i in range(len(x)))


def test_embedding_plan_grows():
    """Tables get wider with the number of vectors, so that what an entry holds stays about the same."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    plans = [embeddings.Index(x, n, 0.9) for n in (10**3, 10**5, 10**7)]
    assert plans[0].width < plans[1].width < plans[2].width and all(p.recall >= 0.97 for p in plans)
    assert all(n * p.tables / 2**p.width < 20_000 for n, p in zip((10**5, 10**7), plans[1:]))


def sellers(pattern, text):
    prev = list(range(len(pattern) + 1))
    best = prev[-1]
    for c in text:
        cur = [0]
        for i, a in enumerate(pattern):
            cur.append(min(prev[i] + (a != c), prev[i + 1] + 1, cur[i] + 1))
        prev = cur
        best = min(best, prev[-1])
    return best


def test_contamination(spark):
    rng = random.Random(2)
    letters = "abcde "
    items = [(i, "".join(rng.choices(letters, k=rng.randint(4, 70)))) for i in range(12)] + [(12, None), (None, "abcdabcdabcdabcd"), (13, "")]
    rows = [(None, None), (1, "")]
    for d in range(2, 40):
        s = list(rng.choices(letters, k=rng.randint(0, 90)))
        x = list(rng.choice(items[:12])[1])
        for _ in range(rng.randint(0, 5)):
            x[rng.randrange(len(x))] = rng.choice(letters)
        s[rng.randint(0, len(s)) : 0] = x
        rows.append((d, "".join(s)))
    rows.append(rows[-1])
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench, q=4, max_edits=0.15).collect()
    want = []
    for d, t in rows:
        for i, x in items:
            p, y = decontaminate.normal(x), decontaminate.normal(t)
            if i is not None and p:
                e = sellers(p, y)
                if e <= int(len(p) * 0.15) if len(p) >= 4 * (int(len(p) * 0.15) + 1) else p == y:
                    want.append((d, i, e))
    assert by(tuple(r) for r in got) == by(want) and want
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_short_items(spark):
    """By q-grams of five characters from ten characters on; by equality below five."""
    items = [(0, "abcdefghijklmnopqrstu"), (1, "mnopqrs"), (2, "yes"), (3, "qwertyuiopas")]
    docs = [(0, "xx abcdXfghijklmnYpqrstu xx"), (1, "-mnopqrs-"), (2, " YES "), (3, "yes!"), (4, "qw ertyuiopas"), (5, "qwXrtZuiopas")]
    got = decontaminate.contamination(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert by(tuple(r) for r in got) == [(0, 0, 2), (1, 1, 0), (2, 2, 0), (4, 3, 1)]


def test_repetitive_text():
    """A line of a million dashes against an item of 400: memory follows the bands."""
    import tracemalloc

    items = decontaminate.Part([7], ["-" * 400], 8, 0.1)
    tracemalloc.start()
    found = items.many(["-" * 1_000_000, "-" * 365, "-" * 359])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [[(7, 0)], [(7, 35)], []]
    assert peak < 500 << 20


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(decontaminate, "TEXT_CHARS", 3000)
    rng = random.Random(4)
    item = "".join(rng.choices("abcdefgh ", k=120))
    text = "".join(rng.choices("abcdefgh ", k=20_000))
    found = decontaminate.Items([1], [item], 8, 0.1)
    for at in range(0, 20_000, 701):
        assert 0 in found.matches(decontaminate.normal(text[:at] + " " + item + " " + text[at:]))
    assert not found.matches(decontaminate.normal(text))


def test_word_ids_equal_whole_texts():
    coder = tokens.encoder(tokens.default_tokenizer())
    rng = random.Random(6)
    pieces = ["a", "É", "é", "´", "'", "s", " ", "\n", "\t", " ", "́", "Σ", "ς", "1", "!", "<|endoftext|>", "İ", "\x1c", "\x85", "中", "it's", "\r", "가", "😀", "word", "Straße,", "...", "$$$", "-"]
    many = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(4000)] + texts()[1:]
    assert coder.encode(many) == coder._ids(many)
    assert coder.encode([None]) == [b""]


def test_token_store(spark, docs, none):
    rows, df = docs
    coder = tokens.encoder(tokens.default_tokenizer())
    store = token_store.TokenStore.write(df, scratch(spark, "t"))
    got = [tuple(r) for r in store.read(df.select("doc_id").distinct()).collect()]
    ids = lambda t: coder._ids([t or ""])[0] + (1).to_bytes(4, "little")
    assert by((d, n, c) for d, _, n, c in got) == by((d, len(ids(t)) // 4, zlib.crc32(ids(t))) for d, t, *_ in rows)
    at = 0
    for d, start, n, _ in sorted(got, key=lambda r: (r[1],)):
        assert start == at
        at += n
    order = [d for d, *_ in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert by(x.tobytes() for x in store.get(12)) == by(ids(t) for d, t, *_ in rows if d == 12)
    assert store.get(10**9) == []
    empty = token_store.TokenStore.write(none, scratch(spark, "t"))
    assert empty.get(1) == [] and empty.read(none.select("doc_id")).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 50_000))
    perfect = token_store.PerfectHash.build(keys)
    assert sorted(perfect.find(keys).tolist()) == list(range(len(keys)))
    slots = np.zeros(len(keys), token_store.SLOT)
    again, _ = token_store.PerfectHash.load(perfect.dump(slots))
    assert (again.find(keys) == perfect.find(keys)).all()


def test_packing(spark, docs, none, monkeypatch):
    rows, df = docs
    coder = tokens.encoder(tokens.default_tokenizer())
    for window in (64, 256):
        got = packing.pack(df, scratch(spark, "p"), window=window).collect()
        want = by(coder._ids([t or ""])[0] + (2).to_bytes(4, "little") for _, t, *_ in rows)
        assert sum(r.length for r in got) == sum(len(x) // 4 for x in want)
        ends = {}
        for r in got:
            ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
        used = []
        for pieces in ends.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at and length > 0
                at += length
            assert at <= window
            used.append(at)
        assert sum(u < window for u in used) <= 1
        one = {d: t for d, t, *_ in rows if sum(r[0] == d for r in rows) == 1}
        for d, t in one.items():
            ids, at = coder._ids([t or ""])[0] + (2).to_bytes(4, "little"), 0
            for r in sorted((r for r in got if r.doc_id == d), key=lambda r: r.start):
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids) // 4, zlib.crc32(ids[4 * at : 4 * (at + r.length)]))
                at += r.length
            assert at == len(ids) // 4
    assert packing.pack(none, scratch(spark, "p")).count() == 0


def repeated(data, length):
    """For each text, which of its bytes a string of that length covers that also starts elsewhere."""
    seen = {}
    for x in data:
        for i in range(len(x) - length + 1):
            seen[x[i : i + length]] = seen.get(x[i : i + length], 0) + 1
    covers = []
    for x in data:
        cover = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        covers.append(bytes(cover))
    return covers


@pytest.mark.parametrize("passage", [None, 266, 300])
def test_suffixes(spark, docs, none, passage):
    rows, df = docs
    rng = random.Random(6)
    some = ["".join(rng.choice("abcd é") for _ in range(n)) for n in (290, 330, 395, 410, 500)]
    more = [(1000 + i, rng.choice(["", "x" * i]) + some[i % 5] + some[(i * 3 + 1) % 5][: 40 * i] + str(i)) for i in range(12)]
    df = df.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).withColumn("kept", F.lit(1)).withColumn("file", F.lit("f"))
    rows = [(r[0], r[1]) for r in rows] + more
    data = [(t or "").encode() for _, t in rows]
    want = []
    for (d, _), x, cover, short in zip(rows, data, repeated(data, 400), repeated(data, passage or 400), strict=True):
        kept = bytes(c for c, g in zip(x, cover, strict=True) if not g)
        want.append((d, len(x), len(x) - len(kept), len(re.findall(b"\1+", cover)), hashlib.sha256(kept).hexdigest(), len(kept), sum(short), kept))
    got = suffix_dedup.remove_repeats(df, passage=passage)
    assert by((*tuple(r)[:7], bytes(r.kept)) for r in got.collect()) == by(want)
    assert suffix_dedup.remove_repeats(none, passage=passage).count() == 0


def test_cover():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


def test_warc(spark):
    big = "é" * 700
    rows = [(1, "http://a", big), (5, "http://b\r\nX: y", big), (3, None, big), (7, "u", None), (8, "u", ""), (9, "u", "short"), (10, "u", "short"), (None, "u", big), (5, "http://b", big), (None, None, "\r\n\r\nWARC/1.1" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    root = scratch(spark, "w")
    index = warc.write_archive(pages, root)
    assert index.count() == len(rows)
    got = [tuple(r) for r in warc.read_archive(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    want = []
    for p, _, h in rows:
        b = (h or "").encode()
        target = 5 if h == big else None
        revisit = target is not None and p != 5
        want.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    assert by(got) == by(want)
    assert [p for _, p in warc.fetch(spark, root, 9)] == [b"short"]
    assert len(warc.fetch(spark, root, 5)) == 2 and warc.fetch(spark, root, 99) == []
    root = scratch(spark, "w")
    warc.write_archive(pages.limit(0), root)
    assert warc.read_archive(spark, root).count() == 0


def test_quality_edges(spark, docs, none):
    rows, df = docs
    labels = spark.createDataFrame([(i, i % 2) for i in range(10, 36)] + [(None, 1), (11, None), (12, 1), (12, 0)], "doc_id long, quality int")
    out = quality.score_quality(df, labels)
    assert out.count() == len(rows) and set(out.columns) == {*df.columns, "p_text", "p_meta", "quality_score", "keep"}
    assert out.where("quality_score is null or quality_score < 0 or quality_score > 1").count() == 0
    assert quality.score_quality(none, labels).count() == 0
    assert quality.score_quality(df, labels.limit(0)).where("not keep").count() == 0
    clash = df.withColumn("_text", F.lit("mine")).withColumn("_view0", F.lit("mine")).withColumn("id", F.lit("mine")).withColumn("keep", F.lit("gone"))
    got = quality.score_quality(clash, labels, labelled=12, pseudo=4, rounds=2)
    assert got.where("_text = 'mine' and _view0 = 'mine' and id = 'mine' and keep is not null").count() == len(rows)


def test_quality_scores_equal_one_by_one(spark, docs, monkeypatch):
    """Every row's scores from the fitted views, worked out one row at a time."""
    rows, df = docs
    labels = spark.createDataFrame([(i, i % 2) for i in range(10, 36)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    monkeypatch.setattr(quality, "fit", lambda *a, **k: model)
    want = []
    for d, text, lang, source, n, *_ in rows:
        t = float(model.text.logit(quality.text_features(text)[None])[0])
        m = float(model.meta.logit(quality.meta_features([lang], [source], [n]))[0])
        p = [1 / (1 + np.exp(-x)) for x in (t, m, t + m - model.prior)]
        want.append((d, *(round(float(x), 5) for x in p), bool(p[2] >= 0.5)))
    got = quality.score_quality(df, labels, keep_columns=("doc_id",)).collect()
    assert by((r.doc_id, round(r.p_text, 5), round(r.p_meta, 5), round(r.quality_score, 5), r.keep) for r in got) == by(want)


def test_calibration_settles():
    """Scores that separate the classes, far out or mixed: probabilities stay on the right side."""
    rng = np.random.default_rng(3)
    for spread, noise in ((1.0, 0.0), (60.0, 0.0), (60.0, 0.02), (400.0, 0.0), (0.001, 0.1)):
        y = (rng.random(1500) < 0.86).astype(float)
        x = np.where(y > 0.5, 1.0, -1.0)[:, None] * rng.uniform(0.2, 1.0, (1500, 1)) * spread
        flip = rng.random(1500) < noise
        model = quality.Logistic(x, y)
        model.weights, model.bias = np.array([1.0]), 0.0
        model.calibrate(x, np.where(flip, 1 - y, y))
        assert ((quality.sigmoid(model.logit(x)) >= 0.5) == (y > 0.5)).mean() > 0.97


def test_quality_features_whole_texts(monkeypatch):
    """Long texts are counted in pieces with the same result, and repetition shows."""
    many = [*texts(), "ab", "abc"]
    whole = [quality.text_features(t) for t in many]
    monkeypatch.setattr(quality, "TEXT_BYTES", 50)
    assert all(np.allclose(a, quality.text_features(t)) for a, t in zip(whole, many, strict=True))
    assert quality.text_features("word " * 200)[-1] > quality.text_features(" ".join(map(str, range(300))))[-1]


def test_license_anchors():
    """A window without any anchor can confirm no template."""
    found = set(licenses.anchors())
    for family, ws in licenses.templates():
        pairs = list(dict.fromkeys(zip(ws, ws[1:])))
        left = [w for w in dict.fromkeys(ws) if w not in found] + [p for p in pairs if not found & set(p)]
        assert len(left) < licenses.CONFIRM * (len(set(ws)) + len(pairs)), (family, ws)


def held_out():
    """Notices as they are found: wrapped, in comments, with other names, years and addresses; and text that is none."""
    wrap = lambda text, n, lead="": "\n".join(lead + x for x in textwrap.wrap(text, n))
    lgpl = "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."
    stated = [
        ("LGPL", wrap(lgpl, 72)), ("LGPL", wrap(lgpl, 40, " * ")), ("MIT", wrap(mit, 79, "# ")), ("MIT", wrap(mit, 48, "// ")), ("MIT", "This project is licensed under the terms of the MIT License."),
        ("Apache-2.0", wrap("Copyright 2019 The Example Authors. Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", 60)),
        ("BSD", wrap("Redistribution and use in source and binary forms, with or without modification, are permitted (subject to the limitations below) provided that the following conditions are met", 50)),
        ("GPL", wrap("Foo is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.", 66, "# ")),
        ("MPL-2.0", wrap("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0. If a copy of the MPL was not distributed with this file, you can get one at mozilla.org.", 55)),
        ("proprietary", "Copyright 2021 Example Inc. All rights reserved."), ("CC-BY-SA", "This article is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ]
    other = [
        "The driver must carry a valid license and the car its registration.", "He asked for permission to use the software in the general public library.", "The conditions of the contract were met without notice.",
        "Fishing licenses are sold at the office; all rights of way stay open.", "She wrote about copyright and the rights of authors in the last chapter.", "Public bodies distribute source material to any person who asks.",
    ]
    return stated, other


def test_licenses_held_out(spark):
    """Notices that aren't templates word by word, between other text; text with licence words that states none."""
    rng = random.Random(10)
    word = lambda: "".join(rng.choices("aeioubdgklmnprst", k=rng.randint(2, 9)))
    filler = lambda n: " ".join(word() for _ in range(n))
    stated, other = held_out()
    rows = [(i, "\n".join(filler(rng.randint(5, 150)) for _ in range(4))) for i in range(80)]
    rows += [(100 + i, filler(50) + gap + t + gap + filler(30)) for i, (_, t) in enumerate(stated) for gap in ("\n",)]
    rows += [(200 + i, filler(50) + "\n\n" + t + "\n\n" + filler(30)) for i, (_, t) in enumerate(stated)]
    rows += [(300 + i, t) for i, t in enumerate(other)] + [(400, stated[4][1] + "\n" + stated[9][1])]
    got = {(r.doc_id, r.family) for r in licenses.scan(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ws string")).collect()}
    want = {(k + i, f) for k in (100, 200) for i, (f, _) in enumerate(stated)} | {(400, "MIT"), (400, "proprietary")}
    assert not {d for d, _ in got if d < 100 or 300 <= d < 400}
    assert len(want & got) >= 0.9 * len(want) and len(got - want) <= 2, (want - got, got - want)


def test_licenses(spark, none):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("aeioubdgklmnprst", k=rng.randint(2, 9)))
    filler = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, "\n".join(filler(rng.randint(5, 150)) for _ in range(4))) for i in range(60)] + [(60, None), (61, ""), (62, "...\n123")]
    planted = {70: ("MIT", "Released under the MIT License."), 71: ("Apache-2.0", "LICENSED under the apache license,  version 2.0"), 72: ("GPL", "This work is licensed under the GNU General Public License, version 3."), 73: ("CC-BY-NC", "Licensed under CC BY-NC 4.0.")}
    rows += [(i, filler(80) + "\n" + t + "\n" + filler(30)) for i, (_, t) in planted.items()] + [(70, "Released under the MIT License.")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.family) for r in got} == {(i, f) for i, (f, _) in planted.items()}
    assert licenses.scan(none).count() == 0


def test_rights_reserved(spark):
    """Short copyright notices are the proprietary family; the words apart from each other are not."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("aeioubdgklmnprst", k=rng.randint(2, 9)))
    filler = lambda n: " ".join(word() for _ in range(n))
    notices = ["All rights reserved.", "Copyright 2024 Example Ltd. All rights reserved.", "(c) 2019 A. Writer, all rights reserved"]
    rows = [(i, "\n".join(filler(rng.randint(5, 150)) for _ in range(4))) for i in range(60)] + [(60, "All seats were reserved, and so were the rights of way.")]
    rows += [(70 + i, filler(80) + "\n" + t + "\n" + filler(30)) for i, t in enumerate(notices)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.family) for r in got} == {(70 + i, "proprietary") for i in range(len(notices))}



def test_license_forms(spark):
    """Short forms, texts of long licences, near-identical families, denials, licences of no family, ties, a very long text."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("aeioubdgklmnprst", k=rng.randint(2, 9)))
    filler = lambda n: " ".join(word() for _ in range(n))
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."
    cases = [
        ({"Apache-2.0"}, "SPDX-License-Identifier: Apache-2.0"), ({"MIT"}, "License: MIT"), ({"GPL"}, "Licensed under GPLv3."), ({"LGPL"}, "// SPDX-License-Identifier: LGPL-2.1-or-later"), ({"GPL"}, "SPDX-License-Identifier: GPL-2.0+"),
        ({"GPL"}, "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
        ({"Apache-2.0"}, "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."),
        ({"WTFPL"}, "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"), ({"proprietary"}, "This file contains confidential and proprietary information of Example Inc."),
        ({"Artistic-2.0"}, "This library is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0."), ({"MIT"}, mit),
        (set(), "You may not use the material for commercial purposes."), (set(), "This tool is not licensed under the MIT License."), (set(), "It was never released\nunder the Apache License, Version 2.0, whatever they say."),
        ({"unknown"}, "This work is licensed under the Open Gate Data License, version 1.2."), ({"unknown"}, "SPDX-License-Identifier: LicenseRef-Gate"),
        ({"MIT", "Apache-2.0"}, "Licensed under the MIT License.\n\nLicensed under the Apache License, Version 2.0."), ({"MIT"}, "This tool is not licensed under the Apache License, Version 2.0. It is licensed under the MIT License."),
        ({"MIT"}, filler(40_000) + "\nReleased under the MIT License.\n" + filler(40_000)),
    ]
    rows = [(i, "\n".join(filler(rng.randint(5, 150)) for _ in range(4))) for i in range(80)]
    rows += [(100 + i, filler(80) + "\n\n" + t + "\n\n" + filler(30)) for i, (_, t) in enumerate(cases)]
    got: dict[int, set] = {}
    for r in licenses.scan(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, family string, id int")).collect():
        got.setdefault(r.doc_id, set()).add(r.family)
    wrong = [(f, got.get(100 + i, set()), t[:80]) for i, (f, t) in enumerate(cases) if got.get(100 + i, set()) != f]
    assert not wrong and not [d for d in got if d < 100], wrong


def test_license_model_learns_from_every_document(spark):
    """Look-alikes in the documents that a sample of 1,500 by hash would miss are unknown; every document's windows count."""
    from playbill.llm.common import hash_sample

    ids = spark.range(2000)
    sampled = {r.id for r in hash_sample(ids, 1500, "licenses", "id").collect()}
    rows = [(i, "Fish of the sea are free of salt" if i in sampled else "The MIT license of our school was long") for i in range(2000)]
    docs = spark.createDataFrame(rows, "id long, text string")
    model = licenses.train(docs)
    (got,) = model.predict(spark.createDataFrame([(licenses._plain(rows[min(set(range(2000)) - sampled)][1]),)], "ws array<string>")).collect()
    assert got.families == [] and got.probability < 0.5, got
    unknown = licenses.unknown_windows(licenses.windows(docs, licenses.anchors())).collect()
    assert sum(r.n for r in unknown) == 2000 and len({tuple(r.features.indices) for r in unknown}) == 2


def test_license_unknown_windows_are_whole(spark):
    """All windows of the paragraphs without a notice, each feature set once a document; wrapped notices go with their paragraph."""
    notice = "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\ndocumentation files (the Software), to deal in the Software without restriction"
    texts = ["a public walk", "a public walk\n\nA public walk", notice, notice + "\n\nThe program of the fair", None, "", "no such word", "Released under the Gate License.", "A public\nwalk"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a public walk"), (None, "a public walk")]
    pieces = licenses.windows(spark.createDataFrame(rows, "id long, text string"), licenses.anchors())
    got: dict[tuple, int] = {}
    for r in licenses.unknown_windows(pieces).collect():
        key = tuple(sorted(licenses.vocabulary()[i] for i in r.features.indices))
        got[key] = got.get(key, 0) + r.n
    known = set(licenses.vocabulary())
    want = {tuple(sorted(known.intersection(licenses._grams(licenses._plain(t))))): n for t, n in (("a public walk", 4), ("the program of the fair", 1))}
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_license_threshold_is_exact(spark, seed):
    rng = random.Random(seed)
    value = [lambda: rng.random(), lambda: 1 - rng.random() ** 8 / 1e6, lambda: rng.choice([0.2, 0.75, 0.750001])][seed]
    rows = [(value(), rng.randint(1, 40)) for _ in range(3000)]
    flat = sorted((p for p, n in rows for _ in range(n)), reverse=True)
    want = max(0.5, flat[int(len(flat) * (1 - licenses.CALIBRATION))])
    assert licenses._upper(spark.createDataFrame(rows, "probability double, n long")) == want
    assert licenses._upper(spark.createDataFrame([], "probability double, n long")) == 0.5


def test_license_templates():
    """Every paragraph that names its licence keeps a template; no template's marks are another family's words."""
    made = licenses.marked_templates()
    for family, paragraphs in licenses.LICENCES.items():
        own = [set(ws) for f, ws, _ in made if f == family]
        assert all(any(ws <= set(licenses._plain(p)) for ws in own) for p in paragraphs)
    full = {}
    for family, ws, marks in made:
        if marks:
            have = set(licenses._grams(ws))
            for other, ts, need in made:
                if need and other != family and set(need) <= have and len(set(licenses._grams(ts)) & have) >= licenses.CONFIRM * len(set(licenses._grams(ts))):
                    full[family, other] = ws
    assert not full, full


def test_likeness_is_all_templates(spark):
    """Looking templates up by marks confirms what comparing every window with every template does."""
    stated, other = held_out()
    texts = [t for _, t in stated] + other + [" ".join(ws) for _, ws in licenses.templates()]
    wins = [licenses._plain(t)[:64] for t in texts]
    want = set()
    for i, ws in enumerate(wins):
        own = set(licenses._grams(ws))
        for f, ts, marks in licenses.marked_templates():
            tg = set(licenses._grams(ts))
            if set(marks) <= own and len(own & tg) / len(tg) >= licenses.CONFIRM:
                want.add((i, f, round(len(own & tg) / len(tg), 9)))
    pieces = spark.createDataFrame(list(enumerate(wins)), "n int, ws array<string>")
    assert {(r.n, r.known, round(r.likeness, 9)) for r in licenses.likeness(pieces).collect()} == want


def test_decontamination_holds_few_texts_at_a_time():
    seen = []

    class Shared:
        class value:
            @staticmethod
            def many(texts):
                seen.append(len(texts))
                return [[(7, 0)] if t == "a" else [] for t in texts]

    ids = list(range(5000))
    batch = pa.RecordBatch.from_pydict({"doc_id": ids, "text": ["A" if i % 1000 == 0 else None for i in ids]})
    got = [tuple(r.values()) for b in decontaminate._matcher(Shared)([batch]) for r in b.to_pylist()]
    assert got == [(i, 7, 0) for i in range(0, 5000, 1000)]
    assert sum(seen) == 5000 and max(seen) <= decontaminate.ROWS
