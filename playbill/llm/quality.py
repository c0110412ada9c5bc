"""Quality classifier by co-training a text view and a metadata view on bounded samples."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, StructType

from playbill.llm.common import hash_sample, small_batches
from playbill.schema import fresh
from playbill.storage import materialize

#: Most labelled documents that the views are fitted on, by the hash of their id, and most
#: pseudo-labels that a view gets in a round, as many of either class. All documents are scored in
#: every round, and read whole.
LABELLED, PSEUDO = 4000, 2000
ROUNDS, CONFIDENT = 3, 0.97
#: Hashed byte trigrams of the text view (and one number for their repetition); hashed values and size classes of the metadata view.
TEXT_BINS, META_BINS, SIZE_BINS = 512, 64, 24
#: Documents whose joined probability of being good is below this are rejected.
THRESHOLD = 0.5
TEXT_BYTES = 1 << 22


def trigram_bins(data: np.ndarray) -> np.ndarray:
    """The bin of the trigram that starts at each byte but the last two."""
    x = data.astype(np.uint32)
    h = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    return h >> np.uint32(32 - int(TEXT_BINS).bit_length() + 1)


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def text_features(text: str | None) -> np.ndarray:
    """Share of each trigram bin in a whole text, and how often two of its trigrams are alike (log)."""
    data, counts = np.frombuffer(_encoded(text), np.uint8), np.zeros(TEXT_BINS)
    for i in range(0, len(data) - 2, TEXT_BYTES):
        counts += np.bincount(trigram_bins(data[i : i + TEXT_BYTES + 2]), minlength=TEXT_BINS)
    n = max(1.0, counts.sum())
    alike = float((counts * counts).sum() - n) / max(1.0, n * (n - 1))
    return np.append(counts / n, math.log10(max(alike, 0.0) + 1e-4)).astype(np.float32)


def meta_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """One-hot language, source and size class; nulls have a class of their own."""
    x = np.zeros((len(lang), 2 * META_BINS + SIZE_BINS), np.float32)
    rows = np.arange(len(lang))
    x[rows, [xxhash.xxh32_intdigest(repr(v)) % META_BINS for v in lang]] = 1
    x[rows, [META_BINS + xxhash.xxh32_intdigest(repr(v)) % META_BINS for v in source]] = 1
    x[rows, [2 * META_BINS + (0 if v is None else min(SIZE_BINS - 1, 1 + int(math.log2(max(v, 0) + 1)))) for v in n_chars]] = 1
    return x


def _largest_square(z: np.ndarray) -> float:
    """A little over the largest eigenvalue of z' z, by power iteration."""
    v = np.ones(z.shape[1]) / math.sqrt(z.shape[1])
    size = 0.0
    for _ in range(30):
        v = z.T @ (z @ v)
        size = float(np.linalg.norm(v))
        if not size:
            return 1.0
        v /= size
    return 1.1 * size


class Logistic:
    """Logistic regression on standardised features, then Platt scaling on other rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 200) -> None:
        mean, std = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = ((x - mean) / std).astype(np.float64)
        w, b = np.zeros(x.shape[1]), 0.0
        v, c = w, b
        step = 1.0 / (0.25 * (_largest_square(z) / max(1, len(z)) + 1) + ridge)
        for k in range(rounds):
            g = 1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30))) - y
            w2, b2 = v - step * (z.T @ g / max(1, len(z)) + ridge * v), c - step * g.mean()
            v, c = w2 + k / (k + 3) * (w2 - w), b2 + k / (k + 3) * (b2 - b)
            w, b = w2, b2
        self.weights, self.bias, self.slope, self.shift = w / std, b - float((w / std) @ mean), 1.0, 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling: slope and shift of the logit on held-out rows, with smoothed targets.

        Newton steps are halved until they lower the loss, so that it also settles where the
        scores separate the classes. Without rows of both classes the logit stays as it is.
        """
        good = y > 0.5
        if good.all() or not good.any():
            return
        s = self.raw(x)
        target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))

        def loss(ab: np.ndarray) -> float:
            z = ab[0] * s + ab[1]
            return float((np.logaddexp(0, z) - target * z).sum())

        at = np.array([1.0 / max(1.0, float(s.std())), 0.0])
        now = loss(at)
        for _ in range(100):
            p = sigmoid(at[0] * s + at[1])
            r, q = p - target, p * (1 - p)
            hess = np.array([[(q * s * s).sum() + 1e-9, (q * s).sum()], [(q * s).sum(), q.sum() + 1e-9]])
            step, size = np.linalg.solve(hess, np.array([(r * s).sum(), r.sum()])), 1.0
            while size > 1e-8 and loss(at - size * step) > now:
                size /= 2
            after = loss(at - size * step)
            if now - after < 1e-9:
                break
            at, now = at - size * step, after
        self.slope, self.shift = max(float(at[0]), 0.0), float(at[1])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift

    def folded(self) -> tuple[np.ndarray, float]:
        return self.slope * self.weights, self.slope * self.bias + self.shift


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


#: Takes the views of a round; returns, for each view, {id: (label, its features)} of documents that the other view is sure of.
Exchange = Callable[[list[Logistic], int], list[dict[int, tuple[float, np.ndarray]]]]


class CoTrained:
    """Both views after the rounds; logit of the whole = sum of the views' less the prior's."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray, exchange: Exchange, rounds: int = ROUNDS) -> None:
        held = np.arange(len(y)) % 4 == 0  # rows are in hash order
        rate = (y.sum() + 1) / (len(y) + 2)
        self.prior = float(np.log(rate / (1 - rate)))
        given: list[dict[int, tuple[float, np.ndarray]]] = [{}, {}]  # pseudo-labels that each view was given
        for k in range(rounds):
            views = []
            for x, extra in zip((text, meta), given, strict=True):
                ids = sorted(extra)
                model = Logistic(np.stack([*x[~held], *(extra[i][1] for i in ids)]), np.array([*y[~held], *(extra[i][0] for i in ids)]))
                model.calibrate(x[held], y[held])
                views.append(model)
            if k < rounds - 1:  # each view labels for the other where it is sure
                for extra, more in zip(given, exchange(views, k), strict=True):
                    extra.update(more)
        self.text, self.meta = views

    def combine(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return text + meta - self.prior


FEATURES = pa.schema([("id", pa.int64()), ("text", pa.binary()), ("meta", pa.binary())])


def _featurise(batches):
    for batch in batches:
        ids, texts, *meta = (c.to_pylist() for c in batch.columns)
        if ids:
            m = meta_features(*meta)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([text_features(t).tobytes() for t in texts], pa.binary()), pa.array([x.tobytes() for x in m], pa.binary())], schema=FEATURES)


def _matrix(rows: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, width)


WIDTHS = (TEXT_BINS + 1, 2 * META_BINS + SIZE_BINS)


def _features(base: DataFrame, ids: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Features of both views of some (boundedly many) documents; of rows that share an id, the least counts."""
    wanted = base.sparkSession.createDataFrame([(i,) for i in ids], "id long")
    rows = base.join(F.broadcast(wanted), "id", "left_semi").groupBy("id").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("d")).select("id", "d.*")
    found = rows.mapInArrow(_featurise, "id long, text binary, meta binary").toArrow()
    return {i: (_matrix([t], WIDTHS[0])[0], _matrix([m], WIDTHS[1])[0]) for i, t, m in zip(*(found[c].to_pylist() for c in ("id", "text", "meta")), strict=True)}


def _probabilities(views: list[Logistic]):
    """id and each view's probability."""
    schema = pa.schema([("id", pa.int64()), ("p_text", pa.float64()), ("p_meta", pa.float64())])
    folded = [v.folded() for v in views]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                t, m = _both(folded, *batch.columns[1:])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(t)), pa.array(sigmoid(m))], schema=schema)

    return run


def _both(folded: list, text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Calibrated logits of the text and the metadata view."""
    (w, b), (v, c) = folded
    t = np.array([text_features(x.as_py()) @ w + b for x in text])
    return t, meta_features(lang.to_pylist(), source.to_pylist(), n_chars.to_pylist()) @ v + c


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED, pseudo: int = PSEUDO, rounds: int = ROUNDS) -> CoTrained | None:
    """Co-train on at most `labelled` labelled documents, chosen by hash of id, and on pseudo-labels.

    After each round but the last every unlabelled document is scored by both views. Of those that
    a view is sure of, at most `pseudo` (half of each class), chosen by hash of id, become training
    rows of the other view.

    A document labelled more than once counts with the majority, ties as good. Null labels and ids
    are no labels. Without eight labelled documents of both classes there is no classifier (None).
    """
    base = _columns(docs, id_col, text_col)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("y"))
    present = base.where("id is not null").select("id").distinct()
    chosen = {r.id: r.y for r in hash_sample(known.join(present, "id", "left_semi"), labelled, "quality", "id").toLocalIterator()}
    rows = _features(base, list(chosen))
    ids = [i for i in chosen if i in rows]
    y = np.array([chosen[i] for i in ids])
    if len(ids) < 8 or len(set(y.tolist())) < 2:
        return None

    def exchange(views: list[Logistic], k: int) -> list[dict[int, tuple[float, np.ndarray]]]:
        scored = base.where("id is not null").mapInArrow(_probabilities(views), "id long, p_text double, p_meta double")
        free = materialize(scored.join(known.select("id"), "id", "left_anti"), "scores")
        picks = []
        for view, p in enumerate(("p_meta", "p_text")):  # the text view learns from the metadata view, and the other way round
            for label, sure in ((1.0, F.col(p) >= CONFIDENT), (0.0, F.col(p) <= 1 - CONFIDENT)):
                picks.append(free.where(sure).orderBy(F.xxhash64(F.lit(k), "id"), "id").limit(pseudo // 2).select("id", F.lit(view).alias("view"), F.lit(label).alias("label")))
        picked = reduce(DataFrame.union, picks).collect()
        found = _features(base, sorted({r.id for r in picked}))
        return [{r.id: (r.label, found[r.id][view]) for r in picked if r.view == view} for view in (0, 1)]

    return CoTrained(np.stack([rows[i][0] for i in ids]), np.stack([rows[i][1] for i in ids]), y, exchange, rounds)


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))


def _scorer(model: CoTrained | None, schema: pa.Schema):
    """The batch's columns but the last four (the views' input), and the results."""
    folded = [model.text.folded(), model.meta.folded()] if model else []

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            own, seen = batch.columns[:-4], batch.columns[-4:]
            if model is None:
                p_text = p_meta = score = np.full(n, 0.5)
                keep = np.ones(n, bool)
            else:
                t, m = _both(folded, *seen) if n else (np.zeros(0), np.zeros(0))
                p_text, p_meta, score = sigmoid(t), sigmoid(m), sigmoid(model.combine(t, m))
                keep = score >= THRESHOLD
            yield pa.RecordBatch.from_arrays([*own, pa.array(p_text), pa.array(p_meta), pa.array(score), pa.array(keep)], schema=schema)

    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_columns: tuple[str, ...] | None = None, labelled: int = LABELLED, pseudo: int = PSEUDO, rounds: int = ROUNDS) -> DataFrame:
    """Every row of docs with p_text, p_meta, quality_score and keep.

    docs has lang, source and n_chars besides id and text; keep_columns (default: all) are
    returned. p_text and p_meta are the calibrated views, quality_score joins them, keep says it
    is at least THRESHOLD. Null and empty texts score with the text view's bias; null metadata is
    a class of its own. Without labels of both kinds all is kept at 0.5. Ids are numbers. Columns
    named like the results are replaced, all others stay as they are. Repeated rows each return.
    No rows in, no rows out. `labelled`, `pseudo` and `rounds` are fit()'s bounds.
    """
    small_batches(docs.sparkSession)
    made = ("p_text", "p_meta", "quality_score", "keep")
    own = [c for c in (keep_columns or docs.columns) if c not in made]
    model = fit(docs, labels, id_col=id_col, text_col=text_col, labelled=labelled, pseudo=pseudo, rounds=rounds)
    seen = (F.col(f"`{text_col}`"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("long"))
    used = docs.select(*(F.col(f"`{c}`") for c in own), *(c.alias(fresh(docs, f"view{i}")) for i, c in enumerate(seen)))
    fields = StructType([docs.schema[c] for c in own])
    for c in made[:3]:
        fields.add(c, DoubleType())
    fields.add("keep", BooleanType())
    return used.mapInArrow(_scorer(model, to_arrow_schema(fields)), fields)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, p_text, p_meta, quality_score, keep of every document."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_quality(docs, labels, keep_columns=("doc_id",))
