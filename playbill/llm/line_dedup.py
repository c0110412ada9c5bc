"""Line dedup: lines whose normalised form is in many documents lose all their occurrences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.common import small_batches

#: Hashes of frequent lines sent to every task: 16 bytes each, so at most 32 MB. Beyond it they are joined.
BROADCAST_LINES = 2_000_000
SPACE = b" \t\n\x0b\x0c\r"


def line_keys(text: str | None) -> list[bytes]:
    """The keys of a text's lines: stripped of ASCII white space, A-Z lower-cased, UTF-8."""
    return [x.strip(SPACE) for x in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "surrogatepass")) >= min_chars)


def _hashes(texts: pa.Array, min_chars: int):
    """For each text its line hashes as an (n, 2) array of int64, zero rows for keys that are too short."""
    digest = xxhash.xxh3_128_digest
    for text in texts:
        keys = line_keys(text.as_py())
        raw = b"".join(digest(k) if _long_enough(k, min_chars) else bytes(16) for k in keys)
        yield np.frombuffer(raw, np.int64).reshape(-1, 2)


def _document_lines(min_chars: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = [np.unique(h, axis=0) if len(h) > 1 else h for h in _hashes(batch.column(1), min_chars)]
            docs = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in rows])
            if rows:
                h = np.concatenate(rows)
                keep = h.any(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(h[keep, 0]), pa.array(h[keep, 1]), pa.array(docs[keep])], schema=schema)

    return run


def frequent_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """128-bit hashes (h1, h2) of the line keys that are in at least min_docs distinct documents."""
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc"), F.col(text_col).alias("text"))
    lines = ids.mapInArrow(_document_lines(min_chars), "h1 long, h2 long, doc long")
    return lines.groupBy("h1", "h2").agg(F.countDistinct("doc").alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")


def _joined(lines: list[str], drop: np.ndarray) -> str:
    return "\n".join(x for x, gone in zip(lines, drop.tolist(), strict=True) if not gone)


def _filter(min_chars: int, text_at: int, schema: pa.Schema, known: np.ndarray | None, names: tuple[str, str, str], drop_name: str):
    """known: frequent hashes; else the batch carries each row's own frequent hashes in drop_name."""

    def members(h: np.ndarray, own) -> np.ndarray:
        among = known if known is not None else np.array(sorted({(x["h1"], x["h2"]) for x in own or ()}), np.int64).reshape(-1, 2).view(PAIR).ravel()
        return np.isin(np.ascontiguousarray(h).view(PAIR).ravel(), among) & h.any(axis=1) if len(among) else np.zeros(len(h), bool)

    def run(batches):
        for batch in batches:
            texts = batch.column(text_at)
            own = batch.column(batch.schema.get_field_index(drop_name)).to_pylist() if known is None else [None] * len(texts)
            hs = list(_hashes(texts, min_chars))
            if known is not None and hs:  # one look-up for the whole batch
                all_gone = members(np.concatenate(hs), None)
                gone = np.split(all_gone, np.cumsum([len(h) for h in hs])[:-1])
            else:
                gone = [members(h, o) for h, o in zip(hs, own, strict=True)]
            kept = [_joined((t.as_py() or "").split("\n"), g) if g.any() else (t.as_py() or "") for t, g in zip(texts, gone, strict=True)]
            columns = [batch.column(batch.schema.get_field_index(f.name)) if f.name in batch.schema.names else None for f in schema]
            made = dict(zip(names, (pa.array(kept, pa.string()), pa.array([len(g) for g in gone], pa.int64()), pa.array([int(g.sum()) for g in gone], pa.int64())), strict=True))
            yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else c for f, c in zip(schema, columns, strict=True)], schema=schema)

    return run


PAIR = np.dtype([("h1", np.int64), ("h2", np.int64)])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, min_docs: int = 10, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """Drop every line whose key is in at least min_docs documents; adds n_lines, n_dropped.

    All input columns stay, text_col holding the kept lines joined by newlines. Lines end at
    newlines only; a null or empty text is one empty line and comes back empty. Keys shorter
    than min_chars code points are never dropped. Rows that share an id are one document when
    documents are counted (null ids together), but each row is returned. Columns already named
    n_lines or n_dropped are replaced. No rows in, no rows out.

    Only 24 bytes a distinct line leave a task; documents are counted in two steps, so a line of
    a third of all documents is no hot task. The frequent hashes go to all tasks if they are
    few (checked); otherwise each document's own are joined to it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(docs.sparkSession)
    # names of our own that no column of docs begins with
    mark = "_" * (1 + max(len(c) - len(c.lstrip("_")) for c in docs.columns))
    kept_name, lines_name, dropped_name, doc_name, drop_name = (mark + x for x in ("kept", "n_lines", "n_dropped", "doc", "drop"))
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    base = docs.select(*(F.col(f"`{c}`") for c in rest))
    frequent = frequent_lines(base, id_col, text_col, min_chars, min_docs)
    found = frequent.limit(broadcast_lines + 1).toArrow()
    outer = base.drop(text_col)
    from pyspark.sql.types import LongType, StringType, StructType

    fields = StructType([*outer.schema.fields]).add(kept_name, StringType()).add(lines_name, LongType()).add(dropped_name, LongType())
    schema = to_arrow_schema(fields)
    if found.num_rows <= broadcast_lines:
        pairs = np.empty(found.num_rows, PAIR)
        pairs["h1"], pairs["h2"] = found["h1"].to_numpy(), found["h2"].to_numpy()
        source = base
        known = pairs
    else:
        ids = base.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc"), F.col(text_col).alias("text"))
        lines = ids.mapInArrow(_document_lines(min_chars), "h1 long, h2 long, doc long")
        drops = lines.join(frequent, ["h1", "h2"]).groupBy("doc").agg(F.collect_set(F.struct("h1", "h2")).alias(drop_name))
        source = base.withColumn(doc_name, F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))).join(drops.withColumnRenamed("doc", doc_name), doc_name, "left").select(*(F.col(f"`{c}`") for c in base.columns), drop_name)
        known = None
    text_at = source.columns.index(text_col)
    done = source.mapInArrow(_filter(min_chars, text_at, schema, known, (kept_name, lines_name, dropped_name), drop_name), fields)
    named = [F.col(kept_name).alias(c) if c == text_col else F.col(f"`{c}`") for c in rest]
    return done.select(*named, F.col(lines_name).alias("n_lines"), F.col(dropped_name).alias("n_dropped"))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    kept = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
with lines as (
  select doc_id, rowid_, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, rowid_, unnest(parts) as line, generate_subscripts(parts, 1) as pos
        from (select doc_id, row_number() over () as rowid_, string_split(coalesce(text, ''), chr(10)) as parts from documents))),
frequent as (select key from lines where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (where f.key is not null) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where f.key is null), '')) as kept_sha256
from lines left join frequent f using (key) group by rowid_, doc_id
"""
