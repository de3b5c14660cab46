"""Lines that many documents hold are dropped from all of them but one.

Two Bloom filters over the hashes of line keys, one of keys seen in a document and one of keys seen in a second, are filled by each task
for its part of the corpus and merged segment by segment, as a tree. Only keys in the second filter, suspected repeats, are shuffled: there exact
128-bit digests are counted by document and the one document that keeps the line is chosen. The filters have a fixed largest size; a corpus
that fills them, which 16 bits a line do from some 17 million lines on, only has more suspects to count, never another result.

Defined cases: a null or empty text is one empty line. Rows of one id are one document when holders are counted. A null id counts as one
document, the smallest. Lines whose key is short always stay. Very long texts are split whole. An empty table gives an empty result. ids must be integers. Columns besides the
named ones are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, only, slices

SEGMENTS = 64
FAN, MERGES = 64, 3
PROBES = 3
MAX_BITS = 1 << 28
NO_ID = -(1 << 63)
_STRIP = b" \t\n\x0b\x0c\r"


def line_digests(text: str | None, min_chars: int) -> list[bytes | None]:
    """For each line the 128-bit digest of its key, or None if the key is too short to count."""
    out: list[bytes | None] = []
    for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"):  # bytes.lower is A-Z only
        key = line.strip(_STRIP)
        long = len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def _bits(digests: list[bytes], m: int) -> np.ndarray:
    """PROBES bit positions for each digest."""
    h = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    k = np.arange(PROBES, dtype=np.uint64)
    return (h[:, :1] + k * (h[:, 1:] | np.uint64(1))) & np.uint64(m - 1)


def _has(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _add(filter_: np.ndarray, at: np.ndarray) -> None:
    at = at.ravel()
    np.bitwise_or.at(filter_, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def _fill(m: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        once, twice = np.zeros(m // 8, np.uint8), np.zeros(m // 8, np.uint8)
        for batch in slices(batches, 2048):
            seen: dict[bytes, int] = {}
            for text in batch.column(0).to_pylist():
                for d in set(line_digests(text, min_chars)):
                    if d:
                        seen[d] = seen.get(d, 0) + 1
            if seen:
                at, many = _bits(list(seen), m), np.fromiter(seen.values(), np.int64, len(seen)) > 1
                _add(twice, at[many | _has(once, at)])
                _add(once, at)
        size, salt = m // 8 // SEGMENTS, TaskContext.get().partitionId()
        for s in range(SEGMENTS):
            a, b = once[s * size : (s + 1) * size], twice[s * size : (s + 1) * size]
            if a.any():
                yield pa.RecordBatch.from_pydict({"segment": [s], "salt": [salt], "once": [zlib.compress(a, 1)], "twice": [zlib.compress(b, 1)]}, schema=pa.schema([("segment", pa.int32()), ("salt", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())]))

    return run


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    once = twice = None
    for a, b in zip(group["once"], group["twice"], strict=True):
        a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
        once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
    return pd.DataFrame({"segment": group["segment"][:1], "salt": group["salt"][:1], "once": [zlib.compress(once, 1)], "twice": [zlib.compress(twice, 1)]})


def twice_seen(docs: DataFrame, text_col: str, min_chars: int) -> tuple[np.ndarray, int]:
    """The filter of keys seen twice, and its number of bits: 16 for each line, a power of two, MAX_BITS at most (32 MB)."""
    texts = only(docs, text_col).toDF("text")
    lines = texts.agg(F.sum(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)).first()[0] or 0
    m = min(MAX_BITS, max(1 << 16, 1 << (16 * lines).bit_length()))
    schema = "segment int, salt int, once binary, twice binary"
    parts = texts.mapInArrow(_fill(m, min_chars), schema)
    for _ in range(MERGES):  # a tree: a group holds a segment of FAN parts at most, up to FAN ** MERGES tasks
        parts = parts.withColumn("salt", F.expr(f"salt div {FAN}").cast("int")).groupBy("segment", "salt").applyInPandas(_merge, schema)
    (once, twice), size = np.zeros((2, m // 8), np.uint8), m // 8 // SEGMENTS
    for row in parts.select("segment", "once", "twice").toLocalIterator():
        at = slice(row["segment"] * size, (row["segment"] + 1) * size)
        a, b = (np.frombuffer(zlib.decompress(row[k]), np.uint8) for k in ("once", "twice"))
        twice[at] |= b | (once[at] & a)
        once[at] |= a
    return twice, m


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, keep_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_lines, n_dropped, kept_sha256 and, if keep_text, the text that stays.

    A key (the line stripped of ASCII white space, A-Z lower-cased) of at least min_chars code points in at least min_docs documents keeps its lines in the
    largest of their ids only.
    """
    spark = docs.sparkSession
    bits, m = twice_seen(docs, text_col, min_chars)
    shared = spark.sparkContext.broadcast(bits)
    schema = pa.schema([("id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("sha", pa.string()), ("suspects", pa.list_(pa.binary()))])

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            digests = [line_digests(t, min_chars) for t in texts]
            distinct = list({d for row in digests for d in row if d})
            found = {d for d, hit in zip(distinct, _has(shared.value, _bits(distinct, m)), strict=True) if hit} if distinct else set()
            rows = [sorted({d for d in row if d in found}) for row in digests]
            sha = [None if s else hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).hexdigest() for s, t in zip(rows, texts, strict=True)]
            kept = [t if keep_text or s else None for s, t in zip(rows, texts, strict=True)]
            yield pa.RecordBatch.from_pydict({"id": ids, "text": kept, "n_lines": [len(r) for r in digests], "sha": sha, "suspects": rows}, schema=schema)

    source = only(docs, id_col, text_col).toDF("id", "text").withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    marked = materialize(source.mapInArrow(suspect, "id long, text string, n_lines long, sha string, suspects array<binary>"), "line-dedup")
    pairs = marked.select("id", F.explode("suspects").alias("key")).distinct()
    repeated = pairs.groupBy("key").agg(F.count("*").alias("holders"), F.max("id").alias("keeper")).filter(F.col("holders") >= min_docs).drop("holders")
    drops = pairs.join(repeated, "key").filter("id <> keeper").groupBy("id").agg(F.collect_list("key").alias("drops"))
    out_schema = f"`{id_col}` long, n_lines long, n_dropped long, kept_sha256 string" + ", text string" * keep_text
    arrow = pa.schema([(id_col, pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())] + [("text", pa.string())] * keep_text)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for r in batch.to_pylist():
                text, dropped, sha = r["text"], 0, r["sha"]
                if sha is None:
                    gone = set(r["drops"] or ())
                    lines = (text or "").split("\n")
                    left = [x for x, d in zip(lines, line_digests(text, min_chars), strict=True) if d not in gone]
                    dropped, text = len(lines) - len(left), "\n".join(left)
                    sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append({id_col: None if r["id"] == NO_ID else r["id"], "n_lines": r["n_lines"], "n_dropped": dropped, "kept_sha256": sha, "text": text or ""})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return marked.drop("suspects").join(drops, "id", "left").mapInArrow(finish, out_schema)
