"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of three letters is bound into one vector: the product of its letters' vectors, the first
permuted (rotated) twice, the second once. A text's profile is the bundle, the sum, of its runs' vectors; a language's prototype is the normalised sum of the normalised
profiles of its learning documents. The language of a text is the prototype of largest cosine.

Defined cases: the prediction of a null text or one without a letter is `und`, score 0; so is every prediction if there is nothing to learn from. Languages of
equal cosine: the first by name. A null doc_id is never held out and never learned from. Repeated rows each have their own result. Very long texts are profiled whole, in pieces that
overlap. An empty table gives an empty result. ids must be integers. Columns besides the named ones are ignored, and kept by keep_known.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import only, slices

DIM = 512
GRAM = 3
_SEED = 20_11
#: Letters from which on a text's cosine tells whether it is in a learned language; the floor of that cosine, as a share of what all learning documents but a tail reach.
LONG, FLOOR_SHARE, FLOOR_TAIL = 100, 0.4, 0.005
#: Steps from 0 to 1 by which cosines are counted to find that floor.
_STEPS = 10_000
_CHUNK_CHARS, _CHUNK_DOCS, _TILE = 1 << 20, 256, 1 << 13


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Code point -> 0 if no letter, else its symbol: a-z and the Latin letters have their own, other letters share 37."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = c - 96 if 97 <= c <= 122 else 27 + c - 0xC0 if 0xC0 <= c < 0x180 else 219 + c % 37
    return out


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """[place in the run, symbol, dimension]: the symbols' vectors, permuted by place."""
    base = np.random.default_rng(_SEED).integers(0, 2, (256, DIM), np.int8) * 2 - 1
    return np.stack([np.roll(base, GRAM - 1 - k, axis=1) for k in range(GRAM)]).astype(np.float32)


_CACHES = (_symbols, _letters)


def _bundle(texts: list[str]) -> np.ndarray:
    symbols, letters = _symbols(), _letters()
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    raw = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    s, doc = symbols[raw], np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0) | (doc[1:] != doc[:-1])  # a gap of any length is one space, in each text
    s, doc = s[keep].astype(np.int32), doc[keep]
    present = np.flatnonzero(np.bincount(s, minlength=1))  # symbols are numbered among those that occur, so that runs have few possible codes
    rank, k = np.zeros(256, np.int32), len(present)
    rank[present] = np.arange(k)
    s, letter = rank[s], s != 0
    code = (s[:-2] * k + s[1:-1]) * k + s[2:]
    inside = (doc[:-2] == doc[2:]) & letter[1:-1]
    code, doc = code[inside], doc[:-2][inside]
    seen, place = np.zeros(k**3, bool), np.zeros(k**3, np.int32)
    seen[code] = True
    used = np.flatnonzero(seen)
    place[used] = np.arange(len(used))
    run, out = place[code], np.zeros((len(texts), DIM), np.float32)
    for low in range(0, len(used), _TILE):  # distinct runs by the tile, so that texts of very many need no more memory
        own, inside = used[low : low + _TILE], slice(None) if len(used) <= _TILE else (run >= low) & (run < low + _TILE)
        count = np.bincount(doc[inside].astype(np.int64) * len(own) + (run[inside] - low), minlength=len(texts) * len(own))
        first, second, third = (present[own // k ** (2 - n) % k] for n in range(GRAM))
        out += count.reshape(len(texts), len(own)).astype(np.float32) @ (letters[0][first] * letters[1][second] * letters[2][third])
    return out


def profiles(texts: list[str | None]) -> np.ndarray:
    """The texts' profiles, of length 1, or 0 for a text without runs of letters."""
    out, i = np.zeros((len(texts), DIM), np.float32), 0
    lower = [f" {(t or '').lower()} " for t in texts]
    while i < len(lower):
        j, size = i, 0
        while j < len(lower) and j - i < _CHUNK_DOCS and (j == i or size + len(lower[j]) <= _CHUNK_CHARS):
            size += len(lower[j])
            j += 1
        out[i:j] = _bundle(lower[i:j]) if size <= 8 * _CHUNK_CHARS else _long(lower[i])
        i = j
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def _long(text: str) -> np.ndarray:
    """A very long text in pieces, which overlap so that no run is lost."""
    step = _CHUNK_CHARS
    return sum(_bundle([text[max(0, i - 2) : i + step]]).astype(np.float64) for i in range(0, len(text), step)).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, per_language: int | None, id_col: str, text_col: str, lang_col: str) -> DataFrame | None:
    """(lang, text) of the learning documents, all of them if per_language is None; None if there are none."""
    own = only(docs, id_col, lang_col, text_col).toDF("id", "lang", "text").filter("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("id")))
    if per_language is None:
        return own.select("lang", "text")
    sizes = {r["lang"]: r["count"] for r in own.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return None
    share = own.sparkSession.createDataFrame([(k, min(1.0, per_language / n)) for k, n in sizes.items()], "lang string, share double")
    return own.join(F.broadcast(share), "lang").filter(F.pmod(F.xxhash64("id", F.lit(_SEED)), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("lang", "text")


def learn(docs: DataFrame, per_language: int | None = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes, from a sample of about per_language labelled documents of each language, chosen by a hash of the id; from all of them if per_language is None."""
    sample = _sample(docs, per_language, id_col, text_col, lang_col)
    if sample is None:
        return [], np.zeros((0, DIM))
    schema = pa.schema([("lang", pa.string()), ("total", pa.binary())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, caches=_CACHES):
            names, vectors = np.array(batch.column(0).to_pylist(), object), profiles(batch.column(1).to_pylist())
            for k in set(names):
                total[k] = total.get(k, 0) + vectors[names == k].sum(axis=0, dtype=np.float64)
        yield pa.RecordBatch.from_pydict({"lang": list(total), "total": [v.tobytes() for v in total.values()]}, schema=schema)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": group["lang"][:1], "total": [sum(np.frombuffer(b) for b in group["total"]).tobytes()]})

    rows = sorted(sample.mapInArrow(sums, "lang string, total binary").groupBy("lang").applyInPandas(add, "lang string, total binary").collect())
    names, out = [r["lang"] for r in rows], np.array([np.frombuffer(r["total"]) for r in rows]).reshape(-1, DIM)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
    return names, out


def predict(docs: DataFrame, names: list[str], prototypes: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score (the cosine, not below 0) and margin to the second language."""
    schema = pa.schema([(id_col, pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, caches=_CACHES):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            vectors = profiles(texts)
            some = np.fromiter((bool(names) and any(map(str.isalpha, t or "")) for t in texts), bool, len(texts))
            cos = vectors @ prototypes.T if names else np.zeros((len(texts), 1))
            best, top = cos.argmax(axis=1), np.sort(cos, axis=1)
            score = np.where(some, np.clip(top[:, -1], 0, 1), 0.0)
            margin = np.where(some, top[:, -1] - top[:, -2] if cos.shape[1] > 1 else score, 0.0)
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array([names[b] if s else "und" for b, s in zip(best, some, strict=True)], pa.string()), pa.array(score), pa.array(margin)], schema=schema)

    out = only(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, lang_pred string, score double, margin double")
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score", "margin")


def identify(docs: DataFrame, per_language: int = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return predict(docs, *learn(docs, per_language, id_col, text_col, lang_col), id_col, text_col)


def least_score(docs: DataFrame, names: list[str], prototypes: np.ndarray, per_language: int | None = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> float:
    """The cosine under which a text of LONG letters is in none of the languages: FLOOR_SHARE of what all but FLOOR_TAIL of the learning documents of that length reach, in whole steps; 0 without such.

    Cosines are counted by steps, every one of them, so neither the order nor the partitions of the rows change the result."""
    sample = _sample(docs, per_language, id_col, text_col, lang_col)
    if sample is None or not names:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(_STEPS + 1, np.int64)
        for batch in slices(batches, caches=_CACHES):
            texts = [t for t in batch.column(0).to_pylist() if _is_long(t)]
            if texts:
                score = (profiles(texts) @ prototypes.T).max(axis=1)
                n += np.bincount((np.clip(score, 0, 1) * _STEPS).astype(np.int64), minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"step": pa.array(at, pa.int64()), "n": pa.array(n[at], pa.int64())})

    counts = sorted(sample.select("text").mapInArrow(run, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect())  # a row for each step at most
    upto = np.cumsum([r["n"] for r in counts])
    return FLOOR_SHARE * counts[int(np.searchsorted(upto, FLOOR_TAIL * upto[-1], "right"))]["step"] / _STEPS if counts else 0.0


def _is_long(text: str) -> bool:
    return np.count_nonzero(_symbols()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]) >= LONG


def keep_known(docs: DataFrame, names: list[str], prototypes: np.ndarray, least: float = 0.0, text_col: str = "text") -> DataFrame:
    """docs, all columns, less the rows without a letter and the texts of LONG letters or more whose best cosine is under `least`. Each row is judged by itself, in place; shorter texts hold too few runs to tell."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, caches=_CACHES):
            texts = batch.column(at).to_pylist()
            score = (profiles(texts) @ prototypes.T).max(axis=1) if names and texts else np.zeros(len(texts))
            yield batch.filter(pa.array([bool(names) and any(map(str.isalpha, t or "")) and (x >= least or not _is_long(t)) for t, x in zip(texts, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
