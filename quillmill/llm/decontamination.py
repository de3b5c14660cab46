"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed, a run of MATCH words, are tiled: the longest common run of unmarked words is marked in both, again and
again, until none of MATCH words is left. Common runs are found by running Karp-Rabin: hashes of MATCH-word windows, joined by
value and grown along diagonals. The share of the item's words under tiles doesn't depend on the order of its passages.

The benchmark is a stated query set. It is taken in blocks of at most BLOCK_WORDS words, each a broadcast of that bounded size and one pass over the documents;
documents are never moved, whatever they share.

Defined cases: words are runs of ASCII letters, digits and non-ASCII characters, without regard to A-Z's case. A null or empty text has none. An item of fewer than MATCH words, or null,
can't be told from chance and never matches. Repeated documents or items each have their own rows. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmill.llm.common import only, slices, word_hashes

MATCH = 5
BLOCK_WORDS = 2_000_000
#: Bytes of words: digits, letters, and all of other characters.
_IN_WORD = np.zeros(256, np.uint8)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22


def words(text: str | None) -> np.ndarray:
    return word_hashes(text, in_word=_IN_WORD)


def windows(w: np.ndarray) -> np.ndarray:
    """The rolling hash of each MATCH-word window."""
    n = len(w) - MATCH + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(MATCH if n > 0 else 0):
        out = out * _ODD + w[k : n + k]
    return out


def tiles(doc: np.ndarray, item: np.ndarray, at_doc: np.ndarray, at_item: np.ndarray) -> list[tuple[int, int, int]]:
    """(start in the document, start in the item, words) of the tiles, given all places where windows of the two are equal."""
    out = []
    order = np.lexsort((at_doc, at_item - at_doc))
    p, q = at_doc[order].astype(np.int64), at_item[order].astype(np.int64)
    while len(p):
        new = np.ones(len(p), bool)
        new[1:] = (np.diff(p) != 1) | (np.diff(q) != 1)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(p)))
        best = first[length == length.max()]
        k = best[np.lexsort((q[best], p[best]))[0]]  # of equal length the first in the document
        size = int(length.max()) + MATCH - 1
        a, b = int(p[k]), int(q[k])
        out.append((a, b, size))
        free = ((p + MATCH <= a) | (p >= a + size)) & ((q + MATCH <= b) | (q >= b + size))
        p, q = p[free], q[free]
    return out


class Items:
    """A block of the benchmark, ready to be probed."""

    def __init__(self, ids: list[int], texts: list[str]):
        own = [(i, w) for i, w in zip(ids, map(words, texts), strict=True) if len(w) >= MATCH]
        self.ids, self.words = [i for i, _ in own], [w for _, w in own]
        all_windows = [windows(w) for w in self.words]
        seeds = np.concatenate(all_windows) if own else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(own)), [len(x) for x in all_windows])
        place = np.concatenate([np.arange(len(x)) for x in all_windows]) if own else item
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place = seeds[order], item[order].astype(np.int32), place[order].astype(np.int32)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._low(self.seeds)] = True

    @staticmethod
    def _low(h: np.ndarray) -> np.ndarray:
        return h >> np.uint64(64 - _FILTER_BITS)

    def found(self, text: str | None, threshold: float) -> Iterator[tuple]:
        """(item id, item words, covered words, tiles, first word, last word) of each item of which the text covers the threshold."""
        w = words(text)
        own = windows(w)
        at = np.flatnonzero(self.filter[self._low(own)])
        if not len(at):
            return
        lo, hi = np.searchsorted(self.seeds, own[at], "left"), np.searchsorted(self.seeds, own[at], "right")
        at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        if not len(at):
            return
        # tiles can't cover more words than an item's matched windows hold: most items go by a count, before any match is written out
        runs = np.unique(np.stack([lo, n]), axis=1)
        each = np.repeat(runs[0], runs[1]) + np.arange(runs[1].sum()) - np.repeat(np.cumsum(runs[1]) - runs[1], runs[1])
        hopeful = np.bincount(self.item[each], minlength=len(self.ids)) * MATCH >= threshold * self.sizes
        if not hopeful.any():
            return
        wanted = np.zeros(len(self.seeds) + 1, np.int64)
        wanted[1 + each[hopeful[self.item[each]]]] = 1
        upto = np.cumsum(wanted)
        some = upto[lo + n] > upto[lo]
        at, lo, n = at[some], lo[some], n[some]
        p = np.repeat(at, n)
        k = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p, k = p[wanted[k + 1] > 0], k[wanted[k + 1] > 0]
        order = np.argsort(self.item[k], kind="stable")
        p, k = p[order], k[order]
        for i in np.split(np.arange(len(k)), np.flatnonzero(np.diff(self.item[k])) + 1):
            item = int(self.item[k[i[0]]])
            ref = self.words[item]
            t = tiles(w, ref, p[i], self.place[k[i]])
            covered = sum(size for _, _, size in t)
            if covered >= threshold * len(ref):
                yield self.ids[item], len(ref), covered, len(t), min(a for a, _, _ in t), max(a + size for a, _, size in t) - 1


def blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    ids: list[int] = []
    texts: list[str] = []
    size = 0
    for r in only(benchmark, item_col, text_col).toDF("id", "text").filter("text IS NOT NULL").toLocalIterator():
        n = len(r["text"]) // 2 + 1  # words at most
        if ids and size + n > BLOCK_WORDS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r["id"])
        texts.append(r["text"])
        size += n
    if ids:
        yield Items(ids, texts)


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs, all columns, less the rows whose text covers the threshold of an item's words. Each row is judged by itself, in place, so ids may be null or shared."""
    at, out = docs.columns.index(text_col), docs
    for block in blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield batch.filter(pa.array([next(shared.value.found(t, threshold), None) is None for t in batch.column(at).to_pylist()], pa.bool_()))

        out = out.mapInArrow(clean, docs.schema)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and item of whose words the document covers the threshold: id, item id, coverage, n_tiles, first_word and last_word (of the tiles in the document, words from 0)."""
    spark = docs.sparkSession
    schema = pa.schema([(id_col, pa.int64()), (item_col, pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())])
    ddl = f"`{id_col}` long, `{item_col}` long, coverage double, n_tiles long, first_word long, last_word long"
    source, out = only(docs, id_col, text_col), None
    for block in blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(block)

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                rows = [
                    (doc, item, covered / n, k, first, last)
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for item, n, covered, k, first, last in shared.value.found(text, threshold)
                ]
                yield pa.RecordBatch.from_pydict({name: [r[j] for r in rows] for j, name in enumerate(schema.names)}, schema=schema)

        part = source.mapInArrow(probe, ddl)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], ddl) if out is None else out
