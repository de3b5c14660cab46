"""Near-duplicate classes by DartMinHash.

A text is the multiset of its five-word runs; the j-th occurrence of a run is the region [j-1, j) of its weight. Darts fall on each region as a Poisson process in the
rank, drawn by hashing the region, so every text that covers a region sees the same darts. Those of rank below a bound that gives a fixed
expected number are thrown, whatever the text's length; each belongs to one coordinate, and the earliest of each coordinate is the
signature. Two signatures agree in a coordinate with the probability of the weighted Jaccard similarity.

Bands of the signature propose, exact similarity decides. Copies are first folded to one representative. In a band's bucket every member is compared with the
bucket's smallest member, so a bucket of n costs n comparisons. Where that leaves a bucket in several classes, those outside the smallest member's class are compared
with all members, block against block: a task holds two blocks of at most CHUNK texts, counts their common runs by matrix products, and returns only links that join
classes. No pair is ever a row. Classes are the connected components of the links.

Defined cases: a text without words, also a null one, is a class of its own. A text of one to four words is one run. Rows of one id and equal text are copies; a null id
counts as the smallest. Different texts of one id, or without ids, are compared and classed each by its own. Classes are named by their smallest id, so two may have one name. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, mix64, only, shingle_hashes, slices, word_hashes

WORDS = 5
CHUNK = 512
_TILE = 8192
BANDS, ROWS = 30, 7
NO_ID = -(1 << 63)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def regions(text: str | None, words: int = WORDS) -> np.ndarray:
    """The unit regions of a text's runs, distinct hashes: equal texts have equal arrays, and set operations on them are multiset operations on the runs."""
    runs = np.sort(shingle_hashes(word_hashes(text), words))
    if len(runs) < 2:
        return runs
    new = np.concatenate(([True], runs[1:] != runs[:-1]))
    at = np.arange(len(runs))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(nth > 0, mix64(runs + nth.astype(np.uint64) * _GOLD), runs)


def signature(items: np.ndarray, size: int) -> np.ndarray:
    """The earliest dart of each of `size` coordinates."""
    out = np.full(size, _NONE)
    if not len(items):
        return out
    bound = size * (math.log(size) + 2) / len(items)
    while True:
        here, rank, ids, ranks, r = items, np.zeros(len(items)), [], [], 0
        while len(here):
            dart = mix64(here + np.uint64((2 * r + 1) * int(_GOLD) % (1 << 64)))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            thrown = rank < bound
            here, rank, dart, r = here[thrown], rank[thrown], dart[thrown], r + 1
            ids.append(dart)
            ranks.append(rank)
        dart, rank = np.concatenate(ids), np.concatenate(ranks)
        dart = dart[np.argsort(rank, kind="stable")[::-1]]
        key = mix64(dart ^ _GOLD)
        out[(key % np.uint64(size)).astype(np.int64)] = key  # the last written is the earliest
        if (out != _NONE).all():
            return out
        bound *= 2  # a coordinate without a dart: look further, the earliest of the others stay


def _band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * _GOLD + rows[:, k])
    return key.view(np.int64)


def _digest(items: np.ndarray) -> tuple[int, int]:
    """128 bits of the whole multiset."""
    a = mix64(items ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mix64(items * np.uint64(0x14057B7EF767814F) + np.uint64(1)).sum(dtype=np.uint64)
    return tuple(int(x) for x in np.array([a, b + np.uint64(len(items))]).view(np.int64))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64()))])
    for batch in slices(batches):
        rows = []
        for doc, text, row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            items = regions(text)
            a, b = _digest(items)
            rows.append((doc, row, a, b, _band_keys(signature(items, BANDS * ROWS)) if len(items) else None))
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in schema.names}, schema=schema)


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("items", pa.list_(pa.int64()))])
    for batch in slices(batches, 64):
        items = [regions(t) for t in batch.column(0).to_pylist()]
        d = [_digest(x) for x in items]
        yield pa.RecordBatch.from_pydict({"d1": [x[0] for x in d], "d2": [x[1] for x in d], "items": [x.view(np.int64) for x in items]}, schema=schema)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): label is the smallest node of its connected component."""
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("low"))
        new = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        jump = labels.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        new = new.join(jump, F.col("label") == F.col("n2"), "left").select("node", "old", F.least("label", F.coalesce("l2", "label")).alias("label"))
        new = materialize(new, "labels")
        labels = new.select("node", "label")
        if new.filter("old <> label").isEmpty():
            return labels


def _similar(pairs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """pairs (a, b) with their exact similarity, tested or not against the threshold by `linked`."""
    left = items.select(F.col("id").alias("a"), F.col("items").alias("ia"))
    right = items.select(F.col("id").alias("b"), F.col("items").alias("ib"))
    both = pairs.join(right, "b").join(left, "a").withColumn("common", F.size(F.array_intersect("ia", "ib")))
    both = both.select("a", "b", (F.col("common") / (F.size("ia") + F.size("ib") - F.col("common"))).alias("similarity"))
    return both.withColumn("linked", F.col("similarity") >= F.lit(threshold - 1e-12))


def _items_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The regions of the wanted (rep, low, d1, d2), computed again from their texts. Those without an id are all read: one key would hold them all."""
    texts = docs.filter(F.col("id") != NO_ID).join(wanted.select(F.col("low").alias("id")).distinct(), "id", "left_semi")
    texts = texts.select("text").union(docs.filter(F.col("id") == NO_ID).select("text"))
    found = texts.mapInArrow(_regions, "d1 long, d2 long, items array<long>").dropDuplicates(["d1", "d2"])
    return found.join(wanted, ["d1", "d2"]).select(F.col("rep").alias("id"), "items")


def _blocks(threshold: float):
    """For two blocks of texts: links between them that join classes not joined yet."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        side, reps, label = (group.column(c).to_numpy() for c in ("side", "rep", "label"))
        column = group.column("items").combine_chunks()
        flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
        size = np.diff(ends)
        _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
        shared = times[code] > 1
        _, code = np.unique(code[shared], return_inverse=True)
        row = np.repeat(np.arange(len(reps)), size)[shared]
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        common = np.zeros((len(a), len(b)), np.float32)
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        for low in range(0, int(code[-1]) + 1 if len(code) else 0, _TILE):
            k = slice(*np.searchsorted(code, (low, low + _TILE)))
            held = np.zeros((len(reps), _TILE), np.float32)
            held[row[k], code[k] - low] = 1
            common += held[a] @ held[b].T
        similar = common >= (threshold - 1e-9) * (size[a][:, None] + size[b][None, :] - common)
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x]
            return x

        links = []
        for i, j in zip(*np.nonzero(similar & (label[a][:, None] != label[b][None, :])), strict=True):
            x, y = top(int(label[a[i]])), top(int(label[b[j]]))
            if x != y:
                up[max(x, y)] = min(x, y)
                links.append((int(reps[a[i]]), int(reps[b[j]])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, class_id (the smallest id of its class) and kept (whether it is that one)."""
    own = only(docs, id_col, text_col).toDF("id", "text").withColumn("row", F.lit(0).cast("long"))
    signed, by_text = _classed(own, threshold)
    lowest = by_text.groupBy("class").agg(F.min("low").alias("lowest"))
    out = signed.filter("bands IS NOT NULL").select("id", "d1", "d2").join(by_text.join(lowest, "class").select("d1", "d2", F.col("lowest").alias("class")), ["d1", "d2"]).select("id", "class")
    out = out.union(signed.filter("bands IS NULL").select("id", F.col("id").alias("class")))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(real("id").alias(id_col), real("class").alias("class_id"), (F.col("id") == F.col("class")).alias("kept"))


def copies(docs: DataFrame, row_col: str, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_col of all rows but one of each class: that of the smallest id stays (one without an id only if none has one), and of equal ids that of the smallest row_col, a unique long."""
    signed, by_text = _classed(only(docs, id_col, text_col, row_col).toDF("id", "text", "row"), threshold)
    rows = signed.filter("bands IS NOT NULL").join(by_text.select("d1", "d2", "class"), ["d1", "d2"]).select("class", "row", F.struct(F.col("id") == NO_ID, "id", "row").alias("order"))
    stay = rows.groupBy("class").agg(F.min("order").alias("o")).select(F.col("o.row").alias("row"))
    return rows.select("row").join(stay, "row", "left_anti").withColumnRenamed("row", row_col)


def _classed(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The signatures of docs (id, text, row), and the class of each distinct text: d1, d2, low (its smallest id) and class, a number without meaning.

    Texts are told apart by their digests and numbered; ids only say where to find a text again.
    """
    own = docs.withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    signed = materialize(own.mapInArrow(_sign, "id long, row long, d1 long, d2 long, bands array<long>"), "signatures")
    some = signed.filter("bands IS NOT NULL")
    reps = some.groupBy("d1", "d2").agg(F.min("id").alias("low"), F.first("bands").alias("bands"))
    reps = materialize(reps.withColumn("rep", F.monotonically_increasing_id()), "texts")

    members = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("band", "key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    members = materialize(members.join(buckets, ["band", "key"]), "buckets")
    wanted = reps.select("rep", "low", "d1", "d2").join(members.select("rep").distinct(), "rep", "left_semi")
    items = materialize(_items_of(own, wanted), "regions")

    pairs = members.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    tested = materialize(_similar(pairs, items, threshold), "tested")
    links = tested.filter("linked").select("a", "b")
    labels = components(links)

    # buckets that hold members outside the class of their smallest member
    at_hub = labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label"))
    placed = members.join(labels, F.col("rep") == F.col("node"), "left").join(at_hub, "hub", "left")
    placed = placed.select("band", "key", "rep", F.coalesce("label", "rep").alias("label"), (F.coalesce("label", "rep") != F.coalesce("hub_label", "hub")).alias("outside"))
    placed = materialize(placed, "placed")
    sizes = placed.groupBy("band", "key").agg(F.count("*").alias("n"), F.sum(F.col("outside").cast("long")).alias("n_out")).filter("n_out > 0")
    chunks = lambda c: F.ceil(F.col(c) / F.lit(CHUNK)).cast("int")
    mixed = placed.join(sizes.select("band", "key", chunks("n").alias("all"), chunks("n_out").alias("outs")), ["band", "key"])
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    left = mixed.filter("outside").select("band", "key", "rep", "label", part("outs").alias("i"), F.explode(F.expr("sequence(0, all - 1)")).alias("j"), F.lit(0).alias("side"))
    right = mixed.select("band", "key", "rep", "label", F.explode(F.expr("sequence(0, outs - 1)")).alias("i"), part("all").alias("j"), F.lit(1).alias("side"))
    both = left.unionByName(right).join(items.withColumnRenamed("id", "rep"), "rep")
    more = both.groupBy("band", "key", "i", "j").applyInArrow(_blocks(threshold), "a long, b long").distinct()
    more = materialize(more, "more-links")
    if not more.isEmpty():
        labels = components(links.union(more).distinct())

    by_text = reps.select("d1", "d2", "low", "rep").join(labels, F.col("rep") == F.col("node"), "left")
    return signed, by_text.select("d1", "d2", "low", F.coalesce("label", "rep").alias("class"))
