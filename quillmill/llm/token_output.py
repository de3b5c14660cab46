"""Token ids of a corpus as binary files, written by the adaptive range coder and read back.

The texts are put in ascending order of id by range partitioning, so that each task writes one part of the output, of about equal size whatever one id holds. A part is a Parquet file of
segments. A segment holds whole documents: their ids, where their token ids start in it, how many they are, and the token ids themselves, coded in blocks that are
reset and checksummed on their own. The starts of parts are sums over a table of one row per part. Reading decodes each segment where it lies; nothing is shuffled but that table.

Layout of a segment: part, segment, start (ids before it in its part), n (its ids), doc_ids, starts, lengths, blocks (framed: number of ids, crc32 of the ids as little-endian
unsigned 32-bit integers, number of coded bytes, each as such an integer, and the coded bytes).

Defined cases: a null text is empty and gives the end id alone. A null doc_id comes before all others. Rows of one id are documents of their own, in the order of their texts.
An empty table writes no segments and reads back as an empty result. A damaged block raises an error that names it. A very long text makes a segment of its size. ids must be
integers. Columns besides the named ones are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm import id_coder
from quillmill.llm.common import only, slices
from quillmill.llm.tokens import Vocabulary

#: Ids after which a segment is closed.
SEGMENT_IDS = 1 << 20
END_ID = 1
#: Most chunks and pieces remembered by a worker, about 110 MB, and how many of them outlast a clearing.
REMEMBERED = 500_000, 100_000
_HEAD = "part int, segment int, start long, n long, doc_ids array<long>, starts array<long>, lengths array<long>"
_SEGMENT = f"{_HEAD}, blocks binary"
_LONGS = pa.list_(pa.int64())
_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("doc_ids", _LONGS), ("starts", _LONGS), ("lengths", _LONGS), ("ids", pa.binary())])


_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def encoder(path: str) -> Vocabulary:
    return Vocabulary(path, packed, b"".join, *REMEMBERED)


def write(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all texts, each followed by END_ID, and write the coded ids under path, in shared storage."""
    spark = docs.sparkSession
    own = only(docs, id_col, text_col).toDF("id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the hash parts rows of one id, should very many have it; order among them is by the hash, then the text
    own = own.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, F.col("id").asc_nulls_first(), "h").sortWithinPartitions(F.col("id").asc_nulls_first(), "h", "text")
    segments = own.select("id", "text").mapInArrow(_segments(tokenizer), f"{_HEAD}, ids binary")
    segments.withColumn("blocks", id_coder.encoded(spark, "ids")).drop("ids").write.parquet(path)


def _segments(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, segment, start, model = TaskContext.get().partitionId(), 0, 0, encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        doc_ids: list = []
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            lengths = np.fromiter((len(h) // 4 for h in held), np.int64, len(held))
            row = [[part], [segment], [start], [size], [doc_ids], [np.cumsum(lengths) - lengths], [lengths], [b"".join(held)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _ARROW.types, strict=True)], schema=_ARROW)

        for rows in slices(batches, caches=(encoder,)):
            for doc, value in zip(rows.column(0).to_pylist(), model.values(rows.column(1).to_pylist()), strict=True):
                doc_ids.append(doc)
                held.append(value + end)
                size += len(value) // 4 + 1
                if size >= SEGMENT_IDS:
                    yield close()
                    segment, start, doc_ids, held, size = segment + 1, start + size, [], [], 0
        if doc_ids:
            yield close()

    return run


def read(spark, path: str, id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """One row per document: id, start, n_tokens, ids_crc32 and, if keep_ids, the ids as a binary of little-endian unsigned 32-bit integers."""
    segments = spark.read.schema(_SEGMENT).parquet(path)
    sizes = segments.groupBy("part").agg(F.sum("n").alias("n"))
    bases = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))  # one row per part

    def document(ids):
        def one(x):
            own = F.substring(ids, (x["starts"] * 4 + 1).cast("int"), (x["lengths"] * 4).cast("int"))
            return F.struct(x["doc_ids"].alias("id"), x["starts"].alias("at"), x["lengths"].alias("n_tokens"), F.crc32(own).alias("ids_crc32"), *[own.alias("ids")] * keep_ids)

        return F.transform(F.arrays_zip("doc_ids", "starts", "lengths"), one)

    # the array of one binds what is decoded, so that it is decoded once for all its documents
    own = F.transform(F.array(id_coder.decoded(spark, "blocks")), document)[0]
    out = segments.select("part", "start", F.explode(own).alias("d")).join(F.broadcast(bases), "part")
    return out.select(F.col("d.id").alias(id_col), (F.col("base") + F.col("start") + F.col("d.at")).alias("start"), "d.n_tokens", "d.ids_crc32", *["d.ids"] * keep_ids)
