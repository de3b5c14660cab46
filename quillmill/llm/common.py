"""What the corpus operators share: table access, lineage cuts in shared storage, word hashing."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the class that separates words: \x20 and \x09-\x0D.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, one of this process, which only a master in the same process can use (tests, single machine)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = folder = tempfile.mkdtemp(prefix="quillmill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{_own_dirs[context.applicationId]}"


def intermediates(spark: SparkSession) -> str:
    """Where this application's intermediate tables lie; `delete` it once the results that are wanted have been written."""
    return f"{shared_dir(spark)}/quillmill/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, what: str) -> str:
    return f"{intermediates(spark)}/{what}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write to the shared folder and read back: later stages restart from the files if executors are lost."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def only(docs: DataFrame, *names: str) -> DataFrame:
    """Just these columns, so that whatever else a table carries can't clash with working names."""
    return docs.select(*[docs[f"`{n}`"] for n in names])


# --- memory of Python workers ---------------------------------------------------------------------


_in_use: tuple[Callable, ...] = ()


def _use(caches: tuple[Callable, ...]) -> None:
    """This worker now works with these caches: those that another operator left in it are emptied, as workers live on from stage to stage and hold a machine's memory beside the JVM."""
    global _in_use
    for cache in _in_use:
        if cache not in caches:
            cache.cache_clear()
    _in_use = caches


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, caches: tuple[Callable, ...] = ()) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows, so that a task holds the Python objects of few rows at a time. After the last one, freed memory goes back to the machine, as workers live on.

    caches: the operator's own, functions under lru_cache, which stay for its next task in this worker."""
    _use(caches)
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call, it keeps what it keeps
        ctypes.CDLL(None).malloc_trim(0)


# --- hashing of words without a Python loop over words -----------------------------------------

_ODD = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; x must be uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_ODD, -1, 1 << 64)
    up, down = np.full(n, _ODD, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


#: Byte -> 1 if it belongs to a word, for words that are runs outside ASCII white space.
_IN_WORD = np.ones(256, np.uint8)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(raw: np.ndarray, in_word: np.ndarray = _IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of word bytes."""
    flags = np.zeros(len(raw) + 2, np.int8)
    flags[1:-1] = in_word[raw]
    edge = np.diff(flags)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: str | None, lower: bool = True, in_word: np.ndarray = _IN_WORD) -> np.ndarray:
    """A 64-bit hash of each word in order (words: runs outside ASCII white space; A-Z count as a-z)."""
    return prefix_hashes(text, (), lower, in_word)[0]


def prefix_hashes(text: str | None, prefixes: tuple[int, ...], lower: bool = True, in_word: np.ndarray = _IN_WORD) -> list[np.ndarray]:
    """The hashes of all words, then for each of `prefixes` those of the longer words' first so many bytes."""
    none = np.zeros(0, np.uint64)
    if not text:
        return [none] * (len(prefixes) + 1)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if lower:
        raw = _LOWER[raw]
    start, end = word_spans(raw, in_word)
    if not len(start):
        return [none] * (len(prefixes) + 1)
    up, down = _powers(1 << max(16, len(raw).bit_length()))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
    out = [mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))]
    for size in prefixes:
        s = start[end - start > size]
        out.append(mix64((total[s + size] - total[s]) * down[s] + np.uint64(1000 + size)))
    return out


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` words; a shorter text of at least one word is one run."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out *= np.uint64(_ODD)
        out += words[k : n - size + 1 + k]
    return mix64(out + np.uint64(size))
