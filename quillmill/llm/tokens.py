"""Encoding with a public tokenizer file, and the cache of token counts.

Encoding whole texts costs about a second a megabyte, nearly all of it for words met before. A Vocabulary therefore splits a text into chunks, at places where
the tokenizer's own pre-tokenizer always splits too, chunks not met before into that pre-tokenizer's pieces, and lets the library encode each distinct piece once per worker. It does so only for tokenizers whose normalizer, pre-tokenizer
and added tokens are exactly those it knows, and for texts of plain characters (tab, newline, printable ASCII, printable Latin-1 letters) without "<|", which begins
the added tokens. Any other text, and any text of another tokenizer, goes to the library whole. So every id comes from the library: pieces go, as the byte-level pre-tokenizers write them, straight to its model.

Defined cases of count_tokens: a null text is the empty text. Rows of one text are encoded once; each row gets its count. Null ids are kept. An empty
table gives an empty result, and nothing is appended to the cache.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, only, slices

_PLAIN = re.compile(r"[\t\n -~À-ÖØ-öø-ÿ]*")
#: The serialised parts of the tokenizers whose splitting is known.
_LETTERS_AND_MARKS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORDS = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _LETTERS_AND_MARKS}, "behavior": "Removed", "invert": True}, _BYTES | {"use_regex": False}]}
_LOWER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
#: (normalizer, pre-tokenizer, the chunks of a plain text, the pieces of a chunk). A run of marks and letters, with the one space before it, is never joined to what is around it; where
#: white space is dropped and letters are lower-cased, chunks are lower-cased words. Pieces are what the pre-tokenizer makes.
_L, _N = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9"
_SPLITS = (
    (None, _BYTES, re.compile(r" ?\S+|\s+(?!\S)|\s+").findall, re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+").findall),
    (_LOWER, _WORDS, lambda text: text.lower().split(), re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+").findall),
)
#: Most chunks and pieces remembered by a worker, about 60 MB; how many of them, the first met, outlast a clearing, as common words are met early; and their longest.
REMEMBERED, FIRST = 250_000, 50_000
MOST_PIECE = 64


def _byte_signs() -> dict[int, str]:
    """Plain character -> how byte-level tokenizers write its UTF-8 bytes: printable Latin-1 characters stand for themselves, the other bytes, in order, for those from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    sign = [chr(b if b in printable else next(others)) for b in range(256)]
    return {ord(c): "".join(sign[b] for b in c.encode()) for c in map(chr, range(256)) if _PLAIN.fullmatch(c)}


_SIGNS = _byte_signs()


def _splitting(model) -> tuple[Callable, Callable] | tuple[None, None]:
    """How plain texts and chunks are split for this tokenizer; None if that isn't known."""
    part = lambda p: json.loads(p.__getstate__()) if p else None
    own = (part(model.normalizer), part(model.pre_tokenizer))
    if any("<|" not in t.content for t in model.get_added_tokens_decoder().values()) or model.model.dropout:
        return None, None
    return next(((chunks, pieces) for normalizer, pre, chunks, pieces in _SPLITS if own == (normalizer, pre)), (None, None))


class Vocabulary:
    """Values of texts by chunk: `value` makes a value of a list of ids, and `total` joins the values of a text."""

    def __init__(self, path: str, value: Callable, total: Callable, remembered: int = REMEMBERED, first: int = FIRST):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.value, self.total, self.remembered, self.first = value, total, remembered, first
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.chunks, self.pieces = _splitting(self.model)
        self.bpe = self.model.model
        self.known: dict[str, object] = {}

    def _encode(self, texts: list[str]) -> list:
        return [self.value(e.ids) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: set[str]) -> list[str]:
        """Remember the chunks; returns what is too long to be kept for later."""
        known, value, tokenize = self.known, self.value, self.bpe.tokenize
        made = {c: self.pieces(c) for c in chunks}
        new = {p for pieces in made.values() for p in pieces if p not in known}
        for p in new:
            known[p] = value([t.id for t in tokenize(p.translate(_SIGNS))])
        for c, pieces in made.items():
            if c not in new:
                known[c] = self.total([known[p] for p in pieces])
        return [c for c in {*new, *chunks} if len(c) > MOST_PIECE]

    def values(self, texts: list[str | None]) -> list:
        """One value for each text; null counts as empty."""
        out: list = [None] * len(texts)
        for i, text in enumerate(texts):
            text = text or ""
            if self.chunks is None or "<|" in text or not _PLAIN.fullmatch(text):
                out[i] = self._encode([text])[0]
                continue
            chunks = self.chunks(text)
            new, long = set(chunks).difference(self.known), ()
            if new:
                if len(self.known) > self.remembered:
                    self.known = dict(islice(self.known.items(), self.first))
                    new = set(chunks).difference(self.known)
                long = self._learn(new)
            out[i] = self.total(map(self.known.__getitem__, chunks))
            for c in long:
                del self.known[c]
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Vocabulary:
    return Vocabulary(path, len, sum)


@lru_cache(maxsize=2)
def piece_counter(path: str):
    """Counts for a .model file."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def counts(path: str, texts: list[str | None]) -> list[int]:
    """Token counts as the library of the file gives them, without added tokens."""
    if path.endswith(".model"):
        return [len(x) for x in piece_counter(path).encode([t or "" for t in texts], num_threads=1)]
    return counter(path).values(texts)


def tokenizer_digest(path: str) -> str:
    """Of the file and of how it is used."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"|no added tokens, no truncation").hexdigest()


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (n_tokens above limit).

    cache: a folder in shared storage of Parquet files by tokenizer digest, each row a content digest and its count. Contents found there
    aren't encoded; of the others, each distinct content is encoded once and its count appended.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    path = f"{cache.rstrip('/')}/tokenizer={version}"
    content = only(docs, id_col, text_col).toDF("id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    content = content.withColumn("digest", F.unhex(F.sha2("text", 256)))
    slim = materialize(content.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "token-keys")
    wanted = slim.groupBy("digest").agg(F.min("id").alias("of"))
    stored = _stored(spark, path)
    misses = wanted if stored is None else wanted.join(stored, "digest", "left_anti")
    # one row, or equal rows of one id, for each distinct miss: no hot content moves more than once
    texts = content.join(misses.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("of"))).select("digest", "text")
    schema = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # equal rows of one id come to one task
        for batch in slices(batches, caches=(counter, piece_counter)):
            new = {d: t for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if d not in seen}
            seen.update(new)
            yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary()), pa.array(counts(tokenizer, list(new.values())), pa.int64())], schema=schema)

    texts.mapInArrow(encode, "digest binary, n_tokens long").dropDuplicates(["digest"]).write.mode("append").parquet(path)
    out = slim.join(_stored(spark, path), "digest")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _stored(spark, path: str) -> DataFrame | None:
    try:
        found = spark.read.schema("digest binary, n_tokens long").parquet(path)
    except AnalysisException:
        return None  # no count of this tokenizer yet
    return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
