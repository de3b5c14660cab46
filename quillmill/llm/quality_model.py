"""A quality classifier from weak labels.

Overlapping heuristics vote on each document: good, bad or no vote; three lists of insults vote on abuse. How often each is right isn't known; expectation-maximisation finds it from how the votes
of all documents agree, which takes only the counts of vote patterns, a table as small for any corpus. Labels, where a document has some, are one more voter of each kind, which
anchors the classes by a fixed accuracy. The posterior labels of a sample then train two logistic scorers, of quality and of abuse, over hashed words, their
beginnings and the heuristics' votes, and those score every document, never by its label.

Defined cases: a text without words, also a null one, has score 0 and isn't kept. A corpus without any votes is scored by the priors. Repeated rows each have
their own result, and null ids are kept. Of several labels of a document the lowest quality and highest toxicity count. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, mix64, only, prefix_hashes, slices, word_hashes

HASHED = 1 << 18
#: Word beginnings, in bytes, that are features besides whole words.
PREFIXES = (4, 5, 6, 7, 8)
_IN_WORD = np.zeros(256, np.uint8)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = 1

# Insults, in three lists that vote apart.
INSULTS = (
    ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "imbecile", "fool", "cretin", "dimwit"),
    ("worthless", "trash", "scum", "garbage", "loser", "losers", "vermin", "filth", "parasite"),
    ("pathetic", "disgusting", "clown", "clowns", "repulsive", "despicable", "ugly", "freak"),
)
QUALITY_VOTES = ("symbols", "shouting", "exclaims", "repeats", "lines", "sentences", "bars")
ABUSE_VOTES = ("stupidity", "worth", "disgust")
#: What a word must show to be a feature with a weight.
TELLS, LEAST = 6.0, 4.0
#: One document in the counts of features, which are whole numbers, so that no order of adding changes them.
_ONE = 1 << 30
#: How often a label says bad of a bad document, and of a good one.
LABEL_RATES = (0.98, 0.0001)
_SYMBOLS, _ENDS = [ord(c) for c in "#*$%&|<>"], [ord(c) for c in ".!?"]


@lru_cache(maxsize=1)
def _insults() -> tuple[np.ndarray, ...]:
    return tuple(np.array([word_hashes(w, in_word=_IN_WORD)[0] for w in group], np.uint64) for group in INSULTS)


def _vote(x: float, good: float, bad: float) -> int:
    """1 good, 2 bad, 0 no vote."""
    return 1 if x <= good else 2 if x >= bad else 0


def look(text: str | None) -> tuple[str, np.ndarray]:
    """The votes, a digit each, and the hashed distinct words; no votes, "", for a text without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    w, *begin = prefix_hashes(text, PREFIXES, in_word=_IN_WORD)
    n = len(w)
    if not n:
        return "", np.zeros(0, np.uint32)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    distinct = np.unique(w)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    votes = [
        _vote(count[_SYMBOLS].sum() / n, 0.03, 0.15),
        _vote(upper / max(upper + lower, 1), 0.12, 0.4) if n >= 5 else 0,
        _vote(count[33] / n, 0.05, 0.25),
        _vote(-len(distinct) / n, -0.45, -0.3) if n >= 20 else 0,
        _vote(1 - len(set(lines)) / len(lines), 0.1, 0.3) if len(lines) >= 4 else 0,
        _vote(n / (count[_ENDS].sum() + 1), 40, 60) if n >= 30 else 0,
        _vote(count[124] / n, 0.02, 0.2),
    ]
    votes += [2 if np.isin(group, distinct).any() else 1 for group in _insults()]
    return "".join(map(str, votes)), np.unique((np.concatenate([distinct, *begin]) >> np.uint64(46)).astype(np.uint32))


def estimate(patterns: dict[str, int], sensitivity: float, specificity: float, prior: float, anchor: tuple[float, float] | None = None, rounds: int = 100) -> tuple[float, np.ndarray]:
    """Expectation-maximisation for a hidden bad/good class. Returns the share of bad documents and [voter, (P(votes bad | bad), P(votes bad | good))], of those that vote.

    anchor: the rates of the last voter, if they are known. Each estimate is held by some pseudo-documents of the start's values, so that no voter of few votes becomes certain.
    """
    keys = [k for k in sorted(patterns) if k]
    if not keys:
        return prior, np.zeros((0, 2))
    v = np.array([[int(c) for c in k] for k in keys])
    n = np.array([patterns[k] for k in keys], float)
    start = np.tile([sensitivity, 1 - specificity], (v.shape[1], 1))
    if anchor:
        start[-1] = anchor
    rate, share, hold = start.copy(), prior, 5.0
    for _ in range(rounds):
        p = posterior(v, share, rate)
        new = rate.copy()
        for c, weight in enumerate((n * p, n * (1 - p))):
            new[:, c] = (weight @ (v == 2) + hold * start[:, c]) / (weight @ (v > 0) + hold)
        if anchor:
            new[-1] = anchor
        share = float((n @ p + hold * prior) / (n.sum() + hold))
        done, rate = np.abs(new - rate).max() < 1e-9, np.clip(new, 1e-6, 1 - 1e-6)
        if done:
            break
    return share, rate


def posterior(v: np.ndarray, share: float, rate: np.ndarray) -> np.ndarray:
    """P(bad | votes)."""
    say = (v == 2) @ np.log(rate) + (v == 1) @ np.log1p(-rate)
    odds = np.log(share) - np.log1p(-share) + say[:, 0] - say[:, 1]
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _columns(votes: str, words: np.ndarray) -> np.ndarray:
    """The features of a document, each present once: its words and beginnings, the votes cast, and a bias."""
    cast = [HASHED + 2 * k + int(c) - 1 for k, c in enumerate(votes) if c != "0"]
    return np.concatenate([words.astype(np.int32), np.array([*cast, HASHED + 2 * len(votes)], np.int32)])


def fit(sample: list[np.ndarray], target: np.ndarray, size: int, tells: np.ndarray, rounds: int = 150, step: float = 0.3, keep: float = 1e-4) -> np.ndarray:
    """Weights of a logistic model for soft labels, by full-gradient Adagrad. Only the columns of `tells` have one."""
    weights, seen = np.zeros(size), np.full(size, 1e-8)
    if not sample:
        return weights
    column, row = np.concatenate(sample), np.repeat(np.arange(len(sample), dtype=np.int32), [len(x) for x in sample])
    column, row = column[tells[column]], row[tells[column]]
    for _ in range(rounds):
        z = np.bincount(row, weights[column], len(sample))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        gradient = np.bincount(column, error[row], size) / len(sample) + keep * weights
        seen += gradient * gradient
        weights -= step * gradient / np.sqrt(seen)
    return weights


def _telling(sampled: DataFrame, models: list[tuple], totals: list[float], n: int) -> DataFrame:
    """(column, tells: a flag for each model) of the words that clearly tell a model's classes apart: in bad documents by TELLS times as frequent as in good ones, and in at least LEAST of them.

    All words of the sampled documents are counted, where they lie; the driver sees only those that tell.
    """
    names = [f"bad{m}" for m in range(len(models))]
    schema = pa.schema([(c, pa.int64()) for c in ("column", "n", *names)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            votes, words = batch.column(0).to_pylist(), [_unpack(w) for w in batch.column(1).to_pylist()]
            if not votes:
                continue
            column, place = np.unique(np.concatenate(words), return_inverse=True)
            row = np.repeat(np.arange(len(words)), [len(w) for w in words])
            out = {"column": column.astype(np.int64), "n": np.bincount(place, minlength=len(column)).astype(np.int64)}
            for name, model in zip(names, models, strict=True):
                shares = np.rint(_targets(votes, *model) * _ONE).astype(np.int64)
                out[name] = np.zeros(len(column), np.int64)
                np.add.at(out[name], place, shares[row])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    counts = sampled.select("votes", "words").mapInArrow(count, ", ".join(f"`{c}` long" for c in schema.names)).groupBy("column").agg(*[F.sum(c).alias(c) for c in ("n", *names)])
    flags = []
    for name, total in zip(names, totals, strict=True):
        bad = F.col(name) / _ONE
        flags.append((bad >= LEAST) & ((bad + 0.5) / (total + 1) >= TELLS * (F.col("n") - bad + 0.5) / (n - total + 1)))
    return counts.select("column", F.array(*flags).alias("tells")).filter(reduce(or_, flags))


def _targets(votes: list[str], part: list[int], share: float, rate: np.ndarray) -> np.ndarray:
    """P(bad) of documents by the votes of a model's part."""
    v = np.array([[int(x[i]) for i in part] for x in votes], int).reshape(len(votes), len(part))
    return posterior(v, share, rate) if len(votes) else np.zeros(0)


def _unpack(words: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(words), np.uint32)


def classify(docs: DataFrame, labels: DataFrame | None = None, sample_docs: int = 8_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, p_quality, p_toxic, score (p_quality less what p_toxic takes) and kept (both judge it clean).

    labels: id, quality and toxic (0 or 1, or null) of some documents. sample_docs: about how many documents, chosen by a hash of the id, the scorers are fitted
    on: labelled ones, if there are any. The label model takes the votes of all.
    """
    spark = docs.sparkSession
    own = only(docs, id_col, text_col).toDF("id", "text")
    if labels is None:
        labels = spark.createDataFrame([], f"`{id_col}` long, quality int, toxic int")
    said = only(labels, id_col, "quality", "toxic").toDF("id", "q", "t").filter("id IS NOT NULL").groupBy("id").agg(F.min("q").alias("q"), F.max("t").alias("t"))
    said = said.select("id", F.expr("CASE q WHEN 1 THEN '1' WHEN 0 THEN '2' ELSE '0' END || CASE t WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '0' END").alias("label"))
    labelled = said.count()
    share = int(min(1.0, sample_docs / max(labelled or own.count(), 1)) * (1 << 20))
    picked = F.pmod(F.xxhash64(F.coalesce("id", F.lit(0))), F.lit(1 << 20)) < F.lit(share)
    if labelled:  # the ids broadcast are the sample's, about sample_docs
        source = own.join(F.broadcast(said.filter(picked).select("id", F.lit(True).alias("picked"))), "id", "left").select("id", "text", "picked")
    else:
        source = own.select("id", "text", picked.alias("picked"))
    schema = pa.schema([("id", pa.int64()), ("votes", pa.string()), ("words", pa.binary())])

    def watch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            votes, words = [], []
            for text, wanted in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                v, w = look(text)
                votes.append(v)
                words.append(zlib.compress(w.tobytes(), 1) if wanted and v else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(votes, pa.string()), pa.array(words, pa.binary())], schema=schema)

    seen = materialize(source.mapInArrow(watch, "id long, votes string, words binary"), "votes").filter("votes <> ''")
    seen = seen.join(said, "id", "left").withColumn("votes", F.concat("votes", F.coalesce("label", F.lit("00"))))
    patterns = {r["votes"]: r["count"] for r in seen.groupBy("votes").count().collect()}  # 3 ** voters rows at most
    q, every = len(QUALITY_VOTES), len(QUALITY_VOTES) + len(ABUSE_VOTES)
    models = []
    for part, start in (([*range(q), every], (0.3, 0.99, 0.1)), ([*range(q, every), every + 1], (0.4, 0.995, 0.05))):
        of: dict[str, int] = {}
        for k, n in patterns.items():
            key = "".join(k[i] for i in part)
            of[key] = of.get(key, 0) + n
        models.append((part, *estimate(of, *start, LABEL_RATES)))

    sampled = seen.filter("words IS NOT NULL")
    known = {r["votes"]: r["count"] for r in sampled.groupBy("votes").count().collect()}
    n = sum(known.values())
    totals = [float(_targets(list(known), *m) @ np.array(list(known.values()), float)) for m in models]
    size = HASHED + 2 * every + 1
    tells = np.zeros((len(models), size), bool)
    tells[:, HASHED:] = True
    for r in _telling(sampled, models, totals, n).collect():
        tells[:, r["column"]] = r["tells"]
    wanted = spark.sparkContext.broadcast(tells.any(axis=0))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [_unpack(w) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w[wanted.value[w]].tobytes() for w in words], pa.binary())], names=["votes", "words"])

    sample = [(r["votes"], np.frombuffer(r["words"], np.uint32)) for r in sampled.select("votes", "words").mapInArrow(narrow, "votes string, words binary").toLocalIterator()]
    inputs = [_columns(v[:every], w) for v, w in sample]
    weights = [fit(inputs, _targets([v for v, _ in sample], *model), size, tells[m]) for m, model in enumerate(models)]
    shared = spark.sparkContext.broadcast(np.stack(weights))
    out_schema = pa.schema([(id_col, pa.int64()), ("p_quality", pa.float64()), ("p_toxic", pa.float64()), ("votes", pa.string())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p, seen_votes = np.zeros((batch.num_rows, 2)), []
            for k, text in enumerate(batch.column(1).to_pylist()):
                votes, words = look(text)
                seen_votes.append(votes)
                if votes:
                    p[k] = 1 / (1 + np.exp(-np.clip(shared.value[:, _columns(votes, words)].sum(axis=1), -30, 30)))
                    p[k, 0] = 1 - p[k, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(seen_votes, pa.string())], schema=out_schema)

    out = own.mapInArrow(score, f"`{id_col}` long, p_quality double, p_toxic double, votes string")
    return out.withColumn("score", F.col("p_quality") * (1 - F.col("p_toxic"))).withColumn("kept", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5))
