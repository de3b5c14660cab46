"""Decontamination, the coder and token output, the weak-label model, the pipeline, and shared helpers."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_corpus_operators import ORDER, low, rows

from quillmill.llm import common, decontamination, id_coder, mixing, near_dedup, quality_model, token_output
from quillmill.llm.common import new_path

DOC = "doc_id long, text string"
ITEM = "item_id long, text string"


def tiled(doc, item, match=5):
    """Greedy string tiling by looking at every pair of places: the share of the item's words under tiles."""
    free_d, free_i, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and free_d[p + n] and free_i[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < match:
            return covered / len(item)
        free_d[p : p + n] = [False] * n
        free_i[q : q + n] = [False] * n
        covered += n


def test_tiles_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        item = rnd.choices("abcdefghij", k=rnd.randrange(5, 40))
        parts = [item[i : i + 9] for i in range(0, len(item), 9)]
        rnd.shuffle(parts)
        doc = rnd.choices("abcdefghij", k=rnd.randrange(30)) + sum(parts[: rnd.randrange(1, 5)], []) + rnd.choices("abcdefghij", k=5)
        items = decontamination.Items([7], [" ".join(item)])
        got = {r[0]: r[2] / r[1] for r in items.found(" ".join(doc), 0.5)}
        want = tiled(doc, item)  # of several longest runs both mark the first in the document, then the first in the item
        assert got == ({7: want} if want >= 0.5 else {})


def test_leaks(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    w = item.split()
    texts = {1: f"some words before {item} and after", 2: " ".join(w[10:] + ["x"] + w[:10]), 3: " ".join(w[:9]), 4: "Alpha, BETA gamma; delta epsilon zeta eta theta iota kappa!", 5: "nothing here", 6: None, 7: ""}
    docs = spark.createDataFrame([*texts.items(), (1, texts[1])], DOC)
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (4, "")], ITEM)
    got = rows(decontamination.leaks(docs, bench))
    assert ORDER((g["doc_id"], g["item_id"], g["coverage"], g["n_tiles"]) for g in got) == ORDER([(1, 1, 1.0, 1), (1, 1, 1.0, 1), (2, 1, 1.0, 2), (4, 1, 0.5, 1)])
    first = next(g for g in got if g["doc_id"] == 1)
    assert (first["first_word"], first["last_word"]) == (3, 22)


def test_leaks_over_blocks_and_edges(spark, small_docs, sf, edge_docs, wide_docs, empty_docs, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = ORDER(r.values() for r in rows(decontamination.leaks(small_docs, bench)))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 400)
    assert [*map(list, ORDER(r.values() for r in rows(decontamination.leaks(small_docs, bench))))] == [*map(list, whole)] and whole
    assert decontamination.leaks(edge_docs, bench).count() == decontamination.leaks(wide_docs, bench).count() == 0
    assert decontamination.leaks(empty_docs, bench).count() == 0 and decontamination.leaks(small_docs, bench.limit(0)).count() == 0


def test_coder_round_trip(spark):
    rng = np.random.default_rng(4)
    n = id_coder.BLOCK
    blocks = [rng.integers(0, 1 << 32, k) for k in (0, 1, 2, 3, 700)] + [np.zeros(900, int), np.arange(2000) % 7, rng.zipf(1.3, n) % 49000, np.full(5, (1 << 32) - 1), rng.integers(0, 65536, 2 * n + 1)]
    blocks += [np.concatenate([blocks[7], blocks[6]]), np.arange(n), 1 << np.arange(32)]
    raw = [b.astype("<u4").tobytes() for b in blocks]
    data = spark.createDataFrame([*enumerate(map(bytearray, raw)), (99, None)], "k int, ids binary").withColumn("coded", id_coder.encoded(spark, "ids"))
    got = {r["k"]: r for r in data.withColumn("back", id_coder.decoded(spark, "coded")).collect()}
    assert got.pop(99)["coded"] is None and all(bytes(got[k]["back"]) == r for k, r in enumerate(raw))
    assert got[10]["coded"] == got[7]["coded"] + got[6]["coded"]  # a block doesn't depend on its neighbours
    assert len(got[5]["coded"]) < 60 and len(got[7]["coded"]) < 1.5 * n and len(got[9]["coded"]) < 1.15 * len(raw[9]) / 2
    head = np.frombuffer(bytes(got[4]["coded"][:12]), "<u4")
    assert head.tolist() == [700, zlib.crc32(raw[4]), len(got[4]["coded"]) - 12]
    damaged = bytearray(got[4]["coded"])
    damaged[50] ^= 1
    for bad in (damaged, got[4]["coded"][:-1], got[4]["coded"][:9]):
        with pytest.raises(Exception, match="block 0 is damaged"):
            spark.createDataFrame([(bytearray(bad),)], "coded binary").select(id_coder.decoded(spark, "coded")).collect()


def test_coder_spells_any_ids_in_few_bits(spark):
    rng = np.random.default_rng(8)
    n = id_coder.BLOCK
    skewed = np.minimum(rng.geometric(0.02, 3 * n) * 700 % 49_000, 48_999)
    blocks = [rng.integers(0, 1 << 32, n), np.concatenate([skewed[:n], rng.integers(0, 1 << 32, 50), skewed[n:]]), skewed, np.full(n, 65535), np.array([65535, 65536, 0, 1 << 31]), np.arange(n) % 16 * 4369]
    blocks += [rng.integers(0, 1 << k, 5000) for k in range(1, 33)]
    raw = [b.astype("<u4").tobytes() for b in blocks]
    data = spark.createDataFrame([*enumerate(map(bytearray, raw))], "k int, ids binary").withColumn("coded", id_coder.encoded(spark, "ids"))
    got = {r["k"]: r for r in data.withColumn("back", id_coder.decoded(spark, "coded")).collect()}
    assert all(bytes(got[k]["back"]) == r for k, r in enumerate(raw))
    assert len(got[0]["coded"]) < 1.06 * len(raw[0]) and len(got[2]["coded"]) < 0.27 * len(raw[2])


def test_encoder_clears_what_it_remembers(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model, texts = Tokenizer.from_file(path), [" ".join(f"{a}{b}, don't {b}{a}." for b in "pqrstuv") for a in "abcdefghijklmn"]
    monkeypatch.setattr(token_output, "REMEMBERED", (20, 5))
    token_output.encoder.cache_clear()
    try:
        own = token_output.encoder(path)
        for text in texts * 2:
            assert np.frombuffer(own.values([text])[0], "<u4").tolist() == model.encode(text, add_special_tokens=False).ids and len(own.known) < 80
    finally:
        token_output.encoder.cache_clear()


@pytest.mark.parametrize("name", ["small_docs", "edge_docs", "wide_docs", "empty_docs"])
def test_token_output(spark, name, request, monkeypatch):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(name)
    path, tokenizer = new_path(spark, "test-ids"), public_tokenizers.path("word_bpe_49k.json")
    token_output.write(docs, tokenizer, path)
    got = rows(token_output.read(spark, path, keep_ids=True))
    model = Tokenizer.from_file(tokenizer)
    want = Counter((r["doc_id"], tuple([*model.encode(r["text"] or "", add_special_tokens=False).ids, 1])) for r in rows(docs))
    assert Counter((g["doc_id"], tuple(np.frombuffer(g["ids"], "<u4").tolist())) for g in got) == want
    order = sorted(got, key=lambda g: g["start"])
    assert [g["doc_id"] for g in order] == sorted((g["doc_id"] for g in got), key=lambda i: (i is not None, i or 0))
    at = 0
    for g in order:
        assert g["start"] == at and g["n_tokens"] == len(g["ids"]) // 4 and g["ids_crc32"] == zlib.crc32(g["ids"])
        at += g["n_tokens"]


def test_label_model_finds_the_reliable_voters():
    rnd = random.Random(1)
    rates = [(0.9, 0.05), (0.7, 0.1), (0.6, 0.02), (0.5, 0.5)]
    patterns = Counter()
    for _ in range(20_000):
        bad = rnd.random() < 0.2
        patterns["".join("2" if rnd.random() < r[not bad] else "1" for r in rates)] += 1
    share, rate = quality_model.estimate(patterns, 0.6, 0.8, 0.3)
    assert abs(share - 0.2) < 0.03 and np.abs(rate - np.array(rates)).max() < 0.08


@pytest.mark.parametrize("name", ["edge_docs", "wide_docs", "empty_docs"])
def test_quality_model_edges(spark, name, request):
    docs = request.getfixturevalue(name)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (None, 0, 1), (999, 0, 0)], "doc_id long, quality int, toxic int")
    for known in (None, labels):
        got = rows(quality_model.classify(docs, known))
        assert Counter(g["doc_id"] for g in got) == Counter(r["doc_id"] for r in rows(docs))
        assert all(0 <= g["score"] <= 1 for g in got) and not any(g["kept"] for g in got if g["doc_id"] in (4, 5, 6, 12) and not g["votes"])


def test_quality_model_learns_from_all_words_of_long_documents(spark):
    rnd = random.Random(8)
    name = lambda k: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    column = lambda w: int(quality_model.look(w)[1][-1])
    tell = max((name(4) for _ in range(3000)), key=column)  # among the last of a document's features
    filler = [name(9) for _ in range(1500)]
    text = lambda words: ". ".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12)) + "."
    data = [(i, text(rnd.sample(filler, 1400) + [tell] * (i % 2))) for i in range(40)]
    assert all(len(quality_model.look(t)[1]) > 5000 for _, t in data)
    short = rnd.sample(filler, 50)
    data += [(100, text([*short, tell])), (101, text([*short, name(4)]))]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in rows(quality_model.classify(spark.createDataFrame(data, DOC), labels))}
    assert not got[100]["kept"] and got[101]["kept"] and got[100]["p_quality"] < got[101]["p_quality"] - 0.3


def test_quality_model_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality_model.classify(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    share = lambda want, f: sum(f(r) for r in got if want(r)) / max(sum(map(want, got)), 1)
    assert share(lambda r: r["quality"] and not r["toxic"], lambda r: r["kept"]) > 0.98
    assert share(lambda r: not r["quality"], lambda r: r["kept"]) < 0.1 and share(lambda r: r["toxic"], lambda r: r["kept"]) < 0.25


def test_pipeline(spark, sf):
    import corpus_pipeline

    out = rows(corpus_pipeline.run(spark, sf))
    docs = rows(spark.read.parquet(f"{sf}/documents.parquet"))
    letters = [r for r in docs if any(map(str.isalpha, r["text"] or ""))]
    frame = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in letters], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {g["doc_id"] for g in rows(near_dedup.classes(frame)) if g["kept"]}
    bad = {g["doc_id"] for g in rows(decontamination.leaks(frame, spark.read.parquet(f"{sf}/benchmark.parquet")))}
    left = frame.filter(frame.doc_id.isin(*(kept - bad)))
    mixed = rows(mixing.mixed_documents(left, mixing.mix(left)))
    assert Counter(g["doc_id"] for g in out) == Counter(r["doc_id"] for r in mixed) and bad and len(kept) < len(letters)
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    crc = lambda t: zlib.crc32(np.array([*model.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes())
    assert Counter((g["doc_id"], g["ids_crc32"]) for g in out) == Counter((r["doc_id"], crc(r["text"])) for r in mixed)


@pytest.mark.parametrize("name", ["edge_docs", "wide_docs", "empty_docs"])
def test_pipeline_stages_on_edges(spark, sf, name, request):
    import corpus_pipeline

    docs = request.getfixturevalue(name)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = new_path(spark, "test-stage")
        stage(spark, docs, sf).write.parquet(path)
        assert spark.read.parquet(path).columns == docs.columns
        docs = spark.read.parquet(path)
    ids = [r["doc_id"] for r in rows(corpus_pipeline.STAGES[-1][1](spark, docs, sf))]
    assert Counter(ids) == Counter(r["doc_id"] for r in rows(docs)) and (name == "empty_docs" or 1 in ids and 5 not in ids)


def test_pipeline_verdicts_hold_for_rows_without_or_of_one_id(spark):
    import corpus_pipeline

    item = " ".join(f"item{i}" for i in range(30))
    own = lambda k: " ".join(f"{k}{i}" for i in range(60))
    data = [(None, f"before {item} after"), (None, own("a")), (1, own("a")), (2, own("b")), (2, own("b")), (3, f"{item} again"), (3, own("c")), (None, own("d")), (None, own("d"))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    path = new_path(spark, "test-benchmark")
    spark.createDataFrame([(1, item)], ITEM).write.parquet(f"{path}/benchmark.parquet")
    unique = corpus_pipeline.near_dedup_stage(spark, docs, path)
    left = rows(corpus_pipeline.decontamination_stage(spark, unique, path))
    assert ORDER((r["doc_id"], r["text"][:2]) for r in left) == ORDER([(1, "a0"), (2, "b0"), (3, "c0"), (None, "d0")])


def test_language_stage_rejects_by_profile(spark):
    import corpus_pipeline

    rnd = random.Random(6)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    noise = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz   ", k=400)), "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=800))]
    noise += ["Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. " * 3]
    more = spark.createDataFrame([(10**9 + i if i else None, t, None, "noise", len(t)) for i, t in enumerate(noise)], docs.schema)
    kept = rows(corpus_pipeline.language_stage(spark, docs.unionByName(more), "").select("doc_id", "source"))
    assert not [r for r in kept if r["source"] == "noise"] and len(kept) == len([r for r in rows(docs) if any(map(str.isalpha, r["text"] or ""))])


def test_language_stage_learns_from_all_documents(spark):
    """Of one language's 9,000 documents, those that a sample of 4,000 would leave out are written in letters of their own."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    from quillmill.llm import language_id

    n = 9000
    ids = spark.range(16_000).filter(~language_id.held_out(F.col("id"))).orderBy("id").limit(n)
    inside = {r["id"]: r["inside"] for r in ids.withColumn("inside", F.pmod(F.xxhash64("id", F.lit(language_id._SEED)), F.lit(1 << 20)) < F.lit(4000 / n * (1 << 20))).collect()}
    assert len(inside) == n and 3000 < sum(inside.values()) < 5000
    latin, other = "the quick brown fox jumps over the lazy dog and sleeps in the warm sun " * 2, "все люди рождаются свободными и равными в своем достоинстве и правах " * 2
    docs = spark.createDataFrame([(i, latin if k else other, "en", "a", 1) for i, k in inside.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert corpus_pipeline.language_stage(spark, docs, "").count() == n


def test_floor_is_that_of_all_learning_documents(spark, small_docs):
    from quillmill.llm import language_id

    names, prototypes = language_id.learn(small_docs, None)
    learned = [r["text"] for r in rows(small_docs.filter(~language_id.held_out(small_docs["doc_id"])).filter("lang IS NOT NULL AND text IS NOT NULL"))]
    score = sorted((language_id.profiles([t for t in learned if language_id._is_long(t)]) @ prototypes.T).max(axis=1))
    want = language_id.FLOOR_SHARE * score[int(language_id.FLOOR_TAIL * len(score))]
    assert abs(language_id.least_score(small_docs.repartition(3), names, prototypes, None) - want) <= language_id.FLOOR_SHARE / language_id._STEPS + 1e-9
    assert language_id.least_score(small_docs.limit(0), names, prototypes, None) == 0.0 and language_id.learn(small_docs.limit(0), None)[0] == []


def test_workers_hold_the_caches_of_one_operator():
    import tracemalloc
    from functools import lru_cache

    from quillmill.llm import language_id
    from quillmill.llm.common import slices

    one, other = (lru_cache(maxsize=1)(lambda: bytearray(8)) for _ in range(2))
    for caches, held in (((one,), (1, 0)), ((one,), (1, 0)), ((other,), (0, 1)), ((), (0, 0))):
        list(slices(iter([]), caches=caches))
        for cache in caches:
            cache()
        assert (one.cache_info().currsize, other.cache_info().currsize) == held
    language_id._symbols(), language_id._letters()
    tracemalloc.start()
    try:
        language_id.profiles(["some plain words of one text"] * 100)
        assert tracemalloc.get_traced_memory()[1] < 20e6
    finally:
        tracemalloc.stop()


def test_word_hashes():
    w = common.word_hashes("Ab ab x  ab\n\x0bé")
    assert len(w) == 4 and w[0] == w[2] and len(set(w.tolist())) == 3 and len(common.word_hashes(None)) == len(common.word_hashes(" \n")) == 0
    assert (common.word_hashes("y" * 70_000 + " ab")[1:] == w[:1]).all() and low("AÉ") == "aÉ"
    assert len(common.shingle_hashes(w, 5)) == 1 and len(common.shingle_hashes(np.arange(9, dtype=np.uint64), 5)) == 5
