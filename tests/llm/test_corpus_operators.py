"""Each operator against brute force, on a small table and on the edge cases."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import pytest

from quillmill.llm import language_id, license_scan, line_dedup, mixing, near_dedup, quality_rules, tokens
from quillmill.llm.common import new_path

WS = " \t\n\x0b\x0c\r"
ORDER = lambda rows: sorted(rows, key=repr)


def ws_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(params=["small_docs", "edge_docs", "wide_docs", "empty_docs"], scope="module")
def docs(request):
    return request.getfixturevalue(request.param)


def test_quality_rules(docs):
    want = []
    for r in rows(docs):
        w = ws_words(r["text"])
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i : i + 5])].append(i)
        repeated = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
        lines = [x for x in (r["text"] or "").split("\n") if x.strip(WS)]
        failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
        want.append((r["doc_id"], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r["text"] or ""), len(lines) - len(set(lines)), len(repeated), failed))
    got = rows(quality_rules.judge(docs))
    assert ORDER(want) == ORDER((g["doc_id"], g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) for g in got)
    assert all(g["kept"] == (not g["base_failed"] and not g["host_failed"]) for g in got)


def test_bad_host_is_dropped_and_small_host_is_not(spark):
    good = "one two three four five six seven eight nine ten eleven twelve " + "x"
    data = [(i, f"{good}{i}", "good") for i in range(60)] + [(100 + i, "short", "bad") for i in range(38)] + [(200 + i, f"{good}{i}", "bad") for i in range(2)] + [(300, "short", "tiny"), (301, f"{good}y", "tiny")]
    got = {r["doc_id"]: r["kept"] for r in rows(quality_rules.judge(spark.createDataFrame(data, "doc_id long, text string, source string")))}
    assert not got[200] and got[301] and got[5]


def test_license_scan(docs):
    want = []
    for r in rows(docs):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(r["text"]))
        hits = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        want.append((r["doc_id"], len(w), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None, ",".join(sorted({x for _, x in hits}))))
    got = rows(license_scan.scan(docs))
    assert ORDER(want) == ORDER((g["doc_id"], g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) for g in got)
    assert all(set(filter(None, g["base_labels"].split(","))) <= set(g["labels"].split(",")) and 0 <= g["score"] <= 1 for g in got)


def test_license_phrases_overlap_and_touch(spark):
    data = [(1, "MIT License mit license, mit-license Apache  LICENSE"), (2, "general public license license general public license"), (3, "permit license")]
    got = {r["doc_id"]: r for r in rows(license_scan.scan(spark.createDataFrame(data, "doc_id long, text string")))}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (4, 0, 6, "apache,mit")
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"]) == (2, 0, 4) and got[3]["n_base"] == 0


def test_license_containment_join_is_exact(spark, small_docs):
    import random

    rnd, data = random.Random(3), []
    vocabulary = sorted({w for _, t in license_scan.TEMPLATES for w in t.split()})
    for i in range(300):
        _, t = rnd.choice(license_scan.TEMPLATES)
        words = [w for w in t.split() if rnd.random() < 0.85] + rnd.choices(vocabulary, k=rnd.randrange(12))
        rnd.shuffle(words)
        data.append((i, "noise first\n" + " ".join(words)))
    found = {r["doc_id"]: {(s["block"], s["label"]) for s in r["spans"]} for r in rows(license_scan.scan(spark.createDataFrame(data, "doc_id long, text string")))}
    sets = [(label, t.split()) for label, t in license_scan.TEMPLATES]
    musts, rivals = license_scan.required(sets, license_scan.THRESHOLD), license_scan.rivals(sets)
    for i, text in data:
        want = set()
        for b, line in enumerate(text.split("\n")):
            held = set(line.split())
            share = [len(set(t) & held) / len(set(t)) for _, t in sets]
            hit = [k for k, m in enumerate(musts) if share[k] >= license_scan.THRESHOLD - 1e-9 and set(m) <= held]
            want |= {(b, sets[k][0]) for k in hit if not any(share[j] > share[k] and j in rivals[k][0] or share[j] == share[k] and j in rivals[k][1] for j in hit)}
        assert found[i] == want


def test_license_labels_tell_like_licenses_apart(spark):
    texts = [
        "Released under the Apache License.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "This work is licensed\nunder a Creative Commons Attribution 4.0\nInternational License.",
        "under the terms of the GNU Affero General Public License\nas published by the Free Software Foundation",
        "Released under the MIT license.",
    ]
    got = {r["doc_id"]: r["labels"] for r in rows(license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))}
    assert [got[i] for i in range(8)] == ["apache", "gpl", "gpl,lgpl", "cc-by", "cc-by-sa", "cc-by", "agpl,gpl", "mit"]


def test_license_passages_over_line_breaks(spark):
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction."""
    warranty = """# THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
# IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,"""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
    isc = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that"""
    words = bsd.replace("\n", " ").split()
    data = [(1, "a line\n" + mit), (2, warranty), (3, "x\n\n" + bsd), (4, isc), (5, "\n".join(words)), (6, "\n".join(w + " far away from it" * 8 for w in words)), (7, f"with the\n{' '.join(words)}\nin the"), (8, bsd + "\nx y z\n" * 30 + bsd)]
    got = {r["doc_id"]: r for r in rows(license_scan.scan(spark.createDataFrame(data, "doc_id long, text string")))}
    assert [got[i]["labels"] for i in range(1, 9)] == ["mit", "mit", "bsd", "isc", "bsd", "", "bsd", "bsd"]
    assert [(s["block"], s["containment"]) for s in got[1]["spans"]] == [(1, 1.0)] and got[3]["score"] == 1.0 and got[6]["score"] == 0
    assert [s["block"] for s in got[7]["spans"]] == [1] and [s["block"] for s in got[8]["spans"]] == [0, 61]


def test_language_id(docs):
    got = rows(language_id.identify(docs))
    assert len(got) == docs.count()
    by = defaultdict(list)
    for r in rows(docs):
        by[r["doc_id"]].append(any(map(str.isalpha, r["text"] or "")))
    for g in got:
        assert 0 <= g["score"] <= 1 and (g["lang_pred"] == "und" or any(by[g["doc_id"]]))
        assert g["lang_pred"] != "und" or not all(by[g["doc_id"]])


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    right = [r["lang"] == r["lang_pred"] for r in rows(docs.select("doc_id", "lang").join(language_id.identify(docs).filter("held_out"), "doc_id"))]
    assert sum(right) >= 0.97 * len(right)


def test_profile_is_the_bundle_of_bound_letters():
    import numpy as np

    letters, symbols = language_id._letters(), language_id._symbols()
    want = np.zeros(language_id.DIM)
    for a, b, c in (" ab", "abc", "bc ", "cd "[:0] or " de", "de "):
        want += letters[0][symbols[ord(a)]] * letters[1][symbols[ord(b)]] * letters[2][symbols[ord(c)]]
    assert np.allclose(language_id.profiles(["aBc -1 De"])[0], want / np.linalg.norm(want), atol=1e-6)


def test_language_predictions_equal_brute_force(spark, small_docs):
    import zlib

    import numpy as np

    letters, symbols = language_id._letters(), language_id._symbols()

    def profile(text):
        out, run = np.zeros(language_id.DIM), []
        for ch in f" {(text or '').lower()} ":
            if symbols[ord(ch)] or not run or run[-1]:
                run.append(symbols[ord(ch)])
        for a, b, c in zip(run, run[1:], run[2:], strict=False):
            if b:
                out += letters[0][a] * letters[1][b] * letters[2][c]
        return out / (np.linalg.norm(out) or 1)

    docs = rows(small_docs)
    own = {r["doc_id"]: profile(r["text"]) for r in docs}
    learned = defaultdict(lambda: np.zeros(language_id.DIM))
    for r in docs:
        if r["lang"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            learned[r["lang"]] += own[r["doc_id"]]
    names = sorted(learned)
    prototypes = np.array([learned[n] / np.linalg.norm(learned[n]) for n in names])
    got_names, got_prototypes = language_id.learn(small_docs, per_language=10**9)
    assert got_names == names and np.allclose(got_prototypes, prototypes, atol=1e-5)
    found = {r["doc_id"]: r for r in rows(language_id.predict(small_docs, names, prototypes))}
    assert len(found) == len(docs) and len({r["lang_pred"] for r in found.values()}) > 3
    for r in docs:
        cos, g = prototypes @ own[r["doc_id"]], found[r["doc_id"]]
        if not any(map(str.isalpha, r["text"] or "")):
            assert (g["lang_pred"], g["score"]) == ("und", 0.0)
        else:
            first, second = np.sort(cos)[::-1][:2]
            assert abs(g["score"] - max(first, 0)) < 1e-5 and abs(g["margin"] - (first - second)) < 1e-5
            assert g["lang_pred"] == names[cos.argmax()] or first - second < 1e-5


def level_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while free and left > 1e-9:
        over = {s for s in free if target[s] + left * w[s] / sum(w[x] for x in free) >= cap * sizes[s]}
        if not over:
            for s in free:
                target[s] += left * w[s] / sum(w[x] for x in free)
            break
        for s in over:
            left -= cap * sizes[s] - target[s]
            target[s] = cap * sizes[s]
        free -= over
    return target


def test_mixing(docs):
    got = rows(mixing.taken_words(mixing.mix(docs, shard_slots=16, bucket_docs=20)))
    own = [(r["doc_id"], r["source"], len(ws_words(r["text"]))) for r in rows(docs)]
    assert ORDER(own) == ORDER((g["doc_id"], g["source"], g["size"]) for g in got)
    sizes = Counter()
    for _, s, n in own:
        sizes[s] += n
    target = level_targets(sizes)
    for g in got:
        assert g["source_size"] == sizes[g["source"]] and g["taken"] <= 2 * g["size"] and g["target"] == pytest.approx(target[g["source"]])
    for s in sizes:
        assert abs(sum(g["taken"] for g in got if g["source"] == s) - target[s]) <= 64
    assert ORDER(got) == ORDER(rows(mixing.taken_words(mixing.mix(docs.repartition(3), shard_slots=16, bucket_docs=20))))


def test_shards_draw_their_sources(spark):
    words = lambda i: " ".join(f"w{i}x{j}" for j in range(640))
    data = [(i, words(i), "abc"[min(i % 6, 2)]) for i in range(600)] + [(None, words(1000 + i), "a") for i in range(30)]
    m = mixing.mix(spark.createDataFrame(data, "doc_id long, text string, source string"), shard_slots=512, bucket_docs=50)
    slots = {r["sid"]: r["slots"] for r in rows(m.sources)}
    of_shard, of_source = defaultdict(dict), Counter()
    for r in rows(m.counts):
        of_shard[r["shard"]][r["sid"]] = r["n"]
        of_source[r["sid"]] += r["n"]
    every = sum(slots.values())
    sizes = [sum(c.values()) for _, c in sorted(of_shard.items())]
    assert set(sizes[:-1]) == {512} and sum(sizes) == every
    for sid, n in slots.items():
        p = n / every
        deviations = [(c.get(sid, 0) - size * p) / (size * p * (1 - p)) ** 0.5 for c, size in zip((c for _, c in sorted(of_shard.items())), sizes, strict=True)]
        assert max(map(abs, deviations)) < 5 and 0.3 < sum(d * d for d in deviations) / len(deviations) < 2.5  # neither equal shares nor wild ones
    taken = rows(m.taken.select("slot", "sid").distinct())
    assert Counter(r["sid"] for r in taken) == slots and len({r["slot"] for r in taken}) == every and of_source != slots


def test_mixed_documents_hold_the_words_taken(docs):
    m = mixing.mix(docs)
    out = mixing.mixed_documents(docs, m)
    assert out.columns == docs.columns
    taken = sum(r["taken"] for r in rows(mixing.taken_words(m)))
    assert sum(len(ws_words(r["text"])) for r in rows(out)) == taken


def test_permutations(spark):
    for n in (1, 2, 7, 1000):
        out = [r[0] for r in spark.range(n).select(mixing.permuted("id", f"{n}L", "5L")).collect()]
        assert sorted(out) == list(range(n)) and (n < 1000 or out != sorted(out))


def classes_by_force(docs):
    sets = {}
    for r in docs:
        w = ws_words(low(r["text"]))
        runs = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
        sets.setdefault(r["doc_id"], []).append(runs)
    nodes = [(i, k) for i, v in sets.items() for k in range(len(v))]
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in combinations(nodes, 2):
        x, y = sets[a[0]][a[1]], sets[b[0]][b[1]]
        if x and y and len(x) and (x & y).total() >= 0.8 * (x | y).total():
            up[top(a)] = top(b)
    groups = defaultdict(list)
    for n in nodes:
        groups[top(n)].append(n[0])
    key = lambda i: (i is not None, i or 0)
    return ORDER((i, min(g, key=key)) for g in groups.values() for i in g)


def test_near_dedup(docs):
    got = rows(near_dedup.classes(docs))
    assert ORDER((g["doc_id"], g["class_id"]) for g in got) == classes_by_force(rows(docs))


def test_near_dedup_large_group_and_chain(spark):
    base = [f"w{i}" for i in range(400)]
    data = [(i, " ".join(base[: 200 + i % 3] + [f"x{i}"] + base[205:])) for i in range(200)]  # near copies of one text
    data += [(1000 + i, " ".join(f"c{j}" for j in range(10 * i, 10 * i + 200))) for i in range(12)]  # a chain: only neighbours are similar
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in rows(near_dedup.classes(docs))}
    assert {got[i] for i in range(200)} == {0} and {got[1000 + i] for i in range(12)} == {1000}


def test_near_dedup_tells_texts_of_one_id_apart(spark):
    text = lambda k, end="": " ".join(f"{k}{i}" for i in range(120)) + end
    data = [(None, text("a")), (None, text("b")), (None, text("c")), (10, text("a", " x")), (11, text("b", " x")), (12, text("c", " x"))]
    data += [(5, text("d")), (5, text("e")), (3, text("d", " x")), (7, text("e", " x"))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = rows(near_dedup.classes(docs))
    assert ORDER((g["doc_id"], g["class_id"]) for g in got) == classes_by_force(rows(docs))
    assert Counter((g["doc_id"], g["class_id"]) for g in got if g["doc_id"] == 5) == Counter([(5, 3), (5, 5)])


def test_near_dedup_leaves_one_row_of_each_class(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(120))
    data = [(None, text("a"), 0), (4, text("a"), 1), (4, text("a"), 2), (4, text("b"), 3), (None, text("c"), 4), (None, text("c"), 5), (6, "", 6)]
    docs = spark.createDataFrame(data, "doc_id long, text string, at long")
    assert sorted(r["at"] for r in rows(near_dedup.copies(docs, "at"))) == [0, 2, 5]


def test_dart_signatures_estimate_weighted_similarity():
    import numpy as np

    items = near_dedup.mix64(np.arange(1, 3001, dtype=np.uint64))
    a, b = (near_dedup.signature(x, 1024) for x in (items[:2000], items[500:2500]))
    assert abs((a == b).mean() - 0.6) < 0.06
    assert (near_dedup.signature(items[:3], 1024) != near_dedup._NONE).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, docs, name):
    path, cache = public_tokenizers.path(name), new_path(spark, "test-cache")
    got = rows(tokens.count_tokens(docs, path, cache))
    data = [(r["doc_id"], r["text"] or "") for r in rows(docs)]
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        n = [len(x) for x in SentencePieceProcessor(model_file=path).encode([t for _, t in data])]
    else:
        from tokenizers import Tokenizer

        n = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch([t for _, t in data], add_special_tokens=False)]
    want = ORDER((i, len(t.encode()), k, k > 1024) for (i, t), k in zip(data, n, strict=True))
    assert want == ORDER((g["doc_id"], g["n_bytes"], g["n_tokens"], g["over_limit"]) for g in got)
    before = spark.read.parquet(cache).count() if got else 0
    assert want == ORDER(tuple(g.values()) for g in rows(tokens.count_tokens(docs, path, cache)))  # nothing left to encode
    assert before == len({t for _, t in data}) and (not got or spark.read.parquet(cache).count() == before)


def test_pieces_equal_the_library_on_plain_text():
    import random

    from tokenizers import Tokenizer

    rnd = random.Random(5)
    alphabet = "aAbZé ß  \t\n'sdt09.,!?|<>-_ÀÿàÖ"
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(60))) for _ in range(4000)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        whole = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        assert tokens.Vocabulary(path, list, lambda x: sum(x, [])).values(texts) == whole


def kept_by_force(docs, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda line: low(line.strip(WS))
    order = lambda i: (i is not None, i or 0)
    for r in docs:
        for line in (r["text"] or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(r["doc_id"])
    out = []
    for r in docs:
        lines = (r["text"] or "").split("\n")
        left = [x for x in lines if not (len(h := holders.get(key(x), ())) >= min_docs and len(key(x)) >= min_chars and max(h, key=order) != r["doc_id"])]
        out.append((r["doc_id"], len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def test_line_dedup(docs):
    want = kept_by_force(rows(docs))
    got = rows(line_dedup.drop_repeated_lines(docs))
    assert ORDER(want) == ORDER((g["doc_id"], g["n_lines"], g["n_dropped"], g["text"]) for g in got)
    slim = rows(line_dedup.drop_repeated_lines(docs, keep_text=False))
    assert ORDER((*w[:3], hashlib.sha256(w[3].encode()).hexdigest()) for w in want) == ORDER((g["doc_id"], g["n_lines"], g["n_dropped"], g["kept_sha256"]) for g in slim)


def test_full_bloom_filters_only_add_suspects(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_BITS", 1 << 9)
    want = kept_by_force(rows(docs))
    assert ORDER(w[:3] for w in want) == ORDER((g["doc_id"], g["n_lines"], g["n_dropped"]) for g in rows(line_dedup.drop_repeated_lines(docs)))
