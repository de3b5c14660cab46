"""License scans, with DataFrame expressions only: fixed phrases, and an exact containment join of text blocks with license templates.

The join is a set-similarity join: the tokens of the templates are ordered from the rarest in the whole corpus to the commonest; a block (a line of a
text) can reach the threshold for a template only if it holds enough of its tokens (length filter), shares one of the template's first tokens
(prefix filter), and has enough tokens left after that one (positional filter). What passes is counted exactly. Only the tokens of the templates
matter to a containment, so a block is narrowed to those before anything is joined, and the template side is a parameter of at most
MAX_TEMPLATE_TOKENS rows whatever the corpus.

Licenses are much alike, so a template holds tokens that a block must have, whatever else it has: the words of labels, and what tells it from a template of another label that would
else reach it (`sharealike`, `lesser`). Of templates of different labels that share half their tokens, the one that is better contained in a block, or among equals one that holds all the other's tokens, displaces the others there.

A passage may be wrapped: besides lines, every window of a template's words and a quarter more that holds words of it in several lines is counted, in those texts that
as a whole hold enough of the template. Of windows that overlap the fullest is reported, by the line where it begins, unless one of its lines reaches the threshold alone.

Defined cases: a null or empty text has no words, no labels and score 0. Very long texts are scanned whole. Repeated rows each have their own result, even with one id. An empty table gives an
empty result. Columns besides the named ones are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import ascii_lower, materialize, only

#: Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, and a passage by which the license is usually named or granted.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without the prior written permission of the publisher"),
)
THRESHOLD = 0.8
MAX_TEMPLATE_TOKENS = 20_000
_WINDOW = "struct<template:int,block:int,last:int,common:int,start:int,stop:int,whole:boolean>"
_GAP = "[\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+"


def required(sets: list[tuple[str, list[str]]], threshold: float) -> list[list[str]]:
    """The tokens of each template that a block must hold."""
    named = {part for label, _ in sets for part in label.split("-")}
    out = []
    for label, words in sets:
        own = set(words)
        must = own & named
        for other_label, other in sets:
            if other_label != label and len(own & set(other)) >= threshold * len(own) - 1e-9:
                must |= own - set(other)
        out.append(sorted(must))
    return out


def rivals(sets: list[tuple[str, list[str]]]) -> list[tuple[list[int], list[int]]]:
    """For each template the numbers of those of other labels with which it shares half the tokens of the smaller, and of those that hold all its tokens and more."""
    alike = lambda a, b: 2 * len(set(a) & set(b)) >= min(len(set(a)), len(set(b)))
    of = lambda label, words, test: [k for k, (other_label, other) in enumerate(sets) if other_label != label and test(words, other)]
    return [(of(label, words, alike), of(label, words, lambda a, b: set(a) < set(b))) for label, words in sets]


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (block number, label, containment)."""
    sets = [(label, sorted(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", words.lower())))) for label, words in templates]
    if sum(len(w) for _, w in sets) > MAX_TEMPLATE_TOKENS:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_TOKENS} tokens; scan them in parts")
    need = [math.ceil(threshold * len(w) - 1e-9) for _, w in sets]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    code = {w: i for i, w in enumerate(vocabulary)}
    spans = [len(w) + -(-len(w) // 4) for w in (re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", words) for _, words in templates)]
    musts = required(sets, threshold)
    wanted = [(t, words, must, least, span) for t, ((_, words), must, least, span) in enumerate(zip(sets, musts, need, spans, strict=True))]
    own = materialize(_measured(docs, vocabulary, min(need, default=1), wanted, id_col, text_col), "licenses")
    spark = docs.sparkSession

    wrapped = own.select("row", F.explode("wrapped").alias("w")).select("row", "w.block", "w.last", "w.template", "w.common")

    blocks = own.select("row", F.explode("blocks").alias("b")).select("row", "b.block", "b.tokens")
    commonness = blocks.select(F.explode("tokens").alias("token")).groupBy("token").count()  # one row per template token at most
    seen = {r["token"]: r["count"] for r in commonness.collect()}
    order = {c: k for k, c in enumerate(sorted(range(len(vocabulary)), key=lambda c: (seen.get(c, 0), c)))}
    rank = F.array(*[F.lit(order[c]) for c in range(len(vocabulary))]) if vocabulary else F.array()
    index, whole = [], []
    for t, ((label, words), must, least, rival) in enumerate(zip(sets, musts, need, rivals(sets), strict=True)):
        ranks = sorted(order[code[w]] for w in words)
        whole.append((t, label, len(ranks), least, ranks, [order[code[w]] for w in must], *rival))
        index += [(r, t, q, len(ranks), least) for q, r in enumerate(ranks[: len(ranks) - least + 1], 1)]
    prefixes = spark.createDataFrame(index, "token int, template int, q int, size int, least int")
    full = spark.createDataFrame(whole, "template int, label string, size int, least int, ranks array<int>, must array<int>, rivals array<int>, larger array<int>")

    ranked = blocks.select("row", "block", F.array_sort(F.transform("tokens", lambda t: F.element_at(rank, t + 1))).alias("own"))
    probes = ranked.select("row", "block", "own", F.size("own").alias("n"), F.posexplode("own").alias("p", "token"))
    probes = probes.join(F.broadcast(prefixes), "token").filter(
        "n >= least AND p + 1 <= n - least + 1 AND 1 + least(n - p - 1, size - q) >= least"  # length, prefix of the block, positional
    )
    probes = probes.groupBy("row", "block", "template").agg(F.first("own").alias("own"))
    hits = probes.join(F.broadcast(full), "template").withColumn("common", F.size(F.array_intersect("own", "ranks"))).filter("common >= least AND size(array_except(must, own)) = 0")
    lines = hits.select("row", "template", F.col("block").alias("line"))
    wrapped = wrapped.join(lines, ["row", "template"], "left").groupBy("row", "template", "block", "last", "common").agg(F.coalesce(F.max(F.col("line").between(F.col("block"), F.col("last"))), F.lit(False)).alias("alone"))
    wrapped = wrapped.filter("NOT alone").join(F.broadcast(full), "template")
    shape = ["row", "block", "last", "template", "rivals", "larger", "label", (F.col("common") / F.col("size")).alias("containment")]
    hits = hits.withColumn("last", F.col("block")).select(*shape).unionByName(wrapped.select(*shape))
    every = F.collect_list(F.struct("block", "last", "template", "rivals", "larger", "label", "containment"))
    best = hits.groupBy("row").agg(every.alias("every"))
    meets = lambda x, y: (x["block"] <= y["last"]) & (y["block"] <= x["last"])
    more = lambda x, y: (F.array_contains(x["rivals"], y["template"]) & (y["containment"] > x["containment"])) | (F.array_contains(x["larger"], y["template"]) & (y["containment"] == x["containment"]))
    beaten = lambda x: F.exists("every", lambda y: more(x, y) & meets(x, y))
    best = best.withColumn("left", F.filter("every", lambda x: ~beaten(x)))
    span = lambda x: F.struct(x["block"].alias("block"), x["label"].alias("label"), x["containment"].alias("containment"))
    best = best.select("row", F.array_distinct(F.transform("left", lambda x: x["label"])).alias("found"), F.array_max(F.transform("left", lambda x: x["containment"])).alias("best"), F.array_sort(F.transform("left", span)).alias("spans"))
    out = own.drop("blocks", "wrapped").join(best, "row", "left")
    every = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<block:int,label:string,containment:double>>")).alias("spans"),
    )


def _wrapped(found: Column, near: Column) -> Column:
    """Of each template in `near`, the fullest windows that hold words of it in several lines: template, block (the first line), last (the last one), common.

    found: (place, line, word) of all words of the vocabulary in a text, in order.
    """

    def of(template: Column) -> Column:
        own = F.filter(found, lambda x: F.array_contains(template["words"], x["word"]))

        def window(own: Column, x: Column, k: Column) -> Column:
            inside = F.filter(F.slice(own, k + 1, template["span"]), lambda y: y["place"] < x["place"] + template["span"])
            words = F.array_distinct(F.transform(inside, lambda y: y["word"]))
            last = F.filter(inside, lambda y: y["word"] == F.element_at(words, -1))[0]  # the first place of the last new word
            return F.struct(template["template"].alias("template"), x["line"].alias("block"), last["line"].alias("last"), F.size(words).alias("common"), x["place"].alias("start"), last["place"].alias("stop"), (F.size(F.array_except(template["must"], words)) == 0).alias("whole"))

        windows = F.flatten(F.transform(F.array(own), lambda o: F.transform(o, lambda x, k: window(o, x, k))))
        windows = F.filter(windows, lambda w: (w["common"] >= template["least"]) & w["whole"])
        none = F.expr(f"cast(array() AS array<{_WINDOW}>)")

        def add(kept: Column, w: Column) -> Column:
            before = F.try_element_at(kept, F.lit(-1))
            over = F.coalesce(w["start"] <= before["stop"], F.lit(False))
            # of equal ones the later is the tighter
            return F.when(~over, F.concat(kept, F.array(w))).when(w["common"] >= before["common"], F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(w))).otherwise(kept)

        return F.aggregate(windows, none, add)

    every = F.filter(F.flatten(F.transform(near, of)), lambda w: w["block"] < w["last"])
    return F.transform(every, lambda w: F.struct(*[w[n].alias(n) for n in ("template", "block", "last", "common")]))


def _measured(docs: DataFrame, vocabulary: list[str], fewest: int, wanted: list[tuple[int, list[str], list[str], int, int]], id_col: str, text_col: str) -> DataFrame:
    """row (its own key), id, the base columns, blocks: those lines that hold at least `fewest` of the vocabulary, with the codes they hold, and the `wanted` templates' windows over several lines."""
    t = only(docs, id_col, text_col).toDF("id", "text").withColumn("text", ascii_lower(F.coalesce("text", F.lit(""))))
    # each word stands between two spaces of its own, so that neighbouring places never share one
    flat = F.expr(f"regexp_replace(regexp_replace(text, '{_GAP}', '  '), '^  |  $', '')")
    t = t.select(F.expr("uuid()").alias("row"), "id", F.split("text", "\n").alias("lines"), F.when(F.expr("length(text) > 0"), F.concat(F.lit(" "), flat, F.lit(" "))).otherwise("").alias("flat"))
    t = t.withColumn("flat", F.when(F.trim("flat") == "", "").otherwise(F.col("flat")))
    spaces = lambda c: F.length(c) - F.length(F.translate(c, " ", ""))
    count, first, last = [], [], []
    for phrase in PHRASES:
        bare = " " + phrase.replace(" ", "  ") + " "
        n, words = F.length("flat") - F.length(F.replace("flat", F.lit(bare))), len(phrase.split())
        count.append((n / len(bare)).cast("long"))
        hit = F.instr("flat", bare) > 0
        before = F.expr(f"substring_index(flat, '{bare}', 1)")
        after = F.expr(f"substring_index(flat, '{bare}', -1)")
        first.append(F.when(hit, (spaces(before) / 2).cast("long")))
        last.append(F.when(hit, F.col("n_words") - (spaces(after) / 2).cast("long") - words))
    t = t.withColumn("n_words", (spaces("flat") / 2).cast("long"))
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.instr("flat", " " + p.replace(" ", "  ") + " ") > 0, F.lit(label)) for p, label in PHRASES.items()]))))
    blocks = F.expr("array()").cast("array<struct<block:int,tokens:array<int>>>")
    wrapped = F.expr("array()").cast("array<struct<template:int,block:int,last:int,common:int>>")
    if vocabulary:
        words = F.array(*[F.lit(w) for w in vocabulary])
        held = F.transform("lines", lambda line, i: F.struct(i.alias("block"), F.array_intersect(F.split(line, _GAP.replace("\\\\", "\\")), words).alias("words")))
        t = t.withColumn("held", held)
        held = F.col("held")
        kept = F.filter(held, lambda b: F.size(b["words"]) >= fewest)
        blocks = F.transform(kept, lambda b: F.struct(b["block"].alias("block"), F.transform(b["words"], lambda w: (F.array_position(words, w) - 1).cast("int")).alias("tokens")))
        templates = F.array(*[F.struct(F.lit(k).alias("template"), F.array(*[F.lit(w) for w in ws]).alias("words"), F.array(*[F.lit(w) for w in must]).cast("array<string>").alias("must"), F.lit(least).alias("least"), F.lit(span).alias("span")) for k, ws, must, least, span in wanted])
        t = t.withColumn("all_held", F.array_distinct(F.flatten(F.transform("held", lambda b: b["words"]))))
        near = F.filter(templates, lambda x: (F.size(F.array_intersect("all_held", x["words"])) >= x["least"]) & (F.size(F.array_except(x["must"], "all_held")) == 0))
        t = t.withColumn("near", F.when((F.size("lines") > 1) & (F.size("all_held") >= fewest), near))
        placed = F.flatten(F.transform("lines", lambda line, i: F.transform(F.filter(F.split(line, _GAP.replace("\\\\", "\\")), lambda w: w != ""), lambda w: F.struct(i.alias("line"), w.alias("word")))))
        placed = F.transform(placed, lambda x, k: F.struct(k.alias("place"), x["line"].alias("line"), x["word"].alias("word")))
        found = F.filter(placed, lambda x: F.array_contains("all_held", x["word"]))
        t = t.withColumn("wrapped", F.when(F.size("near") > 0, F.transform(F.array(found), lambda f: _wrapped(f, F.col("near")))[0]))
        wrapped = F.col("wrapped")
    return t.select("row", "id", "n_words", sum(count[1:], count[0]).alias("n_base"), F.least(*first).alias("first_word"), F.greatest(*last).alias("last_word"), base.alias("base"), blocks.alias("blocks"), wrapped.alias("wrapped"))
