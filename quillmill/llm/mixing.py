"""Mixing sources to target weights, with DataFrame expressions only.

Each source's words are packed, in a fixed pseudorandom order of documents, into blocks of a fixed length. The output is a row of slots, cut into shards. Every slot
draws its source by its own pseudorandom number, so a shard's counts of sources are a multinomial draw at the target weights. Running sums of the counts over the
shards give each slot its place among all its source's slots. A source drawn more often than its target allows gives those last slots to the sources that were
drawn too seldom, so the totals meet the targets exactly. A place goes through its source's pseudorandom permutation to a block index, and slots join blocks by (source, index).
Nothing is ordered or numbered across a whole source: documents are placed by bucket and shards by group, with the sums of buckets and groups in small tables.

Defined cases: a null or blank text has no words and is never taken. A null source is a source, the last. Rows of one id each are
documents of their own. A corpus without words gives targets of 0. An empty table gives an empty result. Very long texts are many blocks. Columns besides the named ones are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, only

_NOT_SPACE = r"[^\\x20\\x09-\\x0D]"
ROUNDS = 10


def n_words(text: str = "text") -> Column:
    """The number of runs outside ASCII white space; 0 for null."""
    blank = f"btrim({text}, ' \\t\\n\\u000b\\f\\r')"
    return F.expr(f"if(coalesce({blank}, '') = '', 0L, cast(size(split({blank}, '[\\\\x20\\\\x09-\\\\x0D]+')) AS long))")


def permuted(x: str, n: str, key: str, rounds: int = ROUNDS) -> Column:
    """Where the pseudorandom permutation `key` of 0..n-1 puts x: swap-or-not rounds, which suit any n. All three are SQL expressions of longs."""
    partner = f"pmod(xxhash64({key}, r) - a, {n})"  # the same offset for all of a round, so partners are mutual
    swap = f"(xxhash64({key}, r, greatest(a, {partner})) & 1) = 1"
    return F.expr(f"aggregate(sequence(1, {rounds}), {x}, (a, r) -> if({swap}, {partner}, a))")


@dataclass
class Mix:
    """documents: id, source, sid, digest, size, source_size, target, start (of its words in the source); sources: one row each; counts: shard, sid, n, the sources drawn by each shard;
    taken: sid, start, pass, from_word, words, shard, slot."""

    documents: DataFrame
    sources: DataFrame
    counts: DataFrame
    taken: DataFrame


def water_filled(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Adds sid (rank by code point, null last), weight and target to source, source_size.

    share times all sizes is dealt by weight, but at most cap times its size to a source; what that leaves over is dealt again by weight. The common
    level per weight is found by one ordered pass over the sources, a table of one row per source.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("sid", F.row_number().over(w).cast("long"))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("sid") - 1, F.lit(len(weights))).cast("int") + 1))
    s = s.withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("most") / F.col("weight"))
    by = Window.orderBy("ratio", "sid")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("all_words", F.sum("source_size").over(everything))
    s = s.withColumn("level", (F.col("all_words") * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sid", "level"))).over(everything)["level"])
    return s.withColumn("target", F.coalesce(F.least(F.col("most"), F.col("level") * F.col("weight")), F.col("most"))).select("source", "source_size", "sid", "weight", "target")


def _owner(places: DataFrame, ranges: DataFrame, cell: int) -> DataFrame:
    """places (slot, shard, place) with the columns of the range (first, slots) that holds their place.

    Both are dealt by cells of places, where a range begins again in each cell it meets, and each place takes the range that began last: linear, however many ranges a cell has.
    """
    fields = [c for c in ranges.columns if c not in ("first", "slots")]
    starts = ranges.withColumn("cell", F.explode(F.expr(f"sequence(first div {cell}, (first + slots - 1) div {cell})")))
    begun = F.struct("first", "slots", *fields)
    none = F.lit(None).cast("long")
    starts = starts.select("cell", F.greatest("first", F.col("cell") * cell).alias("place"), begun.alias("own"), none.alias("slot"), none.alias("shard"))
    own = places.select(F.expr(f"place div {cell}").alias("cell"), "place", F.lit(None).cast(starts.schema["own"].dataType).alias("own"), "slot", "shard")
    before = Window.partitionBy("cell").orderBy("place", F.col("slot").asc_nulls_first())
    met = starts.unionByName(own).withColumn("own", F.last("own", ignorenulls=True).over(before)).filter("slot IS NOT NULL AND place >= own.first AND place < own.first + own.slots")
    return met.select("slot", "shard", "place", "own.first", *[f"own.{c}" for c in fields])


def _running(counts: DataFrame, group: int = 1024) -> DataFrame:
    """(shard, sid, before): the sum of n over the source's earlier shards, by groups of shards and inside them."""
    own = counts.withColumn("group", F.expr(f"shard div {group}"))
    groups = own.groupBy("sid", "group").agg(F.sum("n").alias("n"))
    groups = groups.select("sid", "group", (F.sum("n").over(Window.partitionBy("sid").orderBy("group")) - F.col("n")).alias("base"))
    inside = own.withColumn("inside", F.sum("n").over(Window.partitionBy("sid", "group").orderBy("shard")) - F.col("n"))
    return inside.join(groups, ["sid", "group"]).select("shard", "sid", (F.col("base") + F.col("inside")).alias("before"))


def _settled(dealt: DataFrame, sources: DataFrame, cell: int) -> DataFrame:
    """dealt (slot, shard, sid, i) with i below the source's slots: what is beyond goes, in order, to the sources that have got less than their slots."""
    w = Window.orderBy("sid")  # one row per source
    over, under = F.greatest(F.col("got") - F.col("slots"), F.lit(0)), F.greatest(F.col("slots") - F.col("got"), F.lit(0))
    s = sources.withColumn("over", over).withColumn("under", under)
    s = s.withColumn("over_base", F.sum("over").over(w) - F.col("over")).withColumn("first", F.sum("under").over(w) - F.col("under"))
    own = dealt.join(s.select("sid", F.col("slots").alias("most"), "over_base"), "sid")
    beyond = own.filter("i >= most").select("slot", "shard", (F.col("over_base") + F.col("i") - F.col("most")).alias("place"))
    takers = s.filter("under > 0").select("sid", "first", F.col("under").alias("slots"), F.col("got").alias("had"))
    moved = _owner(beyond, takers, cell).select("slot", "shard", "sid", (F.col("had") + F.col("place") - F.col("first")).alias("i"))
    return own.filter("i < most").select("slot", "shard", "sid", "i").unionByName(moved)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block: int = 64, shard_slots: int = 4096, seed: int = 17, bucket_docs: int = 4_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> Mix:
    """The mix of a corpus as spans of words of documents, each with its place in the output.

    block: words in a block, the grain of the mix; shard_slots: blocks in an output shard; bucket_docs: how many documents of a bucket are numbered together.
    """
    spark = docs.sparkSession
    slim = only(docs, id_col, source_col, text_col).toDF("id", "source", "text").select("id", "source", F.xxhash64("text").alias("digest"), n_words().alias("size"))
    slim = materialize(slim, "mix-sizes")
    buckets = max(1, slim.count() // bucket_docs)
    sources = water_filled(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long"))
    sources = sources.withColumn("slots", F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")), F.floor(F.lit(float(cap)) * F.col("blocks")))).otherwise(0).cast("long"))
    w = Window.orderBy("sid")
    sources = materialize(sources.withColumn("first_slot", F.sum("slots").over(w) - F.col("slots")).withColumn("all_slots", F.sum("slots").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))), "mix-sources")

    placed = slim.join(sources.drop("slots", "first_slot", "all_slots", "blocks", "weight").withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("id", "digest", F.lit(seed)), F.lit(buckets)).cast("long"))  # the digest parts rows without an id
    totals = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    totals = totals.select("sid", "bucket", (F.sum("words").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("words")).alias("base"))
    inside = Window.partitionBy("sid", "bucket").orderBy("id", "size", "digest").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("upto", F.sum("size").over(inside)).join(totals, ["sid", "bucket"])
    placed = materialize(placed.withColumn("start", F.col("base") + F.col("upto") - F.col("size")).drop("base", "upto", "bucket"), "mix-places")

    all_slots = sources.agg(F.max("all_slots")).first()[0] or 0
    drawn = spark.range(all_slots).select(F.col("id").alias("slot"), F.expr(f"id div {shard_slots}").alias("shard"), F.expr(f"pmod(xxhash64({seed}L, id), {max(all_slots, 1)}L)").alias("place"))
    drawn = _owner(drawn, sources.filter("slots > 0").select("sid", F.col("first_slot").alias("first"), "slots"), shard_slots).select("slot", "shard", "sid")
    drawn = materialize(drawn, "mix-drawn")
    counts = materialize(drawn.groupBy("shard", "sid").agg(F.count("*").alias("n")), "mix-counts")
    before = _running(counts)
    inside = Window.partitionBy("shard", "sid").orderBy("slot")  # a shard's slots at most
    dealt = drawn.withColumn("i", F.row_number().over(inside) - 1).join(before, ["shard", "sid"]).select("slot", "shard", "sid", (F.col("i") + F.col("before")).alias("i"))
    totals = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    dealt = _settled(dealt, sources.select("sid", "slots").join(totals, "sid", "left").select("sid", "slots", F.coalesce("got", F.lit(0).cast("long")).alias("got")), shard_slots)
    dealt = dealt.join(sources.select("sid", "blocks"), "sid").select("slot", "shard", "sid", F.expr("i div blocks").alias("pass"), permuted("pmod(i, blocks)", "blocks", f"{seed + 1}L, sid").alias("index"))

    pieces = placed.filter("size > 0").select("sid", "start", "size", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("index"))
    pieces = pieces.select("sid", "index", "start", F.expr(f"greatest(index * {block}, start) - start").alias("from_word"), F.expr(f"least((index + 1) * {block}, start + size) - greatest(index * {block}, start)").alias("words"))
    taken = pieces.join(dealt, ["sid", "index"]).select("sid", "start", "pass", "from_word", "words", "shard", "slot")
    return Mix(placed, sources, counts, taken)


def taken_words(m: Mix, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, size, source, source_size, target and taken, the words the mix takes of it, repeats counted."""
    sums = m.taken.groupBy("sid", "start").agg(F.sum("words").alias("words"))
    out = m.documents.withColumn("start", F.when(F.col("size") > 0, F.col("start"))).join(sums, ["sid", "start"], "left")
    return out.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", F.coalesce("words", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame, m: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The columns of docs, a row for each document and pass of the mix over it, with the words taken in that pass, their white space kept.

    A document taken whole keeps its text but for white space at its end; one that isn't taken has no row.
    """
    keys = [F.coalesce(F.col("id"), F.lit(-(1 << 63))), F.col("digest"), F.col("source").isNull(), F.coalesce(F.col("source"), F.lit(""))]
    spans = m.taken.groupBy("sid", "start", "pass").agg(F.array_sort(F.collect_list(F.struct("from_word", "words"))).alias("spans"))
    spans = spans.join(m.documents.filter("size > 0"), ["sid", "start"]).withColumn("key", F.struct(*keys))
    spans = spans.groupBy("key").agg(F.collect_list("spans").alias("rows"))
    names, work = docs.columns, "_quillmill_"
    own = docs.withColumn(f"{work}key", F.struct(F.coalesce(docs[id_col], F.lit(-(1 << 63))), F.xxhash64(docs[text_col]), docs[source_col].isNull(), F.coalesce(docs[source_col], F.lit(""))))
    own = own.dropDuplicates([f"{work}key"])  # equal rows come back below, as many as the mix takes
    spans = spans.withColumnRenamed("rows", f"{work}rows").withColumnRenamed("key", f"{work}k")
    out = own.join(spans, own[f"{work}key"] == spans[f"{work}k"]).withColumn(f"{work}row", F.explode(f"{work}rows"))
    # the words are bound to w once a row: inlined into the inner lambda they would be found again for each span
    words = f"regexp_extract_all(`{text_col}`, '[\\\\x20\\\\x09-\\\\x0D]*{_NOT_SPACE}+', 0)"
    text = F.expr(f"transform(array({words}), w -> array_join(transform({work}row, s -> array_join(slice(w, cast(s.from_word AS int) + 1, cast(s.words AS int)), '')), ''))[0]")
    out = out.withColumn(text_col, text)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*[out[f"`{n}`"] for n in names])
