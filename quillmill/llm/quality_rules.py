"""Quality rules judged by document and by host, with DataFrame expressions only.

Each document is measured inside its own row: repeated five-word windows are found by sorting the row's window hashes, so
no word ever leaves its row. Hosts are then one partial aggregation of rule failures; failure rates are shrunk towards an
empirical beta prior, so that a host of three documents isn't condemned by three failures, and the verdict goes back to
the documents by a join on the host.

Defined cases: a null or empty text has no words, fails the length rule and isn't kept. A null host is a host of its own. Repeated
rows count as often as they occur. An empty table gives an empty result. Columns besides the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import SPACE_CHARS, materialize, only

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rule -> SQL condition that fails a document; the first two are the base rules.
RULES = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
}


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: its id and host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    space = r"[\\x20\\x09-\\x0D]"
    t = only(docs, id_col, host_col, text_col).toDF("id", "host", "text").withColumn("text", F.coalesce("text", F.lit("")))
    t = t.select(
        "id",
        "host",
        F.length(F.translate("text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.expr(f"filter(split(text, '\\n'), l -> rlike(l, '[^\\\\x20\\\\x09-\\\\x0D]'))").alias("lines"),
        F.expr(f"transform(split(btrim(text, ' \\t\\n\\u000b\\f\\r'), '{space}+'), w -> xxhash64(w))").alias("words"),
    )
    t = t.select(
        "id",
        "host",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("if(word_chars = 0, 0L, cast(size(words) AS long))").alias("n_words"),
        F.expr(
            f"if(size(words) < {WINDOW}, array(), transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64("
            + ", ".join(f"words[i + {k}]" for k in range(WINDOW))
            + ")))"
        ).alias("windows"),
    )
    # the windows of a text without repeats, most texts, are never sorted
    t = t.withColumn(
        "sorted",
        F.expr("if(size(array_distinct(windows)) = size(windows), array(), array_sort(transform(windows, (h, i) -> struct(h AS h, i AS i))))"),
    )
    t = t.withColumn("at", F.expr("array_sort(transform(filter(sorted, (x, j) -> get(sorted, j - 1).h <=> x.h OR get(sorted, j + 1).h <=> x.h), x -> x.i))"))
    return t.select(
        F.col("id"),
        F.col("host"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.expr(f"aggregate(transform(at, (x, j) -> coalesce(least({WINDOW}, get(at, j + 1) - x), {WINDOW})), 0L, (a, b) -> a + b)").alias("n_repeat_words"),
    )


def host_rates(measured: DataFrame) -> DataFrame:
    """One row per host: n, and for each rule the failures f_<rule> and the rate r_<rule> shrunk towards the beta prior of all hosts.

    The prior has the mean of all documents and the spread of the hosts' rates beyond what sampling explains (method of moments,
    hosts weighted by size). It is five pairs of numbers, whatever the corpus: those go to the driver, nothing else does.
    """
    fails = {k: F.expr(f"cast(({cond}) AS long)") for k, cond in RULES.items()}
    hosts = measured.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"f_{k}") for k, c in fails.items()])
    wanted = [F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("n2")]
    wanted += [F.sum(f"f_{k}").alias(f"f_{k}") for k in RULES]
    wanted += [F.sum(F.col(f"f_{k}") * F.col(f"f_{k}").cast("double") / F.col("n")).alias(f"q_{k}") for k in RULES]
    total = hosts.agg(*wanted).first()
    for k in RULES:
        a, b = _beta_prior(total["hosts"], total["n"] or 0, total["n2"] or 0.0, total[f"f_{k}"] or 0, total[f"q_{k}"] or 0.0)
        hosts = hosts.withColumn(f"r_{k}", (F.col(f"f_{k}") + F.lit(a)) / (F.col("n") + F.lit(a + b)))
    return hosts


def _beta_prior(hosts: int, n: float, n2: float, fails: float, q: float) -> tuple[float, float]:
    """a and b by moments: q is the sum of fails^2 / n over hosts, n2 the sum of n^2."""
    if not n:
        return 0.5, 0.5
    mean = (fails + 0.5) / (n + 1.0)
    within = mean * (1 - mean)
    spread = q - 2 * mean * fails + mean * mean * n - (hosts - 1) * within
    room = n - n2 / n
    between = max(spread / room, 0.0) if room > 0 else 0.0
    size = min(max(within / between - 1, 2.0), 1000.0) if between > 0 else 1000.0
    return mean * size, (1 - mean) * size


def judge(docs: DataFrame, limit: float = 0.5, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The measures of each document with base_failed, host_rate (the worst shrunk rate of its host), host_failed and kept.

    A host fails if the shrunk rate of any rule is above `limit`. The hosts' table is joined by Spark's own choice: broadcast below its size
    threshold, else a sort-merge join, whose hot hosts adaptive execution splits; both sides are narrow rows without texts.
    """
    measured = materialize(measure(docs, id_col, text_col, host_col), "quality-rules")
    hosts = host_rates(measured).select(F.col("host").alias("of"), F.greatest(*[F.col(f"r_{k}") for k in RULES]).alias("host_rate"))
    out = measured.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left").drop("of")
    out = out.withColumn("base_failed", F.expr(" OR ".join(f"({RULES[k]})" for k in ("short", "repeats"))))
    out = out.withColumn("host_failed", F.col("host_rate") > F.lit(limit))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")).withColumnRenamed("id", id_col)
