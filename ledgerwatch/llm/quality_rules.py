"""Quality rules by host: counts per document, failure rates per host shrunk to a beta prior, verdicts joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.store import BLANK, null_last, stored, text_of

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
HOST_LIMIT = 0.3
RULES = ("fails_base", "fails_symbols", "fails_lines", "fails_length")
# Fixed value: the characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"


def word_array(text: Column) -> Column:
    """The words of a text in order; an empty array for a text without words."""
    return F.filter(F.split(text, BLANK), lambda w: w != F.lit(""))


def windows(words: Column) -> Column:
    """A 64-bit hash of every window of five words, by position."""
    count = F.size(words) - F.lit(WINDOW)
    at = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    return F.when(count >= 0, F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(0))), at)).otherwise(F.array().cast("array<long>"))


def document_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", row: Column | None = None) -> DataFrame:
    """id, host key and the counts of every row, by built-in functions alone."""
    t = text_of(docs, text)
    carried = [row.alias("row")] if row is not None else []
    first = docs.select(docs[id_col].alias("id"), null_last(docs[host]).alias("host"), t.alias("t"), *carried)
    second = first.withColumn("words", word_array(F.col("t")))
    third = second.select(
        "id",
        "host",
        *(["row"] if row is not None else []),
        F.size("words").cast("long").alias("n_words"),
        (F.length("t") - F.regexp_count("t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        windows(F.col("words")).alias("hashes"),
    )
    fourth = third.withColumn("again", F.size(F.array_distinct("hashes")) < F.size("hashes"))
    fourth = fourth.withColumn("ordered", F.when(F.col("again"), F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    fourth = fourth.withColumn("places", F.sort_array(F.transform(F.filter("ordered", _same_as_neighbour), lambda x: x["i"])))
    next_place = lambda i: F.coalesce(F.get("places", i + 1), F.lit(2147483647))
    covered = F.aggregate(
        F.transform("places", lambda p, i: F.least(F.lit(WINDOW), next_place(i) - p)), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return fourth.select(
        "id",
        "host",
        *(["row"] if row is not None else []),
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _same_as_neighbour(x: Column, i: Column) -> Column:
    n = F.size("ordered")
    before = (i > 0) & (F.get("ordered", i - 1)["h"] == x["h"])
    after = (i < n - 1) & (F.get("ordered", i + 1)["h"] == x["h"])
    return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))


def failures(counts: DataFrame) -> DataFrame:
    """Adds one boolean per rule: base, symbols, repeated lines, length of words."""
    n = F.col("n_words")
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n)
    return counts.withColumns(
        {
            "fails_base": base,
            "fails_symbols": 10 * F.col("n_symbols") > n,
            "fails_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
            "fails_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        }
    )


def host_rates(failed: DataFrame) -> DataFrame:
    """host, n_docs, and per rule the failure rate of the host shrunk to a beta prior fitted to all hosts by moments.

    With rates r of hosts weighted by their documents, mean m and variance v, the prior has strength m(1-m)/v - 1, kept
    between 1 and a million. A rule that every host fails alike, or nobody fails, is shrunk to the common rate.
    """
    hosts = stored(failed.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *[F.count_if(r).alias(r) for r in RULES]), "host-failures")
    rate = {r: F.col(r) / F.col("n_docs") for r in RULES}
    total = F.sum("n_docs")
    moments = [F.try_divide(F.sum(r), total).alias(f"mean_{r}") for r in RULES]
    moments += [F.try_divide(F.sum(F.col("n_docs") * rate[r] * rate[r]), total).alias(f"square_{r}") for r in RULES]
    common = hosts.agg(*moments).first()
    shrunk = []
    for r in RULES:
        mean = common[f"mean_{r}"] or 0.0
        variance = (common[f"square_{r}"] or 0.0) - mean * mean
        strength = min(1e6, max(1.0, mean * (1 - mean) / variance - 1)) if variance > 1e-12 else 1e6
        shrunk.append(((F.col(r) + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))).alias(f"rate_{r}"))
    return hosts.select("host", "n_docs", *shrunk)


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", host_limit: float = HOST_LIMIT, row: Column | None = None) -> DataFrame:
    """Counts, rule failures, host_rate and kept for every row of `docs`.

    A document that fails the base rules goes. Of the others, one goes if it fails a rule that its host fails at a shrunk
    rate above `host_limit`: a single odd document of a good host is kept, the same in a host full of them is not, and a
    document that fails nothing is kept in any host.

    Null or empty text: no words, so it fails the base rules. Null host: a host of its own. Null id, repeated rows: each
    row is judged by itself and counts for its host. Empty input: empty result.
    """
    failed = stored(failures(document_counts(docs, id_col, text, host, row)), "document-counts")
    joined = failed.join(host_rates(failed), "host")
    worst = F.greatest(*[F.when(F.col(r), F.col(f"rate_{r}")).otherwise(F.lit(0.0)) for r in RULES[1:]])
    return joined.withColumn("host_rate", worst).withColumn("kept", ~F.col("fails_base") & (F.col("host_rate") <= host_limit))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with the columns of `docs`."""
    return judge(docs, row=F.struct(*[docs[c] for c in docs.columns])).filter("kept").select("row.*")


def quality_report(docs: DataFrame) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judge(docs).select(F.col("id").alias("doc_id"), *names, F.col("fails_base").alias("base_failed"), "kept")
