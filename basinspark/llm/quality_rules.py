"""Quality rules with cross-document line frequency, in DataFrame functions alone.

Lines are normalised (lower case, digits dropped, white space collapsed) and hashed together with their host. Per host
the *distinct texts* that hold a line are counted, so exact copies count once. Lines above the host's limit are
removed, and a document that loses more than its share of word characters is rejected as depleted.

Defined cases: a NULL text is an empty one; a NULL host is a host of its own; repeated rows get equal results and
count as one text; a line without a word is never counted or removed; an empty table gives no rows. Other columns of
the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.llm.common import SPACE_RUN, let, stored, words

WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class LineLimits:
    """A line is removed when more than ``max(documents, share of the host's texts)`` texts of its host hold it."""

    documents: int = 20
    share: float = 0.005
    removed: float = 0.5  # a document is depleted when it loses more than this share of its word characters


def covered_words(tokens: Column) -> Column:
    """Words inside 5-word windows that occur at least twice in the array."""

    def covered(pairs: Column) -> Column:
        again = F.filter(
            pairs,
            lambda x, i: ((i > 0) & (F.get(pairs, i - 1)["h"] == x["h"])) | F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False)),
        )
        starts = F.sort_array(F.transform(again, lambda x: x["i"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, x: F.struct((acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n"), x.alias("last")),
            lambda acc: acc["n"],
        )

    def repeated(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(pairs, covered))

    # element by element: slice() would copy the whole array for every window
    windows = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - WINDOW), lambda i: F.xxhash64(*(F.get(tokens, i + k) for k in range(WINDOW)))
    )
    return F.when(F.size(tokens) < WINDOW, F.lit(0)).otherwise(let(windows, repeated))


def base_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: word, symbol and repetition counts, whether they fail, and the keys of its text and host."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(host)).alias("host_key"),
        F.xxhash64(body).alias("text_key"),
        body.alias("_text"),
        words(F.col(text)).alias("_words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD_CHARACTER)).alias("_lines"),
    )
    counts = rows.select(
        "doc_id",
        "host_key",
        "text_key",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered_words(F.col("_words")).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def normalised(line: Column) -> Column:
    """Lower case, digits dropped, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", ""), SPACE_RUN, " "))


def keyed_lines(text: Column, host: Column) -> Column:
    """Distinct (line key, word characters) pairs of a text; the key covers the host too."""
    with_words = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(WORD_CHARACTER))
    return F.array_distinct(
        F.transform(
            with_words,
            lambda line: F.struct(
                F.xxhash64(host, normalised(line)).alias("line_key"),
                F.length(F.regexp_replace(line, SPACE_RUN, "")).alias("chars"),
            ),
        )
    )


def line_table(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """One row per host, distinct text and distinct line."""
    rows = docs.select(
        F.xxhash64(F.col(host)).alias("host_key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
        F.explode(keyed_lines(F.col(text), F.col(host))).alias("line"),
    )
    return (
        rows.select("host_key", "text_key", "line.line_key", "line.chars")
        .groupBy("host_key", "text_key", "line_key")
        .agg(F.max("chars").alias("chars"))
    )


def frequent_lines(lines: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Keys of the lines that more texts of their host hold than the limits allow.

    The texts of a host are those with a line of a word, counted from one marked line each, so no text is read again.
    """
    per_line = lines.groupBy("host_key", "line_key").agg(F.count(F.lit(1)).alias("texts"))
    per_host = (
        lines.groupBy("host_key", "text_key").agg(F.lit(1).alias("one")).groupBy("host_key").agg(F.count("one").alias("host_texts"))
    )
    often = per_line.where(F.col("texts") > limits.documents).join(per_host, "host_key")
    return often.where(F.col("texts") > limits.share * F.col("host_texts")).select("line_key", "texts")


def line_losses(lines: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Per host and text: word characters of its distinct lines, and those in lines above the limits."""
    frequent = frequent_lines(lines, limits)
    gone = F.col("texts").isNotNull()
    return (
        lines.join(frequent, "line_key", "left")
        .groupBy("host_key", "text_key")
        .agg(
            F.sum("chars").alias("line_chars"),
            F.sum(F.when(gone, F.col("chars")).otherwise(0)).alias("removed_chars"),
            F.sum(F.when(gone, 1).otherwise(0)).alias("removed_lines"),
            F.collect_set(F.when(gone, F.col("line_key"))).alias("removed_keys"),
        )
    )


def quality_verdicts(
    docs: DataFrame, limits: LineLimits = LineLimits(), doc_id: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """One row per input row with the base counts, the removed lines and whether the document is kept.

    The line table (keys and lengths, no text) is written to the shared folder when the query is built, as three
    aggregates read it.
    """
    lines, _ = stored(line_table(docs, text, host), "lines")
    losses = line_losses(lines, limits).drop("removed_keys")
    joined = base_rules(docs, doc_id, text, host).join(losses, ["host_key", "text_key"], "left")
    depleted = F.coalesce(F.col("removed_chars") > limits.removed * F.col("line_chars"), F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"),
        F.coalesce("removed_lines", F.lit(0)).cast("long").alias("removed_lines"),
        F.coalesce("removed_chars", F.lit(0)).cast("long").alias("removed_chars"),
    )


def without_frequent_lines(docs: DataFrame, limits: LineLimits = LineLimits(), text: str = "text", host: str = "source") -> DataFrame:
    """The input with the lines above the limits taken out of every text; all columns and rows stay."""
    losses = line_losses(line_table(docs, text, host), limits).where(F.col("removed_lines") > 0)
    losses = losses.select(F.col("host_key").alias("_host"), F.col("text_key").alias("_key"), F.col("removed_keys").alias("_gone"))
    on = (F.xxhash64(F.col(host)) == F.col("_host")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("_key"))
    joined = docs.join(losses, on, "left")
    kept = F.filter(
        F.split(F.col(text), "\n"),
        lambda line: ~(line.rlike(WORD_CHARACTER) & F.array_contains(F.col("_gone"), F.xxhash64(F.col(host), normalised(line)))),
    )
    cleaned = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(text, cleaned).select(*docs.columns)
