"""A training corpus in five stages: language, toxicity, near duplicates, benchmark leaks, mixture.

Each stage takes the rows that its predecessor kept and decides on them alone. All but the last return the columns of
``documents``; ``run`` writes each stage to the shared folder and reads it again for the next.

Defined cases are those of the operators. Rows without a text or without a letter go in the first stage; a row whose
doc_id is NULL passes the stages like any other; of rows that repeat, one stays in the third stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.llm.common import few_rows_at_a_time, stored, table, words
from basinspark.llm.decontamination import with_leaks
from basinspark.llm.language_spans import UNKNOWN, fit_languages, identified
from basinspark.llm.mixing import mixed
from basinspark.llm.ngram_join import near_duplicates
from basinspark.llm.toxic_spans import fit_toxicity, toxicity_scored
from basinspark.session import broadcast_if_small

#: A text goes when less than this share of its letters is surely in one learned language.
LEAST_LANGUAGE_SCORE = 0.5
TOXIC_SCORE = 0.5


def without_text(docs: DataFrame) -> list[Column]:
    """All columns but the text as one, which keeps their names apart from those of an operator; the text goes beside it."""
    return [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row")]


def restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents from ``_row`` and ``_text``."""
    return rows.select(*[(F.col("_text") if c == "text" else F.col("_row").getField(c)).alias(c) for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts of a learned language; where no row has a language, nothing can be judged and all rows stay."""
    model = fit_languages(docs)
    if not model.languages:
        return docs
    rows = identified(docs, model, without_text(docs), keep_text=True)
    return restored(rows.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)), docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that the labelled ones among the rows say are toxic."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    rows = toxicity_scored(docs, model, without_text(docs), keep_text=True)
    return restored(rows.where(F.col("score") < TOXIC_SCORE), docs.columns)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the one with the smallest doc_id stays; texts without words all stay.

    Where ids repeat or are NULL, rows are told apart by numbers of their own, and of a group's rows with the smallest id
    the one that comes first by a hash of its columns stays.
    """
    members = near_duplicates(docs.select("doc_id", "text"))
    if members.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return staying(docs, members.select("doc_id", (F.col("doc_id") == F.col("component_id")).alias("_stays")), "doc_id")
    numbered, _ = stored(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*docs.columns).alias("_doc")), "numbered")
    members = near_duplicates(numbered.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text")))
    facts = numbered.select("_row", F.col("_doc.doc_id").alias("id"), F.xxhash64("_doc").alias("hash"))
    placed = facts.join(members.select(F.col("doc_id").alias("_row"), "n_shingles", "component_id"), "_row")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "hash", "_row")
    first = placed.where("n_shingles > 0").groupBy("component_id").agg(F.min(order)["_row"].alias("_row")).select("_row", F.lit(True).alias("_first"))
    kept = F.coalesce("_first", F.col("n_shingles") == 0)
    marked, _ = stored(placed.select("_row", "n_shingles").join(first, "_row", "left").select("_row", kept.alias("_stays")), "marked")
    return staying(numbered, marked, "_row").select("_doc.*")


def staying(docs: DataFrame, marked: DataFrame, key: str) -> DataFrame:
    """The rows whose key is marked ``_stays``; every row has a key of its own, and ``marked`` is a written table.

    The shorter of the lists of staying and going keys meets the rows, broadcast if it is small, so that texts are not shuffled.
    """
    lists = [marked.where("_stays").select(key), marked.where("NOT _stays").select(key)]
    how, keys = min(zip(("left_semi", "left_anti"), lists, strict=True), key=lambda x: x[1].count())
    return docs.join(broadcast_if_small(keys), key, how).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that hold a passage of a benchmark item."""
    rows = with_leaks(docs, table(spark, sf_dir, "benchmark"), without_text(docs), keep_text=True)
    return restored(rows.where(F.coalesce(F.size("leaks"), F.lit(0)) <= 0), docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of every text."""
    rows = mixed(docs, "doc_id", F.size(words(F.col("text"))), F.array("source"))
    return rows.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


STAGES = [
    ("language", language),
    ("toxicity", toxicity),
    ("duplicates", duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

#: Four of the five stages fit models or align texts, which SQL cannot express; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with few_rows_at_a_time(spark):
            docs, _ = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
