"""A corpus from raw documents to packed sequences.

Each stage takes what its predecessor kept, as a table read from the shared folder,
and returns the columns of documents; the last one returns the packing. Nulls, empty
texts and repeated rows are treated as the operator of the stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import numbered, read, written
from stratalake.llm.decontaminate import all_leaks
from stratalake.llm.language_id import UNKNOWN, held_out, identify, learn
from stratalake.llm.packing import pack_documents
from stratalake.llm.pii import redact, text_key
from stratalake.llm.simhash_golay import near_duplicates

# Texts of which fewer n-grams belong to their language are no text of any; clean ones have far more.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    filters = learn(docs.filter(~held_out()))
    if not filters.languages:
        return docs
    rows, names = numbered(docs)
    judged = identify(rows, filters, names["text"])
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.drop("lang_pred", "score").toDF(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: of those with the smallest id, that of the least digest over all columns."""
    rows, names = numbered(docs)
    doc_id, text = F.col(names["doc_id"]), F.col(names["text"])
    others = F.struct(*[n for n in rows.columns if n != names["text"]], text.isNull().alias("no_text"))
    keyed = rows.withColumn("_key", F.md5(F.concat_ws(":", text_key(text), F.to_json(others))))
    groups = near_duplicates(keyed.select(doc_id.alias("doc_id"), F.col("_key").alias("key"), text.alias("text")))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    kept = written(groups.groupBy("root").agg(first.alias("_f")).select(F.col("_f.key").alias("_kept")), "kept")
    # Texts are dealt once: rows equal in all columns meet where the join has put them.
    one = keyed.join(kept.hint("merge"), F.col("_key") == F.col("_kept"), "left_semi")
    return one.dropDuplicates(["_key"]).drop("_key").toDF(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    keyed = docs.select(text_key(F.col("text")).alias("key"), "text")
    leaks = written(all_leaks(keyed, read(spark, sf_dir, "benchmark"), "key").select("key").distinct(), "leaks")
    rows, names = numbered(docs)
    return rows.join(leaks, text_key(F.col(names["text"])) == F.col("key"), "left_anti").toDF(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the text."""
    changed = redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicate),
    ("benchmark decontamination", decontaminated),
    ("PII", without_personal_data),
    ("best-fit packing", packed),
]
# No stage but the third and the fourth's base rules can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
