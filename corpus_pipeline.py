"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
all but the last return the columns of ``documents``. Other columns of the
input, whatever their names, are left behind at the first stage. Texts of any
length are worked on whole, an empty table passes through every stage, and a
result is the same whatever order the rows come in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import latent, lines, packing, quality, simhash
from tramline.llm.common import removed, settled, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a base rule or the likelihood ratio.

    Null and empty texts fail the base rules; a null id is judged like any
    other but never trusted; repeated rows are judged alike, each on its own; a
    score at the threshold stays; without labels only the base rules drop."""
    return quality.drop_rejected(docs.select(*COLUMNS), quality.trusted_ids(table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes aligned common blocks from later documents; a document of which
    nothing is left goes. ``n_chars`` follows the text.

    Null and empty texts have nothing to lose and stay as they are; rows without
    an id neither lose nor remove lines; rows repeated under one id do not
    remove each other's; of documents with one id the smaller hash is earlier."""
    found = lines.dedup_lines(docs.select(*COLUMNS))
    whole = F.col("gone").isNull()
    left = found.where(whole | (F.trim(F.translate("kept", "\t\n\x0b\x0c\r", "     ")) != ""))
    chars = F.when(whole, F.col("doc.n_chars")).otherwise(F.length("kept")).cast("long")
    return left.select("doc.doc_id", F.col("kept").alias("text"), "doc.lang", "doc.source", chars.alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash group.

    Null and empty texts are copies of each other; rows without an id stay, as
    they cannot be told apart; rows repeated under one id stay or go together."""
    return simhash.drop_near_duplicates(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item.

    Null and empty texts leak nothing; rows without an id stay; rows repeated
    under one id go together if one leaks; an empty benchmark drops nothing."""
    return latent.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of several permitted lengths.

    Null and empty texts take no room and give no row; rows without an id and
    repeated rows are packed each; ties between lengths go by a hash of id and
    piece."""
    return packing.best_fit(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the hashed model, the alignment nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each result written and read again. What a
    stage wrote goes once the next one's result is there."""
    docs, folder = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, new = settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        removed(spark, *([folder] if folder else []))
        folder = new
    return STAGES[-1][1](spark, docs, sf_dir)
