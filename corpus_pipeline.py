"""A corpus pipeline: language, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolake.llm import jaccard, language, packing, scratch, toxicity
from tempolake.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Bits per letter above which no learned language explains a text. Text in a learned language
#: takes two to five, also with addresses or codes in it; that in an unknown script takes all
#: the bits of a phrase, about fifteen.
FOREIGN_BITS = 6.5
#: Bits that any text may take besides, about two phrases: a few letters tell little. Of 256,410
#: documents in learned languages none took more, of 12 to 20,000 words.
SPARE_BITS = 30


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts in a language that the labelled ones teach.

    Rejected are texts without a letter (null and empty ones, too) and those that no learned
    language explains. Without a labelled text nothing can be told apart and only texts without
    a letter go. Each row is judged on its own whole text, so repeated rows stay or go together;
    an empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    model = language.train(docs)
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = language.identify(docs, model)
    foreign = F.col("bits_per_letter") > FOREIGN_BITS + SPARE_BITS / F.length("text")
    return found.filter((F.col("lang_pred") != language.UNDETERMINED) & ~foreign).select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that a model of the labelled ones doesn't predict as toxic.

    Null and empty texts have the share of toxic texts in training as their score, so they stay
    unless most are toxic. Each row is scored on its own whole text, so repeated rows stay or go
    together. Without a labelled text all stay; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, labels)
    return toxicity.score(docs, model).filter(F.col("predicted") == 0).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that shares 0.8 of its five-word shingles.

    The one with the smallest doc_id stays, once. Rows without doc_id or words are in no group
    and stay, but for rows that are repeated in full. When a doc_id stands for several texts,
    these stay if one of them does.
    """
    docs = docs.select(*COLUMNS)
    groups = jaccard.join(docs, words=5, percent=80, links=False)
    stays = (F.col("n_shingles") == 0) | (F.col("doc_id") == F.col("component_id"))
    verdicts = (
        groups.filter("doc_id is not null").groupBy("doc_id").agg(F.max(stays).alias("stays"))
    )
    joined = docs.join(verdicts, "doc_id", "left").filter(F.coalesce("stays", F.lit(True)))
    # Whole rows are compared, nulls included, and combined before they are shuffled.
    return joined.select(*COLUMNS).dropDuplicates(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences.

    Null and empty texts are the closing id alone; a long text is cut into pieces. Every row is
    packed, repeated rows each on their own, and an empty table gives no pieces.
    """
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

#: Learned and tokenised stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
