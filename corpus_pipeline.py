"""The corpus pipeline: quality, near duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir), docs being what its predecessor kept, and returns the columns of documents,
but for the last, which returns the packed pieces. run() writes each stage's rows to the shared folder and reads them
again for the next one; a table goes once its successor is written. Labels come from sf_dir; everything else is learnt from docs.

All stages: a null or empty text is a document like any other, a null doc_id stays null, an empty table gives an empty
result, other columns of any name stay up to the last stage, and a very long text is treated whole. Stage by stage:
  quality classifier   null and empty texts have the score of no words; repeated rows and ties share their score and fate
  n-gram Jaccard join  texts without words link with nothing and stay, repeated or not; of repeated rows with words one stays; of
                       linked rows that of the smallest id, ids before none, of one id that of the smallest hash of its text
  personal data        every row stays; a null text stays null, n_chars is the new text's
  mixing sources       texts without words are never taken; null sources are one; repeated rows are taken together or not at all
  best-fit packing     a null or empty text is its end id; repeated rows are packed as often as they come
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgrid.llm import common, jaccard, mixing, packing, pii, quality


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble gives a chance of THRESHOLD or more."""
    model = quality.train(docs, common.read(spark, sf_dir, "labels"))
    return docs.where(model.chance("text") >= quality.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked at a shingle similarity of 0.8."""
    return jaccard.one_of_each(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data generalised to its kind, terms that give it away removed; n_chars is the new text's."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    added = ("size", "source_size", "target", "copies")
    clashing = [c for c in docs.columns if c.lower() in added]
    aside = dict(zip(clashing, common.free_name(docs, *(f"kept_{c}" for c in clashing)), strict=True))
    mixed = mixing.mix(docs.withColumnsRenamed(aside))
    mixed = mixed.withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return mixed.drop(*added).withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("personal data", remove_personal_data),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

#: No stage can be told in SQL (a fitted model, components, co-occurrence, sampling, packing); tests/llm tests them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.read(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, now = common.written(stage(spark, docs, sf_dir))
        if before:
            common.removed(spark, before)
        before = now
    return STAGES[-1][1](spark, docs, sf_dir)
