"""The corpus pipeline: toxic and unreadable documents go, near copies go, the rest is mixed and packed.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipwire.llm import langid, mixing, packing, simhash, toxicity
from clipwire.llm.common import fold, joined_apart, stored, table
from clipwire.llm.queries import MIX_WEIGHTS, tokenizer_path

#: From this probability on a document is toxic.
TOXIC = 0.5
#: Times that a document may stand in the mixture.
EPOCHS = 2
#: Under this probability a document's language is not clear.
CLEAR = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, as they are; the model learns from the labels."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return docs.where(toxicity.scorer(model)("text") < TOXIC)


def keep_clear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the known languages; texts without letters or of no clear language go."""
    network = langid.fit(docs, fold(F.col("doc_id"), 4) != 2)
    found = langid.predictor(network)("text")
    known = F.when(found["lang_pred"] != langid.UNDETERMINED, found["score"]).otherwise(0.0)
    return docs.where(known >= CLEAR)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id, and one row of it.

    Near copies are what ``op10`` links, fingerprints of 64 bits that differ in four at most, and besides
    these texts whose shingles are alike, see ``near_duplicates``; what either joins is one group.
    Groups go by their texts alone, so each keeps exactly one row, whatever its ids are: rows
    with equal or null ids stay if their texts are no near copies. A null id comes last.
    """
    columns = [docs[c] for c in docs.columns]
    row = F.xxhash64(*columns, *[c.isNull() for c in columns])
    groups = simhash.joined_groups(
        simhash.near_groups(docs, row), simhash.near_groups(docs, row, simhash.BY_BITS)
    )
    one = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("one")
    first = groups.groupBy("root").agg(one).select(
        F.col("one.doc_id").alias("first_id"), F.col("one.row").alias("first_row")
    )
    ranked = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").alias("id"), row.alias("hash"))
    kept = ranked.join(
        first, ranked["id"].eqNullSafe(first["first_id"]) & (ranked["hash"] == first["first_row"]), "left_semi"
    )
    once = W.partitionBy("id", "hash").orderBy("hash")
    return kept.withColumn("n", F.row_number().over(once)).where("n = 1").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mixture of as many tokens as there are, by the target weights, in up to two epochs.

    So weights bind wherever a source holds half of its target: its documents come once or twice,
    those of sources over their target in part. Documents are rows, told apart by all their
    columns; rows that are equal in all come and go together. Whole documents are taken, the
    last of a leaf too. Documents without a word are none of the mixture.
    """
    columns = [docs[c] for c in docs.columns]
    row = F.xxhash64(*columns, *[c.isNull() for c in columns])
    keyed = docs.select(row.alias("doc_id"), "text", "lang", "source")
    taken = mixing.mix(keyed, F.col("total"), MIX_WEIGHTS, epochs=EPOCHS, seed=7)
    times = taken.groupBy("doc_id").agg(F.count("*").cast("int").alias("times"))
    whole = docs.select(F.struct(*columns).alias("row"), row.alias("doc_id"))
    mixed = joined_apart(whole, times, "doc_id")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of documents in sequences."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_clear_language),
    ("near duplicates", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
