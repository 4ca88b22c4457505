"""The registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwire.llm import (
    chat,
    fingerprints,
    infilling,
    langid,
    mixing,
    packing,
    personal,
    quality,
    resampling,
    sharding,
    simhash,
    toxicity,
    warc,
)
from clipwire.llm.common import fold, stored, table
from clipwire.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_weighted_sampling(spark, sf):
    return fingerprints.edited_pairs(table(spark, sf, "documents"))


#: Target weights of the mixture.
MIX_WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 4, "de": 3, "fr": 3, "es": 2},
}


@query
def op2_hierarchical_budgets(spark, sf):
    """Four fifths of all tokens, up to three epochs of a leaf."""
    budget = F.expr("total * 4 div 5")
    return mixing.mix(table(spark, sf, "documents"), budget, MIX_WEIGHTS, epochs=3, seed=7)


def tokenizer_path() -> str:
    """The vocabulary of the packing query, out of an installed package."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_cost_balanced_packing(spark, sf):
    docs = table(spark, sf, "documents")
    return packing.pack_documents(docs, tokenizer_path(), with_ids=False)


def learned_from(folds: int, held_out: int):
    """The rows that a model may learn from, by their fold."""
    return fold(F.col("doc_id"), folds) != held_out


@query
def op4_byte_cnn_language(spark, sf):
    docs = table(spark, sf, "documents")
    network = langid.fit(docs, learned_from(4, 2))
    held_out = ~learned_from(4, 2)
    return langid.identify(docs, network).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op5_boosted_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), learned_from(5, 0))
    held_out = ~learned_from(5, 0)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted)


@query
def op6_isolation_forest(spark, sf):
    return quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op8_chat_schema_fingerprint(spark, sf):
    control = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(-1).cast("long").alias("conv_id"),
                        F.lit(k).cast("long").alias("turn"),
                        F.lit(role).alias("role"),
                        F.lit(control).alias("text"),
                    )
                    for k, role in enumerate(("user", chat.ASSISTANT))
                ]
            )
        ).alias("r")
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    records = chat.records_of(rows.union(extra.select("r.*")))
    formatted = chat.format_turns(chat.canonical_turns(records))
    read = formatted.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        "layout",
        "schema_fingerprint",
    )
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )


@query
def op9_kd_tree_shards(spark, sf):
    placed = sharding.shard(table(spark, sf, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_simhash_tiles(spark, sf):
    found = simhash.near_duplicates(
        table(spark, sf, "documents"), shingle=4, words=1, radius=4, min_hashes=0
    )
    return found.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


@query
def op7_seekable_warc(spark, sf):
    folder = scratch_dir(spark, "warc")
    index = stored(warc.write_bundles(warc.records(table(spark, sf, "pages")), folder), "warc-index")
    read = warc.read_bundles(index, folder)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_importance_resampling(spark, sf):
    found = resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_fill_in_middle(spark, sf):
    made = infilling.fill_in_middle(table(spark, sf, "documents"))
    text = infilling.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


@query
def op13_skip_chain_personal_data(spark, sf):
    docs = table(spark, sf, "documents")
    found = personal.personal_data(docs, personal.fit(docs))
    number = [personal.number_of("base", k).alias(f"n_{kind}") for k, kind in enumerate(personal.KINDS)]
    digest = F.sha2(personal.told("base"), 256).alias("base_sha256")
    return found.select("doc_id", *number, digest, personal.told("spans").alias("spans"))
