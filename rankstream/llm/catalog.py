"""The registered corpus queries: each operator over its whole table, in the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankstream.llm import (
    chat, codes, decontaminate, html_text, packing, pii, quality_model, quality_rules, repeats, simhash,
    url_filter, warc, whitening,
)
from rankstream.llm.common import settle, table
from rankstream.llm.oracle import SQL as SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = "byte_bpe_50k.json"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


# The rules of the registered query.
RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


@query
def op1_redirect_url_filter(spark, sf_dir):
    return url_filter.judged(table(spark, sf_dir, "pages"), RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@query
def op2_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_boosted_quality(spark, sf_dir):
    return quality_model.scored(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "labels").select("doc_id", "quality"),
    )


@query
def op4_schema_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], rows.schema)
    made = chat.with_format(chat.conversation_records(rows.unionByName(extra)))
    read = made.select("conv_id", chat.read_back(F.col("formatted"), F.col("loss")).alias("r"))
    return read.select("conv_id", "r.*")


@query
def op5_harmonic_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op6_host_suffix_text(spark, sf_dir):
    texts = html_text.extracted(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op7_feistel_pseudonyms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, counts="replaced").select(
        "doc_id", "text",
        F.aggregate(F.map_values("replaced"), F.lit(0).cast("long"), lambda a, n: a + n)
        .alias("n_replaced"),
        *[F.col("replaced")[kind].alias(f"n_{kind}") for kind in pii.KINDS],
    )


@query
def op8_adaptive_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", quality_rules.statistics(F.col("text")).alias("counts")
    )
    judged = quality_rules.judge(docs, measured=settle(docs, "counts"))
    return judged.select(
        "doc_id", *[F.col(f"counts.{c}") for c in (*quality_rules.BASE, "base_failed", "kept")]
    )


@query
def op9_qgram_decontamination(spark, sf_dir):
    return decontaminate.regions(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op10_seekable_warc(spark, sf_dir):
    folder = warc.archive_folder(spark)
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op11_laesa_vector_codes(spark, sf_dir):
    coded, books = codes.compressed(table(spark, sf_dir, "embeddings"))
    digest = F.lit(books.digest() if books else None).cast("string")
    return codes.with_label_errors(coded).select(
        "vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256")
    )


@query
def op12_sliced_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_window_repeats(spark, sf_dir):
    found = repeats.repeats(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", F.col("digest").alias("kept_sha256"))
