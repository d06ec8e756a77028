"""The registered queries of the operators: whole tables, production parameters, contract columns."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchprofile.llm import (bpe, code_switch, decontaminate, divergence, html_text, middle, mixing, near_dups, repetition, secrets, token_output, toxicity,
                              url_filter)
from patchprofile.llm.common import held_out
from patchprofile.session import work_dir

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "patchprofile_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = work_dir(spark, "llm-tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), out, tokenizer_path())
    return token_output.checksums(token_output.read_tokens(spark, out))


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    got = repetition.repetition(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_code_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    return code_switch.languages(docs, code_switch.fit(docs))


def op4_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    got = mixing.mix(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken")


def op5_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dups.near_dups(table(spark, sf_dir, "documents"))


def op9_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    hits = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "shared", "n_item")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    made = middle.restore(middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


def op13_linked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    path = tokenizer_path("word_bpe_49k.json")
    got = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_output, op2_repetition, op3_code_switch, op4_fair_mix, op5_redirect_filter, op6_layout_text,
    op7_string_kernel, op8_odd_sketch, op9_secret_forest, op10_containment,
    op11_source_divergence, op12_fill_in_middle, op13_linked_bpe)}
