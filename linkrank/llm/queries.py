"""The operators applied to the test tables, as registered for the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkrank.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark, sf_dir):
    from linkrank.llm.bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_token_files(spark, sf_dir):
    from linkrank.llm.token_files import checksums

    return checksums(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_lm(spark, sf_dir):
    from linkrank.llm.lm import scores

    return scores(table(spark, sf_dir, "documents"))


def op4_warc(spark, sf_dir):
    from linkrank.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages"))


def op5_quality(spark, sf_dir):
    from linkrank.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_minhash(spark, sf_dir):
    from linkrank.llm.minhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_decontamination(spark, sf_dir):
    from linkrank.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark, sf_dir):
    from linkrank.llm.rules import judged

    return judged(table(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    from linkrank.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark, sf_dir):
    from linkrank.llm.wordpiece import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_search(spark, sf_dir):
    from linkrank.llm.search import ranked_documents

    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_mixing(spark, sf_dir):
    from linkrank.llm.mixing import mixed

    return mixed(table(spark, sf_dir, "documents"))


def op13_alignment(spark, sf_dir):
    from linkrank.llm.alignment import aligned

    return aligned(table(spark, sf_dir, "documents"), tokenizer_path(), pieces_path())


def queries() -> dict[str, Query]:
    found = [op1_bpe, op2_token_files, op3_lm, op4_warc, op5_quality, op6_minhash, op7_decontamination, op8_quality_rules, op9_toxicity, op10_token_counts, op11_search, op12_mixing, op13_alignment]
    return {q.__name__: q for q in found}
