"""The registered queries of the subpackage and their SQL twins, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainlytics.llm import articles, bpe, collocations, jaccard, language, leaks, manifest, quality, repeats, search, tokens, toxicity, urls
from chainlytics.llm.tables import small_batches

_RUNS = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_language_model": language.op2_language_model,
    "op3_token_files": tokens.op3_token_files,
    "op4_decontaminate": leaks.op4_decontaminate,
    "op5_bpe": bpe.op5_bpe,
    "op6_repeats": repeats.op6_repeats,
    "op7_url_filter": urls.op7_url_filter,
    "op8_quality": quality.op8_quality,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_top_k": search.op10_top_k,
    "op11_manifest": manifest.op11_manifest,
    "op12_main_text": articles.op12_main_text,
    "op13_collocations": collocations.op13_collocations,
}


def _prepared(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: run(small_batches(spark), folder)


QUERIES = {name: _prepared(run) for name, run in _RUNS.items()}

ORACLES = {
    "op7_url_filter": urls.ORACLE,
    "op10_top_k": search.ORACLE,
    "op11_manifest": manifest.ORACLE,
    "op12_main_text": articles.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
