"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventweave.llm import alignment, bpe, chains, decontaminate, fingerprint, langid, minhash, phrases, quality, simhash, suffix, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": minhash.op1_near_duplicates,
    "op2_suffix_dedup": suffix.op2_suffix_dedup,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_fingerprint": fingerprint.op4_fingerprint,
    "op5_fuzzy_passages": chains.op5_fuzzy_passages,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_bpe_tokens": bpe.op7_bpe_tokens,
    "op8_language": langid.op8_language,
    "op9_quality": quality.op9_quality,
    "op10_url_filter": urlfilter.op10_url_filter,
    "op11_token_alignment": alignment.op11_token_alignment,
    "op12_phrases": phrases.op12_phrases,
    "op13_simhash": simhash.op13_simhash,
}

ORACLE_SQL: dict[str, str] = {"op10_url_filter": urlfilter.ORACLE_SQL, "op12_phrases": phrases.ORACLE_SQL}
