"""The queries of these operators, and their SQL where it can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from laketally.llm import chat, decontamination, fingerprints, jaccard, languages, licenses, merkle, mixing, negatives, packing, quality, secrets, suffixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": quality.query,
    "op2_fingerprints": fingerprints.query,
    "op3_packing": packing.query,
    "op4_suffixes": suffixes.query,
    "op5_jaccard": jaccard.query,
    "op6_licenses": licenses.query,
    "op7_mixing": mixing.query,
    "op8_secrets": secrets.query,
    "op9_chat": chat.query,
    "op10_decontamination": decontamination.query,
    "op11_languages": languages.query,
    "op12_negatives": negatives.query,
    "op13_merkle": merkle.query,
}

ORACLE: dict[str, str] = {
    "op5_jaccard": jaccard.SQL,
    "op10_decontamination": decontamination.SQL,
    "op12_negatives": negatives.SQL,
    "op13_merkle": merkle.SQL,
}
