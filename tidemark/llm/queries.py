"""The registered queries of this subpackage and their SQL."""

from tidemark.llm import decontaminate, extraction, fingerprints, language, mixing, ngram_join, repeats, sharding, url_filter

QUERIES = {
    "op1_partenum_join": ngram_join.op1_partenum_join,
    "op2_sainte_lague_mix": mixing.op2_sainte_lague_mix,
    "op3_tag_path_extract": extraction.op3_tag_path_extract,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_shard_shuffle": sharding.op5_shard_shuffle,
    "op6_suffix_dedup": repeats.op6_suffix_dedup,
    "op7_language_id": language.op7_language_id,
    "op8_iblt_fingerprint": fingerprints.op8_iblt_fingerprint,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_recompression_dedup": repeats.op10_recompression_dedup,
}

ORACLES = {
    "op2_sainte_lague_mix": mixing.ORACLE_SQL,
    "op4_url_filter": url_filter.ORACLE_SQL,
}
