"""The operators' queries over the driver's tables, and the SQL of those that SQL can state."""

from spanwatch.llm import (
    align,
    decontam,
    license,
    linededup,
    mix,
    neardup,
    quality,
    repair,
    secrets,
    shard,
    tokens,
    toxicity,
    urls,
)

QUERIES = {
    "op1_mix_sources": mix.op1_mix_sources,
    "op2_license_scan": license.op2_license_scan,
    "op3_token_counts": tokens.op3_token_counts,
    "op4_near_duplicates": neardup.op4_near_duplicates,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_benchmark_leaks": decontam.op7_benchmark_leaks,
    "op8_shard_by_bytes": shard.op8_shard_by_bytes,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_line_dedup": linededup.op10_line_dedup,
    "op11_url_filters": urls.op11_url_filters,
    "op12_token_alignment": align.op12_token_alignment,
    "op13_conversation_repair": repair.op13_conversation_repair,
}
ORACLE = {
    "op1_mix_sources": mix.ORACLE,
    "op4_near_duplicates": neardup.ORACLE,
    "op5_quality_rules": quality.ORACLE,
    "op11_url_filters": urls.ORACLE,
    "op13_conversation_repair": repair.ORACLE,
}
