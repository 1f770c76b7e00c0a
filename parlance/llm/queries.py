"""The corpus operators' queries over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from parlance.llm import decontaminate, lm_score, mixing, multiset_hash, secrets, signature_tree, tokens, toxicity, url_filter, warc

QUERIES = {
    f.__name__: f
    for f in (decontaminate.op1_decontaminate, tokens.op2_token_ids, multiset_hash.op3_multiset_hash, secrets.op4_secrets, mixing.op5_mixing, warc.op6_warc, lm_score.op7_lm_score, toxicity.op8_toxicity, url_filter.op9_url_filter, signature_tree.op10_jaccard_join)
}
ORACLES: dict[str, str] = {"op6_warc": warc.OP6_SQL, "op9_url_filter": url_filter.OP9_SQL, "op10_jaccard_join": signature_tree.OP10_SQL}
