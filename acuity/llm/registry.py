"""The queries of this subpackage, with their SQL forms where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from acuity.llm import embeddings, htmltext, langid, lm, mixing, negatives, packing, pii, quality, secrets, simhash, topk, variants


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_embedding_dedup": embeddings.op1,
        "op2_quality_rules": quality.op2,
        "op3_language_id": langid.op3,
        "op4_simhash": simhash.op4,
        "op5_secrets": secrets.op5,
        "op6_mixing": mixing.op6,
        "op7_packing": packing.op7,
        "op8_lm_scoring": lm.op8,
        "op9_html_text": htmltext.op9,
        "op10_personal_data": pii.op10,
        "op11_spelling_variants": variants.op11,
        "op12_top_k": topk.op12,
        "op13_hard_negatives": negatives.op13,
    }


def oracle_sql() -> dict[str, str]:
    found = {
        "op6_mixing": mixing.op6_sql(),
        "op11_spelling_variants": variants.op11_sql(),
        "op12_top_k": topk.op12_sql(),
        "op13_hard_negatives": negatives.op13_sql(),
    }
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
