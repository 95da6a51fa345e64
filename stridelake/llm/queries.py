"""Registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from stridelake.llm import chat, decontamination, embedding_dedup, hard_negatives, kd_shards
from stridelake.llm.bpe import op8_bpe_codec
from stridelake.llm.gru_toxicity import op5_toxicity_gru
from stridelake.llm.language_svm import op3_language_svm
from stridelake.llm.line_crf import op4_quality_crf
from stridelake.llm.periodic_runs import op13_periodic_runs
from stridelake.llm.pii import op11_pii
from stridelake.llm.secret_scan import op9_secret_scan
from stridelake.llm.simhash_dedup import op10_simhash_dedup

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
    "op3_language_svm": op3_language_svm,
    "op4_quality_crf": op4_quality_crf,
    "op5_toxicity_gru": op5_toxicity_gru,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_kd_sharding": kd_shards.op7_kd_sharding,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_secret_scan": op9_secret_scan,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_pii": op11_pii,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op1_chat_format": chat.ORACLE,
    "op2_embedding_dedup": embedding_dedup.ORACLE,
    "op6_decontamination": decontamination.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
