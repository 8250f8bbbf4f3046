"""Loads every query module of this subpackage."""

from kartotek.llm import q_ann, q_chat, q_decontamination, q_extraction, q_hard_negatives, q_merkle, q_mixing, q_ngram_join, q_pii, q_quality_ratio, q_recompression, q_tokens, q_toxicity  # noqa: F401
from kartotek.llm.registry import ORACLES, QUERIES  # noqa: F401
