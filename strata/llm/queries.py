"""Registered queries of the numbered operators, with their SQL where there is one."""
from __future__ import annotations

from strata.llm import (chat_format, divergence, exact_dedup, hilbert_ann, jaccard_join, language_id, mixing, packing,
                        secrets, sentencepiece_bpe, spelling, substring_dedup, suffix_dedup)

MODULES = (exact_dedup, hilbert_ann, chat_format, language_id, substring_dedup, mixing, jaccard_join, sentencepiece_bpe,
           suffix_dedup, secrets, divergence, packing, spelling)
REGISTRY = {name: entry for m in MODULES for name, entry in m.QUERIES.items()}
