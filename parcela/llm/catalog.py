"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import decontamination, fill_middle
from .alignment import op12_cross_alignment
from .decontamination import op13_decontamination
from .fill_middle import op11_fill_in_middle
from .language import op8_language_kneser_ney
from .lexicon import op10_bpe_lexicon
from .lines import op1_fuzzy_line_dedup
from .neighbours import op4_vantage_neighbours
from .packing import op7_pack_best_fit
from .quality import op9_quality_byte_cnn
from .quartiles import op6_quartile_fingerprints
from .simhash import op5_simhash_near_dedup
from .token_counts import op2_token_counts
from .wavelet import op3_wavelet_token_output

QUERIES = {
    "op1_fuzzy_line_dedup": op1_fuzzy_line_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_wavelet_token_output": op3_wavelet_token_output,
    "op4_vantage_neighbours": op4_vantage_neighbours,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_quartile_fingerprints": op6_quartile_fingerprints,
    "op7_pack_best_fit": op7_pack_best_fit,
    "op8_language_kneser_ney": op8_language_kneser_ney,
    "op9_quality_byte_cnn": op9_quality_byte_cnn,
    "op10_bpe_lexicon": op10_bpe_lexicon,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_cross_alignment": op12_cross_alignment,
    "op13_decontamination": op13_decontamination,
}
# SQL has neither the tokenizers' merges nor fitted models, 64-bit shingle hashes or nearest-neighbour trees at a bearable cost:
# the others are tested against brute force, the tokenizers' own libraries or held-out labels in tests/llm.
ORACLE: dict[str, str] = {
    "op11_fill_in_middle": fill_middle.ORACLE_SQL,
    "op13_decontamination": decontamination.ORACLE_SQL,
}
