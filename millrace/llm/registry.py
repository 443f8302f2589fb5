"""The queries of the corpus operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from millrace.llm import (block_naming, bloom_lookup, class_lm, impact_search, language_id, mixing, ngram_join, pieces,
                          repeated_phrases, spelling_variants, toxicity, warc_derivatives, whitening)

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_repeated_phrases": repeated_phrases.op1_repeated_phrases,
    "op2_language_id": language_id.op2_language_id,
    "op3_warc_derivatives": warc_derivatives.op3_warc_derivatives,
    "op4_block_naming": block_naming.op4_block_naming,
    "op5_class_lm": class_lm.op5_class_lm,
    "op6_bloom_lookup": bloom_lookup.op6_bloom_lookup,
    "op7_piece_scan": pieces.op7_piece_scan,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_systematic_mix": mixing.op9_systematic_mix,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_spelling_variants": spelling_variants.op11_spelling_variants,
    "op12_impact_search": impact_search.op12_impact_search,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES = {
    "op3_warc_derivatives": warc_derivatives.OP3_SQL,
    "op4_block_naming": block_naming.OP4_SQL,
    "op9_systematic_mix": mixing.OP9_SQL,
    "op11_spelling_variants": spelling_variants.OP11_SQL,
    "op12_impact_search": impact_search.OP12_SQL,
}
