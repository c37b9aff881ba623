"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from barloom.llm.decontaminate import OP1_SQL, op1_winnowing
from barloom.llm.exact import OP13_SQL, op13_block_naming
from barloom.llm.fingerprints import op5_bottom_k
from barloom.llm.html import op3_host_consensus
from barloom.llm.langid import op7_byte_network
from barloom.llm.licenses import OP9_SQL, op9_license_sentences
from barloom.llm.lines import OP4_SQL, op4_line_spread
from barloom.llm.neardup import op6_weighted_sampling
from barloom.llm.ngram import op8_elias_fano
from barloom.llm.periods import op12_recompression
from barloom.llm.sentencepiece import op2_unigram_pieces
from barloom.llm.token_counts import op10_section_tokens
from barloom.llm.whitening import op11_chebyshev

QUERIES = {
    "op1_winnowing": op1_winnowing,
    "op2_unigram_pieces": op2_unigram_pieces,
    "op3_host_consensus": op3_host_consensus,
    "op4_line_spread": op4_line_spread,
    "op5_bottom_k": op5_bottom_k,
    "op6_weighted_sampling": op6_weighted_sampling,
    "op7_byte_network": op7_byte_network,
    "op8_elias_fano": op8_elias_fano,
    "op9_license_sentences": op9_license_sentences,
    "op10_section_tokens": op10_section_tokens,
    "op11_chebyshev": op11_chebyshev,
    "op12_recompression": op12_recompression,
    "op13_block_naming": op13_block_naming,
}

ORACLE = {
    "op1_winnowing": OP1_SQL,
    "op4_line_spread": OP4_SQL,
    "op9_license_sentences": OP9_SQL,
    "op13_block_naming": OP13_SQL,
}
