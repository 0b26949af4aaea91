"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from landledger.llm.block_labeller import op10_block_labeller
from landledger.llm.capture_index import op6_capture_index
from landledger.llm.chat_masks import op4_chat_masks
from landledger.llm.digest_runs import OP11_SQL, op11_digest_runs
from landledger.llm.edit_matching import op7_edit_matching
from landledger.llm.hamming_index import op1_hamming_index
from landledger.llm.hyperplane_tree import OP12_SQL, op12_hyperplane_tree
from landledger.llm.line_crf import op5_line_crf
from landledger.llm.mixing import op8_entropy_mix
from landledger.llm.ngram_join import op2_ngram_join
from landledger.llm.token_alignment import op13_token_alignment
from landledger.llm.token_counts import op9_separator_scan
from landledger.llm.url_reputation import OP3_SQL, op3_url_reputation

QUERIES = {
    "op1_hamming_index": op1_hamming_index,
    "op2_ngram_join": op2_ngram_join,
    "op3_url_reputation": op3_url_reputation,
    "op4_chat_masks": op4_chat_masks,
    "op5_line_crf": op5_line_crf,
    "op6_capture_index": op6_capture_index,
    "op7_edit_matching": op7_edit_matching,
    "op8_entropy_mix": op8_entropy_mix,
    "op9_separator_scan": op9_separator_scan,
    "op10_block_labeller": op10_block_labeller,
    "op11_digest_runs": op11_digest_runs,
    "op12_hyperplane_tree": op12_hyperplane_tree,
    "op13_token_alignment": op13_token_alignment,
}
ORACLES = {"op3_url_reputation": OP3_SQL, "op11_digest_runs": OP11_SQL, "op12_hyperplane_tree": OP12_SQL}
