"""The operators' queries by name, and the statements of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from freightlens.llm.bit_planes import OP11_SQL, op11_bit_plane_clusters
from freightlens.llm.chat_windows import op7_chat_windows
from freightlens.llm.dart_minhash import op2_dart_minhash
from freightlens.llm.fertility import op1_tokeniser_fertility
from freightlens.llm.fuzzy_lines import op8_fuzzy_lines
from freightlens.llm.latent_decontamination import op4_latent_decontamination
from freightlens.llm.mixing import OP10_SQL, op10_systematic_mixing
from freightlens.llm.slice_codes import OP12_SQL, op12_slice_codes
from freightlens.llm.substring_dedup import op3_substring_dedup
from freightlens.llm.text_blocks import op13_text_blocks
from freightlens.llm.token_files import op9_repair_token_files
from freightlens.llm.toxicity import op5_noisy_channel_toxicity
from freightlens.llm.warc import op6_splittable_warc

QUERIES = {
    q.__name__: q
    for q in (
        op1_tokeniser_fertility, op2_dart_minhash, op3_substring_dedup, op4_latent_decontamination, op5_noisy_channel_toxicity,
        op6_splittable_warc, op7_chat_windows, op8_fuzzy_lines, op9_repair_token_files, op10_systematic_mixing,
        op11_bit_plane_clusters, op12_slice_codes, op13_text_blocks,
    )
}
STATEMENTS = {"op10_systematic_mixing": OP10_SQL, "op11_bit_plane_clusters": OP11_SQL, "op12_slice_codes": OP12_SQL}
QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    STATEMENTS["pipeline"] = corpus_pipeline.ORACLE_SQL
