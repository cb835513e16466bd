"""Registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from tapeworks.llm.bitplanes import op8_bitplanes
from tapeworks.llm.bpe_prefix import op7_bpe_prefix
from tapeworks.llm.chat_windows import OP3_SQL, op3_chat_windows
from tapeworks.llm.divergence import OP6_SQL, op6_divergence
from tapeworks.llm.exact_heavy import OP4_SQL, op4_exact_heavy
from tapeworks.llm.jaccard_join import OP13_SQL, op13_jaccard_join
from tapeworks.llm.licenses import op10_licenses
from tapeworks.llm.minhash import OP2_SQL, op2_minhash
from tapeworks.llm.mixing import OP9_SQL, op9_mixing
from tapeworks.llm.spelling import op11_spelling
from tapeworks.llm.suffix_dedup import op5_suffix_dedup
from tapeworks.llm.vector_codes import OP12_SQL, op12_vector_codes
from tapeworks.llm.warc_bundles import OP1_SQL, op1_warc_bundles

QUERIES = {f.__name__: f for f in (
    op1_warc_bundles, op2_minhash, op3_chat_windows, op4_exact_heavy, op5_suffix_dedup, op6_divergence, op7_bpe_prefix, op8_bitplanes, op9_mixing, op10_licenses, op11_spelling,
    op12_vector_codes, op13_jaccard_join,
)}
ORACLES: dict[str, str] = {
    "op1_warc_bundles": OP1_SQL, "op2_minhash": OP2_SQL, "op3_chat_windows": OP3_SQL, "op4_exact_heavy": OP4_SQL,
    "op6_divergence": OP6_SQL, "op9_mixing": OP9_SQL, "op12_vector_codes": OP12_SQL, "op13_jaccard_join": OP13_SQL,
}
