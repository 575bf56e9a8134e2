"""The queries of the package by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from civicspark.llm.alignment import op12_alignment
from civicspark.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from civicspark.llm.html_text import op9_html_text
from civicspark.llm.language_model import op10_language_model
from civicspark.llm.line_dedup import OP1_SQL, op1_line_dedup
from civicspark.llm.minhash import OP6_SQL, op6_minhash
from civicspark.llm.mixing import OP2_SQL, op2_mix
from civicspark.llm.neighbours import OP5_SQL, op5_near_vectors
from civicspark.llm.passages import op4_passages
from civicspark.llm.pieces import op7_pieces
from civicspark.llm.search import OP13_SQL, op13_search
from civicspark.llm.secrets import op11_secrets
from civicspark.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_mix": op2_mix,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_passages": op4_passages,
    "op5_near_vectors": op5_near_vectors,
    "op6_minhash": op6_minhash,
    "op7_pieces": op7_pieces,
    "op8_toxicity": op8_toxicity,
    "op9_html_text": op9_html_text,
    "op10_language_model": op10_language_model,
    "op11_secrets": op11_secrets,
    "op12_alignment": op12_alignment,
    "op13_search": op13_search,
}
ORACLE = {
    "op1_line_dedup": OP1_SQL,
    "op2_mix": OP2_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op5_near_vectors": OP5_SQL,
    "op6_minhash": OP6_SQL,
    "op13_search": OP13_SQL,
}
