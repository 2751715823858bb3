"""Queries of this folder by name, and SQL for those that SQL can express."""

from __future__ import annotations

from stagewise.llm.align import op12_align
from stagewise.llm.decontaminate import decontaminate_sql, op6_decontaminate
from stagewise.llm.fingerprint import op7_fingerprint
from stagewise.llm.jaccard import op8_jaccard
from stagewise.llm.language import op1_language
from stagewise.llm.lattice import op5_lattice
from stagewise.llm.lines import lines_sql, op9_lines
from stagewise.llm.minhash import op11_minhash
from stagewise.llm.mixing import mixing_sql, op3_mixing
from stagewise.llm.repair import op13_repair, repair_sql
from stagewise.llm.secrets import op4_secrets, secrets_sql
from stagewise.llm.similar_sql import similar_sql
from stagewise.llm.suffixes import op10_suffixes
from stagewise.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_language": op1_language,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_secrets": op4_secrets,
    "op5_lattice": op5_lattice,
    "op6_decontaminate": op6_decontaminate,
    "op7_fingerprint": op7_fingerprint,
    "op8_jaccard": op8_jaccard,
    "op9_lines": op9_lines,
    "op10_suffixes": op10_suffixes,
    "op11_minhash": op11_minhash,
    "op12_align": op12_align,
    "op13_repair": op13_repair,
}

ORACLE_SQL = {
    "op3_mixing": mixing_sql(),
    "op4_secrets": secrets_sql(),
    "op6_decontaminate": decontaminate_sql(),
    "op8_jaccard": similar_sql(3, 90),
    "op9_lines": lines_sql(),
    "op11_minhash": similar_sql(4, 80, kept=True),
    "op13_repair": repair_sql(),
}
