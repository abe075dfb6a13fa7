"""The operators as queries over the driver's tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from couchlog.llm.decontamination import op1_decontamination
from couchlog.llm.fingerprints import op10_fingerprints
from couchlog.llm.html_text import op5_html_text
from couchlog.llm.line_dedup import OP8_SQL, op8_line_dedup
from couchlog.llm.minhash_dedup import op6_minhash
from couchlog.llm.mixing import op11_mixing
from couchlog.llm.packing import op4_packing
from couchlog.llm.periodic_runs import op13_periodic_runs
from couchlog.llm.quality import op7_quality
from couchlog.llm.secrets import op9_secrets
from couchlog.llm.substring_dedup import OP2_SQL, op2_debruijn
from couchlog.llm.suffix_dedup import op3_suffix_dedup
from couchlog.llm.token_alignment import op12_token_alignment

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_debruijn": op2_debruijn,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_packing": op4_packing,
    "op5_html_text": op5_html_text,
    "op6_minhash": op6_minhash,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_secrets": op9_secrets,
    "op10_fingerprints": op10_fingerprints,
    "op11_mixing": op11_mixing,
    "op12_token_alignment": op12_token_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE = {
    "op2_debruijn": OP2_SQL,
    "op8_line_dedup": OP8_SQL,
}
