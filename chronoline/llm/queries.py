"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from chronoline.llm.bpe import op1_bpe
from chronoline.llm.cross_polytope import OP3_SQL, op3_cross_polytope
from chronoline.llm.divergence import OP12_SQL, op12_divergence
from chronoline.llm.filter_audit import OP13_SQL, op13_filter_audit
from chronoline.llm.langid import op5_langid
from chronoline.llm.licenses import OP10_SQL, op10_licenses
from chronoline.llm.mixing import OP9_SQL, op9_mixing
from chronoline.llm.quality import op4_quality
from chronoline.llm.risk_rules import OP11_SQL, op11_risk_rules
from chronoline.llm.secrets import OP6_SQL, op6_secrets
from chronoline.llm.setsketch import OP7_SQL, op7_setsketch
from chronoline.llm.sharding import op2_sharding
from chronoline.llm.topk import OP8_SQL, op8_topk

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_sharding": op2_sharding,
    "op3_cross_polytope": op3_cross_polytope,
    "op4_quality": op4_quality,
    "op5_langid": op5_langid,
    "op6_secrets": op6_secrets,
    "op7_setsketch": op7_setsketch,
    "op8_topk": op8_topk,
    "op9_mixing": op9_mixing,
    "op10_licenses": op10_licenses,
    "op11_risk_rules": op11_risk_rules,
    "op12_divergence": op12_divergence,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL = {
    "op3_cross_polytope": OP3_SQL,
    "op6_secrets": OP6_SQL,
    "op7_setsketch": OP7_SQL,
    "op8_topk": OP8_SQL,
    "op9_mixing": OP9_SQL,
    "op10_licenses": OP10_SQL,
    "op11_risk_rules": OP11_SQL,
    "op12_divergence": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
