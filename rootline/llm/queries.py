"""Queries and oracle SQL of the training-data operators."""

from .class_lm import op12_class_lm
from .divergence_audit import OP11_SQL, op11_divergence_audit
from .gbt_extract import op1_gbt_extract
from .license_diagonals import OP7_SQL, op7_license_diagonals
from .line_winnow import OP5_SQL, op5_line_winnow
from .merkle_manifest import op13_merkle_manifest
from .mih_search import OP8_SQL, op8_mih_search
from .ngram_jaccard import op3_ngram_jaccard
from .ordinal_toxicity import op4_ordinal_toxicity
from .ss_packing import op10_ss_packing
from .substring_rlz import op2_substring_rlz
from .suffix_bpr import op9_suffix_bpr
from .wu_manber import OP6_SQL, op6_wu_manber

QUERIES = {
    f.__name__: f
    for f in (
        op1_gbt_extract,
        op2_substring_rlz,
        op3_ngram_jaccard,
        op4_ordinal_toxicity,
        op5_line_winnow,
        op6_wu_manber,
        op7_license_diagonals,
        op8_mih_search,
        op9_suffix_bpr,
        op10_ss_packing,
        op11_divergence_audit,
        op12_class_lm,
        op13_merkle_manifest,
    )
}
ORACLE = {"op5_line_winnow": OP5_SQL, "op6_wu_manber": OP6_SQL, "op7_license_diagonals": OP7_SQL, "op8_mih_search": OP8_SQL, "op11_divergence_audit": OP11_SQL}
