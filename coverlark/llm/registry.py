"""The queries of this folder and the SQL of those that SQL can express."""

from .bpe import op9_bpe
from .collocations import OP13_SQL, op13_collocations
from .exact_dedup import OP6_SQL, op6_exact_dedup
from .language import op12_language
from .licenses import op10_licenses
from .mixing import op7_mixing
from .negatives import OP11_SQL, op11_negatives
from .quality import op4_quality
from .secrets import op8_secrets
from .simhash import op5_simhash
from .suffix_dedup import op3_suffix_dedup
from .toxicity import op2_toxicity
from .winnow import op1_winnow

QUERIES = {
    "op1_winnow": op1_winnow,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality": op4_quality,
    "op5_simhash": op5_simhash,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_secrets": op8_secrets,
    "op9_bpe": op9_bpe,
    "op10_licenses": op10_licenses,
    "op11_negatives": op11_negatives,
    "op12_language": op12_language,
    "op13_collocations": op13_collocations,
}
ORACLES = {
    "op6_exact_dedup": OP6_SQL,
    "op11_negatives": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
