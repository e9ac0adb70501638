"""The queries of this subpackage and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from .decontaminate import op2_decontaminate
from .html_text import op8_html_text
from .masked_lm import op5_masked_lm
from .oracles import ORACLES as ORACLES
from .packing import op3_best_fit_pack
from .quality_model import op1_quality_model
from .quality_rules import op7_quality_rules
from .secrets import op6_secret_spans
from .sharding import op10_byte_shards
from .simhash import op9_simhash
from .warc import op4_warc_round_trip

QUERIES = {
    f.__name__: f
    for f in (op1_quality_model, op2_decontaminate, op3_best_fit_pack, op4_warc_round_trip, op5_masked_lm, op6_secret_spans, op7_quality_rules, op8_html_text, op9_simhash, op10_byte_shards)
}
