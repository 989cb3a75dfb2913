"""Queries of this subpackage and their SQL."""

import corpus_pipeline
from demandpanel.llm.decontaminate import OP6_SQL, op6_decontamination
from demandpanel.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from demandpanel.llm.language_id import op9_language_id
from demandpanel.llm.line_dedup import OP7_BY_RATE_SQL, OP7_SQL, op7_line_dedup, op7_line_dedup_by_rate
from demandpanel.llm.mixing import OP11_SQL, op11_mixing
from demandpanel.llm.near_dedup import op4_near_dedup
from demandpanel.llm.packing import op8_best_fit_packing
from demandpanel.llm.phrases import OP13_SQL, op13_phrases
from demandpanel.llm.secrets import OP5_BY_SPREAD_SQL, OP5_SQL, op5_secret_scan, op5_secret_scan_by_spread
from demandpanel.llm.sharding import op1_sharding
from demandpanel.llm.toxicity import op2_toxicity
from demandpanel.llm.trie import OP12_SQL, op12_prefix_trie
from demandpanel.llm.url_filter import op10_url_filter

QUERIES = {f.__name__: f for f in (op1_sharding, op2_toxicity, op3_exact_dedup, op4_near_dedup, op5_secret_scan, op5_secret_scan_by_spread, op6_decontamination, op7_line_dedup, op7_line_dedup_by_rate, op8_best_fit_packing, op9_language_id, op10_url_filter, op11_mixing, op12_prefix_trie, op13_phrases)} | {"pipeline": corpus_pipeline.run}

ORACLES = {"op3_exact_dedup": OP3_SQL, "op5_secret_scan": OP5_SQL, "op5_secret_scan_by_spread": OP5_BY_SPREAD_SQL, "op6_decontamination": OP6_SQL, "op7_line_dedup": OP7_SQL, "op7_line_dedup_by_rate": OP7_BY_RATE_SQL, "op11_mixing": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_phrases": OP13_SQL}
