"""Registered queries of the operators (and the DuckDB SQL where SQL can express one)."""

from geoqa.llm import op7_decontaminate, op9_minhash
from geoqa.llm.op1_tokens import op1_token_counts
from geoqa.llm.op2_html import op2_main_text
from geoqa.llm.op3_lm import op3_lm_scores
from geoqa.llm.op4_substrings import op4_substring_dedup
from geoqa.llm.op5_quality import op5_quality_rules
from geoqa.llm.op6_toxicity import op6_toxicity
from geoqa.llm.op7_decontaminate import op7_benchmark_decontamination
from geoqa.llm.op8_licenses import op8_license_scan
from geoqa.llm.op9_minhash import op9_minhash_near_dedup
from geoqa.llm.op10_pack import op10_best_fit_packing
from geoqa.llm.op11_binary import op11_token_files
from geoqa.llm.op12_alignment import op12_tokenizer_alignment
from geoqa.llm.op13_whitening import op13_embedding_whitening

QUERIES = {f.__name__: f for f in (op1_token_counts, op2_main_text, op3_lm_scores, op4_substring_dedup, op5_quality_rules, op6_toxicity, op7_benchmark_decontamination,
                                   op8_license_scan, op9_minhash_near_dedup, op10_best_fit_packing, op11_token_files, op12_tokenizer_alignment, op13_embedding_whitening)}
ORACLES: dict[str, str] = {"op7_benchmark_decontamination": op7_decontaminate.ORACLE, "op9_minhash_near_dedup": op9_minhash.ORACLE}
