"""Registered queries of the training-data operators: one per operator, over whole tables."""

from __future__ import annotations

from importlib import import_module

MODULES = {
    "op1_line_run_dedup": "line_dedup",
    "op2_byte_prefix_sharding": "sharding",
    "op3_subword_lattice_score": "lm_score",
    "op4_conflict_best_fit_packing": "packing",
    "op5_cover_suffix_dedup": "suffix_dedup",
    "op6_transducer_token_counts": "token_counts",
    "op7_tiled_topk_search": "topk_search",
    "op8_counterfactual_toxicity": "toxicity",
    "op9_suffix_automaton_decontamination": "decontaminate",
    "op10_size_banded_jaccard_join": "jaccard_join",
    "op11_pointer_jumping_manifest": "merkle",
    "op12_cross_polytope_near_dedup": "embedding_dedup",
    "op13_survivor_coalescence_repair": "convo_repair",
}

QUERIES = {}
ORACLE_SQL = {}
for _name, _module in MODULES.items():
    _m = import_module(f"strata.llm.{_module}")
    QUERIES[_name] = _m.query
    if getattr(_m, "SQL", None):
        ORACLE_SQL[_name] = _m.SQL.strip()
