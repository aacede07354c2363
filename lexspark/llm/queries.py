"""Registered queries of this subpackage and their SQL. Each runs over its whole tables."""

from __future__ import annotations

from lexspark.llm.align import count_links
from lexspark.llm.chat import op7_chat_format
from lexspark.llm.classifier import op3_quality_classifier
from lexspark.llm.common import table
from lexspark.llm.html_extract import extract_pages
from lexspark.llm.lattice_dedup import link_embeddings
from lexspark.llm.line_dedup import op2_line_dedup
from lexspark.llm.lm_score import lm_scores
from lexspark.llm.minhash import find_near_duplicates
from lexspark.llm.mixing import op9_mixing
from lexspark.llm.packing import op10_best_fit_packing
from lexspark.llm.quality_rules import OP1_SQL, op1_quality_rules
from lexspark.llm.warc import OP6_SQL, op6_warc
from lexspark.llm.whitening import whiten_embeddings


def _over(name, operator):
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES = {
    "op1_quality_rules": _over("documents", op1_quality_rules),
    "op2_line_dedup": _over("documents", op2_line_dedup),
    "op3_quality_classifier": lambda spark, sf_dir: op3_quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op4_lm_score": _over("documents", lm_scores),
    "op5_lattice_near_dedup": _over("embeddings", link_embeddings),
    "op6_warc": _over("pages", op6_warc),
    "op7_chat_format": _over("conversations", op7_chat_format),
    "op8_minhash_near_dedup": _over("documents", find_near_duplicates),
    "op9_mixing": _over("documents", op9_mixing),
    "op10_best_fit_packing": _over("documents", op10_best_fit_packing),
    "op11_token_alignment": _over("documents", count_links),
    "op12_whitening": _over("embeddings", whiten_embeddings),
    "op13_html_extract": _over("pages", extract_pages),
}

#: The others are beyond SQL, or too slow in it on whole tables; tests hold them against brute force.
ORACLE_SQL = {"op1_quality_rules": OP1_SQL, "op6_warc": OP6_SQL}
