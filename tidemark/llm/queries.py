"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from tidemark.llm.ann import op2_nearest_neighbours
from tidemark.llm.centroids import op13_centroid_clustering
from tidemark.llm.convtrie import op12_conversation_trie
from tidemark.llm.decontam import ORACLE as OP4_ORACLE, op4_decontamination
from tidemark.llm.jaccard import op8_ngram_jaccard
from tidemark.llm.license import op3_license_scans
from tidemark.llm.linededup import op5_line_dedup
from tidemark.llm.packing import op6_packing
from tidemark.llm.quality import op9_quality_classifier
from tidemark.llm.secrets import op11_secret_scans
from tidemark.llm.suffix import op10_suffix_dedup
from tidemark.llm.tokencount import op7_token_counts
from tidemark.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_license_scans": op3_license_scans,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_token_counts": op7_token_counts,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_secret_scans": op11_secret_scans,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_centroid_clustering": op13_centroid_clustering,
}

ORACLES: dict[str, str] = {
    "op4_decontamination": OP4_ORACLE,
}
