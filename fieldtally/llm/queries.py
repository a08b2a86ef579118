"""The registered corpus queries and the SQL for those that SQL can express."""

from __future__ import annotations

from fieldtally.llm.blob_ledger import OP4_SQL, op4_blob_ledger
from fieldtally.llm.covering_simhash import op10_covering_simhash
from fieldtally.llm.hash_tree import op12_hash_tree_shards
from fieldtally.llm.langid import op1_bigru_language
from fieldtally.llm.license_scan import OP8_SQL, op8_license_tfidf
from fieldtally.llm.merkle_log import op13_merkle_log
from fieldtally.llm.mixing import op7_hypergeometric_mix
from fieldtally.llm.outliers import op9_mcd_outliers
from fieldtally.llm.packing import op5_conflict_best_fit
from fieldtally.llm.periodic_runs import op11_periodic_runs
from fieldtally.llm.pii import op2_bootstrapped_pii
from fieldtally.llm.viterbi_counts import op6_viterbi_counts
from fieldtally.llm.voronoi_knn import OP3_SQL, op3_voronoi_knn

CORPUS_QUERIES = {
    "op1_bigru_language": op1_bigru_language,
    "op2_bootstrapped_pii": op2_bootstrapped_pii,
    "op3_voronoi_knn": op3_voronoi_knn,
    "op4_blob_ledger": op4_blob_ledger,
    "op10_covering_simhash": op10_covering_simhash,
    "op5_conflict_best_fit": op5_conflict_best_fit,
    "op6_viterbi_counts": op6_viterbi_counts,
    "op7_hypergeometric_mix": op7_hypergeometric_mix,
    "op8_license_tfidf": op8_license_tfidf,
    "op9_mcd_outliers": op9_mcd_outliers,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hash_tree_shards": op12_hash_tree_shards,
    "op13_merkle_log": op13_merkle_log,
}
CORPUS_SQL = {
    "op3_voronoi_knn": OP3_SQL,
    "op4_blob_ledger": OP4_SQL,
    "op8_license_tfidf": OP8_SQL,
}
