"""The named queries of the operators in this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from lonja.llm.bbit_minhash import near_duplicates_sql, op4_bbit_minhash
from lonja.llm.bm25_packing import op3_bm25_packing
from lonja.llm.cotraining import op8_cotraining
from lonja.llm.hnsw import op6_hnsw
from lonja.llm.lempel_ziv import OP1_SQL, op1_lempel_ziv_dedup
from lonja.llm.mtree import OP7_SQL, op7_mtree
from lonja.llm.net_bound_codes import codes_sql, op13_net_bound_codes
from lonja.llm.pca_clusters import clusters_sql, op12_pca_clusters
from lonja.llm.perspectives import OP2_SQL, op2_perspective_rotation
from lonja.llm.prefix_bpe import op9_prefix_bpe
from lonja.llm.ring import op5_bounded_ring
from lonja.llm.token_counts import op10_token_counts
from lonja.llm.token_files import op11_token_files

QUERIES = {
    "op1_lempel_ziv_dedup": op1_lempel_ziv_dedup,
    "op2_perspective_rotation": op2_perspective_rotation,
    "op3_bm25_packing": op3_bm25_packing,
    "op4_bbit_minhash": op4_bbit_minhash,
    "op5_bounded_ring": op5_bounded_ring,
    "op6_hnsw": op6_hnsw,
    "op7_mtree": op7_mtree,
    "op8_cotraining": op8_cotraining,
    "op9_prefix_bpe": op9_prefix_bpe,
    "op10_token_counts": op10_token_counts,
    "op11_token_files": op11_token_files,
    "op12_pca_clusters": op12_pca_clusters,
    "op13_net_bound_codes": op13_net_bound_codes,
}

SQL = {
    "op1_lempel_ziv_dedup": OP1_SQL,
    "op2_perspective_rotation": OP2_SQL,
    "op4_bbit_minhash": near_duplicates_sql(2),
    "op7_mtree": OP7_SQL,
    "op12_pca_clusters": clusters_sql(),
    "op13_net_bound_codes": codes_sql(),
}
