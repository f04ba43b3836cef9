"""The queries of this subpackage, and the SQL of those that DuckDB can express."""

from __future__ import annotations

from .op1_hilbert_shards import SQL as OP1_SQL
from .op1_hilbert_shards import op1_hilbert_shards
from .op2_ngram_jaccard import op2_ngram_jaccard
from .op3_line_crf import op3_line_crf
from .op4_pu_quality import op4_pu_quality
from .op5_suffix_dedup import op5_suffix_dedup
from .op6_edit_decontamination import op6_edit_decontamination
from .op7_patched_ids import op7_patched_ids
from .op8_license_scan import op8_license_scan
from .op9_url_lists import SQL as OP9_SQL
from .op9_url_lists import op9_url_lists
from .op10_byte_bpe import op10_byte_bpe
from .op11_prefix_trie import SQL as OP11_SQL
from .op11_prefix_trie import op11_prefix_trie
from .op12_pieces import op12_pieces
from .op13_merkle_manifest import SQL as OP13_SQL
from .op13_merkle_manifest import op13_merkle_manifest

QUERIES = {
    "op1_hilbert_shards": op1_hilbert_shards,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_line_crf": op3_line_crf,
    "op4_pu_quality": op4_pu_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_edit_decontamination": op6_edit_decontamination,
    "op7_patched_ids": op7_patched_ids,
    "op8_license_scan": op8_license_scan,
    "op9_url_lists": op9_url_lists,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_pieces": op12_pieces,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {"op1_hilbert_shards": OP1_SQL, "op9_url_lists": OP9_SQL, "op11_prefix_trie": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
