"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from daylog.llm.ann import op5_neighbours
from daylog.llm.bpe_tree import op6_bpe
from daylog.llm.centroids import SQL as CENTROIDS_SQL
from daylog.llm.centroids import op11_centroids
from daylog.llm.chat_windows import op13_chat_windows
from daylog.llm.lm_mixing import op10_lm_mixing
from daylog.llm.packing import op4_pack
from daylog.llm.prefix_trie import SQL as TRIE_SQL
from daylog.llm.prefix_trie import op12_prefix_trie
from daylog.llm.quality import op8_quality
from daylog.llm.simhash import op9_simhash
from daylog.llm.substring_dedup import SQL as SUBSTRING_SQL
from daylog.llm.substring_dedup import op1_substring_dedup
from daylog.llm.syncmers import op7_syncmers
from daylog.llm.token_shards import op2_token_shards
from daylog.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_shards": op2_token_shards,
    "op3_toxicity": op3_toxicity,
    "op4_pack": op4_pack,
    "op5_neighbours": op5_neighbours,
    "op6_bpe": op6_bpe,
    "op7_syncmers": op7_syncmers,
    "op8_quality": op8_quality,
    "op9_simhash": op9_simhash,
    "op10_lm_mixing": op10_lm_mixing,
    "op11_centroids": op11_centroids,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_chat_windows": op13_chat_windows,
}

SQL: dict[str, str] = {
    "op1_substring_dedup": SUBSTRING_SQL,
    "op11_centroids": CENTROIDS_SQL,
    "op12_prefix_trie": TRIE_SQL,
}
