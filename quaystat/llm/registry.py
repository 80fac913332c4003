"""The operators' queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from quaystat.llm.chat import op4_chat
from quaystat.llm.decontaminate import op5_decontamination
from quaystat.llm.merkle import op2_merkle
from quaystat.llm.packing import op1_best_fit_packing
from quaystat.llm.quality import op3_quality
from quaystat.llm.simhash import op10_simhash
from quaystat.llm.suffix_dedup import op7_suffix_dedup
from quaystat.llm.token_counts import op6_token_counts
from quaystat.llm.token_shards import op8_token_shards
from quaystat.llm.toxicity import op9_toxicity
from quaystat.llm.turn_trie import ORACLE_SQL as TURN_TRIE_SQL
from quaystat.llm.turn_trie import op12_turn_trie
from quaystat.llm.vector_codes import ORACLE_SQL as VECTOR_CODES_SQL
from quaystat.llm.vector_codes import op13_vector_codes
from quaystat.llm.window_dedup import ORACLE_SQL as WINDOW_DEDUP_SQL
from quaystat.llm.window_dedup import op11_window_dedup

QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_merkle,
        op3_quality,
        op4_chat,
        op5_decontamination,
        op6_token_counts,
        op7_suffix_dedup,
        op8_token_shards,
        op9_toxicity,
        op10_simhash,
        op11_window_dedup,
        op12_turn_trie,
        op13_vector_codes,
    )
}

ORACLE: dict[str, str] = {"op11_window_dedup": WINDOW_DEDUP_SQL, "op12_turn_trie": TURN_TRIE_SQL, "op13_vector_codes": VECTOR_CODES_SQL}
