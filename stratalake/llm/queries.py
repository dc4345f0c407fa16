"""The registered query of each operator, and the SQL of those that have one."""

from __future__ import annotations

from stratalake.llm.best_fit_packing import op13_best_fit_packing
from stratalake.llm.bpe import op5_bpe
from stratalake.llm.chat_format import op4_chat_format
from stratalake.llm.jaccard_join import op8_jaccard_join
from stratalake.llm.language_id import op10_language_id
from stratalake.llm.mixing import op7_mixing
from stratalake.llm.periodic_runs import op12_periodic_runs
from stratalake.llm.personal_data import op9_personal_data
from stratalake.llm.spelling_variants import op11_spelling_variants
from stratalake.llm.substring_dedup import op3_substring_dedup
from stratalake.llm.voronoi_knn import op6_voronoi_knn
from stratalake.llm.warc import op2_warc
from stratalake.llm.winnowing import op1_winnowing

QUERIES = {
    query.__name__: query
    for query in (
        op1_winnowing,
        op2_warc,
        op3_substring_dedup,
        op4_chat_format,
        op5_bpe,
        op6_voronoi_knn,
        op7_mixing,
        op8_jaccard_join,
        op9_personal_data,
        op10_language_id,
        op11_spelling_variants,
        op12_periodic_runs,
        op13_best_fit_packing,
    )
}

ORACLES: dict[str, str] = {}
