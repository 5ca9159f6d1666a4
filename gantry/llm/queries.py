"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from gantry.llm.centroids import OP11_SQL, op11_centroids
from gantry.llm.ctw import op9_context_tree
from gantry.llm.divergence import OP13_SQL, op13_divergence
from gantry.llm.language import op7_language_id
from gantry.llm.licenses import op12_licenses
from gantry.llm.media import op6_media_columns
from gantry.llm.neardup import op5_near_duplicates
from gantry.llm.packing import op2_packing
from gantry.llm.quality import op10_quality_rules
from gantry.llm.repeats import op8_repeated_passages
from gantry.llm.sentencepieces import op1_sentencepiece
from gantry.llm.tokencounts import op4_token_counts
from gantry.llm.warc import OP3_SQL, op3_warc_revisits

QUERIES = {"op1_sentencepiece": op1_sentencepiece, "op2_packing": op2_packing, "op3_warc_revisits": op3_warc_revisits, "op4_token_counts": op4_token_counts, "op5_near_duplicates": op5_near_duplicates, "op6_media_columns": op6_media_columns, "op7_language_id": op7_language_id, "op8_repeated_passages": op8_repeated_passages, "op9_context_tree": op9_context_tree, "op10_quality_rules": op10_quality_rules, "op11_centroids": op11_centroids, "op12_licenses": op12_licenses, "op13_divergence": op13_divergence}

SQL: dict[str, str] = {"op3_warc_revisits": OP3_SQL, "op11_centroids": OP11_SQL, "op13_divergence": OP13_SQL}
