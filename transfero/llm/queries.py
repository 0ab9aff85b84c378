"""The registered queries of this subpackage, and DuckDB texts for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .op01_substring_dedup import op1_substring_dedup
from .op02_neighbours import op2_neighbours
from .op03_mixing import op3_mixing
from .op04_quality import op4_quality
from .op05_packing import op5_packing
from .op06_token_counts import op6_token_counts
from .op07_similarity_join import op7_similarity_join
from .op08_secrets import op8_secrets
from .op09_toxicity import op9_toxicity
from .op10_language import op10_language
from .op11_conversation_trie import ORACLE as _TRIE, op11_conversation_trie
from .op12_merkle_manifest import ORACLE as _MANIFEST, op12_merkle_manifest
from .op13_warc import ORACLE as _WARC, op13_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_neighbours, op3_mixing, op4_quality, op5_packing, op6_token_counts,
                            op7_similarity_join, op8_secrets, op9_toxicity, op10_language, op11_conversation_trie,
                            op12_merkle_manifest, op13_warc)
}
ORACLE: dict[str, str] = {"op11_conversation_trie": _TRIE, "op12_merkle_manifest": _MANIFEST, "op13_warc": _WARC}
