"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from revlens.llm.decontaminate import op6_decontaminate
from revlens.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from revlens.llm.langid import op1_langid
from revlens.llm.line_dedup import OP7_SQL, op7_line_dedup
from revlens.llm.merkle import OP11_SQL, op11_merkle
from revlens.llm.near_dedup import op2_near_dedup
from revlens.llm.piece_bpe import op4_sentencepiece
from revlens.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from revlens.llm.quality import op9_quality
from revlens.llm.quality_rules import OP13_SQL, op13_quality_rules
from revlens.llm.secret_scan import op5_secret_scan
from revlens.llm.token_shards import op3_token_shards
from revlens.llm.warc_bundles import OP8_SQL, op8_warc

QUERIES = {
    "op1_langid": op1_langid,
    "op2_near_dedup": op2_near_dedup,
    "op3_token_shards": op3_token_shards,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_secret_scan": op5_secret_scan,
    "op6_decontaminate": op6_decontaminate,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_quality": op9_quality,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_merkle": op11_merkle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality_rules": op13_quality_rules,
}
ORACLES: dict[str, str] = {
    "op7_line_dedup": OP7_SQL,
    "op8_warc": OP8_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_merkle": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_quality_rules": OP13_SQL,
}
