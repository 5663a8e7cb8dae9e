"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from tallyhouse.llm import decontaminate, fingerprints, jaccard, merkle, mixing, neighbours, pages, pii, quality, secrets, substrings, tokens, trie
from tallyhouse.llm.base import LlmQuery, table


def all_llm_queries() -> list[LlmQuery]:
    return [
        LlmQuery("op1_nearest_neighbours", lambda s, d: neighbours.op1(s, table(s, d, "embeddings"))),
        LlmQuery("op2_quality", lambda s, d: quality.op2(s, table(s, d, "documents"), table(s, d, "labels"))),
        LlmQuery("op3_secret_scan", lambda s, d: secrets.op3(s, table(s, d, "documents")), secrets.sql()),
        LlmQuery("op4_pii", lambda s, d: pii.op4(s, table(s, d, "documents"))),
        LlmQuery(
            "op5_decontaminate",
            lambda s, d: decontaminate.op5(s, table(s, d, "documents"), table(s, d, "benchmark")),
            decontaminate.SQL,
        ),
        LlmQuery("op6_substring_dedup", lambda s, d: substrings.op6(s, table(s, d, "documents")), substrings.SQL),
        LlmQuery("op7_jaccard_join", lambda s, d: jaccard.op7(s, table(s, d, "documents")), jaccard.SQL),
        LlmQuery("op8_token_ids", lambda s, d: tokens.op8(s, table(s, d, "documents"))),
        LlmQuery("op9_mixing", lambda s, d: mixing.op9(s, table(s, d, "documents")), mixing.SQL),
        LlmQuery("op10_main_text", lambda s, d: pages.op10(s, table(s, d, "pages"))),
        LlmQuery("op11_merkle_manifest", lambda s, d: merkle.op11(s, table(s, d, "documents")), merkle.SQL),
        LlmQuery("op12_fingerprints", lambda s, d: fingerprints.op12(s, table(s, d, "documents")), fingerprints.SQL),
        LlmQuery("op13_prefix_trie", lambda s, d: trie.op13(s, table(s, d, "conversations")), trie.SQL),
    ]
