"""The registered queries of this subpackage and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

from .adaptive_scan import op3_adaptive_scan
from .anchor_tree import OP13_SQL, op13_anchor_tree
from .byte_bpe import op9_byte_bpe
from .cross_polytope import OP11_SQL, op11_cross_polytope
from .html_text import op7_html_text
from .label_shards import op10_label_shards
from .ngram_join import OP5_SQL, op5_ngram_jaccard
from .pii import op6_pii
from .preference_chat import OP1_SQL, op1_preference_chat
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .spaced_seeds import op8_spaced_seeds
from .toxicity import op2_toxicity
from .url_rules import OP4_SQL, op4_url_rules

QUERIES = {f.__name__: f for f in (op1_preference_chat, op2_toxicity, op3_adaptive_scan, op4_url_rules, op5_ngram_jaccard, op6_pii,
                                   op7_html_text, op8_spaced_seeds, op9_byte_bpe, op10_label_shards, op11_cross_polytope, op12_prefix_trie,
                                   op13_anchor_tree)}

ORACLE = {"op1_preference_chat": OP1_SQL, "op4_url_rules": OP4_SQL, "op5_ngram_jaccard": OP5_SQL,
          "op11_cross_polytope": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_anchor_tree": OP13_SQL}
