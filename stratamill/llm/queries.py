"""Imports every operator, so that its query is registered."""

from stratamill.llm import bpe, chat, exact_dedup, jaccard, lexical_search, line_dedup, packing, quality, recurrent_lm  # noqa: F401
from stratamill.llm import secret_scan, substrings, toxicity, turn_trie  # noqa: F401
from stratamill.llm.registry import ORACLE, QUERIES  # noqa: F401
