"""All modules of the package that register a query."""

from wattloom.llm import (  # noqa: F401
    conversation_repair, decontaminate, embedding_dedup, html_extraction, lexical_search, ngram_join, packing, quality, secrets, substring_dedup, tool_calls, toxicity,
    vector_search,
)
from wattloom.llm.base import ORACLE, QUERIES  # noqa: F401
