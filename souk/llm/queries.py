"""The corpus operators' queries and their SQL, by name."""

from __future__ import annotations

from souk.llm import (  # noqa: F401  (they register their queries)
    bpe, collocations, exact_dedup, filter_audit, fingerprints, html_text, language_id, line_dedup, mixing, near_dedup, quality, quotes, vector_links,
)
from souk.llm.common import ORACLES, QUERIES, importable

__all__ = ["ORACLES", "QUERIES", "importable"]
