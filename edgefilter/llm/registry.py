"""All queries of this subpackage, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from edgefilter.llm import common
from edgefilter.llm import bpe, decontaminate, html, langid, neighbours, packing, phrases, quality, runs, secrets, simhash, suffixes, whitening  # noqa: F401


def queries() -> dict:
    return dict(common.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(common.ORACLE)
