"""All queries of this package, by name."""

from __future__ import annotations

from floodmark.llm import bpe, chat, forest, katz, langid, license, near, packing, periodic, quality, repeats, topk, whitening  # noqa: F401  (they register)
from floodmark.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
