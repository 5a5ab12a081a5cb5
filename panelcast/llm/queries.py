"""Imports every operator module, so that its queries register."""

from panelcast.llm import byte_bpe, exact_dedup, jaccard_join, license_scan, line_dedup, mixing, phrases, quality, spelling, substring_dedup, token_counts, token_files, topk  # noqa: F401
from panelcast.llm.registry import QUERIES  # noqa: F401
