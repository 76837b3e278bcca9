"""Importing this module registers every query of the subpackage."""

from tackroom.llm import q_ann, q_bpe, q_chat, q_decontaminate, q_dedup, q_fim, q_fingerprints, q_html, q_langid, q_lines, q_sharding, q_warc, q_whitening  # noqa: F401
from tackroom.llm.registry import QUERIES

__all__ = ["QUERIES"]
