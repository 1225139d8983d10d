"""Operators for preparing text corpora: chat formatting, token files, BPE,
quality, decontamination, toxicity, HTML extraction, sharding, near-duplicates.

Nothing outside this folder imports it. ``queries.py`` registers one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
