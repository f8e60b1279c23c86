"""Operators for preparing training data: dedup, extraction, scoring, tokenising, packing, search.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries when it is there.
"""
