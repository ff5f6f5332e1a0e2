"""Training-data operators: mixing, packing, deduplication, scoring, extraction.

Nothing outside this subpackage imports it; `registry` lists its queries.
"""
