"""Training-data operators: WARC, BPE, URL filters, quality rules, dedup, packing,
toxicity, similarity joins, quality scoring and vector search.

Nothing outside this subpackage imports it.
"""
