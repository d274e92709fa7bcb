"""Training-data operators: filters, near-duplicates, mixing, packing, search, formatting.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries when present.
"""
