"""Training-data operators: deduplication, text coding, archives, quality filters.

Nothing outside this subpackage imports it.
"""
