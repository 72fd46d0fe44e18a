"""Training-data operators (text quality, duplicates, packing, extraction, scans).

Nothing outside this subpackage imports it; ``queries.REGISTRY`` and ``queries.SQL`` are what
``__spark_entry__`` adds when the subpackage is present.
"""
