"""Training-data operators: corpus archives, extraction, deduplication,
decontamination, quality and language models, packing and sharding.

Nothing outside this package imports it; its queries are in ``queries``.
"""
