"""Training-data operators: fingerprints, deduplication, mixing, filters, decontamination, token files and archives.

Nothing outside this folder imports it; ``queries`` has the registered ``opN_`` queries.
"""
