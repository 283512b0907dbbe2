"""Training-data operators: decontamination, language ID, packing, counting, deduplication, token files and PII.

The rest of the library never imports this subpackage.
"""
