"""Training-data operators: decontamination, deduplication, language, secrets, sharding, mixing, chat, PII and quality.

Nothing else in the library imports this subpackage. Queries are in :mod:`tapeline.llm.queries`.
"""
