"""Training-data operators: quality, language models, licences, URLs, mixing,
decontamination, suffix and SimHash de-duplication, PII and quality rules.

Nothing outside this folder imports it; ``queries.py`` registers its queries.
"""
