"""Training-data operators: scoring, packing, extraction, matching, search, redaction, tokens.

Nothing else in the package imports this one.
"""
