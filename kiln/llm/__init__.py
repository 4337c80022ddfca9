"""Training-data operators: tokenising, chat formatting, de-duplication,
scoring, redaction, extraction, packing and quality rules.

Nothing outside this folder (but the driver contract) imports it.
"""
