"""Operators for large training corpora: quality, toxicity, search, language
model scoring, token accounting, deduplication, decontamination and mixing."""
