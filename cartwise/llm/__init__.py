"""Operators of a training-data pipeline: quality, toxicity, near-duplicates,
decontamination, packing, HTML extraction, token counts, chat formatting, URL
filters and exact top-k search. Nothing else in the library imports this package."""
