"""Training-data operators: deduplication, filtering, formatting and packing of text corpora.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``queries.py`` holds the thin queries of the driver contract.
"""
