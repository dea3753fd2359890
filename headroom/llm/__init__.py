"""Training-data operators: deduplication, filtering, scoring, mixing, sharding and packing of text corpora.

Nothing else in the library imports this subpackage.
"""
