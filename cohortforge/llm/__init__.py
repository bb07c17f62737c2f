"""Training-data operators: cleaning, deduplication, packing and sharding of a document corpus.

Nothing else in the library imports this package; ``queries`` registers its queries.
"""
