"""Training-data operators: toxicity, near-duplicates, repeated passages, page
text, search, tokenisation, quality rules, packing and sharding.

Nothing else in the library imports this package.
"""
