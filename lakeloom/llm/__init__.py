"""Training-data operators: dedup, scoring, formatting and mixing of text corpora.

Nothing else in the library imports this subpackage.
"""
