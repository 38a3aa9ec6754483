"""Training-data operators: text clean-up, near copies, packing and output formats.

Nothing else in the library imports this package; ``queries`` registers its
queries.
"""
