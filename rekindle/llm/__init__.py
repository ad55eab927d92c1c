"""Training-data operators (ten of them) on Spark; nothing else in the library imports this package.

Each module holds one operator with a general interface; ``queries.py`` registers
one query per operator over the supplied tables, and ``corpus_pipeline.py`` at the
top of the repository chains five of them.
"""
