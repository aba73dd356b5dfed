"""Training-data operators: tokenisation, quality, deduplication, language, mixing.

Each module holds one operator with a general interface; ``registry`` binds the
operators to the registered queries.  Nothing outside this folder imports it.
"""
