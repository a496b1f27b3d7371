"""Training-data operators: search, mixing, deduplication, licences, toxicity,
token files, personal data, similarity joins and BPE encoding.

Each module holds one operator with its own general interface; ``queries``
derives the registered queries from them.  Nothing else in the library
imports this package.
"""
