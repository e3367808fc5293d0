"""Operators that prepare text corpora for language-model training.

Nothing outside this package imports it.  Each module holds one operator with a general interface; ``queries``
holds the thin registered queries built on them.
"""
