"""Operators of a training-data pipeline: dedup, fingerprints, language models, filters, sharding, mixing, tokens, HTML.

One module per operator; ``queries`` registers the ``opN_`` queries.  Nothing outside this
subpackage imports it.
"""
