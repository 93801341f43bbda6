"""Training-data operators: tokenizing, secrets, packing, line and document dedup,
chat formatting, quality rules and classifier, URL rules and fingerprints.

Nothing outside this subpackage imports it.
"""
