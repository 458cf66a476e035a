"""Operators for large training corpora: URL filters, mixing, chat formatting,
decontamination, exact search, sharding, deduplication, quality scores, token
counts, Merkle manifests, hard negatives and toxicity. Nothing outside this
subpackage imports it."""
