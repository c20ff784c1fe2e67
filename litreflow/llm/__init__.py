"""Training-data operators: fingerprints, decontamination, classifiers, chat
formatting, packing, near-duplicate and passage removal, tokenization.

Nothing outside this subpackage imports it.
"""
