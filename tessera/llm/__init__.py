"""Operators for building language-model training data, each a Spark job over whole tables.

- ``toxicity``     noisy-channel deobfuscation and toxicity scores
- ``exact_dedup``  exact duplicates by progressive refinement (length, prefix hash, full hash)
- ``token_counts`` exact histogram of encoded lengths
- ``sharding``     range partition by sampled, size-weighted splitters
- ``packing``      power-of-two decomposition into padding-free sequences
- ``url_filter``   rules and a logistic regression on hashed character n-grams
- ``quality``      quality rules and cross-document line frequency
- ``sp_dropout``   seeded merge-dropout encoding and lossless decoding
- ``simhash``      SimHash near duplicates through a Gray-order hierarchical index
- ``substring``    repeated passages by collinear chaining
- ``runs``         maximal repetitions of words by a Re-Pair grammar
- ``collocations`` phrases by multikey quicksort of suffix pointers
- ``decontaminate`` benchmark windows in documents by a prefix-filtered set join

``blocks`` and ``members`` shuffle keys compactly and filter them.

``queries`` registers one query per operator. Nothing else in the library imports this package.
"""
