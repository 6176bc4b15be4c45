"""Operators for large-scale training-data preparation.

Each module holds one operator with its own general interface and the thin
registered query on top of it:

  suffix_dedup.py   repeated 100-byte strings by sparse prefix doubling
  packing.py        mixture-controlled packing (deficit round-robin)
  quality.py        hierarchical empirical-Bayes quality classifier
  mixing.py         mixing sources to target weights (block permutations)
  ann.py            nearest neighbours on shifted Hilbert curves
  token_count.py    separator scan over flat token files
  pii.py            keyed surrogate generation for personal data
  near_dedup.py     MinHash near-duplicates by a multi-index Hamming join
  warc.py           WARC writer and sequential reader
  exact_dedup.py    exact duplicates by deterministic block naming (native)
  prefix_trie.py    prefix trie of conversations by the Euler-tour technique
  centroids.py      centroid clustering with a table of pivot distances (LAESA)
  repair.py         token files compressed by Re-Pair grammars
  registry.py       the registered queries and their SQL
"""
