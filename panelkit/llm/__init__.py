"""Operators for preparing training text: ten jobs on documents, conversations and vectors.

``langid``        language by family, then by duels inside the family
``edit_counts``   token counts kept in trees and updated under edits
``transducer``    byte-pair encoding and decoding through a lexicon automaton
``block_join``    nearest neighbours by tiles of int8 products with error bounds
``chat``          conversations checked and formatted by a declarative template
``quality``       a classifier on learned word and n-gram vectors
``packing``       windows of tokens cut by dynamic programming
``dart_minhash``  near duplicates by weighted signatures and banded joins
``disclosure``    personal data and the words that disclose it
``cuckoo``        exact duplicates through a cuckoo-filter index

``queries`` runs each of them over the test tables. Nothing else in the package imports this.
"""
