"""Column expressions shared by the operators (all built-in Spark functions,
so they stay inside whole-stage codegen)."""

from .hashing import MERSENNE_P, element_hash, hash_family, hash_sample_predicate
from .text import category_key, shingles, stem_word, title_similarity, words_of

__all__ = ["MERSENNE_P", "element_hash", "hash_family", "hash_sample_predicate",
           "category_key", "shingles", "words_of", "stem_word", "title_similarity"]
