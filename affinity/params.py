"""Frozen operator defaults (the effective values of the analysed notebooks)."""

from __future__ import annotations

from types import MappingProxyType

# fixed values: defaults that must equal the analysed project's behaviour
DEFAULTS = MappingProxyType({
    "rating_threshold": 3.5,          # like = rating >= 3.5
    "sample_fraction": 0.2,           # item sample for the similarity study
    "sample_seed": 42,
    "hash_seed": 42,
    "k_values": (10, 20, 50, 100, 200),
    "lsh_configs": ((10, 20), (25, 8), (40, 5), (50, 4), (100, 2)),
    "similarity_threshold": 0.3,      # ground truth: Jaccard >= 0.3
    "mllib_tables": 20,
    "mllib_distance": 0.7,
    "min_support": 0.03,
    "min_confidence": 0.1,
    "basket_min": 2,
    "basket_max": 220,
    # our own: a limit that the fixtures reach
    "basket_guard": 15,
    "relevant_confidence": 0.2,
    "relevant_lift": 1.0,
    "graph_lift": 1.2,
    "sequel_similarity": 0.85,
    "top_k": 20,
    "quality_min_ratings": 50,
    # our own: a limit that some items of the fixtures miss
    "quality_few_ratings": 30,
    "quality_top_k": 15,
    "pareto_share": 0.2,
    "histogram_bins": 50,
    "log_bins": 50,
    "density_grid": 45,
    "niche_min_ratings": 100,
    "niche_bubble_scale": 0.7,
})

# fixed values: the two named profiles, which replace some of the defaults
PROFILES = MappingProxyType({
    "quick": MappingProxyType({
        "sample_fraction": 0.10,
        "k_values": (400,),
        "lsh_configs": ((50, 8), (80, 5), (100, 4), (200, 2)),
        "similarity_threshold": 0.85,
        "mllib_tables": 48,
        "mllib_distance": 0.35,
    }),
    "full": MappingProxyType({
        "sample_fraction": 0.10,
        "k_values": (1200,),
        "lsh_configs": ((120, 10), (150, 8), (240, 5), (300, 4), (600, 2)),
        "similarity_threshold": 0.85,
        "mllib_tables": 96,
        "mllib_distance": 0.30,
    }),
})


def profile(name: str | None = None) -> MappingProxyType:
    """The defaults, or those with a named profile's values in their place."""
    if name is None:
        return DEFAULTS
    if name not in PROFILES:
        raise ValueError(f"a profile is one of {', '.join(PROFILES)}")
    return MappingProxyType({**DEFAULTS, **PROFILES[name]})


#: Mersenne prime 2^31 - 1, modulus of the MinHash family.
MERSENNE_P = 2147483647
