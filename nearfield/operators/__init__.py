from nearfield.operators.distance import distance_pairs, scaled_features, squared_distance, with_vector
from nearfield.operators.lsh import lsh_semi_join, projections, with_hashes
from nearfield.operators.range_join import range_anti_join, range_pairs, range_semi_join
from nearfield.operators.upsert import latest
from nearfield.operators.wide import exact_pairs, wide_pairs, wide_semi_join

__all__ = [
    "distance_pairs",
    "exact_pairs",
    "latest",
    "lsh_semi_join",
    "projections",
    "range_anti_join",
    "range_pairs",
    "range_semi_join",
    "scaled_features",
    "squared_distance",
    "wide_pairs",
    "wide_semi_join",
    "with_hashes",
    "with_vector",
]
