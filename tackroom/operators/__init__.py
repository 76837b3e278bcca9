"""DataFrame -> DataFrame operators."""

from tackroom.operators.batches import batch_of, batch_outcomes, id_batches, missing_ids
from tackroom.operators.clean import classify_lines, clean, clean_report, dedupe_first, group_lines, kept_lines
from tackroom.operators.features import (
    birth_year, career_totals, jockey_weight_missing, position_class, race_context, race_rows, trainer_stats,
)
from tackroom.operators.reshape import (
    assemble_profiles, flatten_profile, flatten_races, map_career, map_races, map_struct,
    map_struct_array, race_element, unnest_elements,
)
from tackroom.operators.scoring import (
    cast_numeric_fields, cast_string_fields, class_probs, greedy_top_k, prob_of, race_card,
    relative_rank, win_place_top3,
)
from tackroom.operators.skew import rank_in_group, split_by_group_size
from tackroom.operators.upsert import DuplicateSourceKey, assert_unique_source, reconcile_counts, upsert

__all__ = [
    "batch_of", "batch_outcomes", "id_batches", "missing_ids",
    "classify_lines", "clean", "clean_report", "dedupe_first", "group_lines", "kept_lines",
    "birth_year", "career_totals", "jockey_weight_missing", "position_class", "race_context", "race_rows",
    "trainer_stats",
    "assemble_profiles", "flatten_profile", "flatten_races", "map_career", "map_races", "map_struct",
    "map_struct_array", "race_element", "unnest_elements",
    "cast_numeric_fields", "cast_string_fields", "class_probs", "greedy_top_k", "prob_of", "race_card",
    "relative_rank", "win_place_top3",
    "rank_in_group", "split_by_group_size",
    "DuplicateSourceKey", "assert_unique_source", "reconcile_counts", "upsert",
]
