"""Print COVERAGE.md: each SURVEY §2 id -> implementation -> registered queries -> tests.

The query column comes from the registry (each query lists the ids it
exercises); the implementation and test columns are maintained here.
"""

from __future__ import annotations

import os
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tackroom.plans import catalog  # noqa: E402,F401
from tackroom.plans.registry import REGISTRY  # noqa: E402

IMPL = {
    "S1": ("sources.shards.list_shards (empty files too), read_shard_lines (glob + name regex), plans.flows.merge_job (nothing to merge); sources.landing.list_landed (manifest, nothing listed)", "test_typed_loads::test_empty_shards_are_listed_counted_and_retired, test_clean::test_shards_order_and_pattern, test_sources::test_merge_job_nothing_then_merged, test_landing_inference"),
    "S2": ("sources.shards.read_shard_lines (order key shard/file/block/row); sources.landing.read_landed", "test_clean::test_order_invariant_under_small_splits, test_landing_inference"),
    "S3": ("sources.shards.write_master", "test_sources::test_merge_job_nothing_then_merged"),
    "S4": ("sources.ledger (one ledger for batch and stream), shards.retire_files; streaming cleanSource", "test_quarantine_ledger::test_one_ledger_for_batch_and_stream, test_sources::test_ledger_skips_consumed, test_merge_job_removes_after_commit"),
    "S5": ("sources.shards.merge_summary (over the listing)", "test_batches_streaming::test_write_and_read_batch_shards, test_typed_loads::test_empty_shards_are_listed_counted_and_retired"),
    "S6": ("sources.shards.write_batch_shards, write_line_shards; sources.landing.land (files of one folder, manifest)", "test_batches_streaming::test_write_and_read_batch_shards, test_landing_inference"),
    "S7": ("sources.shards.write_cleaned, cleaned_name; plans.flows.clean_job", "test_sources::test_names_and_percent"),
    "S8": ("sources.tables.load_staging, functions.records.load_records; functions.inference (lattice, load_inferred)", "test_typed_loads, test_flow_racing, test_landing_inference::test_types_meet_in_the_lattice"),
    "S9": ("sources.tables.read_target/write_target (versioned, bucketed), upsert_ranged; sources.merge_on_read (deltas, manifest, compaction); upsert_version (counts while writing, NULL keys beside the buckets)", "test_upsert::test_versioned_target, test_bucketed_upsert_shuffles_only_source, test_merge_on_read, test_many_null_keys_are_spread_and_the_rest_joins_in_place"),
    "S10": ("sources.tables.write_snapshot/read_snapshot, snapshot_suffix", "test_sources::test_snapshot_prunes_to_one_day"),
    "S11": ("sources.tables.read_instances", "test_sources::test_instances_object_bare_and_missing, test_request_value_cases"),
    "P1": ("functions.jsonline.is_blank", "test_clean::test_classes"),
    "P2": ("functions.jsonline.strict_parse", "test_clean::test_classes"),
    "P3": ("functions.jsonline.id_identity/js_truthy_id; operators.clean.classify_lines", "test_clean::test_classes, test_key_identity_and_first_wins"),
    "P4": ("operators.reshape.flatten_profile", "test_reshape::test_flatten_profile_falsy_and_missing, test_landed_responses_to_records"),
    "P5": ("functions.columns.falsy_to_null", "test_reshape::test_flatten_profile_falsy_and_missing"),
    "P6": ("operators.reshape.flatten_races, race_element", "test_reshape::test_landed_responses_to_records"),
    "P7": ("functions.fold.fold_prizes (nested), fold_prize_rows (chunked scan)", "test_reshape::test_fold_rules, test_fold_forms_agree"),
    "P8": ("operators.reshape.map_career", "test_reshape::test_map_career_null_to_empty_and_constants"),
    "P9": ("operators.reshape.map_races", "test_reshape::test_map_races_bad_cast_fails, test_flow_racing"),
    "P10": ("operators.scoring.cast_string_fields", "test_scoring::test_casts"),
    "P11": ("operators.scoring.cast_numeric_fields", "test_scoring::test_casts, test_sources::test_request_value_cases"),
    "J1": ("operators.reshape.assemble_profiles", "test_reshape::test_assemble_requires_all_three"),
    "J2": ("operators.upsert.upsert; sources.tables.upsert_ranged; sources.merge_on_read.upsert_delta/read_merged/compact, sources.tables.upsert_version", "test_upsert::test_upsert_semantics, test_batches_streaming::test_ranged_upsert_rewrites_only_touched_ranges, test_merge_on_read"),
    "J3": ("operators.upsert.assert_unique_source", "test_upsert::test_duplicate_source_fails"),
    "J4": ("operators.reshape.unnest_elements", "test_reshape::test_unnest_keeps_empty"),
    "A1": ("operators.clean.group_lines/kept_lines, dedupe_first", "test_clean::test_key_identity_and_first_wins, test_keep_last"),
    "A2": ("operators.clean.clean_report", "test_clean::test_report_sums_to_total"),
    "A3": ("operators.upsert.reconcile_counts; upsert_version, upsert_ranged, merge_on_read.reconcile_log (observed while writing)", "test_upsert::test_reconcile, test_upsert::test_counts_taken_while_writing_equal_those_of_whole_tables, test_merge_on_read"),
    "A4": ("operators.batches.batch_outcomes", "test_batches_streaming::test_missing_ids_and_outcomes"),
    "W1": ("operators.scoring.relative_rank", "test_scoring::test_relative_rank_half_even_and_equal"),
    "W2": ("operators.scoring.greedy_top_k", "test_scoring::test_greedy_matches_brute_force"),
    "W3": ("sources.shards ORDER_COLS; keep='last' in clean", "test_clean::test_rescraped_range_older_wins_unless_keep_last"),
    "U1": ("sources.shards.read_shard_lines (multi-file scan)", "test_clean::test_shards_order_and_pattern"),
    "U2": ("operators.batches.id_batches, batch_of", "test_batches_streaming::test_id_batches"),
    "U3": ("operators.batches.missing_ids", "test_batches_streaming::test_missing_ids_and_outcomes"),
    "F1": ("functions.jsonline.strict_parse; from_json with schema", "test_clean::test_classes"),
    "F2": ("kept source line is written as read (no re-serialisation); functions.columns.js_number_text for numbers read as text", "test_clean::test_shards_order_and_pattern, test_typed_loads::test_number_text_as_the_original_writes_it"),
    "F3": ("functions.jsonline.is_blank", "test_clean::test_classes"),
    "F4": ("functions.fold (concat with ' + ')", "test_reshape::test_fold_rules"),
    "F5": ("sources.shards name regex on file_name / shard", "test_clean::test_shards_order_and_pattern"),
    "F6": ("sources.tables.snapshot_suffix; cleaned_name", "test_sources::test_snapshot_prunes_to_one_day"),
    "F7": ("reshape casting rules", "test_reshape::test_map_races_bad_cast_fails"),
    "F8": ("reshape.map_struct / map_struct_array", "test_reshape::test_landed_responses_to_records"),
    "F9": ("operators.scoring.class_probs", "test_scoring::test_class_probs_and_cumulative"),
    "F10": ("operators.scoring.prob_of", "test_scoring::test_class_probs_and_cumulative"),
    "F11": ("bround in relative_rank", "test_scoring::test_relative_rank_half_even_and_equal"),
    "F12": ("functions.columns.percent_text", "test_sources::test_names_and_percent"),
    "F13": ("run_ts parameter everywhere", "test_upsert::test_upsert_semantics"),
    "M1": ("operators.scoring.class_probs (fails under 8 scores)", "test_scoring::test_fewer_than_eight_scores_fails"),
    "M2": ("operators.scoring.win_place_top3", "test_scoring::test_class_probs_and_cumulative"),
    "M3": ("operators.scoring.race_card (+ greedy_top_k)", "test_entry (race_card parity)"),
    "M4": ("operators.ml.score (fixed label order)", "test_ml::test_train_score_label_order"),
    "M5": ("operators.ml.train (dry run; model='auto' picks by held-out macro AUC), macro_auc; operators.auc (exact ROC AUC by ranks)", "test_ml::test_train_score_label_order, test_auto_picks_by_auc, test_running::test_auc_equals_all_pairs"),
    "X1": ("operators.features.career_totals; operators.running.as_of (point in time)", "test_features::test_career_totals_and_as_of, test_running::test_as_of_counts_earlier_rows_only"),
    "X2": ("operators.features.career_totals", "test_features::test_career_totals_and_as_of"),
    "X3": ("operators.features.career_totals, functions.columns.prize_total", "test_features::test_career_totals_and_as_of"),
    "X4": ("operators.features.trainer_stats; operators.running.as_of (point in time)", "test_features::test_trainer_stats_as_of, test_running::test_as_of_counts_earlier_rows_only"),
    "X5": ("operators.features.birth_year", "test_features::test_small_features"),
    "X6": ("operators.features.jockey_weight_missing", "test_features::test_small_features"),
    "X7": ("operators.features.race_rows / race_context", "test_entry (race_context_rows parity)"),
    "X8": ("operators.features.position_class", "test_features::test_small_features"),
    "E1": ("plans.flows.clean_job", "test_entry (clean_job_files parity)"),
    "E2": ("plans.flows.merge_clean_upsert; operators.quarantine; layouts files, partitioned, manifest; targets versioned, ranged, merge on read", "test_flow_racing::test_profiles_flow_twice, test_profiles_flow_ranged, test_quarantine_ledger, test_landing_inference::test_ingest_from_a_manifest"),
    "E3": ("train_and_rank query (features -> snapshot -> model -> card)", "test_entry (rows)"),
    "T1": ("streaming.incremental.shard_stream / incremental_shards; sources.ledger shared with batch runs", "test_batches_streaming::test_incremental_consumes_only_new, test_quarantine_ledger::test_one_ledger_for_batch_and_stream"),
    "T2": ("streaming.incremental.incremental_upsert, upsert_batch(_ranged); upsert_batch_delta; first record of a typed key wins, or the batch fails", "test_batches_streaming::test_incremental_upsert_replaces, test_upsert_batch_replay_is_skipped, test_ranged_streaming_replay, test_typed_loads::test_ids_that_are_one_key_once_typed"),
}


def main() -> None:
    by_id = defaultdict(list)
    for name, q in REGISTRY.items():
        for op in q.operators.split():
            by_id[op].append(name + ("" if q.sql else " (rows)"))
    print("# Coverage of SURVEY §2\n")
    print("Generated by `scripts/coverage_table.py`. Paths are relative to `tackroom/`; tests to `tests/`.\n")
    print("| ID | Implementation | Registered queries | Tests |")
    print("| --- | --- | --- | --- |")
    for op, (impl, tests) in IMPL.items():
        print(f"| {op} | {impl} | {', '.join(by_id.get(op, [])) or '—'} | {tests} |")


if __name__ == "__main__":
    main()
