"""

Ids listed under ``TESTED_ONLY`` have no query of their own worth
registering; the named tests exercise them.
"""

from __future__ import annotations

QUERIES_BY_ID: dict[str, list[str]] = {
    "A1": ["a1_json_events", "a1_read_files"],
    "A2": ["a2_change_feed"],
    "A3": ["a3_table_scan"],
    "A4": ["a4_append_history"],
    "A5": ["st4_stream_upsert", "a5_older_second_batch"],
    "A6": ["a6_land_raw", "a6_unprocessed"],
    "B1": ["b1_amount_minor", "c3_c4_dirty_rows"],
    "B2": ["b2_timestamps", "b2_iso_forms"],
    "B3": ["b4_payload_fields"],
    "B4": ["b4_payload_fields", "b4_variant_payload", "c1_lookup_latest", "j6_failure_breakdown"],
    "B5": ["e1_users", "e2_merchants"],
    "B6": ["a1_read_files", "e5_refunds"],
    "B7": ["b7_log_ids"],
    "B8": ["e3_payment_intents", "e4_charges", "e5_refunds", "e6_chargebacks"],
    "B9": ["e3_payment_intents"],
    "B10": ["b10_unify_v0", "b10_unify_v1", "b10_unify_versions", "jn3_fill_sparse_late", "c4_reject_reasons", "d6_v0_exact_copies"],
    "C1": ["c1_lookup_latest", "c1_events_of_a_month", "c1_lookup_by_entity"],
    "C2": ["c2_route_counts"],
    "C3": ["c3_c4_dirty_rows"],
    "C4": ["c3_c4_dirty_rows", "c4_reject_reasons"],
    "C5": ["c12_constraint_report", "c12_broken_tables"],
    "C6": ["c12_constraint_report", "c12_broken_tables"],
    "C7": ["c7_one_entity_literal", "c12_broken_tables"],
    "C8": ["c12_constraint_report", "c12_broken_tables", "c12_batched_report"],
    "C9": ["c12_broken_tables", "c12_batched_report", "jn5_lost_refund_ids"],
    "C10": ["c12_constraint_report", "c12_broken_tables", "b4_variant_payload"],
    "C11": ["a2_change_feed"],
    "C12": ["c12_constraint_report", "c12_broken_tables", "c12_batched_report"],
    "C13": ["e1_users", "e2_merchants"],
    "D1": ["d1_dedup_history", "h2_top_transitions"],
    "D2": ["d2_dedup_raw"],
    "D3": ["d3_classify_deliveries", "d3_null_keys"],
    "D4": ["d4_duplicate_rates"],
    "D5": ["d5_key_collisions", "d5_sketched_reuse"],
    "D6": ["d6_v0_exact_copies"],
    "E1": ["e1_users"],
    "E2": ["e2_merchants"],
    "E3": ["e3_payment_intents"],
    "E4": ["e4_charges"],
    "E5": ["e5_refunds", "e5_refunds_by_id"],
    "E6": ["e6_chargebacks"],
    "E7": ["e7_intent_status"],
    "F1": ["f1_status_counts"],
    "F2": ["f2_transition_counts", "f2_stream_transitions", "f2_tied_events", "h2_top_transitions"],
    "F3": ["f3_pool_sizes"],
    "F4": ["f4_apply_metrics", "f4_stream_metrics"],
    "F5": ["f5_rows_per_transaction", "c1_lookup_latest"],
    "G1": ["g1_previous_status", "f2_stream_transitions"],
    "G2": ["g2_first_last_status"],
    "H1": ["h1_latest_per_transaction", "c1_lookup_latest"],
    "H2": ["h2_top_transitions"],
    "H3": ["h3_first_n_deliveries"],
    "U1": ["u1_bag_union"],
    "J1": ["j1_open_authorisations", "st7_open_too_long"],
    "J2": ["j2_open_captures"],
    "J3": ["j3_lifecycle_state", "j3_tied_events"],
    "J4": ["j4_illegal_transitions", "j4_illegal_by_event_time"],
    "J5": ["j5_lifecycle_funnel"],
    "J6": ["j6_failure_breakdown"],
    "JN1": ["jn1_capture_with_authorisation", "jn1_stream_join"],
    "JN2": ["jn2_late_with_capture"],
    "JN3": ["jn3_fill_sparse_late"],
    "JN4": ["jn4_payment_chain"],
    "JN5": ["jn5_lost_refund_ids"],
    "JN6": ["jn6_insert_if_absent"],
    "ST1": ["st1_lateness_bands"],
    "ST2": ["st2_late_split", "st2_stream_late_split"],
    "ST3": ["st3_stream_dedup"],
    "ST4": ["st4_stream_upsert"],
    "ST5": ["a2_change_feed", "st5_keyed_deletes"],
    "ST6": ["st6_snapshot_then_changes"],
    "ST7": ["st7_stream_lifecycle", "st7_open_too_long"],
}

# Behaviour beyond the registered queries, checked by these tests.
# Not built: a table format of one's own (commit log, versions, compaction) is engine work.
NOT_BUILT = ["A7"]

TESTED_ONLY: dict[str, list[str]] = {
    "B6": ["tests/test_normalise.py::test_default_applies_only_when_key_absent"],
    "B9": ["tests/test_fold.py::test_applied_at_literal_stamps_one_time_per_batch"],
    "C3": ["tests/test_validate.py::test_strict_mode_fails_the_batch"],
}
