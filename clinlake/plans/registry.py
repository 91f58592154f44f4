"""Query registry: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinlake.plans import cohort, dictionary, evaluation, icu, image, profile, scans, selection, stroke, waveform

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        # relational cohort analysis
        "cohort_counts": cohort.q_cohort_counts,
        "inner_equi_join": cohort.q_inner_equi_join,
        "code_join_numeric": cohort.q_code_join_numeric,
        "code_join_exact": cohort.q_code_join_exact,
        "text_match_count": cohort.q_text_match_count,
        "title_match_count": cohort.q_title_match_count,
        # size-graded scans
        "filter_item_threshold_count": scans.q_filter_item_threshold_count,
        "row_count": scans.q_row_count,
        "group_count_high_card": scans.q_group_count_high_card,
        "group_count_low_card": scans.q_group_count_low_card,
        "preview_top_n": scans.q_preview_top_n,
        "csv_scan_typed": scans.q_csv_scan_typed,
        "csv_scan_inferred": scans.q_csv_scan_inferred,
        "label_matrix_scan": scans.q_label_matrix_scan,
        "csv_scan_profiled": scans.q_csv_scan_profiled,
        "checked_scan_good": scans.q_checked_scan_good,
        "checked_scan_bad": scans.q_checked_scan_bad,
        # size profiling
        "table_size": profile.q_table_size,
        "profile_tables": profile.q_profile_tables,
        "observed_sizes": profile.q_observed_sizes,
        "joined_sizes": cohort.q_joined_sizes,
        "assembled_size": stroke.q_assembled_size,
        "scored_size": waveform.q_scored_size,
        # stroke recipe
        "tolerant_int_cast": stroke.q_tolerant_int_cast,
        "constant_fill": stroke.q_constant_fill,
        "interaction_features": stroke.q_interaction_features,
        "case_bucket": stroke.q_case_bucket,
        "index_categories": stroke.q_index_categories,
        "assemble_features": stroke.q_assemble_features,
        "feature_table_case": stroke.q_feature_table_case,
        "split_80_20": stroke.q_split_80_20,
        # ICU recipe
        "sentinel_to_null": icu.q_sentinel_to_null,
        "equal_width_bin": icu.q_equal_width_bin,
        "impute_median": icu.q_impute_median,
        "ratio_round": icu.q_ratio_round,
        "edge_bin": icu.q_edge_bin,
        "impute_group_mean": icu.q_impute_group_mean,
        "impute_group_mode": icu.q_impute_group_mode,
        "union_by_name": icu.q_union_by_name,
        "seeded_shuffle_rank": icu.q_seeded_shuffle_rank,
        "feature_table_impute": icu.q_feature_table_impute,
        "feature_table_original": icu.q_feature_table_original,
        # waveform
        "vector_index_cardinality": waveform.q_vector_index_cardinality,
        "vector_distinct_count": waveform.q_vector_distinct_count,
        "vector_category_flags": waveform.q_vector_category_flags,
        "vector_category_maps": waveform.q_vector_category_maps,
        "split_70_30": waveform.q_split_70_30,
        # category dictionaries
        "category_dictionary": dictionary.q_category_dictionary,
        "category_codes": dictionary.q_category_codes,
        # metrics
        "confusion_matrix": evaluation.q_confusion_matrix,
        "classification_metrics": evaluation.q_classification_metrics,
        "classification_report": evaluation.q_classification_report,
        "auc_roc": evaluation.q_auc_roc,
        "binary_scorecard": evaluation.q_binary_scorecard,
        "misclassified_rows": evaluation.q_misclassified_rows,
        "argmax_array": evaluation.q_argmax_array,
        "roc_curve": evaluation.q_roc_curve,
        # quantiles and k-fold selection
        "exact_quantiles": selection.q_exact_quantiles,
        "quantile_bins": selection.q_quantile_bins,
        "fold_split": selection.q_fold_split,
        "fold_leaderboard": selection.q_fold_leaderboard,
        "out_of_fold_predictions": selection.q_out_of_fold_predictions,
        # boosting for several classes
        "boosted_predictions": selection.q_boosted_predictions,
        "boosted_metrics": selection.q_boosted_metrics,
        # models (SQL checks what must hold of every scored row; metric rows are held against Spark's evaluators)
        "logistic_predictions": stroke.q_logistic_predictions,
        "forest_predictions": stroke.q_forest_predictions,
        "tuning_leaderboard": stroke.q_tuning_leaderboard,
        "forest_leaderboard": stroke.q_forest_leaderboard,
        "stroke_scorecard": stroke.q_stroke_scorecard,
        "forest_scorecard": stroke.q_forest_scorecard,
        "icu_predictions": icu.q_icu_predictions,
        "icu_scorecard": icu.q_icu_scorecard,
        "tree_predictions": waveform.q_tree_predictions,
        "multinomial_predictions": waveform.q_multinomial_predictions,
        "waveform_metrics": waveform.q_waveform_metrics,
        "tree_metrics": waveform.q_tree_metrics,
        "tree_misclassified": waveform.q_tree_misclassified,
        "mlp_predictions": image.q_mlp_predictions,
        "mlp_report": image.q_mlp_report,
        # image features, mini-batch descent with momentum
        "cyclic_batches": image.q_cyclic_batches,
        "network_history": image.q_network_history,
        "network_predictions": image.q_network_predictions,
        "network_report": image.q_network_report,
    }
