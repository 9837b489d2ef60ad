"""Column-expression building blocks."""

from kiln.functions.exprs import (all_of, argmax_index, between_expr, col_of, cut_expr, extract_group,
                                  groups_expr, mean_bins_expr, nonzero_expr, not_equal_keep_null, numeric,
                                  one_hot_array, prefix_expr, presence_expr, replace_expr, rules_expr,
                                  safe_log1p, starts_with, sum_of, swish, threshold_flag, zscore_expr)

__all__ = ["all_of", "argmax_index", "between_expr", "col_of", "cut_expr", "extract_group", "groups_expr",
           "mean_bins_expr", "nonzero_expr", "not_equal_keep_null", "numeric", "one_hot_array", "prefix_expr",
           "presence_expr", "replace_expr", "rules_expr", "safe_log1p", "starts_with", "sum_of", "swish",
           "threshold_flag", "zscore_expr"]
