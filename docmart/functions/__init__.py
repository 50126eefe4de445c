from .sets import (null_keeping_set, sorted_set, sorted_refs, ref_names, join_refs,
                   join_values, empty_if_null)
from .search import escape_like, contains_ci, all_terms_match, split_terms

__all__ = ["null_keeping_set", "sorted_set", "sorted_refs", "ref_names", "join_refs",
           "join_values", "empty_if_null", "escape_like", "contains_ci", "all_terms_match",
           "split_terms"]
