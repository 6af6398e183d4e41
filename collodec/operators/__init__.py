from .counts import (
    bigram_counts,
    decade_totals,
    merge_totals,
    prepare_bigrams,
    prepare_unigrams,
    sum_measures,
    unigram_counts,
    unigram_grouping_sets,
)
from .filters import drop_empty, drop_null_keys, drop_stop_words, filter_arity
from .lookup import lookup_join
from .marginals import (
    attach_first_marginal,
    attach_second_marginal,
    attach_total,
    marginal_by_window,
    pair_marginals,
    reverse_pairs,
    split_union,
    union_marginals_and_pairs,
)
from .ordering import key_order, order_by_counts, output_order
from .scores import with_scores, with_terms

__all__ = [
    "attach_first_marginal",
    "attach_second_marginal",
    "attach_total",
    "bigram_counts",
    "decade_totals",
    "drop_empty",
    "drop_null_keys",
    "drop_stop_words",
    "filter_arity",
    "key_order",
    "lookup_join",
    "marginal_by_window",
    "merge_totals",
    "order_by_counts",
    "output_order",
    "pair_marginals",
    "prepare_bigrams",
    "prepare_unigrams",
    "reverse_pairs",
    "split_union",
    "sum_measures",
    "unigram_counts",
    "unigram_grouping_sets",
    "union_marginals_and_pairs",
    "with_scores",
    "with_terms",
]
