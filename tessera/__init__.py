"""tessera: Spark-native numbers, word counts and k-median clustering.

Every operator takes DataFrames and returns DataFrames built from Spark's own
expressions, so Catalyst plans them (pruning, pushdown, partial aggregation).
"""

from tessera.operators.numeric import (  # noqa: F401
    harmonic_mean,
    max_value,
    max_value_sorted,
    normalize_by_max,
)
from tessera.operators.wordcount import (  # noqa: F401
    avg_distinct_word_length,
    distinct_word_count,
    doc_term_counts,
    tokenize,
    word_count,
    word_count_partitioned,
    word_count_report,
    word_count_salted,
)
from tessera.operators.clustering import (  # noqa: F401
    assign_nearest,
    assign_parts,
    cluster_sizes,
    cluster_weights,
    coreset,
    kmedian,
    kmedian_cost,
    kmedian_mr,
    lloyd,
    lloyd_step,
    seed_centers,
)
from tessera.operators.partitioning import spread  # noqa: F401
from tessera.sources.text import lines, parse_numbers, read_documents, read_numbers  # noqa: F401
from tessera.sources.points import parse_points, read_points  # noqa: F401
