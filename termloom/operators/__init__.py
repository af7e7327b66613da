from termloom.operators.scoring import tfidf, tfidf_for_terms
from termloom.operators.stripes import (
    explode_stripes,
    merge_stripes,
    row_stripes,
    sum_stripes,
    term_stripes,
    tfidf_stripes,
)
from termloom.operators.tagging import (
    pos_frequency,
    pos_frequency_stripes,
    pos_stripes,
    pos_tag,
    tag_counts,
)
from termloom.operators.terms import (
    apply_stems,
    distinct_terms,
    document_frequency,
    idf,
    stem_vocabulary,
    term_frequency,
    top_terms_by_df,
)
from termloom.operators.tokens import (
    explode_lines,
    explode_tokens,
    normalize,
    remove_stopwords,
)

__all__ = [
    "apply_stems",
    "distinct_terms",
    "document_frequency",
    "explode_lines",
    "explode_stripes",
    "explode_tokens",
    "idf",
    "merge_stripes",
    "normalize",
    "pos_frequency",
    "pos_frequency_stripes",
    "pos_stripes",
    "pos_tag",
    "remove_stopwords",
    "row_stripes",
    "stem_vocabulary",
    "sum_stripes",
    "tag_counts",
    "term_frequency",
    "term_stripes",
    "tfidf",
    "tfidf_for_terms",
    "tfidf_stripes",
    "top_terms_by_df",
]
