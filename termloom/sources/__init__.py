from termloom.sources.corpus import (
    count_documents,
    read_corpus_parquet,
    read_corpus_text,
)
from termloom.sources.tables import (
    default_stopwords,
    read_df_table,
    read_stopwords,
    read_tsv,
    stopword_list,
)

__all__ = [
    "count_documents",
    "default_stopwords",
    "read_corpus_parquet",
    "read_corpus_text",
    "read_df_table",
    "read_stopwords",
    "read_tsv",
    "stopword_list",
]
