from termloom.functions.counting import count_values, terms_of
from termloom.functions.scoring import DEFAULT_N_DOCS, idf_value
from termloom.functions.stemming import with_stem
from termloom.functions.tagging import LEXICON, tag_token
from termloom.functions.tokenizing import TOKEN_RE, split_lines, tokenize

__all__ = [
    "DEFAULT_N_DOCS",
    "LEXICON",
    "TOKEN_RE",
    "count_values",
    "idf_value",
    "split_lines",
    "tag_token",
    "terms_of",
    "tokenize",
    "with_stem",
]
