"""The registered queries in DuckDB SQL, written apart from the package's own rules."""

from __future__ import annotations

from termloom.functions.tagging import LEXICON
from termloom.sources.tables import stopword_list

_OTHER = r"[^\p{L}\p{Nd}\p{Z}\x09-\x0d\x1c-\x1f]"
_PUNCTUATION = [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]
_TOKEN = "|".join([r"\p{L}+", r"\p{Nd}+", *(rf"\x{c:02x}+" for c in _PUNCTUATION), _OTHER])


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


_STOPWORDS = "stopwords(word) AS (VALUES " + ", ".join(f"({_quoted(w)})" for w in stopword_list()) + ")"


def _terms(source: str = "SELECT doc_id, text FROM documents") -> str:
    return rf"""
    {_STOPWORDS},
    tokens AS (
        SELECT doc_id, unnest(regexp_extract_all(text, '{_TOKEN}')) AS token FROM ({source})
    ),
    terms AS (
        SELECT doc_id, lower(token) AS term FROM tokens
        WHERE token NOT IN (SELECT word FROM stopwords)
    )"""


_TF = "tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term)"
_DF = "df AS (SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY term)"


def _score(n: str = "10000.0", df: str = "df.df") -> str:
    return f"round(tf.tf * log10({n} / ({df} + 1)), 6)"


def _scores(source: str = "SELECT doc_id, text FROM documents") -> str:
    return f"""
    WITH {_terms(source)}, {_TF}, {_DF}
    SELECT tf.doc_id, tf.term, tf.tf, {_score()} AS score FROM tf JOIN df USING (term)
    """


# Porter's algorithm, read from the paper once more: rules as lists, longest first.
_V = "^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])"
_M0 = _V + "[aeiou]*[^aeiou]"
_M1 = _M0 + "[^aeiouy]*[aeiouy][aeiou]*[^aeiou]"
_CVC = "^[^aeiou][^aeiouy]*[aeiouy][^aeiouwxy]$"


def _cut(n: int, w: str = "w") -> str:
    return f"left({w}, length({w}) - {n})"


def _rule_step(before: str, name: str, measure: str, rules: str) -> str:
    pairs = [rule.split(">") for rule in rules.split()]
    pairs.sort(key=lambda pair: -len(pair[0]))
    found = " ".join(
        f"WHEN regexp_matches(w, '{'[st]ion' if old == 'ion' else old}$') THEN '{old}'"
        for old, _ in pairs
    )
    new = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in pairs)
    return f"""
    {name}a AS (SELECT word, w, CASE {found} END AS old FROM {before}),
    {name}b AS (SELECT word, w, old, left(w, length(w) - length(old)) AS stem FROM {name}a),
    {name} AS (
        SELECT word, CASE WHEN old IS NOT NULL AND regexp_matches(stem, '{measure}')
                          THEN stem || CASE old {new} END ELSE w END AS w
        FROM {name}b
    )"""


_STEMS = f"""
    s0 AS (SELECT DISTINCT term AS word, term AS w FROM terms),
    s1 AS (
        SELECT word, CASE WHEN ends_with(w, 'sses') THEN {_cut(2)} WHEN ends_with(w, 'ies') THEN {_cut(2)}
                          WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {_cut(1)} ELSE w END AS w
        FROM s0
    ),
    s2 AS (
        SELECT word, w, CASE WHEN ends_with(w, 'eed') THEN NULL
                             WHEN ends_with(w, 'ed') AND regexp_matches({_cut(2)}, '{_V}') THEN {_cut(2)}
                             WHEN ends_with(w, 'ing') AND regexp_matches({_cut(3)}, '{_V}') THEN {_cut(3)} END AS b
        FROM s1
    ),
    s3 AS (
        SELECT word, CASE
            WHEN ends_with(w, 'eed') AND regexp_matches({_cut(3)}, '{_M0}') THEN {_cut(1)}
            WHEN b IS NULL THEN w
            WHEN ends_with(b, 'at') OR ends_with(b, 'bl') OR ends_with(b, 'iz') THEN b || 'e'
            WHEN length(b) > 1 AND right(b, 1) = left(right(b, 2), 1) AND right(b, 1) NOT IN ('a','e','i','o','u','y')
                THEN CASE WHEN right(b, 1) IN ('l', 's', 'z') THEN b ELSE {_cut(1, "b")} END
            WHEN regexp_matches(b, '{_CVC}') THEN b || 'e' ELSE b END AS w
        FROM s2
    ),
    s4 AS (
        SELECT word, CASE WHEN ends_with(w, 'y') AND regexp_matches({_cut(1)}, '{_V}')
                          THEN {_cut(1)} || 'i' ELSE w END AS w
        FROM s3
    ),
    {_rule_step("s4", "s5", _M0,
        "ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous "
        "ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive "
        "biliti>ble logi>log")},
    {_rule_step("s5", "s6", _M0, "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>")},
    {_rule_step("s6", "s7", _M1,
        "al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ion> ou> ism> ate> iti> ous> ive> ize>")},
    s8 AS (
        SELECT word, CASE WHEN ends_with(w, 'e') AND regexp_matches({_cut(1)}, '{_M0}')
                           AND NOT regexp_matches({_cut(1)}, '{_CVC}') THEN {_cut(1)} ELSE w END AS w
        FROM s7
    ),
    s9 AS (
        SELECT word, CASE WHEN ends_with(w, 'll') AND regexp_matches(w, '{_M1}') THEN {_cut(1)} ELSE w END AS w
        FROM s8
    ),
    stems AS (SELECT word, CASE WHEN length(word) > 2 THEN w ELSE word END AS stem FROM s9),
    stemmed AS (SELECT doc_id, stem AS term FROM terms JOIN stems ON term = word)"""
_STEMMED_TF = _TF.replace("FROM terms", "FROM stemmed")
_STEMMED_DF = _DF.replace("FROM terms", "FROM stemmed")

_TAGGED = rf"""
    lexicon(word, tag) AS (VALUES {", ".join(f"({_quoted(w)}, '{tag}')" for tag, ws in LEXICON.items() for w in ws)}),
    lines AS (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents),
    listed AS (SELECT regexp_extract_all(line, '{_TOKEN}') AS found FROM lines),
    placed AS (SELECT unnest(found) AS token, generate_subscripts(found, 1) AS place FROM listed),
    tagged AS (
        SELECT token, CASE
            WHEN lexicon.tag IS NOT NULL THEN lexicon.tag
            WHEN regexp_matches(token, '^\p{{Nd}}') THEN 'NUM'
            WHEN left(token, 1) IN ('$','%','+','=','<','>','^','|','~') THEN 'SYM'
            WHEN NOT regexp_matches(token, '^\p{{L}}') THEN 'PUNCT'
            WHEN ends_with(lower(token), 'ly') THEN 'ADV'
            WHEN regexp_matches(lower(token), '(ing|ed|ize)$') THEN 'VERB'
            WHEN regexp_matches(lower(token), '(ous|ful|ive|able|al)$') THEN 'ADJ'
            WHEN place > 1 AND left(token, 1) <> lower(left(token, 1)) THEN 'PROPN'
            ELSE 'NOUN' END AS tag
        FROM placed LEFT JOIN lexicon ON lower(token) = word
    )"""


def _top(order: str) -> str:
    return f"top AS (SELECT term, df FROM df ORDER BY df {order}, term LIMIT 100)"


def _top_scores(order: str) -> str:
    return f"""
    WITH {_terms()}, {_TF}, {_DF}, {_top(order)}
    SELECT tf.doc_id, tf.term, {_score(df="top.df")} AS score FROM tf JOIN top USING (term)
    """


_MIXED_CASE = "('the', 'and', 'of', 'la', 'de', 'der', 'und', 'que', 'y', '.', ',')"
_WITHOUT_FRENCH = "SELECT doc_id, CASE WHEN lang <> 'fr' THEN text END AS text FROM documents"
_SOURCES = "SELECT lang || chr(9) || source || chr(92) || chr(10) AS doc_id, text FROM documents"
_CONVERSATIONS = "SELECT conv_id AS doc_id, text FROM conversations"
_TOKEN_COUNTS = f"""
    WITH {_terms()} SELECT token, count(*) AS n FROM tokens GROUP BY token
"""
_DOCUMENT_FREQUENCY = f"WITH {_terms()}, {_DF} SELECT term, df FROM df"
_TERM_FREQUENCY = f"WITH {_terms()}, {_TF} SELECT doc_id, term, tf FROM tf"
_TAG_COUNTS = f"WITH {_TAGGED} SELECT tag, count(*) AS n FROM tagged GROUP BY tag"

_STEMMED_TFIDF = f"""
    WITH {_terms()}, {_STEMS}, {_STEMMED_TF}, {_STEMMED_DF}
    SELECT tf.doc_id, tf.term, {_score()} AS score FROM tf JOIN df USING (term)
"""

_STEMMED_RAREST = f"""
    WITH {_terms()}, {_STEMS}, {_STEMMED_TF}, {_STEMMED_DF}, {_top("ASC")}
    SELECT tf.doc_id, tf.term, {_score(df="top.df")} AS score FROM tf JOIN top USING (term)
"""

ORACLES = {
    "token_counts": _TOKEN_COUNTS,
    "text_source_token_counts": _TOKEN_COUNTS,
    "text_source_term_frequency": f"""
        WITH {_terms()} SELECT lang, term, count(*) AS tf FROM terms JOIN documents USING (doc_id) GROUP BY lang, term
    """,
    "stopword_file_term_frequency": _TERM_FREQUENCY,
    "null_text_term_frequency": f"WITH {_terms(_WITHOUT_FRENCH)}, {_TF} SELECT doc_id, term, tf FROM tf",
    "case_insensitive_term_frequency": f"""
        WITH {_terms()}
        SELECT doc_id, lower(token) AS term, count(*) AS tf FROM tokens
        WHERE lower(token) NOT IN {_MIXED_CASE} GROUP BY 1, 2
    """,
    "words_only_term_frequency": rf"""
        WITH {_terms()}, {_TF} SELECT doc_id, term, tf FROM tf WHERE regexp_matches(term, '^\p{{L}}')
    """,
    "sorted_tsv_round_trip": _DOCUMENT_FREQUENCY,
    "stopword_filtered_counts": f"""
        WITH {_terms()} SELECT term, count(*) AS n FROM terms GROUP BY term
    """,
    "term_frequency": _TERM_FREQUENCY,
    "document_frequency": _DOCUMENT_FREQUENCY,
    "tsv_round_trip": _DOCUMENT_FREQUENCY,
    "inverse_document_frequency": f"""
        WITH {_terms()}, {_DF} SELECT term, df, round(log10(10000.0 / (df + 1)), 6) AS idf FROM df
    """,
    "tfidf": _scores(),
    "tfidf_stripes": _scores(),
    "tfidf_corpus_n": f"""
        WITH {_terms()}, {_TF}, {_DF}
        SELECT tf.doc_id, tf.term, {_score("(SELECT count(*)::DOUBLE FROM documents)")} AS score
        FROM tf JOIN df USING (term)
    """,
    "tfidf_external_df": f"""
        WITH {_terms()}, {_TF},
        df AS (
            SELECT term, count(DISTINCT doc_id) AS df
            FROM terms JOIN documents USING (doc_id) WHERE lang = 'en' GROUP BY term
        )
        SELECT tf.doc_id, tf.term, {_score(df="coalesce(df.df, 0)")} AS score
        FROM tf LEFT JOIN df USING (term)
    """,
    "rarest_terms": f"WITH {_terms()}, {_DF}, {_top('ASC')} SELECT term, df FROM top",
    "commonest_terms": f"WITH {_terms()}, {_DF}, {_top('DESC')} SELECT term, df FROM top",
    "tfidf_rarest_terms": _top_scores("ASC"),
    "tfidf_commonest_terms": _top_scores("DESC"),
    "term_stripes_flat": _TERM_FREQUENCY,
    "stem_vocabulary": f"WITH {_terms()}, {_STEMS} SELECT word AS term, stem FROM stems",
    "stemmed_term_frequency": f"WITH {_terms()}, {_STEMS}, {_STEMMED_TF} SELECT doc_id, term, tf FROM tf",
    "stemmed_document_frequency": f"WITH {_terms()}, {_STEMS}, {_STEMMED_DF} SELECT term, df FROM df",
    "stemmed_tfidf": _STEMMED_TFIDF,
    "indexed_tfidf": _STEMMED_TFIDF,
    "stemmed_tfidf_stripes": _STEMMED_TFIDF,
    "stemmed_tfidf_rarest_terms": _STEMMED_RAREST,
    "stemmed_stripes_rarest_terms": _STEMMED_RAREST,
    "pos_frequency": _TAG_COUNTS,
    "pos_frequency_stripes": _TAG_COUNTS,
    "pos_tag": f"WITH {_TAGGED} SELECT token, tag, count(*) AS n FROM tagged GROUP BY token, tag",
    "pos_frequency_own_tagger": rf"""
        WITH {_terms()} SELECT CASE WHEN regexp_matches(token, '^\p{{L}}') THEN 'WORD'
                                    WHEN regexp_matches(token, '^\p{{Nd}}') THEN 'NUMBER'
                                    ELSE 'MARK' END AS tag, count(*) AS n
        FROM tokens GROUP BY 1
    """,
    "conversation_term_frequency": f"WITH {_terms(_CONVERSATIONS)}, {_TF} SELECT doc_id, term, tf FROM tf",
    "conversation_tfidf": _scores(_CONVERSATIONS),
    "vocabulary": f"WITH {_terms()} SELECT DISTINCT term FROM terms",
    "dictionary_stemmed_term_frequency": f"WITH {_terms()}, {_STEMS}, {_STEMMED_TF} SELECT doc_id, term, tf FROM tf",
    "resumed_index_tfidf": _STEMMED_TFIDF,
    "stemmed_tfidf_corpus_n": f"""
        WITH {_terms()}, {_STEMS}, {_STEMMED_TF}, {_STEMMED_DF}
        SELECT tf.doc_id, tf.term, {_score("(SELECT count(*)::DOUBLE FROM documents)")} AS score
        FROM tf JOIN df USING (term)
    """,
    "conversation_tfidf_corpus_n": f"""
        WITH {_terms(_CONVERSATIONS)}, {_TF}, {_DF}
        SELECT tf.doc_id, tf.term, {_score("(SELECT count(DISTINCT conv_id)::DOUBLE FROM conversations)")} AS score
        FROM tf JOIN df USING (term)
    """,
    "escaped_tsv_round_trip": f"""
        WITH {_terms(_SOURCES)} SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term
    """,
}
