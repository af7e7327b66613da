"""Porter's suffix stripping (Program 14(3), 1980) as a chain of projections.

With C a run of consonants and V a run of vowels, a word reads ``[C](VC)^m[V]``.
A rule replaces a suffix if the stem before it is long enough, that is, if its
measure ``m`` exceeds a bound. The stem is only looked at once a suffix matches,
so a word without one costs a handful of suffix tests.

Each step is a projection of its own. Spark keeps them apart, because a step names
its input several times, and compiles the chain into one method. The JIT leaves
methods of 8000 bytes and more uncompiled, so the rules are kept terse: tables are
data (one pattern, one map) and not a CASE with a branch per suffix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The suffix tables of the published algorithm, with the two
# changes its author made later (bli -> ble for abli -> able, and logi -> log).
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance",
    "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent",
    "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = {
    "al": "", "ance": "", "ence": "", "er": "", "ic": "", "able": "",
    "ible": "", "ant": "", "ement": "", "ment": "", "ent": "", "ion": "",
    "ou": "", "ism": "", "ate": "", "iti": "", "ous": "", "ive": "", "ize": "",
}

# The possessive quantifiers stop a leading consonant y from being re-read as a vowel.
HAS_VOWEL = "^(?:[^aeiou][^aeiouy]*+)?+[aeiouy]"
M_OVER_0 = HAS_VOWEL + "[aeiou]*+[^aeiou]"
M_OVER_1 = M_OVER_0 + "[^aeiouy]*+[aeiouy][aeiou]*+[^aeiou]"
# m = 1 and consonant-vowel-consonant at the end, the last one not w, x or y
SHORT = "^[^aeiou][^aeiouy]*+[aeiouy][^aeiouwxy]$"
ENDS_IN_CONSONANT = (
    "^(?:[^aeiou][^aeiouy]*+)?+(?:[aeiouy][aeiou]*+[^aeiou][^aeiouy]*+)*+$"
)

_PLURAL = """
CASE WHEN NOT endswith(w, 's') OR endswith(w, 'ss') AND NOT endswith(w, 'sses') THEN w
     WHEN endswith(w, 'sses') OR endswith(w, 'ies') THEN left(w, length(w) - 2)
     ELSE left(w, length(w) - 1) END
"""

# What -ed or -ing leaves, null where neither may go.
_WITHOUT_PAST = f"""
CASE WHEN endswith(w, 'eed') THEN NULL
     WHEN endswith(w, 'ed') AND left(w, length(w) - 2) RLIKE '{HAS_VOWEL}'
     THEN left(w, length(w) - 2)
     WHEN endswith(w, 'ing') AND left(w, length(w) - 3) RLIKE '{HAS_VOWEL}'
     THEN left(w, length(w) - 3) END
"""
_PAST = f"""
CASE WHEN part IS NULL THEN
       CASE WHEN endswith(w, 'eed') AND left(w, length(w) - 3) RLIKE '{M_OVER_0}'
            THEN left(w, length(w) - 1) ELSE w END
     WHEN right(part, 2) IN ('at', 'bl', 'iz') THEN concat(part, 'e')
     WHEN right(part, 2) = repeat(right(part, 1), 2) AND right(part, 1) NOT IN ('a', 'e', 'i', 'o', 'u')
          AND (right(part, 1) <> 'y' OR part RLIKE '{ENDS_IN_CONSONANT}')
     THEN CASE WHEN right(part, 1) IN ('l', 's', 'z') THEN part ELSE left(part, length(part) - 1) END
     WHEN part RLIKE '{SHORT}' THEN concat(part, 'e')
     ELSE part END
"""
_FINAL_Y = f"""
CASE WHEN endswith(w, 'y') AND left(w, length(w) - 1) RLIKE '{HAS_VOWEL}'
     THEN concat(left(w, length(w) - 1), 'i') ELSE w END
"""
_FINAL_E = f"""
CASE WHEN endswith(w, 'e') AND left(w, length(w) - 1) RLIKE '{M_OVER_0}'
          AND NOT left(w, length(w) - 1) RLIKE '{SHORT}'
     THEN left(w, length(w) - 1) ELSE w END
"""
_FINAL_LL = f"CASE WHEN endswith(w, 'll') AND w RLIKE '{M_OVER_1}' THEN left(w, length(w) - 1) ELSE w END"


def _find_suffix(rules: dict[str, str]) -> str:
    """The longest suffix of ``w`` in the table, null or empty if there is none."""
    endings = " ".join(sorted({suffix[-2:] for suffix in rules}))
    suffixes = "|".join("(?<=[st])ion" if suffix == "ion" else suffix for suffix in rules)
    longest = max(map(len, rules))
    return f"""
    CASE WHEN contains('{endings}', right(w, 2))
         THEN regexp_extract(right(w, {longest + 1}), '(?:{suffixes})$', 0) END
    """


def _swap_suffix(rules: dict[str, str], measure: str) -> str:
    stem = "left(w, length(w) - length(part))"
    replaced = stem
    if any(rules.values()):
        pairs = ", ".join(f"'{suffix}', '{new}'" for suffix, new in rules.items())
        replaced = f"concat({stem}, map({pairs})[part])"
    return f"CASE WHEN part <> '' AND {stem} RLIKE '{measure}' THEN {replaced} ELSE w END"


# (expression for the intermediate ``part`` or None, expression for the new word)
_STEPS = (
    (None, _PLURAL),
    (_WITHOUT_PAST, _PAST),
    (None, _FINAL_Y),
    (_find_suffix(STEP_2), _swap_suffix(STEP_2, M_OVER_0)),
    (_find_suffix(STEP_3), _swap_suffix(STEP_3, M_OVER_0)),
    (_find_suffix(STEP_4), _swap_suffix(STEP_4, M_OVER_1)),
    (None, _FINAL_E),
    (None, _FINAL_LL),
)


def with_stem(df: DataFrame, term: str = "term", stem: str = "stem") -> DataFrame:
    """Add ``stem``, the stem of the lower-cased word in ``term``; it may replace ``term``.

    Words of one or two characters stay as they are. Letters other than
    a, e, i, o, u and y count as consonants, accented ones too.
    """
    names = [c for c in df.columns if c not in (term, stem)]
    # Other columns go by numbers meanwhile, whatever they are called.
    keep = [f"__kept{i}" for i in range(len(names))]
    kept = [F.col(f"`{c}`").alias(k) for c, k in zip(names, keep, strict=True)]
    word = F.col(f"`{term}`")
    # Null checks in every rule would make the compiled method too large for the JIT.
    out = df.select(*kept, word.alias("__word"), F.coalesce(word, F.lit("")).alias("w"))
    for part, word in _STEPS:
        if part:
            out = out.select(*keep, "__word", "w", F.expr(part).alias("part"))
        out = out.select(*keep, "__word", F.expr(word).alias("w"))
    stemmed = F.when(F.length("__word") > 2, F.col("w")).otherwise(F.col("__word"))
    original = [] if term == stem else [F.col("__word").alias(term)]
    # Exploding an array of one stops later filters on the stem from being pushed into
    # the chain, where each step would copy them several times over.
    others = [F.col(k).alias(c) for c, k in zip(names, keep, strict=True)]
    return out.select(*others, *original, F.explode(F.array(stemmed)).alias(stem))
