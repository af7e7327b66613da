"""Rule-based part-of-speech tags as a Column expression.

Tag names are those of Universal Dependencies. The rules do not reproduce the
tags of a trained model; pass a tagger to ``pos_tag`` for that.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# English closed-class words by tag, looked up in lower case.
LEXICON = {
    "DET": "a an the this that these those each every either neither no some any".split(),
    "PRON": (
        "i me my mine myself you your yours yourself he him his himself she her hers "
        "herself it its itself we us our ours they them their theirs who whom whose "
        "which what someone anyone everyone nobody nothing something everything"
    ).split(),
    "ADP": (
        "of in on at by for with from to into onto upon over under above below between "
        "among through during before after against about across behind beside beyond "
        "within without toward towards until since near off out up down"
    ).split(),
    "CCONJ": "and or but nor yet".split(),
    "SCONJ": "because although though while whereas if unless whether when where as than".split(),
    "AUX": (
        "am is are was were be been being have has had having do does did will would "
        "shall should can could may might must"
    ).split(),
    "ADV": "not very too also never always often here there now then soon again how why".split(),
    "PART": ["t"],
    "NUM": "one two three four five six seven eight nine ten hundred thousand million".split(),
    "INTJ": "oh yes hello please".split(),
}


def tag_token(token: Column, lowered: Column, position: Column) -> Column:
    """Tag of ``token``, the ``position``-th of its line counted from 0.

    ``lowered`` is the token in lower case, named apart so that it is computed once.
    """
    first = F.substring(token, 1, 1)
    letter = (
        first.between("a", "z") | first.between("A", "Z") | F.rlike(token, F.lit(r"^\p{L}"))
    )

    def ends(*suffixes: str) -> Column:
        return reduce(or_, [F.endswith(lowered, F.lit(suffix)) for suffix in suffixes])

    closed = F
    for name, words in LEXICON.items():
        closed = closed.when(lowered.isin(words), name)
    open_class = (
        F.when(ends("ly"), "ADV")
        .when(ends("ing", "ed", "ize"), "VERB")
        .when(ends("ous", "ful", "ive", "able", "al"), "ADJ")
        .when((position > 0) & (first != F.lower(first)), "PROPN")
        .otherwise("NOUN")
    )
    return (
        F.when(lowered.isin(sorted(set().union(*LEXICON.values()))), closed)
        .when(letter, open_class)
        .when(F.rlike(token, F.lit(r"^\p{Nd}")), "NUM")
        .when(first.isin(*"$%+=<>^|~"), "SYM")
        .otherwise("PUNCT")
    )
