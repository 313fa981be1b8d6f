"""License scans by rules over sentences, with DataFrame functions only.

A text is cut into sentences, each is normalised, and the known licence sentences become identifiers; all
others are passed over. A sentence may be wrapped over several lines; where it is not known as a whole,
its lines are tried as they are. A rule is an ordered sequence of identifiers. It matches where its identifiers
follow one another among the known sentences of a text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The parts that the sentences of the GNU licences share.
_GNU = "it under the terms of the gnu general public license"
_FSF = "as published by the free software foundation"
_LATER = "of the license or at your option any later version"
_CC_KINDS = {"nc": "attribution noncommercial", "": "attribution", "sa": "attribution sharealike"}

# Normalised licence sentences and their identifiers.
SENTENCES: dict[str, str] = {
    "licensed under the apache license version 2 0": "apache2-notice",
    "you may not use this file except in compliance with the license": "apache2-compliance",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-grant",
    "the software is provided as is without warranty of any kind": "as-is",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this program is free software": "free-software",
    "licensed under the gnu general public license version 2": "gpl2-notice",
    "licensed under cc by nc 4 0": "cc-by-nc4-notice",
    "licensed under cc by 4 0": "cc-by4-notice",
    "licensed under cc by sa 4 0": "cc-by-sa4-notice",
    "redistribution and use in source and binary forms are permitted": "bsd-grant",
    "all rights reserved": "reserved",
    # The standard texts, sentence by sentence.
    "apache license version 2 0 january 2004 http www apache org licenses": "apache2-notice",
    "licensed under the apache license version 2 0 the license"
    " you may not use this file except in compliance with the license": "apache2-grant",
    "licensed under the apache license version 2 0 the license": "apache2-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files the software to deal in the software without restriction including"
    " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
    " copies of the software and to permit persons to whom the software is furnished to do so subject to"
    " the following conditions": "mit-grant",
    "the software is provided as is without warranty of any kind express or implied including but not"
    " limited to the warranties of merchantability fitness for a particular purpose and"
    " noninfringement": "as-is",
    **{
        "redistribution and use in source and binary forms with or without modification are permitted"
        f" provided that the following conditions are met{number}": "bsd-grant"
        for number in ("", " 1")  # the list's number, when all is one line
    },
    **{
        f"this software is provided by {who} as is and any express or implied warranties including but"
        " not limited to the implied warranties of merchantability and fitness for a particular purpose"
        " are disclaimed": "as-is"
        for who in (
            "the copyright holders and contributors", "the copyright holder and contributors",
            "the regents and contributors", "the author and contributors", "the authors and contributors",
        )
    },
    **{
        f"this software is provided by the {who} as is and any express or implied warranties including but"
        " not limited to the implied warranties of merchantability and fitness for a particular purpose"
        " are disclaimed": "as-is"
        for who in ("author", "authors")
    },
    "gnu general public license version 2 june 1991": "gpl2-notice",
    "gnu general public license version 3 29 june 2007": "gpl3-notice",
    **{
        f"{start}you can redistribute it and or modify {_GNU} {terms}": f"gpl{n}-{kind}"
        for n in (2, 3)
        for start, kind in (("this program is free software ", "grant"), ("", "notice"))
        for terms in (
            f"{_FSF} either version {n} {_LATER}", f"{_FSF} version {n} of the license",
            f"{_FSF} version {n}", f"version {n} {_FSF}",
        )
    },
    **{
        f"this work is licensed under {article} creative commons {words} 4 0 international license":
            f"cc-by{kind and '-'}{kind}4-notice"
        for kind, words in _CC_KINDS.items()
        for article in ("a", "the")
    },
}


@dataclass(frozen=True)
class Rule:
    license: str
    sequence: tuple[str, ...]


# Ordered rules.
RULES = (
    Rule("Apache-2.0", ("apache2-notice",)),
    Rule("Apache-2.0-full", ("apache2-notice", "apache2-compliance")),
    Rule("Apache-2.0", ("apache2-grant",)),
    Rule("Apache-2.0-full", ("apache2-grant",)),
    Rule("MIT", ("mit-notice",)),
    Rule("MIT-full", ("mit-grant", "as-is")),
    Rule("GPL-3.0", ("gpl3-notice",)),
    Rule("GPL-3.0", ("gpl3-grant",)),
    Rule("GPL-2.0", ("gpl2-notice",)),
    Rule("GPL-2.0-full", ("free-software", "gpl2-notice")),
    Rule("GPL-2.0", ("gpl2-grant",)),
    Rule("GPL-2.0-full", ("gpl2-grant",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc4-notice",)),
    Rule("CC-BY-4.0", ("cc-by4-notice",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa4-notice",)),
    Rule("BSD", ("bsd-grant", "as-is")),
    Rule("All-rights-reserved", ("reserved",)),
)


# Where a wrapped sentence ends: at a mark before white space, a colon before a line's end, one or more
# lines without a letter or digit, and before a line that starts with a list number.
WRAPPED_END = (
    r"(?<=[.!?])(?:[ \t]+|\r?\n)|(?<=:)[ \t\r]*\n|\n[^A-Za-z0-9]*\n"
    r"|\n(?=[^A-Za-z0-9\n]*(?:[0-9]{1,3}|[A-Za-z])[.)][ \t])"
)


def wrapped_sentences_of(text: Column) -> Column:
    """Sentences that may go on over single line breaks; each of ``sentences_of`` lies in one of them."""
    return F.split(text, WRAPPED_END)


def sentences_of(text: Column) -> Column:
    """A sentence ends at a line's end, or at ``. ! ?`` before white space."""
    return F.split(F.regexp_replace(text, r"([.!?])[ \t]+", "$1\n"), r"\n")


def normalised(sentence: Column) -> Column:
    """Lower-case a-z and digits, all else one space between words."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def scan(
    docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_known``, ``sentence_ids``, ``licenses``.

    ``sentence_ids`` lists the known sentences in the text's order, ``licenses`` the licences whose rule
    matches, sorted, each once; both are joined by a space and empty where there are none, as for a
    null or empty text. Rows that repeat an id get a row each; other columns are not looked at.
    """
    if any(" " in s for s in sentences.values()) or any(not r.sequence for r in rules):
        raise ValueError("identifiers have no spaces and rules have at least one")
    known = F.create_map(*(F.lit(x) for pair in sentences.items() for x in pair))
    # Most sentences are longer than any known one or empty: they need no look-up.
    longest = max(map(len, sentences))

    def looked_up(cut: Column) -> Column:
        cut = F.transform(cut, normalised)
        cut = F.filter(cut, lambda s: (F.length(s) > 0) & (F.length(s) <= longest))
        return F.filter(F.transform(cut, lambda s: F.try_element_at(known, s)), lambda s: s.isNotNull())

    def either(sentence: Column) -> Column:
        whole = looked_up(F.array(sentence))
        # An array of one element, to name ``whole`` once.
        pick = F.transform(
            F.array(whole),
            lambda w: F.when((F.size(w) > 0) | ~F.contains(sentence, F.lit("\n")), w).otherwise(
                looked_up(sentences_of(sentence))
            ),
        )
        return F.flatten(pick)

    found = F.flatten(F.transform(wrapped_sentences_of(F.coalesce(F.col(text_col), F.lit(""))), either))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), found.alias("found"))
    line = F.concat(F.lit(" "), F.array_join("found", " "), F.lit(" "))
    matched = [
        F.when(F.contains(line, F.lit(f" {' '.join(r.sequence)} ")), F.lit(r.license)) for r in rules
    ]
    licenses = F.array_sort(F.array_distinct(F.filter(F.array(*matched), lambda x: x.isNotNull())))
    return rows.select(
        F.col("id").alias(id_col),
        F.size("found").cast("long").alias("n_known"),
        F.array_join("found", " ").alias("sentence_ids"),
        F.array_join(licenses, " ").alias("licenses"),
    )
