"""Licence scan by sentence rules.

A text is cut into sentences, each is normalised, and every sentence that is a
known licence sentence becomes its identifier; any other run of sentences
becomes one gap.  A known sentence may be wrapped over lines of a paragraph and
may be given in full or by its known beginning.  Ordered rules, each a sequence of identifiers, are then
matched one after the other against the sequence; what a rule matches is used
up, so a later, shorter rule does not report it again.

Built-in functions only, one pass, no shuffle; the catalogue is part of the
plan (its size does not depend on the data).

Defined results: NULL or empty text has no sentence and no licence; rows are
judged one by one; an empty table gives an empty result; a text of any length
is read whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import ascii_lower

# Sentences of public licences, normalised (A-Z lower-cased,
# other characters than a-z and 0-9 as single spaces).
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2-short",
    "licensed under the apache license version 2 0 the license": "apache2-notice",
    "you may not use this file except in compliance with the license": "apache2-use",
    "you may obtain a copy of the license at": "apache2-copy",
    "released under the mit license": "mit-short",
    "this project is licensed under the mit license": "mit-short",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies": "mit-notice",
    "the software is provided as is without warranty of any kind": "mit-warranty",
    "redistributions of source code must retain the above copyright notice": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products": "bsd-endorse",
    "this work is licensed under the gnu general public license version 3": "gpl3-short",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-grant",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "either version 2 of the license or at your option any later version": "gpl2-later",
    "licensed under cc by nc 4 0": "cc-by-nc4-short",
    "licensed under cc by 4 0": "cc-by4-short",
    "all rights reserved": "all-rights",
    "this work is in the public domain": "public-domain",
}

#: Ordered: (licence, sequence of identifiers); longer sequences first.
RULES = (
    ("Apache-2.0", ("apache2-notice", "apache2-use", "apache2-copy")),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-endorse")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-grant", "gpl3-later")),
    ("GPL-2.0-or-later", ("gpl-grant", "gpl2-later")),
    ("Apache-2.0", ("apache2-short",)),
    ("MIT", ("mit-short",)),
    ("GPL-3.0-only", ("gpl3-short",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4-short",)),
    ("CC-BY-4.0", ("cc-by4-short",)),
    ("public-domain", ("public-domain",)),
)

_GPL = "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version {} of the license or at your option any later version"
_GPL_KNOWN = ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "either version {} of the license or at your option any later version")
_APACHE_COPY = "you may obtain a copy of the license at"
_BSD_TAIL = "this list of conditions and the following disclaimer"

#: Complete sentences of the licences (``*``: a holder's name) -> the sentences of
#: SENTENCES that they stand for.
WHOLE = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ),
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": (
        "the above copyright notice and this permission notice shall be included in all copies",
    ),
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": (
        "the software is provided as is without warranty of any kind",
    ),
    **{
        f"redistributions of source code must retain the above copyright notice {_BSD_TAIL}{end}": ("redistributions of source code must retain the above copyright notice",)
        for end in ("", " and")
    },
    **{
        f"redistributions in binary form must reproduce the above copyright notice {_BSD_TAIL} in the documentation and or other materials provided with the distribution{end}": (
            "redistributions in binary form must reproduce the above copyright notice",
        )
        for end in ("", " and")
    },
    "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    ),
    **{
        f"{head}{_GPL.format(version)}": tuple(x.format(version) for x in _GPL_KNOWN)
        for head in ("", "this program is free software ")
        for version in (2, 3)
    },
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": (
        "licensed under the apache license version 2 0 the license",
        "you may not use this file except in compliance with the license",
    ),
    **{f"{_APACHE_COPY} {scheme} www apache org licenses license 2 0": (_APACHE_COPY,) for scheme in ("http", "https")},
}

#: Marks of list items, cut off as sentences of their own; they part nothing.
MARKS = (*map(str, range(1, 21)), *"abcdefghij", "ii", "iii", "iv")


def sequence_of(ids: Sequence[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def unwrapped(clean: Column, sentences: Mapping[str, str], whole: Mapping[str, Sequence[str]]) -> Column:
    """``clean`` with every known sentence, from a line's start to a line's end and
    wrapped or not, on a line of its own.  A text is searched for the sentences
    that it holds when its line breaks are taken for spaces."""
    flat = F.replace(clean, F.lit("\n"), F.lit(" "))
    forms = {**{s: (s,) for s in sentences}, **whole}
    mark = f"(?:(?:{'|'.join(MARKS)})[ \n])?"

    def form(s: str) -> Column:
        pattern = f"(?<![^\n]){mark}{s.replace(' ', '[ \n]').replace('*', '[a-z0-9 \n]+?')}(?![^\n])"
        # Of a sentence with a name the part behind it is looked for.
        return F.struct(F.lit(s.split("* ")[-1]).alias("held"), F.lit(pattern).alias("pattern"), F.lit("\n".join(forms[s])).alias("lines"))

    # Longer ones first: a sentence may begin another.
    ordered = F.array(*[form(s) for s in sorted(forms, key=len, reverse=True)])
    return F.aggregate(ordered, clean, lambda t, f: F.when(F.contains(flat, f["held"]), F.regexp_replace(t, f["pattern"], f["lines"])).otherwise(t))


def scan(
    docs: DataFrame,
    text: str = "text",
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
    whole: Mapping[str, Sequence[str]] = WHOLE,
) -> DataFrame:
    """``docs`` plus sentence_ids (the known identifiers in order, comma-joined),
    licences (those of the rules that matched, in the rules' order, each once,
    comma-joined), n_known and n_unmatched (known sentences that no rule used).

    Cuts are made at ``.``, ``!``, ``?`` or ``:`` before white space and at line
    ends, those of a known sentence's inner lines excepted; a blank line always
    cuts.  Columns of these names are replaced."""
    docs = docs.drop("sentence_ids", "licences", "n_known", "n_unmatched")
    cut = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[.!?:][\\x20\\x09-\\x0D]+", "\n\n")
    clean = F.regexp_replace(ascii_lower(cut), "[^a-z0-9\\n]+", " ")
    # No spaces at line ends; "\n\n" is a sentence's end or a blank line.
    df = docs.withColumn("__clean", F.trim(F.replace(F.replace(clean, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))))
    df = df.withColumn("__lines", F.split(unwrapped(F.col("__clean"), sentences, whole), "\n")).drop("__clean")
    catalogue = F.create_map(*[F.lit(x) for pair in {**dict.fromkeys(MARKS, ""), **sentences}.items() for x in pair])
    ids = F.transform("__lines", lambda s: F.coalesce(F.element_at(catalogue, F.trim(s)), F.when(F.trim(s) == "", "").otherwise("-")))
    df = df.withColumn("__ids", F.array_remove(ids, "")).drop("__lines")
    known = F.array_remove(F.col("__ids"), "-")
    df = df.withColumn("__known", known)
    joined = F.concat(F.lit("<"), F.array_join("__ids", "><"), F.lit(">"))
    gapped = F.when(F.size("__known") == 0, "").otherwise(F.regexp_replace(joined, "(<->)+", "<->"))
    laws = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(sequence_of(ids)).alias("ids"), F.lit(len(ids)).alias("n")) for name, ids in rules])
    nothing = F.array().cast("array<string>")
    start = F.struct(gapped.alias("rest"), nothing.alias("found"))

    def apply(state, law):
        hit = F.contains(state["rest"], law["ids"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], law["ids"], F.lit("<+>"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_union(state["found"], F.array(law["name"]))).otherwise(state["found"]).alias("found"),
        )

    state = F.when(F.size("__known") > 0, F.aggregate(laws, start, apply)).otherwise(start)
    df = df.withColumn("__state", state)
    rest = F.regexp_replace(F.col("__state.rest"), "<[-+]>", "")
    return df.withColumns(
        {
            "sentence_ids": F.array_join("__known", ","),
            "licences": F.array_join("__state.found", ","),
            "n_known": F.size("__known"),
            "n_unmatched": F.length(rest) - F.length(F.translate(rest, "<", "")),
        }
    ).drop("__ids", "__known", "__state")


def _sql() -> str:
    """Sentences of one line in the forms of SENTENCES: without wrapped lines, WHOLE
    and marks of list items."""
    names = ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items())
    steps, prev = [], "s0"
    for k, (name, ids) in enumerate(RULES, 1):
        seq = sequence_of(ids)
        steps.append(
            f"s{k} AS (SELECT doc_id, known, replace(rest, '{seq}', '<+>') rest, "
            f"CASE WHEN contains(rest, '{seq}') AND NOT list_contains(found, '{name}') THEN list_append(found, '{name}') ELSE found END found FROM {prev})"
        )
        prev = f"s{k}"
    return f"""
WITH a AS (
  SELECT doc_id, string_split(regexp_replace(translate(regexp_replace(coalesce(text, ''), '[.!?:][\\x20\\x09-\\x0D]+', chr(10), 'g'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\n]+', ' ', 'g'), chr(10)) AS lines FROM documents),
b AS (SELECT doc_id, list_filter(list_transform(lines, lambda x: CASE WHEN trim(x, ' ') = '' THEN '' ELSE coalesce((MAP {{{names}}})[trim(x, ' ')], '-') END), lambda x: x <> '') AS ids FROM a),
c AS (SELECT doc_id, ids, list_filter(ids, lambda x: x <> '-') AS known FROM b),
s0 AS (SELECT doc_id, known, CASE WHEN len(known) = 0 THEN '' ELSE regexp_replace('<' || array_to_string(ids, '><') || '>', '(<->)+', '<->', 'g') END AS rest, []::VARCHAR[] AS found FROM c),
{', '.join(steps)}
SELECT doc_id, array_to_string(known, ',') AS sentence_ids, array_to_string(found, ',') AS licences, len(known)::INT AS n_known,
       (length(regexp_replace(rest, '<[-+]>', '', 'g')) - length(replace(regexp_replace(rest, '<[-+]>', '', 'g'), '<', '')))::INT AS n_unmatched
FROM {prev}"""


SQL = _sql()
