"""License scan by sentence rules.

A text is cut into sentences, each is normalised (ASCII lower case, runs of other characters than
letters and digits become one space) and looked up in a table of known license sentences. The
identifiers found, in the order of the text, form a sequence; a rule names identifiers that must
occur in that order, others may lie between. Rules are tried in the order given; one that contains
another comes first and rules the other out.

Sentences are taken three ways: with line breaks as spaces (wrapped license files), with line breaks
as ends (one-line notices below other text), and with lines without letters and digits as ends and other
line breaks as spaces (paragraphs below a title, a copyright line or an address). What the three find is
merged by position: the letters and digits (ASCII) ahead of a sentence, which no way of cutting changes. So a
sentence that several ways find counts once, a known sentence within a longer one beside it, and rules see
the order of the text.
A header line with a license identifier is one sentence, its colon ends none.
Long sentences are in the table as the ends of their original punctuation cut them, and without it.

Null and empty texts have no sentences and no license. Rows are judged one by one: the operator is a
narrow projection, repeated rows give repeated results and an empty table none. Texts may be of any length. Of
the input only `doc_id` and `text` are read, so further columns may have any name; null ids stay null. The table and the rules are fixed lists in this file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmill.llm.common import ascii_lower, opened, text_of, with_running

# fixed values: sentences of public licenses and of common notices, normalised
SENTENCES = {
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-reversed": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-licensed": "licensed under the apache license version 2 0",
    "apache-licensed-the-license": "licensed under the apache license version 2 0 the license",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-copy-as-is": "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-copy-as-is-https": "you may obtain a copy of the license at https www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-title": "apache license",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-licensed": "licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-no-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl3-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl3-either": "either version 3 of the license or at your option any later version",
    "gpl2-either": "either version 2 of the license or at your option any later version",
    "gpl-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl2-only-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl2-only-conditions": "you can redistribute it and or modify it under the terms and conditions of the gnu general public license version 2 as published by the free software foundation",
    "gpl2-only-version": "version 2 of the license",
    "agpl3-redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "agpl-see": "see the gnu affero general public license for more details",
    "lgpl3-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl21-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl21-either": "either version 2 1 of the license or at your option any later version",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc0-licensed": "licensed under cc0 1 0",
    "cc0-deed": "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law",
    "cc0-purpose": "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights defined below upon the creator and subsequent owner s each and all an owner of an original work of authorship and or a database each a work",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-subject-v": "this source code form is subject to the terms of the mozilla public license v",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "isc-permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "reserved": "all rights reserved",
}

# fixed values: license identifiers of one-line file headers, normalised, and the license each stands for
SPDX = {
    "bsd 3 clause": "bsd-3-clause",
    "bsd 2 clause": "bsd-2-clause",
    "mit": "mit",
    "apache 2 0": "apache-2.0",
    "agpl 3 0 or later": "agpl-3.0",
    "agpl 3 0 only": "agpl-3.0-only",
    "lgpl 3 0 or later": "lgpl-3.0",
    "lgpl 3 0 only": "lgpl-3.0-only",
    "lgpl 2 1 or later": "lgpl-2.1",
    "lgpl 2 1 only": "lgpl-2.1-only",
    "gpl 3 0 or later": "gpl-3.0",
    "gpl 3 0 only": "gpl-3.0-only",
    "gpl 2 0 or later": "gpl-2.0",
    "gpl 2 0 only": "gpl-2.0-only",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by 4 0": "cc-by-4.0",
    "cc0 1 0": "cc0-1.0",
    "mpl 2 0": "mpl-2.0",
    "unlicense": "unlicense",
    "isc": "isc",
}
SENTENCES |= {f"spdx-{words.replace(' ', '-')}": f"spdx license identifier {words}" for words in SPDX}

# (license, identifiers in order, licenses that rule it out); tried from the top
RULES = (
    *((name, (f"spdx-{words.replace(' ', '-')}",), ()) for words, name in SPDX.items()),
    ("bsd-3-clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"), ()),
    ("bsd-2-clause", ("bsd-redistribution", "bsd-source", "bsd-binary"), ("bsd-3-clause",)),
    ("mit", ("mit-grant", "mit-notice", "mit-as-is"), ()),
    ("mit-notice", ("mit-released",), ("mit",)),
    ("mit-notice", ("mit-licensed",), ("mit",)),
    ("apache-2.0", ("apache-licensed-the-license", "apache-compliance", "apache-as-is"), ()),
    ("apache-2.0", ("apache-licensed-the-license", "apache-compliance", "apache-copy-as-is"), ()),
    ("apache-2.0", ("apache-licensed-the-license", "apache-compliance", "apache-copy-as-is-https"), ()),
    ("apache-2.0-notice", ("apache-licensed",), ("apache-2.0",)),
    ("apache-2.0-notice", ("apache-licensed-the-license",), ("apache-2.0",)),
    ("gpl-3.0", ("gpl-free", "gpl-no-warranty", "gpl-see"), ()),
    ("gpl-3.0", ("gpl3-redistribute", "gpl-implied", "gpl-see"), ()),
    ("gpl-3.0", ("gpl-redistribute", "gpl3-either", "gpl-implied", "gpl-see"), ()),
    ("gpl-3.0-notice", ("gpl3-work",), ("gpl-3.0",)),
    ("gpl-3.0-notice", ("gpl3-licensed",), ("gpl-3.0",)),
    ("gpl-3.0-notice", ("gpl-free",), ("gpl-3.0",)),
    ("gpl-3.0-notice", ("gpl3-redistribute",), ("gpl-3.0",)),
    ("gpl-3.0-notice", ("gpl-redistribute", "gpl3-either"), ("gpl-3.0",)),
    ("gpl-2.0", ("gpl2-free", "gpl-no-warranty", "gpl-see"), ()),
    ("gpl-2.0", ("gpl2-redistribute", "gpl-implied", "gpl-see"), ()),
    ("gpl-2.0", ("gpl-redistribute", "gpl2-either", "gpl-implied", "gpl-see"), ()),
    ("gpl-2.0-notice", ("gpl2-free",), ("gpl-2.0",)),
    ("gpl-2.0-notice", ("gpl2-redistribute",), ("gpl-2.0",)),
    ("gpl-2.0-notice", ("gpl-redistribute", "gpl2-either"), ("gpl-2.0",)),
    ("gpl-2.0-only", ("gpl2-only-redistribute", "gpl-implied", "gpl-see"), ()),
    ("gpl-2.0-only", ("gpl2-only-conditions", "gpl-implied", "gpl-see"), ()),
    ("gpl-2.0-only", ("gpl-redistribute", "gpl2-only-version", "gpl-implied", "gpl-see"), ()),
    ("gpl-2.0-only-notice", ("gpl2-only-redistribute",), ("gpl-2.0-only",)),
    ("gpl-2.0-only-notice", ("gpl2-only-conditions",), ("gpl-2.0-only",)),
    ("gpl-2.0-only-notice", ("gpl-redistribute", "gpl2-only-version"), ("gpl-2.0-only",)),
    ("agpl-3.0", ("agpl3-redistribute", "gpl-implied", "agpl-see"), ()),
    ("agpl-3.0", ("agpl-redistribute", "gpl3-either", "gpl-implied", "agpl-see"), ()),
    ("agpl-3.0-notice", ("agpl3-redistribute",), ("agpl-3.0",)),
    ("agpl-3.0-notice", ("agpl-redistribute", "gpl3-either"), ("agpl-3.0",)),
    ("lgpl-3.0", ("lgpl3-redistribute", "gpl-implied", "lgpl-see"), ()),
    ("lgpl-3.0", ("lgpl-redistribute", "gpl3-either", "gpl-implied", "lgpl-see"), ()),
    ("lgpl-3.0-notice", ("lgpl3-redistribute",), ("lgpl-3.0",)),
    ("lgpl-3.0-notice", ("lgpl-redistribute", "gpl3-either"), ("lgpl-3.0",)),
    ("lgpl-2.1", ("lgpl21-redistribute", "gpl-implied", "lgpl-see"), ()),
    ("lgpl-2.1", ("lgpl-redistribute", "lgpl21-either", "gpl-implied", "lgpl-see"), ()),
    ("lgpl-2.1-notice", ("lgpl21-redistribute",), ("lgpl-2.1",)),
    ("lgpl-2.1-notice", ("lgpl-redistribute", "lgpl21-either"), ("lgpl-2.1",)),
    ("cc0-1.0", ("cc0-licensed",), ()),
    ("cc0-1.0", ("cc0-deed",), ()),
    ("cc0-1.0", ("cc0-purpose",), ()),
    ("cc-by-nc-4.0", ("cc-by-nc",), ()),
    ("cc-by-nc-4.0", ("cc-by-nc-work",), ()),
    ("cc-by-sa-4.0", ("cc-by-sa",), ()),
    ("cc-by-sa-4.0", ("cc-by-sa-work",), ()),
    ("cc-by-4.0", ("cc-by",), ()),
    ("cc-by-4.0", ("cc-by-work",), ()),
    ("mpl-2.0", ("mpl-subject",), ()),
    ("mpl-2.0", ("mpl-subject-v",), ()),
    ("unlicense", ("unlicense",), ()),
    ("isc", ("isc-permission",), ()),
)

# every sentence of the table has one of these stems, so a text without any has no known sentence
CUE = r"(?i)licen[cs]|permission|permitted|copyright|warrant|distribut|domain|rights"
ENDS = r"([.!?;:])[\x20\x09-\x0D]"
# the colon of a header line is no end, so that the line is one sentence
SPDX_COLON = "(?i)(spdx-license-identifier):"
BLANK_LINES = r"\n([^A-Za-z0-9\n]*\n)+"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(text), "[^a-z0-9]+", " "))


def _length(sentence: Column) -> Column:
    return F.char_length(F.replace(sentence, F.lit(" "), F.lit("")))


def _known(way: str) -> Column:
    """(start, end, id) of the known sentences of one way."""
    table = F.create_map(*[F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)])
    ends = F.col(f"{way}_end")

    def hit(s: Column, i: Column) -> Column:
        end = F.get(ends, i)
        return F.struct((end - _length(s)).alias("start"), end.alias("end"), F.try_element_at(table, s).alias("id"))

    return F.filter(F.transform(way, hit), lambda h: h["id"].isNotNull())


def rule_pattern(names: tuple[str, ...]) -> str:
    """Regular expression over `|id|id|...|` for identifiers in order with others between."""
    return r"\|" + r"(.*\|)?".join(name.replace(".", r"\.") + r"\|" for name in names)


def _licenses(sequence: Column) -> Column:
    """Names of the rules that the sequence meets."""
    found: dict[str, Column] = {}
    for name, names, over in RULES:
        hit = sequence.rlike(rule_pattern(names))
        for other in over:
            hit = hit & ~found[other]
        found[name] = found[name] | hit if name in found else hit
    return F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in found.items()]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, sentences, licenses) per row of `docs`; lists are comma-joined."""
    cued = opened(docs.select("doc_id", text_of().alias("text")), told=F.when(F.col("text").rlike(CUE), F.regexp_replace("text", SPDX_COLON, "$1")))

    def wrapped_from(text: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "), ENDS, "$1\n")

    wrapped = wrapped_from(F.col("told"))
    # a zero byte holds the place of blank lines, as it is no white space
    paragraphs = F.translate(wrapped_from(F.regexp_replace("told", BLANK_LINES, "\0")), "\0", "\n")
    lines = F.regexp_replace("told", ENDS, "$1\n")
    none = F.array().cast("array<string>")
    ways = {"a": wrapped, "b": lines, "c": paragraphs}
    found = opened(
        cued,
        **{way: F.coalesce(F.transform(F.split(text, "\n", -1), normalised), none) for way, text in ways.items()},
    )
    found = with_running(found, {f"{way}_end": F.transform(way, _length) for way in ways})
    found = opened(found, every=F.array_sort(F.concat(*[_known(way) for way in ways])))
    once = F.filter("every", lambda h, i: (i == 0) | (h != F.get("every", i - 1)))
    found = opened(found, ids=F.transform(once, lambda h: h["id"]))
    found = opened(found, sequence=F.concat(F.lit("|"), F.array_join("ids", "|"), F.lit("|")))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentences"),
        F.array_join(_licenses(F.col("sequence")), ",").alias("licenses"),
    )
