"""License scans by sentence rules.

Lines are joined into paragraphs without their comment leaders and cut into
sentences, which are normalised (lower case, words and digits only) and mapped
to the identifiers of known licence sentences; of a sentence over several lines,
whole lines may be known by themselves. A
document's sequence of identifiers is then matched against ordered licence
rules: each rule is a run of identifiers, the most specific rules first, and
identifiers that a rule has used are not used again.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import map_batches, table

# Sentences of public licences and customary notices, as patterns
# over normalised sentences (lower case, one space between words).
SENTENCES: list[tuple[str, str]] = [
    ("apache-notice", r"licensed under (the )?apache license (version )?2(\.| )?0( the license)?"),
    ("apache-compliance", r"you may not use this file except in compliance with the license"),
    ("apache-obtain", r"you may obtain a copy of the license at( http.*)?"),
    ("apache-as-is", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("apache-see", r"see the license for the specific language governing permissions and limitations.*"),
    ("apache-title", r"apache license( version 2 0( january 2004)?)?"),
    ("mit-notice", r"(released|licensed|available|distributed) under (the )?(terms of the )?mit license"),
    ("mit-title", r"(the )?mit license( mit)?"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit-include", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-as-is", r"the software is provided as is without warranty of any kind.*"),
    ("mit-liability", r"in no event shall the authors or copyright holders be liable.*"),
    ("isc-title", r"(the )?isc license"),
    ("isc-notice", r"(released|licensed|available|distributed) under (the )?isc license"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("bsd-notice", r"(released|licensed|available|distributed) under (the )?(bsd license|3 clause bsd license|bsd 3 clause license)"),
    ("bsd2-notice", r"(released|licensed|available|distributed) under (the )?(2 clause bsd license|bsd 2 clause license)"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted provided that.*"),
    ("bsd-source", r".*redistributions of source code must retain the above copyright notice.*"),
    ("bsd-binary", r".*redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd-endorse", r".*neither the name of .* may be used to endorse or promote products.*"),
    ("bsd-as-is", r"this software is provided by (the )?(copyright (holder|owner)s?( and| or) contributors|copyright (holder|owner)s?|authors?( and contributors)?|regents and contributors|.* and contributors).* as is.*"),
    ("gpl3-later", r"(this work is |this program is |this file is )?(released|licensed|available|distributed) under (the )?(terms of the )?gnu general public license( version| v) ?3( 0)? or( at your option)?( any)? later( version)?"),
    ("gpl2-later", r"(this work is |this program is |this file is )?(released|licensed|available|distributed) under (the )?(terms of the )?gnu general public license( version| v) ?2( 0)? or( at your option)?( any)? later( version)?"),
    ("gpl3-notice", r"(this work is |this program is |this file is )?(released|licensed|available|distributed) under (the )?(terms of the )?gnu general public license( version| v) ?3( 0)?( only)?"),
    ("gpl2-notice", r"(this work is |this program is |this file is )?(released|licensed|available|distributed) under (the )?(terms of the )?gnu general public license( version| v) ?2( 0)?( only)?"),
    ("gpl-notice", r"(this work is |this program is |this file is )?(released|licensed|available|distributed) under (the )?(terms of the )?gnu general public license"),
    ("gpl-terms-3", r".*gnu general public license as published by the free software foundation either version 3.*"),
    ("gpl-terms-2", r".*gnu general public license as published by the free software foundation either version 2.*"),
    ("gpl-only-3", r".*gnu general public license as published by the free software foundation version 3.*"),
    ("gpl-only-2", r".*gnu general public license as published by the free software foundation version 2.*"),
    ("gpl-only-3", r".*gnu general public license version 3( only)? as published by the free software foundation.*"),
    ("gpl-only-2", r".*gnu general public license version 2( only)? as published by the free software foundation.*"),
    ("lgpl-terms-3", r".*gnu lesser general public license as published by the free software foundation either version 3.*"),
    ("lgpl-terms-2-1", r".*gnu lesser general public license as published by the free software foundation either version 2 1.*"),
    ("lgpl-terms-2", r".*gnu library general public license as published by the free software foundation either version 2.*"),
    ("agpl-terms-3", r".*gnu affero general public license as published by the free software foundation either version 3.*"),
    ("gpl-free", r"this program is free software you can redistribute it and or modify.*"),
    ("gpl-warranty", r".*without even the implied warranty of merchantability or fitness for a particular purpose.*"),
    ("gpl-copy", r"you should have received a copy of the gnu (general|lesser general|library general|affero general) public license.*"),
    ("lgpl-notice", r"(this work is )?(released|licensed|available|distributed) under (the )?gnu lesser general public license.*"),
    ("agpl-notice", r"(this work is )?(released|licensed|available|distributed) under (the )?gnu affero general public license.*"),
    ("mpl-notice", r"this source code form is subject to the terms of the mozilla public license v( 2 0)?.*"),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file you can obtain one at.*"),
    ("cc-by-nc-sa", r"(this work is )?licensed under (a |the )?(cc by nc sa|creative commons attribution noncommercial sharealike)( [0-9] [0-9])?( international| unported| generic)?( public)?( license)?"),
    ("cc-by-nc-nd", r"(this work is )?licensed under (a |the )?(cc by nc nd|creative commons attribution noncommercial noderivatives)( [0-9] [0-9])?( international| unported| generic)?( public)?( license)?"),
    ("cc-by-nc", r"(this work is )?licensed under (a |the )?(cc by nc|creative commons attribution noncommercial)( [0-9] [0-9])?( international| unported| generic)?( public)?( license)?"),
    ("cc-by-sa", r"(this work is )?licensed under (a |the )?(cc by sa|creative commons attribution sharealike)( [0-9] [0-9])?( international| unported| generic)?( public)?( license)?"),
    ("cc-by-nd", r"(this work is )?licensed under (a |the )?(cc by nd|creative commons attribution noderivatives)( [0-9] [0-9])?( international| unported| generic)?( public)?( license)?"),
    ("cc-by", r"(this work is )?licensed under (a |the )?(cc by|creative commons attribution)( [0-9] [0-9])?( international| unported| generic)?( public)?( license)?"),
    ("cc0", r"(this work is )?(licensed|released|dedicated) (under|to) (the )?(cc0|public domain)( [0-9] [0-9])?( universal)?"),
    ("cc0", r"to the extent possible under law .* has waived all copyright and related or neighboring rights to.*"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("all-rights", r"(copyright .* )?all rights reserved"),
]

_V = r"( version| ?v)? ?"
_LATER = r"( only)? or( at your option)?( any)? (later|newer|greater|higher)( versions?)?"
_CC = r"( license)?( [0-9] [0-9])?( international| unported| generic)?( public)?( license)?"
_GPL = r"(gnu )?(gpl|general public licen[cs]e)( gpl)?"
# What notices call a licence (identifier, normalised name), the
# more specific names first.
NAMES: list[tuple[str, str]] = [
    ("gpl3-later", rf"{_GPL}{_V}3( 0)?{_LATER}"),
    ("gpl2-later", rf"{_GPL}{_V}2( 0)?{_LATER}"),
    ("gpl3-notice", rf"{_GPL}{_V}3( 0)?( only)?( licen[cs]e)?"),
    ("gpl2-notice", rf"{_GPL}{_V}2( 0)?( only)?( licen[cs]e)?"),
    ("gpl-notice", rf"{_GPL}( licen[cs]e)?"),
    ("lgpl3-notice", rf"(gnu )?(lgpl|lesser general public licen[cs]e)( lgpl)?{_V}3( 0)?({_LATER}| only)?"),
    ("lgpl2-1-notice", rf"(gnu )?(lgpl|lesser general public licen[cs]e)( lgpl)?{_V}2 1({_LATER}| only)?"),
    ("lgpl-notice", r"(gnu )?(lgpl|lesser general public licen[cs]e|library general public licen[cs]e)( lgpl)?"),
    ("agpl3-notice", rf"(gnu )?(agpl|affero general public licen[cs]e)( agpl)?{_V}3( 0)?({_LATER}| only)?"),
    ("agpl-notice", r"(gnu )?(agpl|affero general public licen[cs]e)( agpl)?"),
    ("apache-notice", rf"(apache( software)? licen[cs]e( al| asl)?|asl|apache){_V}2( 0)?( licen[cs]e)?"),
    ("mit-notice", r"(mit x11|mit expat|expat|mit)( style)?( licen[cs]e)?( mit)?"),
    ("isc-notice", r"isc( licen[cs]e)?"),
    ("bsd2-notice", r"((2 clause|two clause|simplified|freebsd) bsd|bsd (2|two) clause)( licen[cs]e)?"),
    ("bsd-notice", r"((3 clause|three clause|new|modified|revised) bsd|bsd (3|three) clause|bsd)( style)?( licen[cs]e)?"),
    ("mpl-notice", rf"(mozilla public licen[cs]e|mpl)( mpl)?{_V}2( 0)?"),
    ("epl2-notice", rf"(eclipse public licen[cs]e|epl)( epl)?{_V}2( 0)?"),
    ("epl1-notice", rf"(eclipse public licen[cs]e|epl)( epl)?{_V}1( 0)?"),
    ("boost-notice", rf"(boost software licen[cs]e|bsl)( bsl)?({_V}1( 0)?)?"),
    ("artistic2-notice", rf"artistic licen[cs]e{_V}2( 0)?"),
    ("zlib-notice", r"zlib( libpng)?( licen[cs]e)?"),
    ("cc-by-nc-sa", rf"(cc by nc sa|creative commons attribution non ?commercial share ?alike)( cc by nc sa)?{_CC}"),
    ("cc-by-nc-nd", rf"(cc by nc nd|creative commons attribution non ?commercial no ?deriv(ative)?s)( cc by nc nd)?{_CC}"),
    ("cc-by-nc", rf"(cc by nc|creative commons attribution non ?commercial)( cc by nc)?{_CC}"),
    ("cc-by-sa", rf"(cc by sa|creative commons attribution share ?alike)( cc by sa)?{_CC}"),
    ("cc-by-nd", rf"(cc by nd|creative commons attribution no ?deriv(ative)?s)( cc by nd)?{_CC}"),
    ("cc-by", rf"(cc by|creative commons attribution)( cc by)?{_CC}"),
    ("cc0", r"(cc0|creative commons zero|creative commons cc0)( [0-9] [0-9])?( universal)?( public domain dedication)?( licen[cs]e)?"),
    ("unlicense", r"unlicense( licen[cs]e)?"),
]
# A notice: what it is about (a few words, none of which denies it), a verb,
# the name, and what may follow a name.
_DENIED = r"(?!(?:[a-z0-9]+ ){0,16}?(?:not|never|neither|nor|no|without|formerly|previously|unlike|cannot|isn|aren|wasn|don|doesn)(?: |$))"
_ABOUT = r"(?:[a-z0-9]+ ){0,14}?"
_VERB = r"(?:(?:re)?released|(?:dual |multi |re)?licen[cs]ed|available|distributed|published|provided|covered|offered|shared|governed)(?: to you)?(?: as open source)? (?:under|by|with)"
_TERMS = r"(?: the| a| an)?(?: terms(?: and conditions)? of(?: either)?(?: the| a| an)?)?"
_AFTER = r"(?: (?:the |a )?licen[cs]e)?(?: (?:see|as|and|or|which|that|you|for|in|at|with|a copy|please|unless|refer|found|copyright|http|https|the) ?.*)?"
NOTICES = [(k, f"{_DENIED}{_ABOUT}{_VERB}{_TERMS} {name}{_AFTER}") for k, name in NAMES]

#: Known identifiers that may stand between two of a rule.
GAP = 2

# Fixed values: (licence, identifiers in their order), most specific first. Up
# to ``GAP`` other known sentences may stand between two of them, and any
# number of unknown ones.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-notice", "apache-compliance", "apache-obtain", "apache-as-is", "apache-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    ("MIT", ("mit-grant", "mit-include", "mit-as-is", "mit-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("GPL-3.0-or-later", ("gpl-terms-3", "gpl-warranty", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-terms-2", "gpl-warranty", "gpl-copy")),
    ("GPL", ("gpl-free", "gpl-warranty", "gpl-copy")),
    ("MIT", ("mit-title", "mit-grant")),
    ("ISC", ("isc-title", "isc-grant")),
    ("GPL-3.0-or-later", ("gpl-terms-3",)),
    ("GPL-2.0-or-later", ("gpl-terms-2",)),
    ("GPL-3.0-only", ("gpl-only-3",)),
    ("GPL-2.0-only", ("gpl-only-2",)),
    ("LGPL-3.0-or-later", ("lgpl-terms-3",)),
    ("LGPL-2.1-or-later", ("lgpl-terms-2-1",)),
    ("LGPL-2.0-or-later", ("lgpl-terms-2",)),
    ("AGPL-3.0-or-later", ("agpl-terms-3",)),
    ("MPL-2.0", ("mpl-notice", "mpl-copy")),
    ("MPL-2.0", ("mpl-notice",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-title",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-title",)),
    ("ISC", ("isc-notice",)),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-notice",)),
    ("BSD-2-Clause", ("bsd2-notice",)),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-2.0", ("gpl2-notice",)),
    ("GPL", ("gpl-notice",)),
    ("LGPL-3.0", ("lgpl3-notice",)),
    ("LGPL-2.1", ("lgpl2-1-notice",)),
    ("LGPL", ("lgpl-notice",)),
    ("AGPL-3.0", ("agpl3-notice",)),
    ("AGPL", ("agpl-notice",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("EPL-1.0", ("epl1-notice",)),
    ("BSL-1.0", ("boost-notice",)),
    ("Artistic-2.0", ("artistic2-notice",)),
    ("Zlib", ("zlib-notice",)),
    ("CC-BY-NC-SA", ("cc-by-nc-sa",)),
    ("CC-BY-NC-ND", ("cc-by-nc-nd",)),
    ("CC-BY-NC", ("cc-by-nc",)),
    ("CC-BY-SA", ("cc-by-sa",)),
    ("CC-BY-ND", ("cc-by-nd",)),
    ("CC-BY", ("cc-by",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
    ("Proprietary", ("all-rights",)),
]
# "All rights reserved." right before a licence belongs to its copyright line
RULES = [rule for name, run in RULES for rule in ([(name, ("all-rights", *run))] if run != ("all-rights",) else []) + [(name, run)]]

#: A sentence is only normalised when it holds one of these (every pattern does).
HINT = r"licen[sc]e|under|permi|warrant|copyright|redistribut|liable|software|public domain|cc0|mpl|reserved"

# A sentence ends at . ! ? ; before white space (but for the version that a
# grant names after a semicolon), or at a colon at a line end.
_END = re.compile(r"(?<=[.!?;])(?!\s+(?:either\s+)?version\s+\d)\s+|(?<=:)[ \t\r\f\v]*\n", re.I)
#: Comment leaders, list marks and the like; a line of these alone ends a paragraph.
_LEAD = re.compile(r"[^A-Za-z0-9]*(?:(?:dnl|rem)[ \t]+)?", re.I)
_HINT = re.compile(HINT, re.I)
_WORD = re.compile(r"[a-z0-9]+")
_SPDX_ID = r"\(*[A-Za-z0-9][A-Za-z0-9.+:\-]*\)*"
_SPDX = re.compile(rf"SPDX-License-Identifier:[ \t]*({_SPDX_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_SPDX_ID})*)", re.I)


def normalised(sentence: str) -> str:
    return " ".join(_WORD.findall(sentence.lower()))


def compiled(sentences: list[tuple[str, str]]) -> list[tuple[str, re.Pattern, bool]]:
    """(identifier, pattern over lines of normalised words, whether it may
    start anywhere): a match is of whole lines, and a space also stands for a
    line end."""
    spaced = [(k, re.sub(r" (?!\?)", r"\\s", p).replace(" ?", r"\s?"), p.startswith(".*")) for k, p in sentences]
    return [(k, re.compile(rf"^(?:{p})$", re.M | re.S), anywhere) for k, p, anywhere in spaced]


def paragraphs(text: str):
    """Lines without comment leaders, joined up to the next empty one; a line
    with an SPDX tag is a paragraph of its own."""
    held: list[str] = []
    for line in text.splitlines():
        tag = "spdx" in line.lower() and _SPDX.search(line)
        line = line if tag else line[_LEAD.match(line).end() :].rstrip()
        if held and (tag or not line):
            yield "\n".join(held)
            held = []
        if tag:
            yield line
        elif line:
            held.append(line)
    if held:
        yield "\n".join(held)


def expression(tag: str) -> str:
    """An SPDX expression with its brackets in balance."""
    tag = " ".join(tag.split())
    while tag.endswith(")") and tag.count(")") > tag.count("("):
        tag = tag[:-1]
    while tag.startswith("(") and tag.count("(") > tag.count(")"):
        tag = tag[1:]
    return tag


def identifiers(text: str, known: list[tuple[str, re.Pattern, bool]]) -> list[str]:
    """Identifiers of a text's licence sentences in order; an SPDX tag is an
    identifier of its own."""
    out = []
    for part in paragraphs(text):
        if not _HINT.search(part):
            continue
        tag = _SPDX.search(part)
        if tag:
            out.append(f"spdx:{expression(tag[1])}")
            continue
        for s in _END.split(part):
            if not _HINT.search(s):
                continue
            n = "\n".join(x for x in map(normalised, s.split("\n")) if x)
            at, left = 0, known
            while at < len(n):
                name, end = None, at
                for k, p, _ in left:  # the longest, of equally long ones the first
                    m = p.match(n, at)
                    if m and m.end() > end:
                        name, end = k, m.end()
                if name:
                    out.append(name)
                    at = end + 1
                    continue
                if left is known:  # what may start anywhere does not start further on either
                    left = [x for x in known if not x[2]]
                at = n.find("\n", at) + 1 or len(n)
    return out


def joined(names: list[str]) -> str:
    """The distinct licences, joined by AND; alternatives among others in brackets."""
    names = list(dict.fromkeys(names))
    if len(names) > 1:
        names = [f"({x})" if re.search(r"\bOR\b", x, re.I) and not re.fullmatch(r"\([^()]*\)", x) else x for x in names]
    return " AND ".join(names)


def _place(ids: list[str], used: list[bool], run: tuple[str, ...], i: int) -> list[int] | None:
    """Where ``run`` stands from place ``i`` on, each next one within ``GAP``."""
    if used[i] or ids[i] != run[0]:
        return None
    at = [i]
    for x in run[1:]:
        span = range(at[-1] + 1, min(at[-1] + 2 + GAP, len(ids)))
        j = next((j for j in span if ids[j] == x and not used[j]), None)
        if j is None:
            return None
        at.append(j)
    return at


def recognise(ids: list[str], rules: list[tuple[str, tuple[str, ...]]]) -> list[str]:
    """Licences of the rules that the sequence holds, in order of their place
    in it; rules are tried in order and use up what they match."""
    used = [False] * len(ids)
    found = []
    for i, x in enumerate(ids):
        if x.startswith("spdx:"):
            used[i] = True
            found.append((i, x[5:]))
    present = set(ids)
    for name, run in rules:
        if not present.issuperset(run):
            continue
        for i in range(len(ids)):
            at = _place(ids, used, run, i)
            if at:
                for j in at:
                    used[j] = True
                found.append((i, name))
    return [n for _, n in sorted(found)]


def scan_licenses(
    docs: DataFrame,
    sentences: list[tuple[str, str]] | None = None,
    rules: list[tuple[str, tuple[str, ...]]] | None = None,
) -> DataFrame:
    """One row per document row: doc_id, n_sentences (known licence sentences),
    sentence_ids, licenses (in order of appearance, repeats kept), license (the
    distinct ones, joined by `` AND ``; empty without any).

    A map over whole texts, without a shuffle. Null or empty text has no
    sentences. Repeated rows are scanned alike; null ids pass through; extra
    columns are ignored; an empty table gives no rows.
    """
    sentences, rules = sentences or [*SENTENCES, *NOTICES], rules or RULES

    def run(batch: pa.RecordBatch):
        known = compiled(sentences)
        ids = [identifiers(t or "", known) if t and _HINT.search(t) else [] for t in batch.column(1).to_pylist()]
        names = [recognise(x, rules) if x else [] for x in ids]
        yield {
            "doc_id": batch.column(0),
            "n_sentences": [len(x) for x in ids],
            "sentence_ids": ids,
            "licenses": names,
            "license": [joined(x) for x in names],
        }

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        run,
        "doc_id long, n_sentences long, sentence_ids array<string>, licenses array<string>, license string",
    )


def op2_licenses(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    return scan_licenses(docs).select(
        "doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), "license"
    )
