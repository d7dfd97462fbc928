"""Licence scan by sentence rules (DataFrame functions only).

A text falls into sentences (a full stop, question or exclamation mark before
white space, or a blank line; not the stop of "v." before a number).  A sentence
in lower case with every other run of signs, hyphens that stand alone included,
as one blank is normalised ("licence" as "license").  A normalised sentence is
mapped to identifiers, in this order: the phrases of ``PHRASES`` that it holds;
the licences named after "licensed under" and the like (also "A or B"), or
named by the whole sentence as a heading; the licences of an
SPDX-License-Identifier tag.  Names and tags are looked up in the maps of
``license_names``.  Other sentences drop out; the document is then a sequence of
identifiers.  Rules, ordered from the longest to the shortest, are matched
against that sequence one after the other, and what one rule has matched is
taken out before the next; a name or tag left over stands for its licence.

"Only" and "or later" of the GNU licences are told apart where the sentence says
either.  "Not licensed under X" names nothing.  "All rights reserved" just
before a licence's own text belongs to that text.

Only texts with one of ``CUES`` are split at all; every alternative of every
phrase and every form of a name or tag holds a cue within one word, so nothing
is missed.  All work is within a row: one scan, no shuffle.

Defined results: null and empty texts have no sentence and no licence; each
repeated row is judged alone; licences are listed once each, in the order of
``ORDER``; identifiers that no rule takes, tags of unknown licences among them,
count as unmatched; empty tables give empty results; other columns pass through;
texts are scanned whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import license_expectations
from llm.common import col, fresh
from llm.license_names import GNU, IDENTIFIERS, NAME, NAMED, TAGS

# Phrases of public licence texts, as patterns over normalised sentences.
PHRASES = (
    ("apache2-obtain", r"you may obtain a copy of the license at"),
    ("apache2-unless", r"software distributed under the license is distributed on an as is basis"),
    ("apache2-see", r"see the license for the specific language governing permissions"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit-notice", r"copyright notice and this permission notice shall be included in all copies"),
    ("mit-warranty", r"the software is provided as is without warranty of any kind express or implied"),
    ("mit-liability", r"in no event shall the authors or copyright holders be liable"),
    ("bsd-redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-endorse", r"be used to endorse or promote products derived from this software"),
    ("bsd-warranty", r"this software is provided by .* as is and any express or implied warranties"),
    ("bsd-liability", r"be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("agpl3-free", r"under the terms of the gnu affero general public license as published .*version 3"),
    ("lgpl3-free", r"under the terms of the gnu lesser general public license as published .*version 3"),
    ("lgpl21-free", r"under the terms of the gnu lesser general public license as published .*version 2\.1"),
    ("gpl3-free", r"under the terms of the gnu general public license as published .*version 3"),
    ("gpl2-free", r"under the terms of the gnu general public license as published .*version 2"),
    ("gpl-hope", r"distributed in the hope that it will be useful but without any warranty"),
    ("gpl-details", r"see the gnu (lesser |affero )?general public license for more details"),
    ("gpl-received", r"you should have received a copy of the gnu (lesser |affero )?general public license"),
    ("mpl2-subject", r"subject to the terms of the mozilla public license v\. ?2\.0"),
    ("mpl2-obtain", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("unlicense-free", r"this is free and unencumbered software released into the public domain"),
    ("cc0-waived", r"waived all copyright and related or neighboring rights"),
    ("rights-reserved", r"all rights reserved"),
)

# The sentences of licences' own texts and notices, longest first for each licence (SPDX names).
_CHAINS = (
    ("Apache-2.0", ("name:Apache-2.0", "apache2-obtain", "apache2-unless", "apache2-see")),
    ("Apache-2.0", ("name:Apache-2.0", "apache2-obtain")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty",
                      "bsd-liability")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    *((f"{name}{kind}", (f"{key}-free{kind}", *rest))
      for name, key in (("AGPL-3.0", "agpl3"), ("LGPL-3.0", "lgpl3"), ("LGPL-2.1", "lgpl21"), ("GPL-3.0", "gpl3"),
                        ("GPL-2.0", "gpl2"))
      for rest in (("gpl-hope", "gpl-details", "gpl-received"), ("gpl-hope", "gpl-received"), ())
      for kind in ("-or-later", "-only", "")),
    ("MPL-2.0", ("mpl2-subject", "mpl2-obtain")),
    ("MPL-2.0", ("mpl2-subject",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense-free",)),
    ("CC0-1.0", ("cc0-waived",)),
)
RESERVED = "rights-reserved"
RESERVED_NAME = "LicenseRef-All-Rights-Reserved"
RULES = (*((name, (RESERVED, *chain)) for name, chain in _CHAINS), *_CHAINS, (RESERVED_NAME, (RESERVED,)))
ORDER = (*IDENTIFIERS, RESERVED_NAME)

# Every alternative of every phrase holds one of these.  They lie within one word: line breaks and comment
# signs between words, which only normalising takes out, cannot hide them.
CUES = ("licens", "permission", "software", "copyright", "redistribution", "damages", "warrant", "reserved",
        "distributed", "liable", "cc0", "creative", "licenc", "released", "available", "published", "dedicated")

_BREAK = r"([.!?])\s+|\n[ \t\r#*/;-]*\n"
_MARK = "\u0001"
_OTHER = r"[^a-z0-9.+-]+(?:-+[^a-z0-9.+-]+)*"
_VERSION = r"\bv\.[ \t]*\r?\n?[ \t#*/;-]*([0-9])"  # "v. 2.0", also over a line break, is no end of a sentence

# Over normalised sentences: how a licence is named, denied, tagged, and what a GNU notice says about versions.
_VERBS = "(?:released|licensed|distributed|available|published|dedicated)"
_NEGATED = rf"\b(?:not|never|no longer|[a-z]+n t) (?:(?:yet|been|be|being|currently) )*{_VERBS} (?=under\b)"
_INVERTED = r"version ([0-9]+(?:\.[0-9]+)*) of the ((?:gnu )?(?:[a-z]+ ){1,3}license)"
_NAMING = rf"\b{_VERBS} under (?:(?:either|both|of|the|a|an|terms|conditions) )*{NAME}(?:(?: and)?(?: or)? (?:the |an? )?{NAME})*"
_HEADING = rf"^ ?(?:(?:the|license) )*(?=.*license){NAME}\.? ?(?:copyright .*|spdx-license-identifier .*)?$"
_TAG = r"spdx-license-identifier ([a-z0-9.+-]+(?: (?:or|and|with) [a-z0-9.+-]+)*)"
_NOTICE_LATER = r"version [0-9.]+ (?:of the license )?or (?:at your option )?any later version"
_NOTICE_ONLY = r"version [0-9.]+ (?:of the license )?only\b"


def _has_cue(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in CUES])


def _looked_up(table: dict[str, str], key: Column) -> Column:
    pairs = ";".join(f"{k}={v}" for k, v in table.items())
    return F.try_element_at(F.str_to_map(F.lit(pairs), F.lit(";"), F.lit("=")), key)


def _licence_of(name: Column) -> Column:
    """The SPDX identifier of one written name, NULL where the map has none."""
    stem, version = F.regexp_extract(name, NAME, 1), F.regexp_replace(F.regexp_extract(name, NAME, 2), r"\.0$", "")
    suffix = F.regexp_extract(name, NAME, 3)
    base = F.coalesce(_looked_up(NAMED, F.concat_ws("|", stem, version)), _looked_up(NAMED, F.concat(stem, F.lit("|"))))
    kind = F.when(~base.rlike(f"^({'|'.join(GNU)})-") | (suffix == ""), "").when(suffix.rlike("only"), "-only")
    return F.concat(base, kind.otherwise("-or-later"))


def _names(s: Column) -> Column:
    """``<name:X>`` of every licence that the normalised sentence names, in order."""
    said = F.regexp_replace(F.regexp_replace(s, _NEGATED, "denied "), _INVERTED, "$2 version $1")
    heading = F.when(said.rlike(_HEADING), F.array(said)).otherwise(F.array().cast("array<string>"))
    stretches = F.concat(heading, F.regexp_extract_all(said, F.lit(_NAMING), F.lit(0)))
    written = F.flatten(F.transform(stretches, lambda x: F.regexp_extract_all(x, F.lit(NAME), F.lit(0))))
    found = F.filter(F.transform(written, _licence_of), lambda x: x.isNotNull())
    text = F.array_join(F.transform(found, lambda x: F.concat(F.lit("<name:"), x, F.lit(">"))), "")
    return F.when(s.contains("as published"), "").otherwise(text)  # the notices of PHRASES


def _tags(s: Column) -> Column:
    """``<name:X>`` of every licence in the sentence's SPDX tags (an exception after "with" is none)."""
    expressions = F.regexp_extract_all(s, F.lit(_TAG), F.lit(1))
    terms = F.flatten(F.transform(expressions, lambda e: F.split(F.regexp_replace(e, " with [^ ]+", ""), " (?:or|and) ")))
    known = F.transform(terms, lambda t: F.coalesce(_looked_up(TAGS, F.regexp_replace(t, r"\.$", "")), F.lit("")))
    return F.array_join(F.transform(known, lambda x: F.when(x == "", "<tag-unknown>")
                                    .otherwise(F.concat(F.lit("<name:"), x, F.lit(">")))), "")


def _identified(s: Column) -> Column:
    later = F.when(s.rlike(_NOTICE_LATER), "-or-later").when(s.rlike(_NOTICE_ONLY), "-only").otherwise("")
    phrases = [F.when(s.rlike(p), F.concat(F.lit(f"<{i}"), later if i.endswith("-free") and "gpl" in i else F.lit(""),
                                           F.lit(">"))).otherwise("") for i, p in PHRASES]
    return F.concat(_names(s), *phrases, _tags(s))


def sentence_ids(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order, each in angle brackets, as one string."""
    folded = F.lower(text)
    sentences = F.split(F.regexp_replace(F.regexp_replace(folded, _VERSION, "v.$1"), _BREAK, "$1" + _MARK), _MARK, -1)
    plain = F.transform(F.filter(sentences, _has_cue),
                        lambda s: F.regexp_replace(F.regexp_replace(s, _OTHER, " "), "licenc", "licens"))
    return F.when(_has_cue(folded), F.array_join(F.transform(plain, _identified), "")).otherwise(F.lit(""))


def scan_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus n_license_sentences (identifiers found), licenses (array, in ``ORDER``) and n_unmatched."""
    ids = fresh(df, "l_ids")
    marked = df.withColumn(ids, F.coalesce(sentence_ids(col(text)), F.lit("")))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in chain)).alias("chain"))
                      for name, chain in RULES])
    start = F.struct(col(ids).alias("rest"), F.array().cast("array<string>").alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        return F.struct(F.replace(state["rest"], rule["chain"], F.lit("|")).alias("rest"),
                        F.when(F.contains(state["rest"], rule["chain"]),
                               F.array_union(state["names"], F.array(rule["name"])))
                         .otherwise(state["names"]).alias("names"))

    matched = F.when(col(ids) != "", F.aggregate(rules, start, apply)).otherwise(start)
    state = fresh(df, "l_state")
    n1, n2, n3 = fresh(df, "n_license_sentences"), fresh(df, "licenses"), fresh(df, "n_unmatched")
    done = marked.withColumn(state, matched)
    found = F.concat(col(state)["names"], F.regexp_extract_all(col(state)["rest"], F.lit("<name:([^>]+)>"), F.lit(1)))
    ordered = F.filter(F.array(*[F.lit(x) for x in ORDER]), lambda x: F.array_contains(found, x))
    return done.select(*[col(c) for c in df.columns],
                       F.regexp_count(col(ids), F.lit("<")).cast("long").alias(n1),
                       F.when(col(ids) != "", ordered).otherwise(F.array().cast("array<string>")).alias(n2),
                       F.regexp_count(col(state)["rest"], F.lit("<(?!name:)")).cast("long").alias(n3))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).select("doc_id", "n_license_sentences",
                                      F.array_join("licenses", ",").alias("licenses"), "n_unmatched")


QUERIES = {"op7_license_scan": op7_license_scan}
ORACLE = {"op7_license_scan": license_expectations.sql()}
