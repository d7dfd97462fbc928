"""What a licence scan must find, as SQL of its own: expectations by licence, over whole texts, without sentences or prefilter.

Each row is a licence and the wording that stands for it; the wording's one group holds "only" or "or later".  Rows
without a licence are sentences of a licence's text after its first: they are counted only.
"""

from __future__ import annotations

_UNDER = "(?:released|licensed|distributed|available|published|dedicated) under (?:(?:the|a|an|terms|of|either|both) )*"
_TAG = "spdx-license-identifier "
_V = "(?: license)?[ -]?(?:version |v[.]? ?)?"
_AGE = "( or (?:at your option )?(?:any )?later|-or-later|[+]|[ -]only|)"


def _gnu(name: str, short: str, major: str) -> str:
    return (rf"(?:{_UNDER}(?:gnu )?(?:{name}general public license|{short}){_V}{major}(?:[.]0)?|{_TAG}{short}-{major}(?:[.]0)?)"
            rf"(?: license)?{_AGE}")


def _cc(kind: str, words: str, version: str) -> str:
    return (rf"(?:{_UNDER}(?:(?:cc|creative commons)[ -]by{kind}|(?:cc|creative commons) attribution{words}){_V}"
            rf"{version}|{_TAG}cc-by{kind}-{version})()")


# In the order of the report.
EXPECTED = (
    ("Apache-2.0", rf"(?:{_UNDER}apache(?: software)?{_V}2(?:[.]0)?\b|{_TAG}apache-2[.]0)()"),
    ("MIT", rf"(?:{_UNDER}mit\b|{_TAG}mit\b|permission is hereby granted free of charge to any person obtaining a copy)()"),
    ("BSD-3-Clause", rf"(?:{_UNDER}(?:(?:3-clause|new|modified|revised) bsd|bsd[ -]3-clause)|{_TAG}bsd-3-clause)()"),
    ("BSD-2-Clause", rf"(?:{_UNDER}(?:(?:2-clause|simplified) bsd|bsd[ -]2-clause)|{_TAG}bsd-2-clause)()"),
    ("AGPL-3.0", _gnu("affero ", "agpl", "3")),
    ("LGPL-3.0", _gnu("lesser ", "lgpl", "3")),
    ("LGPL-2.1", _gnu("lesser ", "lgpl", "2[.]1")),
    ("GPL-3.0", _gnu("", "gpl", "3")),
    ("GPL-2.0", _gnu("", "gpl", "2")),
    ("MPL-2.0", rf"(?:(?:{_UNDER}|subject to the terms of the )(?:mozilla public license|mpl){_V}2[.]0|{_TAG}mpl-2[.]0)()"),
    ("EPL-2.0", rf"(?:{_UNDER}(?:eclipse public license|epl){_V}2[.]0|{_TAG}epl-2[.]0)()"),
    ("BSL-1.0", rf"(?:{_UNDER}boost software license|{_TAG}bsl-1[.]0)()"),
    ("ISC", rf"(?:{_UNDER}isc license|{_TAG}isc\b|permission to use copy modify and or distribute this software for any "
            r"purpose with or without fee)()"),
    ("Unlicense", rf"(?:{_UNDER}unlicense|{_TAG}unlicense|free and unencumbered software released into the public domain)()"),
    ("CC0-1.0", rf"(?:{_UNDER}(?:cc0|creative commons zero)|{_TAG}cc0-1[.]0)()"),
    *((f"CC-BY{kind.upper()}-{version}", _cc(kind, words, version.replace(".", "[.]")))
      for kind, words in (("-nc-sa", "[ -]non-?commercial[ -]share-?alike"), ("-nc-nd", "[ -]non-?commercial[ -]no-?deriv[a-z]*"),
                          ("-nc", "[ -]non-?commercial"), ("-sa", "[ -]share-?alike"), ("-nd", "[ -]no-?deriv[a-z]*"), ("", ""))
      for version in ("4.0", "3.0", "2.0")),
    ("LicenseRef-All-Rights-Reserved", "all rights reserved()"),
    (None, "(?:you may obtain a copy of the license at|distributed under the license is distributed on an as is basis|"
           "see the license for the specific language governing permissions|permission notice shall be included in all copies|"
           "the software is provided as is without warranty of any kind|shall the authors or copyright holders be liable)()"),
)


def sql(documents: str = "documents") -> str:
    rows = ",\n    ".join(f"({k}, {'NULL' if name is None else repr(name)})" for k, (name, _) in enumerate(EXPECTED))
    lists = ",\n    ".join(f"(SELECT list_transform(regexp_extract_all(t, '{p}', 1), lambda x: {{'k': {k}, 'age': x}}))"
                           for k, (_, p) in enumerate(EXPECTED))
    return rf"""
WITH wording(k, licence) AS (VALUES
    {rows}),
folded AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')),
    '[^a-z0-9.+-]+(-+[^a-z0-9.+-]+)*', ' ', 'g'), 'licenc', 'licens', 'g'),
    '\b(not|never|no longer|[a-z]+n t) ((yet|been|be) )*[a-z]+ under\b', ' ', 'g') AS t FROM {documents}),
hits AS (SELECT doc_id, unnest(flatten([
    {lists}])) AS h FROM folded),
named AS (SELECT doc_id, k, licence || CASE WHEN h.age = '' THEN '' WHEN contains(h.age, 'only') THEN '-only'
                                            ELSE '-or-later' END AS licence
          FROM hits JOIN wording ON h.k = wording.k),
found AS (SELECT doc_id, count(*) AS n FROM named GROUP BY doc_id),
listed AS (SELECT doc_id, string_agg(licence, ',' ORDER BY k, CASE WHEN ends_with(licence, '-or-later') THEN 0
                                     WHEN ends_with(licence, '-only') THEN 1 ELSE 2 END) AS licenses
           FROM (SELECT DISTINCT doc_id, k, licence FROM named WHERE licence IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_license_sentences, coalesce(licenses, '') AS licenses,
       CASE WHEN licenses IS NULL THEN coalesce(n, 0) ELSE 0 END::BIGINT AS n_unmatched
FROM {documents} LEFT JOIN found USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
