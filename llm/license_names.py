"""Licence names: how a licence is called, and the map from (stem, version) to its SPDX identifier.

A name is a stem ("gpl", "apache license"), a version written in any of the usual ways ("v3", "-3.0", " version 3.0")
and, for the GNU family, "only" or "or later".  A stem that is an everyday word counts with "license" only.
"""

from __future__ import annotations

# Fixed values: (SPDX stem, names in lower case, versions; none: the SPDX stem is the whole identifier).
FAMILIES = (
    ("Apache", ("apache license", "apache software license"), ("2.0", "1.1", "1.0")),
    ("MIT", ("mit", "mit x11", "mit expat", "expat license"), ()),
    ("BSD-3-Clause", ("bsd-3-clause", "bsd 3-clause", "bsd 3 clause", "3-clause bsd", "3 clause bsd", "new bsd",
                      "modified bsd", "revised bsd"), ()),
    ("BSD-2-Clause", ("bsd-2-clause", "bsd 2-clause", "bsd 2 clause", "2-clause bsd", "2 clause bsd", "simplified bsd",
                      "freebsd license"), ()),
    ("AGPL", ("agpl", "gnu agpl", "affero general public license", "gnu affero general public license"),
     ("3.0", "1.0")),
    ("LGPL", ("lgpl", "gnu lgpl", "lesser general public license", "gnu lesser general public license",
              "library general public license", "gnu library general public license"), ("3.0", "2.1", "2.0")),
    ("GPL", ("gpl", "gnu gpl", "general public license", "gnu general public license"), ("3.0", "2.0", "1.0")),
    ("MPL", ("mpl", "mozilla public license"), ("2.0", "1.1", "1.0")),
    ("EPL", ("epl", "eclipse public license"), ("2.0", "1.0")),
    ("BSL", ("boost software license", "boost license"), ("1.0",)),
    ("ISC", ("isc license",), ()),
    ("Unlicense", ("unlicense",), ()),
    ("CC0", ("cc0", "creative commons zero"), ("1.0",)),
    ("0BSD", ("0bsd", "zero-clause bsd"), ()),
    ("LicenseRef-BSD", ("bsd license", "bsd-style license"), ()),
    ("CDDL", ("cddl", "common development and distribution license"), ("1.1", "1.0")),
    ("EUPL", ("eupl", "european union public license"), ("1.2", "1.1", "1.0")),
    ("OFL", ("sil open font license", "open font license"), ("1.1", "1.0")),
    ("Artistic", ("artistic license",), ("2.0", "1.0")),
    ("Zlib", ("zlib license",), ()),
    ("WTFPL", ("wtfpl",), ()),
    ("PostgreSQL", ("postgresql license",), ()),
    ("PSF", ("python software foundation license", "psf license"), ("2.0",)),
    ("MS-PL", ("ms-pl", "microsoft public license"), ()),
    ("ODbL", ("odbl", "open database license"), ("1.0",)),
)
CC_WORDS = {"nc": ("noncommercial", "non-commercial"), "sa": ("sharealike", "share-alike", "share alike"),
            "nd": ("noderivatives", "noderivs", "no-derivatives", "no derivatives")}
CC_KINDS = (("nc", "sa"), ("nc", "nd"), ("nc",), ("sa",), ("nd",), ())
CC_VERSIONS = ("4.0", "3.0", "2.5", "2.0", "1.0")
GNU = ("AGPL", "LGPL", "GPL")


def _creative_commons(kind: tuple[str, ...]) -> tuple[str, tuple[str, ...]]:
    """CC BY by its short names (blanks or hyphens between the parts) and by its full ones."""
    short = [f"{first}{a}by{''.join(b + k for k in kind)}"
             for first in ("cc", "creative commons") for a in " -" for b in " -"]
    full = ["attribution"]
    for k in kind:
        full = [f"{name}{between}{word}" for name in full for between in (" ", "-") for word in CC_WORDS[k]]
    return ("-".join(("CC", "BY", *(k.upper() for k in kind))),
            tuple(dict.fromkeys([*short, *(f"{first} {name}" for first in ("cc", "creative commons") for name in full)])))


ALL_FAMILIES = (*FAMILIES, *((*_creative_commons(kind), CC_VERSIONS) for kind in CC_KINDS))


def _unversioned(base: str, versions: tuple[str, ...]) -> str:
    if len(versions) == 1:
        return f"{base}-{versions[0]}"
    return f"LicenseRef-{base}" if versions else base


def _named() -> dict[str, str]:
    """``stem|version`` (a closing ".0" left out) -> SPDX identifier.

    Without a version: the only version there is, or LicenseRef-<stem>.
    """
    out = {}
    for base, stems, versions in ALL_FAMILIES:
        for stem in stems:
            out[f"{stem}|"] = _unversioned(base, versions)
            out.update({f"{stem}|{v.removesuffix('.0')}": f"{base}-{v}" for v in versions})
    out.update({f"apache|{v.removesuffix('.0')}": f"Apache-{v}" for v in ("2.0", "1.1")})  # bare: with a version only
    return out


def _identifiers() -> tuple[str, ...]:
    """Every identifier a name or a tag can stand for, in the order of the families, newest version first."""
    out = []
    for base, _, versions in ALL_FAMILIES:
        for v in versions:
            kinds = ("-or-later", "-only", "") if base in GNU else ("",)
            out += [f"{base}-{v}{kind}" for kind in kinds]
        if len(versions) != 1:
            out.append(_unversioned(base, versions))
    return tuple(out)


NAMED = _named()
IDENTIFIERS = _identifiers()
TAGS = {i.lower(): i for i in IDENTIFIERS} | {
    f"{i.lower().removesuffix('-or-later')}+": i for i in IDENTIFIERS if i.endswith("-or-later")}

_STEMS = "|".join(sorted({key.split("|")[0] for key in NAMED}, key=lambda s: (-len(s), s)))
LATER = r" or (?:at your option )?(?:any )?(?:later|newer)(?: version)?|-or-later|\+"
ONLY = "[ -]only"
# Groups: stem, version, "only" or "or later".
NAME = (rf"\b({_STEMS})(?: license)?(?:[ -]?(?:version |v\.? ?)?([0-9]+(?:\.[0-9]+)*))?"
        rf"(?: (?:international|unported|universal|generic))?(?: public)?(?: license)?({LATER}|{ONLY})?(?![a-z0-9])")
