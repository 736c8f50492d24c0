"""Notices, names and full texts of common licences: what the licence scan looks for.

The full texts stand in the .txt files beside this module, one a label, without titles, preambles and appendices.
They are read on the driver only. Words are runs of letters and digits in lower case.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

_GNU = "{} is free software you can redistribute it and or modify it under the terms of the gnu {} as published by the free software foundation either version {} of the license or at your option any later version"
_MPL = "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at {} mozilla org mpl 2 0"

#: Standard notices by label.
NOTICES = {
    "apache-2.0": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at {} www apache org licenses license 2 0",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    "cc-by-nc": ("licensed under cc by nc 4 0",),
    "cc-by-4.0": ("licensed under cc by 4 0", "creative commons attribution 4 0 international license"),
    "cc0-1.0": (
        "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide this software is distributed without any warranty",
    ),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3",),
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
    ),
    "mpl-2.0": (_MPL,),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "zlib": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software",
    ),
}

#: Names of licences without versions, and of those with versions: kind, versions, long names, short names.
NAMES = {
    "bsd": ("bsd license",),
    "bsd-2-clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause"),
    "bsd-3-clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause"),
    "isc": ("isc license",),
    "mit": ("mit license", "mit licence"),
    "unlicense": ("unlicense license",),
    "zlib": ("zlib license",),
}
VERSIONED = (
    ("apache", ("2.0",), ("apache license", "apache software license"), ("apache",)),
    ("agpl", ("3.0",), ("gnu affero general public license",), ("agpl", "gnu agpl")),
    ("lgpl", ("2.0", "2.1", "3.0"), ("gnu lesser general public license", "gnu library general public license"), ("lgpl", "gnu lgpl")),
    ("gpl", ("1.0", "2.0", "3.0"), ("gnu general public license",), ("gpl", "gnu gpl")),
    ("gfdl", ("1.2", "1.3"), ("gnu free documentation license",), ("gfdl", "gnu fdl")),
    ("mpl", ("1.1", "2.0"), ("mozilla public license",), ("mpl",)),
    ("epl", ("1.0", "2.0"), ("eclipse public license",), ("epl",)),
    ("bsl", ("1.0",), ("boost software license",), ()),
    ("artistic", ("1.0", "2.0"), ("artistic license",), ()),
)
SPDX = {
    **{k: k for k in ("mit", "isc", "unlicense", "zlib", "bsd 2 clause", "bsd 3 clause")},
    **{f"{kind} {v}": f"{kind}-{v}" for kind, versions, _, _ in VERSIONED for v in versions},
}
CREATIVE = {
    "by": "attribution",
    "by-nc": "attribution noncommercial",
    "by-nd": "attribution noderivatives",
    "by-sa": "attribution sharealike",
    "by-nc-nd": "attribution noncommercial noderivatives",
    "by-nc-sa": "attribution noncommercial sharealike",
}
CREATIVE_VERSIONS = {"2.0": "generic", "2.5": "generic", "3.0": "unported", "4.0": "international"}


def _words(text: str) -> str:
    return " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower()))


def _versions(version: str) -> list[str]:
    """The usual ways to write a version: 'version 3', 'v3', '3 0', ..."""
    text = [_words(version), *([version[0]] if version.endswith(".0") else [])]
    return [form.format(t) for t in text for form in ("version {}", "v{}", "v {}", "{}")]


def _named(name: str) -> list[str]:
    return [f"{before} {name}" for before in ("under the", "terms of the", "under a", "under an", "licensed under", "released under")]


def _creative(kind: str, version: str) -> list[str]:
    short, long = _words(f"cc {kind} {version}"), CREATIVE[kind]
    spelled = long.replace("non", "non ").replace("nod", "no d").replace("sharealike", "share alike")
    names = [f"creative commons {t} {_words(version)} {CREATIVE_VERSIONS[version]} license" for t in {long: 0, spelled: 0}]
    return [*_named(short), *names]


@cache
def templates() -> dict[str, tuple[str, ...]]:
    """All templates by label: notices, names in the usual wordings, full texts."""
    found: dict[str, list[str]] = {}
    for label, texts in NOTICES.items():
        found.setdefault(label, []).extend(t.format(p) for t in texts for p in (("http", "https") if "{}" in t else ("",)))
    for label, names in NAMES.items():
        found.setdefault(label, []).extend(t for n in names for t in _named(n))
    for kind, versions, long, short in VERSIONED:
        for version in versions:
            own = found.setdefault(f"{kind}-{version}", [])
            for v in _versions(version):
                own.extend(t for n in (*long, *short) for t in _named(f"{n} {v}"))
                own.extend(t for n in short for t in _named(f"{n}{v}") if v.startswith("v") and v[1:2].isdigit())
    for kind, name, versions in (
        ("gpl", "general public license", ("1", "2", "3")),
        ("lgpl", "library general public license", ("2",)),
        ("lgpl", "lesser general public license", ("2 1", "3")),
        ("agpl", "affero general public license", ("3",)),
    ):
        for v in versions:
            label = f"{kind}-{v.replace(' ', '.')}" if " " in v else f"{kind}-{v}.0"
            found[label].extend(_GNU.format(what, name, v) for what in ("this program", "this library"))
    for spdx, label in SPDX.items():
        found.setdefault(label.replace(" ", "-"), []).append(f"spdx license identifier {_words(spdx)}")
    for kind in CREATIVE:
        for version in CREATIVE_VERSIONS:
            # the notice of this one licence has a label of its own
            label = "cc-by-nc" if (kind, version) == ("by-nc", "4.0") else f"cc-{kind}-{version}"
            found.setdefault(label, []).extend(_creative(kind, version))
    found["cc0-1.0"].extend(t for n in ("cc0 1 0", "creative commons cc0 1 0 universal", "cc0") for t in _named(n))
    for file in sorted(Path(__file__).parent.glob("*.txt")):
        found.setdefault(file.stem, []).append(_words(file.read_text(encoding="utf-8")))
    return {label: tuple(dict.fromkeys(texts)) for label, texts in found.items()}
