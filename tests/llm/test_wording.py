"""License wording as it is published, and what is close to it but is not."""

from __future__ import annotations

import pytest

from forgelens.llm import license_scan

GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation, either version {version} of the License, or
(at your option) any later version."""

MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License."""

BSD_START = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

PUBLISHED = [
    ("gpl-3.0", GPL.format(kind="", version=3)),
    ("gpl-2.0", GPL.format(kind="", version=2)),
    ("lgpl-3.0", GPL.format(kind="Lesser ", version=3)),
    ("lgpl-2.1", GPL.format(kind="Lesser ", version="2.1")),
    ("agpl-3.0", GPL.format(kind="Affero ", version=3)),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nCopyright"),
    ("mpl-2.0", MPL),
    ("apache-2.0", APACHE),
    ("apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/"),
    ("bsd", BSD_START + BSD_NAMES + BSD_END),
    ("bsd", BSD_START + BSD_END),
    ("isc", ISC),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-4.0", "The text is licensed under CC BY 4.0."),
    ("mit-notice", "The MIT License (MIT)\n\nCopyright (c) 2026"),
    ("mit-notice", "MIT License\n\nCopyright (c) 2026 Somebody"),
    ("mit-notice", "Released under the MIT License."),
]


def labels(text: str) -> set[str]:
    return set(license_scan.Scanner().scan(text.encode())["labels"].split(",")) - {""}


@pytest.mark.parametrize("label, text", PUBLISHED)
def test_published_wording_is_accepted(label, text):
    found = labels(f"Some words before. {text} And some behind.")
    own = found - {"gpl", "cc-by", "reserved"}
    assert own == {label}


@pytest.mark.parametrize(
    "label, text",
    [
        ("gpl-3.0", GPL.format(kind="", version=4)),
        ("mpl-2.0", MPL.replace("Source Code Form", "Source Form")),
        ("bsd", BSD_START + BSD_END.replace("EXEMPLARY", "PUNITIVE")),
        ("bsd", BSD_START),
        ("isc", ISC[: ISC.index("THE SOFTWARE")]),
        ("isc", ISC.replace("NEGLIGENCE", "FAULT")),
        ("cc-by-4.0", "licensed under a Creative Commons Attribution 3.0 License"),
        ("apache-2.0", "Licensed under the Apache License, Version 1.1"),
    ],
)
def test_other_wording_is_not(label, text):
    assert label not in labels(text)
