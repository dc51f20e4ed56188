"""Licence names in their usual sentences, SPDX lines, and texts of public licences."""

_GPL = "GNU General Public License"
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license",
                   "Apache-2.0 license", "Apache 2.0"),
    "Apache-1.1": ("Apache License, Version 1.1", "Apache Software License, Version 1.1"),
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License",
                     "Modified BSD License"),
    "BSD-4-Clause": ("BSD 4-Clause License", "4-Clause BSD License"),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "MPL-1.1": ("Mozilla Public License, Version 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0",
                "Mozilla Public License 2.0", "MPL 2.0"),
    "EPL-1.0": ("Eclipse Public License, Version 1.0", "Eclipse Public License v1.0"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0"),
    "CC0-1.0": ("CC0 1.0", "Creative Commons CC0 1.0 Universal License"),
    "Unlicense": ("Unlicense",),
}
for _id, _short, _long, _versions in (
    ("GPL", "GPL", _GPL, ("1", "2", "3")),
    ("LGPL", "LGPL", "GNU Lesser General Public License", ("2.1", "3")),
    ("LGPL", "LGPL", "GNU Library General Public License", ("2",)),
    ("AGPL", "AGPL", "GNU Affero General Public License", ("3",)),
):
    for _v in _versions:
        _dotted = _v if "." in _v else f"{_v}.0"
        NAMES[f"{_id}-{_dotted}"] = tuple(
            f"{n}{sep}{v}" for n in (_long, f"GNU {_short}", _short)
            for sep in (", version ", " v", " ") for v in dict.fromkeys((_v, _dotted))
        )
for _kind, _words in (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
):
    for _v in ("2.0", "2.5", "3.0", "4.0"):
        NAMES[f"CC-{_kind}-{_v}"] = (
            f"CC {_kind} {_v}", f"CC {_kind} {_v} license", f"Creative Commons {_words} {_v} License",
            f"Creative Commons {_words} {_v} {'International' if _v == '4.0' else 'Unported'} License",
        )

SENTENCES = ("Licensed under the {}", "Licensed under {}", "Released under the {}",
             "This work is licensed under the {}")

# Words of licences that other texts seldom have: where templates are looked for.
KEYS = frozenset(
    "0bsd affero agpl apache bsd bsl cc cc0 clause commons disclaimed disclaims eclipse encumbered "
    "epl gnu gpl hereby identifier isc lesser lgpl licence license licensed merchantability "
    "misrepresented mozilla mpl noninfringement redistribute redistribution redistributions spdx "
    "sublicense tort tortious unencumbered unlicense verbatim warranties warranty zlib".split()
)

_EITHER = ("This {} is free software{} you can redistribute it and/or modify it under the terms of "
           "the {} as published by the Free Software Foundation")
_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
             "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
             "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
             "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
             "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
             "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_COPYLEFT = (
    ("GPL-1.0", _GPL, "1", "program"), ("GPL-2.0", _GPL, "2", "program"),
    ("GPL-3.0", _GPL, "3", "program"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1",
                                        "library"),
    ("LGPL-2.0", "GNU Library General Public License", "2", "library"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "library"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "program"),
)
NOTICES = tuple(
    (name, _EITHER.format(thing, ":", long) + tail.format(v))
    for name, long, v, thing in _COPYLEFT
    for tail in (", either version {} of the License, or (at your option) any later version.",
                 "; either version {} of the License, or (at your option) any later version.",
                 ", version {} of the License.", "; version {} of the License.")
) + (
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
                "2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
                "https://mozilla.org/MPL/2.0/."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file "
                "LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
)

_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain "
    "the above copyright notice, this list of conditions and the following disclaimer. 2. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. ")
_NEITHER = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission. ")
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.")
_VERBATIM = ("Everyone is permitted to copy and distribute verbatim copies of this license document, "
             "but changing it is not allowed.")

# Whole texts of the short licences; of the long ones the passage that every copy opens with.
FULL = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in "
            "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
            "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
            "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
            "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
            "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", _CLAUSES + _DISCLAIMER),
    ("BSD-3-Clause", _CLAUSES + _NEITHER + _DISCLAIMER),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies. " + _WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
             "or without fee is hereby granted. " + _WARRANTY),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is "
                  "free to copy, modify, publish, use, compile, sell, or distribute this software, "
                  "either in source code form or as a compiled binary, for any purpose, commercial "
                  "or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no "
             "event will the authors be held liable for any damages arising from the use of this "
             "software. Permission is granted to anyone to use this software for any purpose, "
             "including commercial applications, and to alter it and redistribute it freely, subject "
             "to the following restrictions: 1. The origin of this software must not be "
             "misrepresented; you must not claim that you wrote the original software. If you use "
             "this software in a product, an acknowledgment in the product documentation would be "
             "appreciated but is not required. 2. Altered source versions must be plainly marked as "
             "such, and must not be misrepresented as being the original software. 3. This notice "
             "may not be removed or altered from any source distribution."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS "
                   "AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "
                   "\"License\" shall mean the terms and conditions for use, reproduction, and "
                   "distribution as defined by Sections 1 through 9 of this document."),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989 Copyright (C) 1989 Free Software "
                "Foundation, Inc. 51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA " + _VERBATIM),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free "
                "Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA "
                + _VERBATIM),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software "
                "Foundation, Inc. https://fsf.org/ " + _VERBATIM),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, "
                 "1999 Free Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA "
                 "02110-1301 USA " + _VERBATIM),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1991 Free "
                 "Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 "
                 "USA " + _VERBATIM),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free "
                 "Software Foundation, Inc. https://fsf.org/ " + _VERBATIM),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 "
                 "Free Software Foundation, Inc. https://fsf.org/ " + _VERBATIM),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each "
                "individual or legal entity that creates, contributes to the creation of, or owns "
                "Covered Software."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A "
                "LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES."),
)


def _spdx():
    for name in (*NAMES, "0BSD"):
        yield name, name
        if "GPL" in name:
            yield name, f"{name}-only"
            yield name, f"{name}-or-later"


SHORT = tuple(
    (name, sentence.format(variant))
    for name, variants in NAMES.items() for variant in variants for sentence in SENTENCES
) + tuple((name, f"SPDX-License-Identifier: {code}") for name, code in _spdx()) + NOTICES
