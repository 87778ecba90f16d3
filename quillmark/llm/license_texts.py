"""Known licences and notices, as text. Public licence texts."""

#: Equivalent spellings, one word for one word.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

#: How licences are called in notices.
NAMES = {
    "0BSD": ("BSD Zero Clause License",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPL-3.0", "AGPLv3"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License", "3-Clause BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 International"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-SA-3.0": ("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "CC0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, Version 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPL-2.0", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPL-3.0", "GPLv3"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPL-2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPL-3.0", "LGPLv3"),
    "MIT": ("MIT License", "MIT licence", "MIT"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}

#: The sentences around the names.
SENTENCES = (
    "Licensed under {}",
    "Licensed under the {}",
    "Released under {}",
    "Released under the {}",
    "Distributed under the {}",
    "Available under the {}",
    "This work is licensed under {}",
    "This work is licensed under the {}",
    "This work is licensed under a {}",
    "This project is licensed under the {}",
    "This program is licensed under the {}",
    "This software is licensed under the {}",
    "This file is licensed under the {}",
    "The code is licensed under the {}",
)


def notices() -> dict[str, str]:
    """Notice to licence: every sentence with every name, and the tag that names the licence by its id."""
    out = {sentence.format(name): i for i, names in NAMES.items() for name in names for sentence in SENTENCES}
    return out | {f"SPDX-License-Identifier: {i}{more}": i for i in NAMES for more in ("", "-only", "-or-later")}


#: Titles that stand above licences.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng license"),
}


def known_texts() -> list[tuple[str, str]]:
    """(licence, text): each text as it is and under each of its titles."""
    return sorted((i, head + text) for i, text in LICENSES.items() for head in ("", *(f"{t}\n\n" for t in TITLES.get(i, ()))))


_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_PERMISSION = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

LICENSES = {
    "0BSD": f"{_PERMISSION}.\n\n{_ISC_WARRANTY}",
    "BSD-2-Clause": f"{_BSD_GRANT}\n{_BSD_WARRANTY}",
    "BSD-3-Clause": f"{_BSD_GRANT}3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n{_BSD_WARRANTY}",
    "ISC": f"{_PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}",
    "MIT": f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

{_WARRANTY}""",
    "Unlicense": f"""This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

{_WARRANTY.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")}

For more information, please refer to <https://unlicense.org/>""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}

#: Digests of the canonical forms of long licences.
DIGESTS = {
    "Apache-2.0": (
        "045649cdaf85384ba827242062f2f3b36409835c98d297e25177cb1faf7c2847",
        "6ed232a1aaf66db92997c53c056b853f2a64b9f74585489f71cbae1bb4d6d166",
        "108490d21e2d3edc9128233e48fabc169818d0c7c5f0bbdd58231a367d2d6c87",
    ),
    "Artistic-1.0": (
        "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",
    ),
    "CC0-1.0": (
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    ),
    "GFDL-1.2": (
        "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60",
    ),
    "GFDL-1.3": (
        "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826",
    ),
    "GPL-1.0": (
        "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
        "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc",
    ),
    "GPL-2.0": (
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
    ),
    "GPL-3.0": (
        "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a",
        "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636",
    ),
    "LGPL-2.0": (
        "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
        "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260",
    ),
    "LGPL-2.1": (
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
    ),
    "LGPL-3.0": (
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ),
    "MPL-1.1": (
        "fcb579371133afd771fed87cd5d8c6dc5648746c9945d4adf08ec5c79aba5c61",
    ),
    "MPL-2.0": (
        "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9",
        "2cec6f733aa157c2d0b72e9669f75ca354f332218fcb5a3a885931f385272a04",
    ),
}
