"""Texts of public licences and the notices that stand for them.

Fixed values: the wording is that of the licences themselves.
"""

from __future__ import annotations

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so"""

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

#: (licence, text): whole licences, with and without their titles.
LICENSES: list[tuple[str, str]] = [
    ("MIT", f"{_MIT_GRANT}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n{_WARRANTY}"),
    ("MIT", f"MIT License\n{_MIT_GRANT}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n{_WARRANTY}"),
    ("MIT", f"The MIT License (MIT)\n{_MIT_GRANT}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n{_WARRANTY}"),
    ("MIT-0", f"MIT No Attribution\n{_MIT_GRANT}.\n{_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD_GRANT}\n{_BSD_WARRANTY}"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n{_BSD_GRANT}\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD_GRANT}\n{_BSD_NAMES}\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n{_BSD_GRANT}\n{_BSD_NAMES}\n{_BSD_WARRANTY}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_WARRANTY}"),
    ("ISC", f"ISC License\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_WARRANTY}"),
    ("0BSD", f"{_ISC_GRANT}.\n{_ISC_WARRANTY}"),
    ("0BSD", f"BSD Zero Clause License\n{_ISC_GRANT}.\n{_ISC_WARRANTY}"),
]

#: (licence, notice): whole lines by which a text names its licence.
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]

#: (licence, digest): SHA-256 of the canonical forms of whole licences that are too long to be kept here, with and without
#: the appendix on how to apply them.
DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "6eaa4793f5a8b0d5faa66c3153fcb1360cb1765d0255accfc085e7c42b80e401"),
    ("Apache-2.0", "b9540988b232006f6e7c5d475e7f290098f8f4bbd8250f4a3e72777f7870d20d"),
    ("GPL-1.0", "3b7c00b08d5c6de2349faf7a31bb6e49ff8a2273a7cfdd16f96859720b00d9ef"),
    ("GPL-1.0", "f4d5622e8488e9135bbad4562a4dddb47eb06044ce19b0c0d2064503f5933de5"),
    ("GPL-2.0", "9aae015a6322bbdec1a61c624a33b2c7d3b56283db1642e6e18d7820d4957b61"),
    ("GPL-2.0", "3c9f4977ae65ec51dce2737640196c8c2d45aa4ba394ba71168fae3b8a4cc93f"),
    ("GPL-3.0", "6ff3a9a8b11f055a64cb21003d19dbe88dd6a41f7487672c402dfe38b6fe2582"),
    ("GPL-3.0", "5d527914d4539f34149cd198edb1e5de52322047d37781b3bd66403f12dc40e1"),
    ("LGPL-2.0", "2f0a8618627c179dd830ddb8fa74635ae037468a5880f3b46a73915ae1990c24"),
    ("LGPL-2.0", "d449b5d838ee652333de62d88304ddcf67663cda782f1c7257ee9c9dae33dfb4"),
    ("LGPL-2.1", "56d21d93f6012cbd7f1195b72528da245ccf843598ff833a87101eb36863f95b"),
    ("LGPL-2.1", "a7bd7bcc6f59de5c915482fc3cacdd5a1b6b27c24354df724c2ef3672dce9475"),
    ("LGPL-3.0", "f0cae4b317f4f263dca8e79625f8d9c7618c87e0ca6665c79b0f1c12ac856938"),
    ("MPL-1.1", "0ac61f2f49b44016379e89eb6a869e098cdbe0a797cf497618f3e8de3adaf375"),
    ("MPL-2.0", "7eb42cd7f8edde0699d303a531b8d604a4370bd579346f5e1d615398ffe83791"),
    ("CC0-1.0", "bd0e52fb1af40ab9797ba72f1d627b83d449e9926f66d21c51209413ac988137"),
    ("Zlib", "8bf2401b537adc6d7855d0185623ab72dec4c3e358280b77207e10c6933870dc"),
    ("Zlib", "1f52c6bffd822ce7cf64b80e8480554df8247a0375268a00fa38de93eb7e3a14"),
    ("Unlicense", "af6569657d66e59605c0ac493c85eea3f5f2a64128879b081d0a5ca46cb1d5f9"),
    ("Unlicense", "d838b4ad7073104ee15e8c7c02b134fb97d6e7602a159234aa4442c186c953f7"),
    ("Unlicense", "e036143787b9efdafaaf5676f94dbb07ab0e77c34f182f2481cac2660851fc4b"),
]

_SPDX = [
    "Apache-2.0", "MIT", "MIT-0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD", "Zlib", "Unlicense",
    "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "MPL-1.1", "MPL-2.0",
]
_GNU = ["GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"]

#: More (licence, notice): SPDX lines of all known licences, and the usual lines of others.
MORE_NOTICES: list[tuple[str, str]] = [
    *((i, f"SPDX-License-Identifier: {i}") for i in [*_SPDX, *(f"{i}{kind}" for i in _GNU for kind in ("", "-only", "-or-later"))]),
    ("MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("MPL-2.0", "License, v. 2.0. If a copy of the MPL was not distributed with this"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("Zlib", "Licensed under the zlib License."),
]

#: (spelling, canonical): spellings that count as the same word.
EQUIVALENT: list[tuple[str, str]] = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]
