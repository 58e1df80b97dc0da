"""Known licence texts and notices: fixed values, the licences' own public wording."""

from __future__ import annotations

from importlib.resources import files

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""

_MIT = f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

{_AS_IS} IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_KEEP = """, provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
_BSD_THREE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission."""
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in
a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License."""

_UNLICENSE = f"""This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to
the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

{_AS_IS} IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

#: Standard file headers: the paragraph that names the licence; {} is program, library or the like.
_GNU_HEADER = ("This {} is free software; you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation; "
               "either version {} of the License, or (at your option) any later version.")
_GNU_ONLY = "This {} is free software; you can redistribute it and/or modify it under the terms of the {} version {} as published by the Free Software Foundation."
_GNU = {"GPL-2.0": ("GNU General Public License", "2"), "GPL-3.0": ("GNU General Public License", "3"), "LGPL-2.1": ("GNU Lesser General Public License", "2.1"),
        "LGPL-3.0": ("GNU Lesser General Public License", "3"), "AGPL-3.0": ("GNU Affero General Public License", "3")}
_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
HEADERS = [("MPL-2.0", _MPL_HEADER),
           *((spdx, _GNU_HEADER.format(what, name, version)) for spdx, (name, version) in _GNU.items() for what in ("program", "library", "software", "file")),
           *((spdx, _GNU_ONLY.format(what, name, version)) for spdx, (name, version) in _GNU.items() for what in ("program", "library", "software", "file"))]

#: Identifiers whose whole text is a file of ``licenses``.
FILES = ["Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"]

#: Full texts and file notices: (SPDX identifier, text).
TEXTS = [("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License\n\n" + _MIT),
         ("ISC", f"{_ISC_GRANT}{_ISC_KEEP}\n\n{_ISC_REST}"), ("ISC", f"ISC License\n\n{_ISC_GRANT}{_ISC_KEEP}\n\n{_ISC_REST}"), ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_REST}"),
         ("BSD-2-Clause", f"{_BSD_TWO}\n\n{_BSD_REST}"), ("BSD-3-Clause", f"{_BSD_TWO}\n\n{_BSD_THREE}\n\n{_BSD_REST}"), ("Zlib", _ZLIB), ("Apache-2.0", _APACHE_NOTICE),
         ("Unlicense", _UNLICENSE), ("Unlicense", f"{_UNLICENSE}\n\nFor more information, please refer to <https://unlicense.org>")]

#: Names by which one-line notices call a licence.
NAMES = {"MIT": ["MIT License"], "ISC": ["ISC License"], "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
         "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"], "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
         "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
         "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPLv2"], "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPLv3"],
         "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1"], "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3"],
         "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3"], "Unlicense": ["Unlicense"], "Zlib": ["zlib License"],
         "CC0-1.0": ["CC0 1.0", "CC0", "Creative Commons Zero"], "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
         "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
         "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
         "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
         "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
         "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"]}

#: One-line notices; {} is a name.
NOTICES = ["Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}", "Distributed under {}", "Distributed under the {}",
           "This work is licensed under {}", "This work is licensed under the {}", "This work is licensed under a {}", "This software is licensed under the {}",
           "This project is licensed under the {}", "This program is licensed under the {}", "This file is licensed under the {}", "Published under the {}",
           "Available under the {}", "License: {}"]


def known_licenses() -> list[tuple[str, str]]:
    """(identifier, text) of every known text and notice."""
    notices = [(spdx, notice.format(name)) for spdx, names in NAMES.items() for name in names for notice in NOTICES]
    tags = [(spdx, f"SPDX-License-Identifier: {spdx}{end}") for spdx in NAMES for end in ("", "-only", "-or-later")]
    whole = [(spdx, files("tessera.llm").joinpath("licenses", f"{spdx}.txt").read_text("utf-8")) for spdx in FILES]
    return TEXTS + HEADERS + whole + notices + tags
