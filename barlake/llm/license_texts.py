"""Licence notices as their licences or common practice word them, by SPDX name."""

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
    "furnished to do so, subject to the following conditions:"
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
    "other materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}


def _lines(spdx: str, *names: str) -> tuple[str, ...]:
    """The usual one-line forms: a sentence of its own for the first name, the bare clause for the others."""
    first = names[0]
    return (
        f"Released under the {first}.", f"Distributed under the {first}.", f"This project is licensed under the {first}.",
        f"This work is licensed under the {first}.", *(f"Licensed under the {name}." for name in names),
        f"SPDX-License-Identifier: {spdx}",
    )


def _gnu(kind: str, version: str) -> dict[str, tuple[str, ...]]:
    name, spdx, short = _GNU[kind], f"{kind}-{version}", f"{kind}v{version.removesuffix('.0')}"
    number = version.removesuffix(".0")
    later = (
        f"it under the terms of the {name} as published by the Free Software Foundation, either version {number} of "
        "the License, or (at your option) any later version."
    )
    only = f"it under the terms of the {name} version {number} as published by the Free Software Foundation."
    begin = "This program is free software: you can redistribute it and/or modify "
    library = "This library is free software; you can redistribute it and/or modify "
    rest = (
        " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"{name} for more details. You should have received a copy of the {name} along with this program. If not, "
        "see <https://www.gnu.org/licenses/>."
    )
    return {
        f"{spdx}-only": (
            *_lines(f"{spdx}-only", f"{name}, version {number}", f"{name} v{version}", short, f"GNU {short}"),
            begin + only,
        ),
        f"{spdx}-or-later": (
            *_lines(f"{spdx}-or-later", f"{name}, version {number} or later", f"{name} v{version} or later", f"{short} or later"),
            begin + later, begin + later + rest,
            *((library + later,) if kind == "LGPL" else ()),
        ),
        # The old identifiers, with or without a plus sign: words alone do not tell which.
        spdx: (f"SPDX-License-Identifier: {spdx}",),
    }


def _creative_commons() -> dict[str, tuple[str, ...]]:
    words = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    found = {}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        name = "-".join(words[w] for w in kind.split("-"))
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            port = {"4.0": "International", "3.0": "Unported"}.get(version, "Generic")
            found[f"CC-{kind}-{version}"] = (
                f"Licensed under CC {kind} {version}.", f"This work is licensed under CC {kind} {version}.",
                f"This work is licensed under a Creative Commons {name} {version} {port} License.",
                f"SPDX-License-Identifier: CC-{kind}-{version}",
            )
    return found


TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        _MIT_GRANT,
        "Distributed under the MIT License.", "This work is licensed under the MIT License.",
        "Licensed under the MIT License.", "SPDX-License-Identifier: MIT", "The MIT License (MIT)",
        _MIT_GRANT + " The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-1.1": _lines("Apache-1.1", "Apache License, Version 1.1", "Apache Software License, Version 1.1"),
    "Apache-2.0": (
        *_lines("Apache-2.0", "Apache License, Version 2.0", "Apache 2.0 License", "Apache License 2.0"),
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    "BSD-2-Clause": (
        *_lines("BSD-2-Clause", "BSD 2-Clause License", "Simplified BSD License"),
        _BSD_TWO, f"{_BSD_TWO} {_BSD_DISCLAIMER}",
    ),
    "BSD-3-Clause": (
        *_lines("BSD-3-Clause", "BSD 3-Clause License", "New BSD License", "Modified BSD License"),
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        _BSD_TWO + _BSD_THIRD, f"{_BSD_TWO}{_BSD_THIRD} {_BSD_DISCLAIMER}",
    ),
    "ISC": (
        *_lines("ISC", "ISC License"),
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
    ),
    **_gnu("GPL", "2.0"),
    **_gnu("GPL", "3.0"),
    **_gnu("LGPL", "2.1"),
    **_gnu("LGPL", "3.0"),
    **_gnu("AGPL", "3.0"),
    "MPL-2.0": (
        *_lines("MPL-2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "EPL-2.0": _lines("EPL-2.0", "Eclipse Public License, Version 2.0", "Eclipse Public License 2.0"),
    "BSL-1.0": (
        *_lines("BSL-1.0", "Boost Software License, Version 1.0"),
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ),
    **_creative_commons(),
    "CC0-1.0": (
        "Licensed under CC0 1.0.", "This work is licensed under CC0 1.0 Universal.",
        "This work is marked with CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense",
    ),
}
