"""Texts of common licenses and notices, and the words that tell close ones apart. Fixed values.

``license_bodies`` holds the whole texts of longer licenses, under the name of the license.
"""

from importlib.resources import files

TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, version 2.0.",
    "BSD-3-Clause-notice": "Released under the BSD 3-Clause License.",
    "BSD-2-Clause-notice": "Released under the BSD 2-Clause License.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}

TEMPLATES["BSD-3-Clause"] = TEMPLATES["BSD-2-Clause"] + """ 3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from this software without specific prior written
permission."""
TEMPLATES["BSD-4-Clause"] = TEMPLATES["BSD-2-Clause"] + """ 3. All advertising materials mentioning features or use of this
software must display the following acknowledgement: This product includes software developed by the organization. 4.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
TEMPLATES["Unlicense"] = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""
TEMPLATES["CC0-1.0"] = """To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to
this software to the public domain worldwide. This software is distributed without any warranty. You should have received a
copy of the CC0 Public Domain Dedication along with this software. If not, see
http://creativecommons.org/publicdomain/zero/1.0/."""
TEMPLATES["EPL-2.0"] = """This program and the accompanying materials are made available under the terms of the Eclipse Public License
2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""
TEMPLATES["EPL-1.0"] = """This program and the accompanying materials are made available under the terms of the Eclipse Public License
v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"""
TEMPLATES["CC0-1.0-notice"] = "Released under CC0 1.0 Universal."
TEMPLATES["Unlicense-notice"] = "Released under the Unlicense license."
TEMPLATES["EPL-2.0-notice"] = "Licensed under the Eclipse Public License, version 2.0."
TEMPLATES["EPL-1.0-notice"] = "Licensed under the Eclipse Public License, version 1.0."
TEMPLATES["LGPL-2.1-notice"] = "This work is licensed under the GNU Lesser General Public License, version 2.1."
TEMPLATES["AGPL-3.0-notice"] = "This work is licensed under the GNU Affero General Public License, version 3."

# Phrases (as normal forms) that a match must hold word for word, or it is of another license.
REQUIRED = {
    "MIT-notice": ["mit license"],
    "Apache-2.0-notice": ["apache license version 2 0"],
    "GPL-3.0-notice": ["gnu general public license version 3"],
    "GPL-2.0-notice": ["gnu general public license version 2"],
    "LGPL-3.0-notice": ["gnu lesser general public license version 3"],
    "LGPL-2.1-notice": ["gnu lesser general public license version 2 1"],
    "AGPL-3.0-notice": ["gnu affero general public license version 3"],
    "MPL-2.0-notice": ["mozilla public license version 2 0"],
    "BSD-3-Clause-notice": ["bsd 3 clause"],
    "BSD-2-Clause-notice": ["bsd 2 clause"],
    "CC0-1.0-notice": ["cc0 1 0"],
    "Unlicense-notice": ["the unlicense"],
    "EPL-2.0-notice": ["eclipse public license version 2 0"],
    "EPL-1.0-notice": ["eclipse public license version 1 0"],
    "Apache-2.0": ["apache license version 2 0"],
    "MPL-2.0": ["mozilla public license v 2 0"],
    "BSD-3-Clause": ["endorse or promote products"],
    "BSD-4-Clause": ["advertising materials", "endorse or promote products"],
    "EPL-2.0": ["eclipse public license 2 0"],
    "EPL-1.0": ["eclipse public license v1 0"],
    "CC0-1.0": ["cc0 public domain dedication"],
    "Unlicense": ["unencumbered software"],
}

# Headers of the GNU family: license, version, what is licensed.
for _id, _license, _version, _what in [
    ("GPL-2.0", "GNU General Public License", "2", "program"),
    ("GPL-3.0", "GNU General Public License", "3", "program"),
    ("LGPL-2.0", "GNU Library General Public License", "2", "library"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "library"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "program"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "program"),
]:
    _start = f"This {_what} is free software: you can redistribute it and/or modify it under the terms of the {_license}"
    _end = f"""This {_what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {_license} for more details."""
    _words, _number = _license.lower(), _version.replace(".", " ")
    TEMPLATES[f"{_id}-or-later"] = f"""{_start} as published by the Free Software Foundation, either version {_version} of the License,
or (at your option) any later version. {_end}"""
    REQUIRED[f"{_id}-or-later"] = [f"terms of the {_words}", f"version {_number} of the license", "any later version"]
    TEMPLATES[f"{_id}-only"] = f"{_start} version {_version} as published by the Free Software Foundation. {_end}"
    REQUIRED[f"{_id}-only"] = [f"{_words} version {_number} as published"]

for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _version in ("4.0", "3.0", "2.5", "2.0", "1.0"):
        TEMPLATES[f"CC-{_kind}-{_version}-notice"] = f"Licensed under CC {_kind} {_version}."
        REQUIRED[f"CC-{_kind}-{_version}-notice"] = [f"CC {_kind} {_version}".lower().replace("-", " ").replace(".", " ")]

# Whole texts.
BODIES = {
    entry.name.removesuffix(".txt"): entry.read_text(encoding="utf-8")
    for entry in sorted(files(__package__).joinpath("license_bodies").iterdir(), key=lambda e: e.name)
    if entry.name.endswith(".txt")
}
TEMPLATES |= {f"{_id}-text": _text for _id, _text in BODIES.items()}

# Tags that name a license.
for _id in [
    "MIT", "ISC", "Unlicense", "Zlib", "BSL-1.0", "CC0-1.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-1.1", "MPL-2.0",
    "EPL-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
]:
    TEMPLATES[f"{_id}-tag"] = f"SPDX-License-Identifier: {_id}"
    REQUIRED[f"{_id}-tag"] = [f"SPDX License Identifier {_id}".lower().replace("-", " ").replace(".", " ")]

# Words too frequent in any text to begin a search at.
COMMON = "a an and any as at be by can for from if in is it not of on or see shall that the this to under was will with you your work no do so such list use file free more out may"
