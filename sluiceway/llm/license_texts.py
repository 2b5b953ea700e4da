"""Texts that license scans look for: phrases, notices and passages of public licenses."""

from __future__ import annotations

# Phrases whose places are counted, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Names that licenses are given in notices. The words of a name must all be there.
NAMES = {
    "agpl": ["GNU Affero General Public License", "AGPL 3.0"],
    "apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "boost": ["Boost Software License, Version 1.0"],
    "bsd": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License"],
    "cc-by": ["CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": [
        "CC BY-NC 4.0",
        "CC BY-NC 3.0",
        "Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc-by-nc-nd": ["CC BY-NC-ND 4.0"],
    "cc-by-nc-sa": ["CC BY-NC-SA 4.0"],
    "cc-by-nd": ["CC BY-ND 4.0"],
    "cc-by-sa": [
        "CC BY-SA 4.0",
        "CC BY-SA 3.0",
        "Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "cc0": ["CC0 1.0"],
    "epl": ["Eclipse Public License 2.0"],
    "gpl": ["GNU General Public License", "GPL version 3", "GPLv3"],
    "isc": ["ISC License"],
    "lgpl": ["GNU Lesser General Public License", "LGPL 2.1"],
    "mit": ["MIT License"],
    "mpl": ["Mozilla Public License 2.0"],
    "ofl": ["SIL Open Font License, Version 1.1"],
    "zlib": ["zlib License"],
}

# What stands before a name.
NOTICES = [
    "licensed under",
    "licensed under the",
    "released under the",
    "distributed under the",
    "available under the",
    "under the terms of the",
    "this work is licensed under the",
]

_FREE_SOFTWARE = (
    "This {work} is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU {kind} as published by the Free Software Foundation, either version 3 of the "
    "License, or (at your option) any later version."
)
_NO_WARRANTY = (
    "This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
    "See the GNU {kind} for more details."
)
_GNU = {
    "gpl": {"work": "program", "kind": "General Public License"},
    "lgpl": {"work": "library", "kind": "Lesser General Public License"},
    "agpl": {"work": "program", "kind": "Affero General Public License"},
}

# Passages of license texts.
PASSAGES = {
    "apache": [
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "boost": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        '"Software") to use, reproduce, display, distribute, execute, and transmit the Software',
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ],
    "zlib": [
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:",
    ],
    **{
        label: [text.format(**names) for text in (_FREE_SOFTWARE, _NO_WARRANTY)]
        for label, names in _GNU.items()
    },
}
