"""Notices and licence texts to look for (fixed values): the usual headers, titles and bodies of common licences."""

from __future__ import annotations

_FREE = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
         "License as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version.")
_ONLY = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
         "License as published by the Free Software Foundation, either version {v} of the License.")
_RECEIVED = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
             "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details.")
_TITLE = ("GNU {kind}GENERAL PUBLIC LICENSE Version {v}, {date} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy "
          "and distribute verbatim copies of this license document, but changing it is not allowed.")
_BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
              "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
              "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
              "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAME = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
            "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")
_CC = "This work is licensed under a Creative Commons {kind} {v} International License."


def _gnu(name: str, kind: str, v: str, date: str) -> list[str]:
    return [
        f"This work is licensed under the GNU {kind}General Public License, version {v}.", _FREE.format(kind=kind, v=v), _ONLY.format(kind=kind, v=v),
        f"Licensed under the {name}, version {v}.", f"SPDX-License-Identifier: {name}-{v}.0-or-later", f"SPDX-License-Identifier: {name}-{v}.0-only",
        _TITLE.format(kind=kind.upper(), v=v, date=date),
        _FREE.format(kind=kind, v=v) + " " + _RECEIVED.format(kind=kind),
    ]


def _cc(short: str, kind: str, v: str) -> list[str]:
    return [f"Licensed under {short} {v}.", _CC.format(kind=kind, v=v), f"SPDX-License-Identifier: {short.replace(' ', '-')}-{v}"]


TEMPLATES = {
    "AGPL-3.0": _gnu("AGPL", "Affero ", "3", "19 November 2007"),
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [_BSD_START + _BSD_END, "SPDX-License-Identifier: BSD-2-Clause", "Released under the 2-clause BSD License."],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD License.", _BSD_START + _BSD_NAME + _BSD_END, "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": _cc("CC BY", "Attribution", "4.0"),
    "CC-BY-NC-4.0": _cc("CC BY-NC", "Attribution-NonCommercial", "4.0"),
    "CC-BY-SA-4.0": _cc("CC BY-SA", "Attribution-ShareAlike", "4.0"),
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0.", "CC0 1.0 Universal Public Domain Dedication", "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL-2.0": _gnu("GPL", "", "2", "June 1991"),
    "GPL-3.0": _gnu("GPL", "", "3", "29 June 2007"),
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.", "SPDX-License-Identifier: ISC",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only", _TITLE.format(kind="LESSER ", v="2.1", date="February 1999"),
    ],
    "LGPL-3.0": _gnu("LGPL", "Lesser ", "3", "29 June 2007"),
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.", "SPDX-License-Identifier: MPL-2.0", "Mozilla Public License Version 2.0",
    ],
}
