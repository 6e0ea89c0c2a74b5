"""Licence texts and notices with markup for what may be left out or replaced.

Fixed values, all of them: the wording is that of the public licences. Regions
between ``<<beginOptional>>`` and ``<<endOptional>>`` may be missing;
``<<var;words=A-B>>`` stands for A to B words of any kind and
``<<var;match=x|y z>>`` for one of the wordings given. Case, punctuation and
line breaks do not matter.
"""

_AS_IS = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND <<beginOptional>>NONINFRINGEMENT<<endOptional>>
<<beginOptional>>NON-INFRINGEMENT<<endOptional>>. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>>
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY <<var;words=1-20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL <<var;words=1-20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.
"""

_THING = "<<var;match=work|file|program|project|software|document|page|text|content|package|library|source code|book|article>>"
_LICENSED = "<<var;match=licensed|released|distributed|available|published|made available>>"
_VERSION = "<<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>>"

#: (label, template); a label may have several templates.
TEMPLATES: list[tuple[str, str]] = [
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial
        portions of the Software."""
        + _AS_IS,
    ),
    (
        "MIT",
        f"<<beginOptional>>This {_THING} is<<endOptional>> {_LICENSED} under the"
        " <<beginOptional>>terms of the<<endOptional>> MIT <<var;match=License|licence>>",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-12>> DISCLAIMS ALL WARRANTIES
        WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-12>> DISCLAIMS ALL WARRANTIES WITH REGARD
        TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    ),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    (
        "BSD-3-Clause",
        _BSD_HEAD
        + """<<beginOptional>>3.<<endOptional>> Neither the name of <<var;words=1-20>> nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission."""
        + _BSD_TAIL,
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will
        <<var;words=1-12>> be held liable for any damages arising from the use of this software. Permission is granted
        to anyone to use this software for any purpose, including commercial applications, and to alter it and
        redistribute it freely, subject to the following restrictions:""",
    ),
    (
        "BSL-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
        and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
        execute, and transmit the Software, and to prepare derivative works of the Software""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
        for any purpose, commercial or non-commercial, and by any means.""",
    ),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        <<beginOptional>>http://www.apache.org/licenses/LICENSE-2.0<<endOptional>>
        <<beginOptional>>https://www.apache.org/licenses/LICENSE-2.0<<endOptional>> Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    ),
    (
        "Apache-2.0",
        f"<<beginOptional>>This {_THING} is<<endOptional>> {_LICENSED} under the"
        f" <<beginOptional>>terms of the<<endOptional>> Apache <<var;match=License|licence>> {_VERSION} 2.0",
    ),
    (
        "GPL-2.0-or-later",
        """is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or
        (at your option) any later version.""",
    ),
    (
        "GPL-3.0-or-later",
        """is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version.""",
    ),
    (
        "GPL-2.0",
        f"<<beginOptional>>This {_THING} is<<endOptional>> {_LICENSED} under the"
        f" <<beginOptional>>terms of the<<endOptional>> GNU General Public License {_VERSION} 2",
    ),
    (
        "GPL-3.0",
        f"<<beginOptional>>This {_THING} is<<endOptional>> {_LICENSED} under the"
        f" <<beginOptional>>terms of the<<endOptional>> GNU General Public License {_VERSION} 3",
    ),
    (
        "LGPL-2.1-or-later",
        """is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
        License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)
        any later version.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at""",
    ),
    *(
        (
            f"CC-{terms.upper()}-{version}",
            f"<<beginOptional>>This {_THING} is<<endOptional>> {_LICENSED} under"
            " <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> <<beginOptional>>a<<endOptional>>"
            " <<beginOptional>>Creative Commons<<endOptional>> <<beginOptional>>license<<endOptional>>"
            f" <<var;match=CC {terms}|{long}>> {version}",
        )
        for terms, long in [
            ("by", "Attribution"),
            ("by-sa", "Attribution-ShareAlike"),
            ("by-nc", "Attribution-NonCommercial"),
            ("by-nd", "Attribution-NoDerivatives"),
            ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
            ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"),
        ]
        for version in ("3.0", "4.0")
    ),
    (
        "CC0-1.0",
        """waived all copyright and related or neighboring rights to""",
    ),
    (
        "proprietary",
        """All rights reserved. <<beginOptional>>No part of this <<var;words=1-3>> may be reproduced<<endOptional>>
        <<var;words=0-20>> without <<beginOptional>>the<<endOptional>> prior <<beginOptional>>express<<endOptional>>
        written <<var;match=permission|consent>>""",
    ),
]
