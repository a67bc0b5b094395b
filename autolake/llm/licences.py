"""Licence wordings for the licence scan: texts, notices and tags (fixed values, public texts)."""

from __future__ import annotations

_GRANT_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions
the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other
liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"""

_BSD_HEAD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the
documentation and or other materials provided with the distribution"""

_BSD_NAMES = """3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission"""

_BSD_TAIL = """this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not
limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder
or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement
of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in
contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the
possibility of such damage"""

_ISC = """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the
above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties
with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any
special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of
contract negligence or other tortious action arising out of or in connection with the use or performance of this software"""

_APACHE = """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may
obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software
distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the
license for the specific language governing permissions and limitations under the license"""

_MPL = """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this
file you can obtain one at"""

_GNU = """this program is free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the free
software foundation either version {version} of the license or at your option any later version this program is distributed in the hope that it
will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu
{name} for more details"""

_UNLICENSE = """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or
distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"""

# (text, label, key phrases of which one must stand whole)
TEMPLATES = (
    (_GRANT_MIT, "mit-full", ("permission is hereby granted free of charge",)),
    (f"{_BSD_HEAD} {_BSD_TAIL}", "bsd-2-clause", ("following disclaimer in the documentation and or other materials provided with the distribution this software",)),
    (f"{_BSD_HEAD} {_BSD_NAMES} {_BSD_TAIL}", "bsd-3-clause", ("neither the name of the copyright holder",)),
    (_ISC, "isc", ("permission to use copy modify and or distribute this software",)),
    (_APACHE, "apache-2.0-header", ("apache license version 2 0",)),
    (_MPL, "mpl-2.0-header", ("mozilla public license v 2 0",)),
    (_GNU.format(name="general public license", version="2"), "gpl-2.0-or-later", ("either version 2 of the license",)),
    (_GNU.format(name="general public license", version="3"), "gpl-3.0-or-later", ("either version 3 of the license",)),
    (_GNU.format(name="lesser general public license", version="2 1"), "lgpl-2.1-or-later", ("gnu lesser general public license",)),
    (_GNU.format(name="affero general public license", version="3"), "agpl-3.0-or-later", ("gnu affero general public license",)),
    (_UNLICENSE, "unlicense-full", ("free and unencumbered software",)),
)

# Identifiers that stand behind an SPDX tag.
SPDX = ("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later",
        "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "Unlicense", "Zlib")
