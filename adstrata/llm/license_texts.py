"""Paragraphs of licenses as their licenses word them (fixed values), and the Creative Commons names by rule."""

from __future__ import annotations

#: Fixed values: (label, paragraph).
PARAGRAPHS = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
            " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
            " permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
            " the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO"
            " THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"
            " AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,"
            " TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE"
            " SOFTWARE."),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
            " disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
            " disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
            " products derived from this software without specific prior written permission."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
            " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
            " DISCLAIMED."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
            " granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
            " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
               " with the License."),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
               " on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache", "See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
            " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
            " later version."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program."),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library."),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
            " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source"
                  " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
             " liable for any damages arising from the use of this software."),
    ("zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("boost", "Boost Software License - Version 1.0"),
    ("cc0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his"
            " or her rights to the work worldwide under copyright law."),
)

#: The kinds of Creative Commons licenses, short and long.
CREATIVE_COMMONS = {
    "by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives", "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def creative_commons() -> list[tuple[str, str]]:
    """Short and long name of every kind and version."""
    return [
        (f"cc-{kind}", name) for kind, long in CREATIVE_COMMONS.items() for version in VERSIONS
        for name in (f"CC {kind} {version}", f"Creative Commons {long} {version} International License", f"Creative Commons {long} {version}")
    ]
