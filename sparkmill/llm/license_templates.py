"""License wordings as templates with markup, fixed values in the notation of the public SPDX license templates.

``<<beginOptional>>`` .. ``<<endOptional>>`` encloses words that may be left out.  ``<<var;name="..";original="..";match="..">>``
stands for replaceable words; ``match`` is ``.{a,b}``, counted in words here.  Marks and letter case do not
count.  A template is (label, family, text): the family is the label that naming the license alone would give, if any."""

_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
<<var;name="holder";original="AUTHORS OR COPYRIGHT HOLDERS";match=".{1,12}">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""

_MIT = """
<<beginOptional>><<var;name="title";original="The";match=".{0,1}">> MIT License <<beginOptional>>(MIT)<<endOptional>><<endOptional>>
<<beginOptional>>Copyright <<var;name="copyright";original="(c) <year> <copyright holders>";match=".{0,20}">><<endOptional>>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>>
shall be included in all copies or substantial portions of the Software.""" + _WARRANTY

_BSD_HEAD = """
<<beginOptional>>Copyright <<var;name="copyright";original="(c) <year> <owner>";match=".{0,20}">> <<beginOptional>>All rights reserved.<<endOptional>><<endOptional>>
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
met: <<var;name="bullet";original="1.";match=".{0,1}">> Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. <<var;name="bullet";original="2.";match=".{0,1}">> Redistributions in binary form must reproduce
the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution."""

_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY <<var;name="holder";original="THE COPYRIGHT HOLDERS AND CONTRIBUTORS";match=".{1,12}">> "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL <<var;name="liable";original="THE COPYRIGHT HOLDER OR CONTRIBUTORS";match=".{1,12}">> BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

_BSD_NAMES = """
<<var;name="bullet";original="3.";match=".{0,1}">> Neither the name of <<var;name="organization";original="the copyright holder";match=".{1,12}">> nor
the names of its contributors may be used to endorse or promote products derived from this software without specific prior written
permission."""

_ISC = """
<<beginOptional>>ISC License<<endOptional>> <<beginOptional>>Copyright <<var;name="copyright";original="(c) <year> <owner>";match=".{0,20}">><<endOptional>>
Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="holder";original="THE AUTHOR";match=".{1,12}">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
<<var;name="liable";original="THE AUTHOR";match=".{1,12}">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_APACHE_NOTICE = """
<<beginOptional>>Copyright <<var;name="copyright";original="[yyyy] [name of copyright owner]";match=".{0,20}">><<endOptional>>
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at <<beginOptional>>http<<beginOptional>>s<<endOptional>>://<<endOptional>>www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""

_GPL_NOTICE = """
<<var;name="program";original="This program";match=".{1,6}">> is free software<<beginOptional>>;<<endOptional>> you can redistribute it and/or modify it under
the terms of the GNU General Public License as published by the Free Software Foundation; either version
<<var;name="version";original="2";match=".{1,1}">> of the License, or (at your option) any later version."""

#: Whole wordings and notices, and statements of one line that grant a license by its full name and version.
TEMPLATES = (
    ("mit", "mit", _MIT),
    ("mit", "mit", "Released under the MIT License."),
    ("bsd-2-clause", None, _BSD_HEAD + _BSD_TAIL),
    ("bsd-3-clause", None, _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("isc", None, _ISC),
    ("apache-2.0", "apache", _APACHE_NOTICE),
    ("apache-2.0", "apache", "Licensed under the Apache License<<beginOptional>>, Version<<endOptional>> 2.0"),
    ("gpl-2.0-or-later", "gpl", _GPL_NOTICE),
    ("gpl-3.0", "gpl", "licensed under the GNU General Public License<<beginOptional>>, version<<endOptional>> <<beginOptional>>v<<endOptional>> 3"),
    ("cc-by-4.0", "cc-by", "licensed under <<beginOptional>>a<<endOptional>> CC BY 4.0"),
    ("cc-by-nc-4.0", "cc-by", "licensed under <<beginOptional>>a<<endOptional>> CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "cc-by", "licensed under <<beginOptional>>a<<endOptional>> CC BY-SA 4.0"),
)

#: Base phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
