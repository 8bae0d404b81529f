import pytest

from pulsegrid.llm import licences

GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""
GPL_NOTICE = GPL + """
    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM.
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this file..."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
PUBLISHED = {
    "apache2-notice": APACHE, "mit-text": MIT, "bsd3-text": BSD3, "bsd2-text": BSD2, "gpl3-notice": GPL_NOTICE, "gpl3-short": GPL,
    "apache2-short": 'Licensed under the Apache License, Version 2.0 (the "License").', "apache2-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.", "mit-line-2": "Licensed under the MIT license.",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-line": "This work is licensed under the\nGNU General Public License, version 2.",
    "lgpl3-line": "This work is licensed under the GNU Lesser General Public License, version 3.", "mpl2-line": MPL, "isc-line": ISC,
    "cc-by-4-line": "Licensed under CC BY 4.0.", "cc-by-sa-4-line": "Licensed under CC BY-SA 4.0.", "cc-by-nc-4-line": "Licensed under CC BY-NC 4.0.",
    "cc0-line": "This work is dedicated to the public domain under CC0 1.0.",
    "unlicense-line": "This is free and unencumbered software released into the public domain.",
    "spdx-mit-tag": "SPDX-License-Identifier: MIT\nimport os", "spdx-apache2-tag": "SPDX-License-Identifier: Apache-2.0", "spdx-gpl3-tag": "SPDX-License-Identifier: GPL-3.0-only",
}


@pytest.mark.parametrize("comment", ["", "# ", " * ", "// "])
def test_every_rule_finds_its_published_text(spark, docs_of, comment):
    assert list(PUBLISHED) == [name for name, *_ in licences.RULES]
    texts = ["\n".join((comment + line).rstrip() for line in f"Some words.\n{t}\nMore words.".split("\n")) for t in PUBLISHED.values()]
    got = licences.scan_licences(docs_of(texts)).orderBy("doc_id").collect()
    assert {name: (r["licence_rules"], r["unmatched"]) for name, r in zip(PUBLISHED, got, strict=True)} == {name: ([name], []) for name in PUBLISHED}


def test_a_sentence_is_not_found_inside_a_longer_fragment(spark, docs_of):
    texts = ["It was released under the MIT License.", "SPDX-License-Identifier: MIT-0", "SPDX-License-Identifier: MIT OR Apache-2.0", "Released under the MIT License or another."]
    assert all(r["sentence_ids"] == [] for r in licences.scan_licences(docs_of(texts)).collect())
