"""Licence files and notices as people keep them: wrapped, with copyright lines, as comments."""

import re
import textwrap

import pytest

from convlens.llm import licenses

BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE."
)
GNU = (
    "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation{mid} "
    "either version {version} of the License, or (at your option) any later version.\n\n"
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
)
TEXTS = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE."
    ),
    "BSD-2-Clause": BSD + DISCLAIMER,
    "BSD-3-Clause": BSD + NAMES + DISCLAIMER,
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice "
        "appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "GPL-3.0-or-later": GNU.format(what="program", mark=":", kind="", mid=",", version="3"),
    "GPL-2.0-or-later": GNU.format(what="program", mark=";", kind="", mid=";", version="2").replace("; either", ", either"),
    "LGPL-2.1-or-later": GNU.format(what="library", mark=";", kind="Lesser ", mid=",", version="2.1"),
    "LGPL-3.0-or-later": GNU.format(what="program", mark=":", kind="Lesser ", mid=",", version="3"),
    "AGPL-3.0-or-later": GNU.format(what="program", mark=":", kind="Affero ", mid=",", version="3"),
    "GPL-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n"
        "    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software is distributed on an \"AS IS\" BASIS."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}
TITLES = {
    "GPL-3.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n",
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n", "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE\n Version 2.1, February 1999\n",
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007\n",
    "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n",
    "CC0-1.0": "CC0 1.0 Universal\n\n    CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM", "MPL-2.0": "Mozilla Public License Version 2.0\n==================================\n",
}


def wrapped(text, width=72):
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))


def forms(name, text):
    body = wrapped(text)
    yield body
    yield f"Copyright (c) 2020 Jane Doe\n{body}"
    yield f"{name} License\n\nCopyright (c) 2020, Jane Doe. All rights reserved.\n\n{body}\n"
    yield "MIT License\nCopyright (c) 2020 Jane Doe\n" + body if name == "MIT" else f"Some Tool\nCopyright 2019-2021 The Authors\nAll rights reserved.\n{body}"
    lines = f"Copyright (C) 2020 Jane Doe\n\n{body}".split("\n")
    yield "/*\n" + "\n".join(f" * {x}".rstrip() for x in lines) + "\n */\nint main() { return 0; }\n"
    yield "#!/bin/sh\n" + "\n".join(f"# {x}".rstrip() for x in lines) + "\nset -e\n"
    yield "\r\n".join(f"// {x}".rstrip() for x in lines) + "\r\ncode();\r\n"


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: r for r in licenses.scan(df).collect()}


def test_files_and_notices(spark):
    cases = [(name, text) for name, whole in TEXTS.items() for text in forms(name, whole)]
    got = scanned(spark, [t for _, t in cases])
    wrong = [(name, got[i].licenses, got[i].license, text[:300]) for i, (name, text) in enumerate(cases) if got[i].license != name]
    assert not wrong, wrong[:3]


def test_titles_and_tags(spark):
    cases = list(TITLES.items()) + [(n, f"{lead}SPDX-License-Identifier: {n}{tail}") for n in licenses.TAGGED for lead, tail in (("", ""), ("// ", "\n"), ("/* ", " */\nx = 1;"), ("# ", "\n#\nimport os"))]
    got = scanned(spark, [t for _, t in cases])
    assert [(n, got[i].license, t) for i, (n, t) in enumerate(cases) if got[i].license != n] == []


def test_no_licence_in_other_texts(spark):
    got = scanned(spark, [None, "", "The MIT license is short.", "We did not find a copyright notice; permission was not given.", wrapped(BSD + NAMES), "warranty " * 100_000])
    assert all(r.license is None and r.licenses == [] for r in got.values())


def test_the_first_rule_wins(spark):
    """Both fit; the specific one comes first, whatever its place in the text."""
    text = "SPDX-License-Identifier: MIT\n\n" + wrapped(TEXTS["BSD-3-Clause"])
    row = scanned(spark, [text])[0]
    assert row.license == "BSD-3-Clause" and sorted(row.licenses) == ["BSD-3-Clause", "MIT"]


@pytest.mark.parametrize("name", sorted(licenses.SENTENCES))
def test_sentences_are_normalised_and_hold_a_stem(name):
    sentence = licenses.SENTENCES[name]
    assert sentence == " ".join(re.findall("[a-z0-9]+", sentence.lower()))
    assert re.search(licenses.STEMS, sentence)
