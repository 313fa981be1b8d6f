from __future__ import annotations

import re

import pytest

from ledgerlark.llm import license_rules as lr


def brute(text):
    found = []
    for s in re.split(r"\n|(?<=[.!?])[ \t]+", text or ""):
        s = re.sub("[^a-z0-9]+", " ", s.lower()).strip()
        if s in lr.SENTENCES:
            found.append(lr.SENTENCES[s])
    names = {
        r.license for r in lr.RULES
        if any(tuple(found[i : i + len(r.sequence)]) == r.sequence for i in range(len(found)))
    }
    return len(found), " ".join(found), " ".join(sorted(names))


TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "Prose. Released under the MIT License. More\nThis work is licensed under the GNU General Public License, version 3.",
    "This program is free software. Something else! Licensed under the GNU General Public License, version 2",
    "Licensed under the GNU General Public License, version 2. This program is free software.",
    "xLicensed under CC BY-NC 4.0.", "LICENSED UNDER CC BY-NC 4.0.\n" * 3, "", None, "...", "\n\n", "a " * 50_000,
]


def test_same_as_one_text_at_a_time(make):
    got = {r[0]: tuple(r[1:]) for r in lr.scan(make(list(enumerate(TEXTS)))).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_awkward_rows(awkward, make):
    assert [tuple(r[1:]) for r in lr.scan(awkward).collect()] == [(0, "", "")] * 13
    assert lr.scan(make([])).collect() == []


def test_own_rules(make):
    docs = make([(0, "A a. B b. C c."), (1, "B b. A a.")])
    got = lr.scan(docs, {"a a": "a", "b b": "b"}, (lr.Rule("ab", ("a", "b")),)).collect()
    assert {r.doc_id: r.licenses for r in got} == {0: "ab", 1: ""}


def test_identifiers_have_no_spaces(make):
    with pytest.raises(ValueError):
        lr.scan(make([]), {"a": "a b"}, ())


MIT = '''MIT License

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY.
'''
BSD = '''Copyright (c) 2020, Somebody

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE.
'''
APACHE = '''Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
'''
GPL = '''This file is part of it.

This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
'''
STANDARD = [
    (MIT, "MIT-full"), (BSD, "BSD"), (APACHE, "Apache-2.0 Apache-2.0-full"),
    (GPL.format(";", ";", 2), "GPL-2.0 GPL-2.0-full"), (GPL.format(":", ",", 3), "GPL-3.0"),
    ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
]


def test_standard_texts_wrapped_and_in_comments(make):
    shapes = [
        lambda t: t,
        lambda t: "/*\n" + "".join(f" * {line}\n" for line in t.split("\n")) + " */\nint main() { return 0; }\n",
        lambda t: "".join(f"# {line}".rstrip() + "\r\n" for line in t.split("\n")),
        lambda t: re.sub(r"(?<!\n)\n(?!\n)", " ", t),
    ]
    rows = [(shape(t), want) for shape in shapes for t, want in STANDARD]
    got = {r.doc_id: r.licenses for r in lr.scan(make([(i, t) for i, (t, _) in enumerate(rows)])).collect()}
    wrong = [(i // len(STANDARD), rows[i][1], got[i]) for i in got if got[i] != rows[i][1]]
    assert wrong == []


def test_a_known_line_within_a_wrapped_sentence_is_found(make):
    text = "Copyright 2020\nAll rights reserved\nand more of it\nReleased under the MIT License. Done."
    assert lr.scan(make([(0, text)])).first().sentence_ids == "reserved mit-notice"
