import textwrap

from lakelayer.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = f"""{BSD2}

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
GPL2 = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS."""


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))


def test_genuine_texts_wrapped(spark):
    want = {"MIT": MIT, "BSD-2-Clause": BSD2, "BSD-3-Clause": BSD3, "GPL-3.0-or-later": GPL3, "GPL-2.0-or-later": GPL2, "Apache-2.0": APACHE}
    forms = [
        *[lambda t, w=w: wrapped(t, w) for w in (20, 60, 72, 79, 10_000)],
        lambda t: "".join(f" * {x}\n" for x in wrapped(t, 60).split("\n")),
        lambda t: f"Copyright (c) 2020 Some Holder\n{wrapped(t, 66)}\nLast line".replace("\n", "\r\n"),
        lambda t: wrapped(t.replace("1. ", "* ").replace("2. Re", "* Re").replace("3. N", "* N"), 70),
        lambda t: wrapped(t.replace("1. ", "(1) ").replace("2. Re", "(2) Re").replace("3. N", "c) N").replace("the copyright holder", "Example Inc."), 70),
    ]
    rows = [(f"{name} {k}", f(text)) for name, text in want.items() for k, f in enumerate(forms)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r["doc_id"]: r["licences"] for r in got} == {d: d.split()[0] for d, _ in rows}
    assert all(r["n_unmatched"] == 0 for r in got)


def test_lines_are_not_joined_beyond_a_paragraph(spark):
    rows = [(1, "All rights\n\nreserved"), (2, "All rights. Reserved"), (3, "nearly all rights\nreserved"), (4, "Some holder\nAll rights reserved\nand more"), (5, "all\n  rights reserved")]
    got = {r["doc_id"]: r["sentence_ids"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "", 2: "", 3: "", 4: "all-rights", 5: "all-rights"}


def test_rules_in_order(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. The above copyright notice and this permission notice shall be included in all copies. The software is provided 'as is', without warranty of any kind."
    bsd = "Redistributions of source code must retain the above copyright notice.\nRedistributions in binary form must reproduce the above copyright notice."
    rows = [
        (1, f"Some code.\n{mit}\nMore."),
        (2, bsd),
        (3, bsd.replace("\n", "\nsomething between.\n")),  # not in sequence
        (4, "Released under the MIT License. LICENSED under CC BY 4.0!"),
        (5, "The licence is not here"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k]["licences"] for k in range(1, 6)] == ["MIT", "BSD-2-Clause", "", "MIT,CC-BY-4.0", ""]
    assert got[3]["sentence_ids"] == "bsd-source,bsd-binary" and got[3]["n_unmatched"] == 2
    assert got[1]["n_unmatched"] == 0


def test_messy(messy, clash, no_docs):
    assert licenses.scan(messy).filter("licences <> '' OR n_known > 0").count() == 0
    assert licenses.scan(clash).count() == messy.count()
    assert licenses.scan(no_docs).count() == 0


def test_holder_of_any_length(spark):
    """The name in the BSD clause may be long and wrapped."""
    holder = "the Regents of " + ", ".join(f"University {k}" for k in range(60))
    text = textwrap.fill(BSD3.split("\n\n")[-1].replace("the copyright holder", holder), 72)
    docs = spark.createDataFrame([(1, f"{BSD2}\n\n{text}")], "doc_id long, text string")
    assert len(holder) > 600 and licenses.scan(docs).first()["licences"] == "BSD-3-Clause"
