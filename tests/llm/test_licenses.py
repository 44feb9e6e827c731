"""Licence scan: known notices, the size bound against brute force, odd rows."""

import random

from tidemark.llm import licenses as L

from helpers import documents, letters, odd_documents

MIT = next(t for n, t in L.TEMPLATES if n == "MIT")
APACHE = next(t for n, t in L.TEMPLATES if n == "Apache-2.0")


def brute(text):
    found = {}
    if text:
        paragraphs = L.PARAGRAPHS.split(text)
        for block in [*text.split("\n"), *paragraphs, text]:
            grams = L.bigrams(L.normalised_words(block))
            for name, template in L.TEMPLATES:
                d = L.dice(grams, L.bigrams(L.normalised_words(template))) if grams else 0.0
                if d >= L.THRESHOLD:
                    found[name] = max(found.get(name, 0.0), d)
    return sorted(found.items(), key=lambda f: (-f[1], f[0]))


def test_pruned_scan_finds_what_brute_force_finds():
    r = random.Random(1)
    for i in range(150):
        name, template = r.choice(L.TEMPLATES)
        words = template.split()
        for _ in range(r.randint(0, 1 + len(words) // 12)):
            words[r.randrange(len(words))] = r.choice(["the", "foo", "License,", "bar."])
        at = r.randrange(len(words) + 1)
        text = "\n".join([letters(i, r.randint(0, 30)), r.choice(["", letters(i + 1, 5)]), " ".join(words[:at]), " ".join(words[at:]), "", letters(i, 9)])
        found = [(n, d) for n, d, _ in L.scan(text)]
        want = brute(text)
        # Of one block only the best template is named.
        assert found == [f for f in want if f in found] and (bool(found) == bool(want)) and (not want or found[0][1] == want[0][1])


def test_where_a_licence_is_found(spark):
    texts = [MIT, f"{letters(1, 40)}\n\n{APACHE}\n\n{letters(2, 300)}", f"{letters(3, 50)}\nReleased under the MIT License.\n{letters(4, 50)}",
             f"Copyright (c) 2019 Jane Doe\n{MIT}", letters(5, 200), "Licensed under the Apache License, Version 2.0."]
    got = {r["doc_id"]: r for r in L.scan_licenses(documents(spark, texts)).collect()}
    assert [got[i]["license"] for i in range(6)] == ["MIT", "Apache-2.0", "MIT", "MIT", None, "Apache-2.0"]
    assert got[0]["dice"] == 1.0 and got[2]["found_in"] == "line" and got[1]["found_in"] == "paragraph"
    assert got[4]["licenses"] == []


def in_paragraphs(template, *starts):
    text = " ".join(template.split())
    for start in starts:
        assert text.count(start) == 1
        text = text.replace(start, "\n\n" + start)
    return text


def test_licences_of_several_paragraphs_in_a_long_document():
    templates = {n: t for n, t in reversed(L.TEMPLATES)}
    gpl = next(t for n, t in L.TEMPLATES if n == "GPL-3.0" and "hope" in t)
    for name, template, starts in (
            ("MIT", MIT, ("The above copyright notice", "THE SOFTWARE IS PROVIDED")),
            ("ISC", templates["ISC"], ("THE SOFTWARE IS PROVIDED",)),
            ("BSD-2-Clause", templates["BSD-2-Clause"], ("1. Redistributions", "2. Redistributions", "THIS SOFTWARE IS PROVIDED")),
            ("BSD-3-Clause", templates["BSD-3-Clause"], ("1. Redistributions", "2. Redistributions", "3. Neither", "THIS SOFTWARE IS PROVIDED")),
            ("GPL-3.0", gpl, ("This program is distributed", "You should have received"))):
        text = "\n\n".join([letters(1, 400), in_paragraphs(template, *starts), letters(2, 900), letters(3, 50)])
        found = L.scan(text)
        assert [n for n, _, _ in found] == [name] and found[0][1] == 1.0 and found[0][2] == "paragraphs"


def test_neighbours_are_not_confused():
    for name, template in L.TEMPLATES:
        assert L.scan(template)[0][:2] == (name, 1.0)
    long = {n: t for n, t in L.TEMPLATES if "hope that" in t}
    assert set(long) == {"GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"}
    # Versions and families that no template has get no name rather than a neighbour's.
    assert L.scan(" ".join(long["GPL-3.0"].split()).replace("version 3", "version 4")) == []
    assert L.scan(" ".join(long["GPL-3.0"].split()).replace("GNU General", "GNU Library General")) == []
    assert L.scan("This work is licensed under a Creative Commons Attribution 3.0 International License.") == []


def test_full_texts():
    for name, _, text in L.FULL_TEXTS:
        assert L.scan(text)[0][:2] == (name, 1.0)
        inside = L.scan("\n\n".join([letters(1, 300), text.strip(), letters(2, 300)]))
        assert inside[0][:2] == (name, 1.0), inside
    gpl = next(t for n, _, t in L.FULL_TEXTS if n == "GPL-3.0")
    assert "GPL-3.0" not in [n for n, _, w in L.scan(gpl.replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE", 1)) if w == "document"]


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    rows = L.scan_licenses(odd).collect()
    assert len(rows) == odd.count() and all(r["license"] is None and r["licenses"] == [] for r in rows)
    assert L.scan_licenses(documents(spark, [])).count() == 0
