import hashlib
import random

import xxhash

from panelwright.llm import bottomk, licenses, quotes
from panelwright.llm import queries as Q
from pyspark.sql import functions as F
from tests.llm import awkward

SMALL = "/root/testdata/sf0.01"


def test_nested_quotes_are_parsed():
    own, mine, quoted = quotes.parse("Ann wrote:\n> > Deep one. Deep\n>> two?\n> Near\n> again\n\nOwn text here.\n")
    assert own == "Own text here." and mine == ["own text here"]
    assert quoted == [(2, ["deep one", "deep two"]), (1, ["near again"])]


def thread_by_hand(rows):
    """Links, threads and depths message by message."""
    parsed = {(c, t): quotes.parse(x or "") for c, t, _, x in rows}
    parent = {}
    for (c, t), (_, _, quoted) in parsed.items():
        votes = {}
        if c is None or t is None:
            continue
        for depth, s in {(d, s) for d, ss in quoted for s in ss}:
            earlier = [u for (k, u), p in parsed.items() if k == c and u is not None and u < t and s in p[1]]
            if earlier:
                votes[depth, max(earlier)] = votes.get((depth, max(earlier)), 0) + len(s)
        if votes:
            parent[c, t] = max((-d, size, u) for (d, u), size in votes.items())[2]
    out = {}
    for c, t in parsed:
        up, depth = t, 0
        while (c, up) in parent:
            up, depth = parent[c, up], depth + 1
        out[c, t] = (parsed[c, t][0], parent.get((c, t)), up, depth)
    return out


def test_links_equal_those_by_hand(spark, monkeypatch):
    monkeypatch.setattr(quotes, "RANGE", 4)
    rng = random.Random(1)
    rows = []
    for c in range(6):
        told = []
        for t in range(25):
            text = ". ".join(awkward.prose(rng, 4) for _ in range(3)) + "."
            if told and rng.random() < 0.7:
                old = rng.choice(told).split(". ")
                part = ". ".join(old[rng.randrange(len(old)):])
                text = "".join(f"> {line}\n" for line in part.replace(". ", ".\n").split("\n")) + text
            if rng.random() < 0.2:
                text = "> Thanks.\n" + text + " Thanks."
            told.append(text)
            rows.append((c, t, "user", text))
    rows += [(None, 1, "user", "> x"), (7, None, "user", "y"), (7, 1, None, None), (7, 2, "user", "")]
    got = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = thread_by_hand(rows)
    assert len(got) == len(rows)
    assert {(r["conv_id"], r["turn"]): (r["text"], r["reply_to"], r["thread"], r["depth"]) for r in got} == want
    assert sum(r["reply_to"] is not None for r in got) > 60
    keys = [(r["conv_id"] is not None, r["conv_id"] or 0, r["thread"] or -1, r["depth"], r["turn"] or -1) for r in got]
    assert keys == sorted(keys)


def test_conversation_tables(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, depth int")
    assert quotes.reply_order(empty).isEmpty()
    assert Q.op4(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/conversations.parquet").count()


def test_templates_find_themselves_and_nothing_else():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            found = scanner.scan(licenses.words_of(text))
            assert [n.name for n in found] == [name] and not found[0].missing and not found[0].added
    for other in ("Licensed under CC BY-NC-SA 4.0.", "Licensed under the Apache License, Version 1.1.",
                  "This work is licensed under the GNU Lesser General Public License, version 4.", "The license was lost."):
        assert not scanner.scan(licenses.words_of(other)), other


def test_compression_decides_between_templates_that_the_wording_confirms(monkeypatch):
    """Every template is found in prose; without the ranking a shorter license within a longer one is taken."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    rng = random.Random(2)
    for name, own, _ in scanner.templates:
        words = awkward.prose(rng, 20).split() + own + awkward.prose(rng, 20).split()
        assert [n.name for n in scanner.scan(words)] == [name], own
    right = [n.name for n in scanner.scan(licenses.words_of(licenses.BSD3))]
    ranked = licenses.Scanner.ranked
    monkeypatch.setattr(licenses.Scanner, "ranked", lambda self, words: sorted((0, i) for _, i in ranked(self, words)))
    wrong = [n.name for n in scanner.scan(licenses.words_of(licenses.BSD3))]
    assert right == ["BSD-3-Clause"] and wrong == ["BSD-2-Clause"]


def test_usual_forms_and_expressions():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for text, names in {
        "Licensed under the Apache License 2.0": ["Apache-2.0"],
        "Distributed under the terms of the MIT License": ["MIT"],
        "GNU Lesser General Public License, version 2.1": ["LGPL-2.1"],
        "GNU Affero General Public License, version 3 or later.": ["AGPL-3.0-or-later"],
        "Licensed under GPLv2 only": ["GPL-2.0-only"],
        "GNU General Public License v3.0": ["GPL-3.0"],
        "SPDX-License-Identifier: GPL-3.0-or-later": ["GPL-3.0-or-later"],
        "SPDX-License-Identifier: MIT OR Apache-2.0": ["MIT", "Apache-2.0"],
        "SPDX-License-Identifier: (LGPL-2.1-only AND BSD-3-Clause) OR MPL-2.0": ["LGPL-2.1-only", "BSD-3-Clause", "MPL-2.0"],
        "Released under the Eclipse Public License 2.0. Licensed under the Boost Software License, Version 1.0.": ["EPL-2.0", "BSL-1.0"],
        "Licensed under GPLv4": [], "SPDX-License-Identifier: GPL-1.0-only": [], "The MIT license was discussed.": [],
    }.items():
        words = licenses.words_of(text)
        found = scanner.scan(words)
        assert [n.name for n in found] == names, text
        assert all(a.end <= b.begin for a, b in zip(found, found[1:])) and all(n.begin < n.end <= len(words) for n in found)
    # templates that save the same
    twice = licenses.Scanner({"B": ["under the very same notice"], "A": ["under the very same notice"]})
    assert [n.name for n in twice.scan("it is under the very same notice".split())] == ["A"]


def test_license_behind_templates_that_fail():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for before in ("Licensed under CC BY-NC-SA 4.0.\nLicensed under the GNU Lesser General Public License, version 2.1.\n",
                   "Released under the BSD 4-Clause License.\n"):
        found = scanner.scan(licenses.words_of(f"{before}Copyright 2020 Foo. All rights reserved."))
        assert [n.name for n in found] == ["LGPL-2.1"] * ("Lesser" in before) + ["Proprietary"]
    # all of a wide set is tried, whatever the rank
    many = {f"L{i:02}": [f"Licensed under the terms of the common public notice number {i} of this whole work."] for i in range(40)}
    scanner = licenses.Scanner(many)
    for name, (text,) in many.items():
        assert [n.name for n in scanner.scan(licenses.words_of(text))] == [name]
    words = licenses.words_of(" ".join(many[f"L{i:02}"][0].replace("whole", "entire old") for i in range(20)) + many["L39"][0])
    assert "L39" in {n.name for n in scanner.scan(words)}


def test_license_in_a_long_line(spark):
    rng = random.Random(6)
    lines = {"Released under the MIT License.": "MIT", "All rights reserved.": "Proprietary", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause", licenses.BSD3.replace("\n", " "): "BSD-3-Clause",
             licenses.MIT.replace("\n", " ").replace("and associated", "and the associated"): "MIT"}
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for line, name in lines.items():
        for before in (0, 150, 200, 395, 1700):
            text = f"{awkward.prose(rng, before)} {line} {awkward.prose(rng, 3000 - before)}"
            found = scanner.scan(licenses.words_of(text))
            assert [n.name for n in found] == [name], (line, before)
            assert (found[0].begin, found[0].end) == (before, before + len(licenses.words_of(line)))
    text = f"{awkward.prose(rng, 1000)} {' '.join(lines)} {awkward.prose(rng, 1000)} All rights reserved."
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["licenses"] == sorted(set(lines.values())) and len(row["notices"]) == 7


def test_license_scan_of_texts(spark):
    text = f"Prose.\nMore.\n\n{licenses.MIT}\n\n" + "line\n" * 6 + licenses.APACHE.replace("this file", "this work") + "\nEnd"
    rows = spark.createDataFrame([(1, text), (2, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(rows).collect()}
    assert got[1]["licenses"] == ["Apache-2.0", "MIT"] and got[1]["n_blocks"] == 2
    mit, apache = got[1]["notices"]
    assert text[mit["begin"]:mit["end"]].startswith("Permission") and text[mit["begin"]:mit["end"]].endswith("SOFTWARE")
    assert apache["missing"] == ["file"] and apache["added"] == ["work"]
    assert got[2]["licenses"] == ["CC-BY-NC-4.0"]
    docs = awkward.documents(spark)
    assert licenses.scan(docs).count() == docs.count()
    assert licenses.scan(awkward.nothing(spark)).isEmpty()


def test_license_query_equals_search_for_known_lines(spark):
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "Proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = {i: sorted({n for line, n in lines.items() if line in t}) for i, t in docs.items()}
    assert {r["doc_id"]: r["licenses"] for r in Q.op9(spark, SMALL).collect()} == want and any(want.values())


def sketch(text, k, size):
    words, out = (text or "").lower().split(), set()
    for i in range(max(1, len(words) - size + 1)) if words else ():
        h = 42
        for w in words[i:i + size]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return sorted(out)[:k]


def test_sketches_equal_brute_force(spark):
    docs = awkward.documents(spark)
    got = bottomk.with_sketch(docs, "text", "f", 16, 3)
    assert got.columns == [*docs.columns, "f"]
    for r in got.collect():
        if (r["text"] or "").isascii():
            assert r["f"] == sketch(r["text"], 16, 3)


def test_sketches_estimate_and_merge(spark):
    rng = random.Random(4)
    words = awkward.prose(rng, 6000).split()
    a, b = " ".join(words[:4000]), " ".join(words[1000:])
    row = spark.createDataFrame([(a, b, " ".join(words), "")], "a string, b string, u string, e string")
    for c in "abue":
        row = bottomk.with_sketch(row, c, f"s{c}", 512, 1)
    s = {c: F.col(f"s{c}") for c in "abue"}
    r = row.select(
        bottomk.resemblance(s["a"], s["b"], 512).alias("j"), bottomk.containment(s["a"], s["b"], 512).alias("c"),
        bottomk.distinct_shingles(s["u"], 512).alias("n"), (bottomk.merge(s["a"], s["b"], 512) == s["u"]).alias("m"),
        bottomk.resemblance(s["e"], s["e"]).alias("ee"), bottomk.resemblance(s["e"], s["a"]).alias("ea")).first()
    x, y = set(a.split()), set(b.split())
    assert abs(r["j"] - len(x & y) / len(x | y)) < 0.08 and abs(r["c"] - len(x & y) / len(x)) < 0.1
    assert abs(r["n"] / len(x | y) - 1) < 0.15 and r["m"] and (r["ee"], r["ea"]) == (1.0, 0.0)
    parts = spark.createDataFrame([("g", a), ("g", b), ("h", a)], "g string, t string")
    merged = {r["g"]: r["f"] for r in bottomk.merge_rows(bottomk.with_sketch(parts, "t", "f", 64, 1), ["g"], "f", 64).collect()}
    assert merged == {"g": sketch(" ".join(words), 64, 1), "h": sketch(a, 64, 1)}


def test_edited_texts(spark, monkeypatch):
    real = bottomk.buckets_by_descending_id
    monkeypatch.setattr(bottomk, "buckets_by_descending_id", lambda d, c: real(d, c, rows=7))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    got = {r["id"]: r for r in bottomk.edited_pairs(docs).collect()}
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(rows):
        cut = len(t) // 3
        edited = t[:len(t) - cut] + rows[(i + 1) % len(rows)][1][:cut]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if t.isascii() and edited.isascii():
            assert r["sketch"] == sketch(t, bottomk.K, bottomk.SIZE) and r["edited_sketch"] == sketch(edited, bottomk.K, bottomk.SIZE)
        if i + 1 < len(rows):
            assert r["next_sketch"] == got[rows[i + 1][0]]["sketch"]
    odd = awkward.documents(spark)
    assert bottomk.edited_pairs(odd).count() == odd.count()
    assert bottomk.edited_pairs(awkward.nothing(spark)).isEmpty()
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    assert bottomk.edited_pairs(one).first()["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
