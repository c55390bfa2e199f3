"""Licence scan, personal data, decontamination and URL filter."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, documents
from wardflow.llm import license_rules, pii_bootstrap, spaced_seeds, url_rules
from wardflow.llm.queries import URL_RULES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    worth = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in worth) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def spans(value):
    return [(s["kind"], s["start"], s["end"]) for s in value]


def test_base_spans_are_the_plain_patterns(spark):
    rng = random.Random(4)
    parts = ["a", "_", "b.c", "@", ".", "x@y.z", "1", "22", "256", "0.0.1.2", " ", "-", "+", "(", ")", "+1 (743) 555-3824",
             "4111 1111 1111 1111", "4111111111111111", "é", "😀", "\n", "00255.1.2.003"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    got = {r["doc_id"]: spans(r["base"]) for r in pii_bootstrap.find(documents(spark, list(enumerate(texts)))).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_long_runs_take_linear_time(spark):
    texts = ["1 " * 60_000, "1" * 200_000, "a" * 200_000 + "@", "a@b" + ".c" * 40_000, "x@y.zz " * 3000, "1.2.3." * 20_000]
    got = {r["doc_id"]: spans(r["base"]) for r in pii_bootstrap.find(documents(spark, list(enumerate(texts)))).collect()}
    assert got[3] == [("email", 0, len(texts[3]))]
    assert got[4] == [("email", 7 * k, 7 * k + 6) for k in range(3000)]


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(6)

    def card(ok):
        while True:
            digits = "".join(rng.choice("0123456789") for _ in range(16))
            if luhn(digits) == ok:
                return digits

    texts = [f"Please charge card number {card(True)} for order of item {k}" for k in range(40)]
    texts += [f"Please charge card number {card(False)} for the rest"]
    texts += [f"Item {card(False)} is in stock and the code {card(False)} is not" for _ in range(20)]
    rows = {r["doc_id"]: r for r in pii_bootstrap.find(documents(spark, list(enumerate(texts)))).collect()}
    assert all(spans(rows[k]["spans"]) == base(texts[k]) for k in range(40))
    assert spans(rows[40]["base"]) == [] and spans(rows[40]["spans"]) == [("card", 26, 42)]
    assert all(not rows[k]["spans"] for k in range(41, 61))


def test_personal_data_of_awkward_rows(spark):
    docs = awkward(spark, extra=("spans", "version"))
    rows = pii_bootstrap.find(docs).collect()
    assert len(rows) == docs.count() and all(not r["spans"] for r in rows)
    assert pii_bootstrap.digests(docs.limit(0)).count() == 0


def test_license_rules(spark):
    apache = license_rules.SENTENCES
    header = ". ".join(apache[k].capitalize() for k in ("apache-notice", "apache-comply", "apache-copy", "apache-basis")) + "."
    wrapped = header.replace("this file", "this\nfile")
    texts = [
        "Text. Released under the MIT License.", "released### under%%% the*** mit&&& license.%%% More.", header, wrapped,
        "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.", "The MIT License is nice.", None, "",
    ]
    got = sorted((r["doc_id"], r["rule"]) for r in license_rules.scan(documents(spark, list(enumerate(texts)))).collect())
    assert got == [(0, "mit-notice"), (1, "mit-notice"), (2, "apache-2.0-header"), (3, "apache-2.0-header"),
                   (4, "cc-by-4.0"), (4, "cc-by-nc-4.0")]
    docs = awkward(spark, extra=("rule", "ids"))
    assert license_rules.scan(docs).count() == 0 and license_rules.scan(docs.limit(0)).count() == 0


#: Headers as their licences publish them.
HEADERS = {
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "lgpl-2.1-header": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "mit-text": """MIT License

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,""",
    "cc-by-sa-4.0": """This work is licensed under the Creative Commons
Attribution-ShareAlike 4.0 International License.""",
    "gpl-3.0-later-notice": "This work is licensed under the GNU General Public License, version 3 or later.",
}


def test_published_license_headers(spark):
    texts, want = [], []
    for rule, header in HEADERS.items():
        commented = "\n".join(f" * {line}".rstrip() for line in header.split("\n"))
        for text in (header, " ".join(header.split()), f"/*\n{commented}\n */\nint x;", f"Some words before {header} and after"):
            want.append((len(texts), rule))
            texts.append(text)
    texts.append("This file is not licensed under the MIT License.")
    got = sorted((r["doc_id"], r["rule"]) for r in license_rules.scan(documents(spark, list(enumerate(texts)))).collect())
    assert got == want


def overlap_brute_force(docs, items, short_items=True, window=12, differ=2):
    out = {}
    for doc_id, text in docs:
        a = spaced_seeds.tokens(text)
        for item_id, other in items:
            b = spaced_seeds.tokens(other)
            width = min(window, len(b))
            need = width - differ * width // window
            covered, n = set(), 0
            for j in range(len(b) - width + 1 if b else 0):
                for i in range(len(a) - width + 1):
                    if sum(x == y for x, y in zip(a[i : i + width], b[j : j + width], strict=True)) >= need:
                        covered.update(range(j, j + width))
                        n += 1
            if n:
                least = min(spaced_seeds.MIN_OVERLAP, len(b)) if short_items else spaced_seeds.MIN_OVERLAP
                out[doc_id, item_id] = (len(covered), len(b), n, len(covered) >= least)
    return out


@pytest.mark.parametrize("block, short", [(1 << 20, False), (300, False), (1 << 20, True), (300, True)])
def test_overlaps_are_brute_force(spark, block, short):
    rng = random.Random(8)
    words = [f"t{i}" for i in range(30)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([3, 7, 12, 20, 40])))) for k in range(12)] + [(50, None), (51, " .,")]
    docs = []
    for k in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if k % 2:
            copy = rng.choice(items[:12])[1].split()
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "changed"
            text[len(text) // 2 : len(text) // 2] = copy
        docs.append((k, ", ".join(text).upper()))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = spaced_seeds.overlaps(documents(spark, docs), benchmark, block, short).collect()
    got = {(r["doc_id"], r["item_id"]): (r["covered"], r["n_tokens"], r["n_windows"], r["contaminated"]) for r in rows}
    want = overlap_brute_force(docs, items, short)
    assert got == want and want
    bad = {i for (i, _), v in want.items() if v[3]}
    kept = spaced_seeds.keep_clean(documents(spark, docs, extra=("covered",)), benchmark, block, short)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - bad


def test_overlaps_of_awkward_rows(spark):
    docs = awkward(spark, extra=("item_id", "covered"))
    items = spark.createDataFrame([(1, "one plain line of words here another line"), (1, "one plain line of words here another line")], "item_id bigint, text string")
    rows = spaced_seeds.overlaps(docs, items).collect()
    assert len(rows) == 4 and {r["doc_id"] for r in rows} == {1}
    assert spaced_seeds.overlaps(docs, items.limit(0)).count() == 0
    assert spaced_seeds.overlaps(docs.limit(0), items).count() == 0
    assert spaced_seeds.keep_clean(docs, items.limit(0)).count() == docs.count()


def test_tokens_of_all_scripts():
    def plain(text):
        return [t.decode() for t in spaced_seeds.tokens(text)]

    assert plain("Don’t “quote” a\u00a0b—c_d Straße naïve ２") == ["don", "t", "quote", "a", "b", "c", "d", "straße", "naïve", "２"]
    assert plain("don't") == plain("don’t")
    assert plain("中文、かなABC 한국어 हिन्दी ที่") == ["中", "文", "か", "な", "abc", "한국어", "हिन्दी", "ที่"]
    gaps = "".join(map(chr, range(0x2010, 0x2030)))
    assert plain(f"é{gaps}ö") == ["é", "ö"]


def test_short_and_unspaced_items_contaminate(spark):
    items = [(1, "Why don’t penguins fly?"), (2, "二つの数の和を求めなさい"), (3, "x" * 3 + " one two three four five six seven eight nine ten eleven")]
    docs = [(1, "And so: why don't penguins fly? Nobody knows."), (2, "前の文です。二つの数の和を求めなさい。後の文です。"), (3, "Penguins fly, don't they? 二つの数")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    frame = documents(spark, docs)
    rows = spaced_seeds.overlaps(frame, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["contaminated"]} == {(1, 1), (2, 2)}
    assert [r["doc_id"] for r in spaced_seeds.keep_clean(frame, benchmark).collect()] == [3]


def test_hosts_paths_and_fixed_rules(spark):
    urls = ["https://WWW.Example.com/en/1?x", "http://a.net/es/", "http://net/fr/x", "http://anet/es/", "http://x.com", "x.com/en/",
            "http://b.example.com/en/#f", "ftp://c.com?q=/a", None, "http://É.com/", "a\nhttp://y.com/z://"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("rule", F.lit("own"))
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, labels, URL_RULES).collect()}
    assert got == {
        0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        1: ("a.net", "/es/", "net/es/", "block"),
        2: ("net", "/fr/x", "net/fr/", "block"),
        3: ("anet", "/es/", None, "allow"),
        4: ("x.com", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("b.example.com", "/en/", "example.com/en/", "block"),
        7: ("c.com", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("É.com", "/", "com/", "allow"),
        10: ("y.com", "/z://", "com/", "allow"),
    }


def test_mined_rules_decide_the_rest(spark):
    rows = [(k, f"http://{'spam' if k % 3 == 0 else 'good'}.example.org/x/{k}") for k in range(300)]
    pages = spark.createDataFrame(rows + [(1000, "http://spam.example.org/y/none"), (1000, "http://spam.example.org/y/none")], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, 0 if k % 3 == 0 else 1, 0) for k in range(150)] + [(None, 0, 1), (3, None, 1)], "doc_id bigint, quality int, toxic int")
    got = url_rules.judge(pages, labels, URL_RULES).collect()
    assert len(got) == 302
    assert all(r["verdict"] == ("block" if "spam" in r["host"] else "allow") for r in got)
    rules = url_rules.mine(url_rules.label_transactions(pages, labels)).collect()
    assert ("host=spam",) in {tuple(r["tokens"]) for r in rules if r["verdict"] == "block"}
    assert url_rules.judge(pages.limit(0), labels, URL_RULES).count() == 0


def test_rules_below_the_share_are_mined(spark):
    hosts = [("bad", 8, 0, "x"), ("mixed", 20, 0, "casino/sub"), ("mixed", 20, 1, "news/sub")]
    rows = [(h, q, path) for h, n, q, path in hosts for _ in range(n)] + [(f"h{k % 50}", int(k % 40 > 0), "y") for k in range(4000)]
    pages = spark.createDataFrame([(k, f"http://{h}.example.org/{path}/{k}") for k, (h, _, path) in enumerate(rows)], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, q, 0) for k, (_, q, _) in enumerate(rows)], "doc_id bigint, quality int, toxic int")
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, labels, URL_RULES).collect()}
    assert [got[k] for k in range(len(rows))] == ["block"] * 28 + ["allow"] * 4020


def slow_url_verdicts(labelled, urls):
    """Verdict for each token set of `urls`: all combinations of the tokens of `labelled` (tokens, bad) are counted."""
    rows, n_bad = len(labelled), sum(bad for _, bad in labelled)
    count = {0: Counter(), 1: Counter()}
    for have, bad in labelled:
        for size in range(1, len(have) + 1):
            count[bad].update(combinations(sorted(have), size))
    rules = []
    for tokens in set(count[0]) | set(count[1]):
        good, n = count[0][tokens], count[0][tokens] + count[1][tokens]
        least = {0: max(5, 0.01 * (rows - n_bad)), 1: max(5, 0.01 * n_bad)}
        if len(tokens) > 2 and all(count[c][tokens] < least[c] for c in (0, 1)):
            continue
        for verdict, hits, share in (("block", n - good, n_bad / rows), ("allow", good, 1 - n_bad / rows)):
            far = hits - n * share >= 3 * (n * share * (1 - share)) ** 0.5
            if hits >= 5 and hits / n >= 0.6 and hits / n >= 1.1 * share and (hits >= 0.01 * rows or far):
                rules.append((hits / n, hits, verdict, set(tokens)))
    rules.sort(key=lambda r: r[:3], reverse=True)
    return [next((r[2] for r in rules if r[3] <= have), "allow") for have in urls]


@pytest.mark.parametrize("broadcast", [100_000, 3])
def test_mined_verdicts_are_brute_force(spark, broadcast, monkeypatch):
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", broadcast)
    rng = random.Random(12)
    rows = []
    for k in range(900):
        host, folder, last = rng.choice("abcdef"), rng.choice(["shop", "news", "wiki"]), rng.choice(["x", "y", "z"])
        chance = 0.95 if (host, folder) in {("a", "shop"), ("b", "news")} or (folder, last) == ("wiki", "z") else 0.15
        rows.append((k, host, folder, last, rng.random() < chance))
    pages = spark.createDataFrame(
        [(k, f"http://{h}.site.org/{f}/{e}/{k}{'?s=1&t=2' if e == 'y' else ''}") for k, h, f, e, _ in rows], "page_id bigint, url string"
    )
    labels = spark.createDataFrame([(k, 0 if bad else 1, 0) for k, *_, bad in rows if k < 600], "doc_id bigint, quality int, toxic int")
    tokens = [
        frozenset({"scheme", f"h={h}", "site", "org", f"p={f}", f"p={e}", "0"} | ({"s", "t"} if e == "y" else set()))
        for _, h, f, e, _ in rows
    ]
    want = slow_url_verdicts([(t, r[-1]) for t, r in zip(tokens[:600], rows[:600], strict=True)], tokens)
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, labels, URL_RULES).collect()}
    assert [got[k] for k in range(900)] == want
    # On pages that carry no label the mined rules decide: by default all would be allowed.
    held_out = [(got[k], rows[k][-1]) for k in range(600, 900)]
    blocked = [bad for verdict, bad in held_out if verdict == "block"]
    assert len(blocked) > 50 and sum(blocked) >= 0.85 * len(blocked)
    assert sum(blocked) >= 0.6 * sum(bad for _, bad in held_out)


def test_urls_of_many_parts(spark):
    """Parts that always stand together make one item: 400 of them add no combinations."""
    query = "&".join(f"k{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400))
    rows = [(k, f"http://h.site.org/p/{k}" + (f"?{query}" if k % 4 == 0 else "")) for k in range(200)]
    pages = spark.createDataFrame(rows + [(900, "http://h.site.org/q/z?kbb"), (901, "http://h.site.org/q/z")], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(100)], "doc_id bigint, quality int, toxic int")
    (rule,) = [r for r in url_rules.mine(url_rules.label_transactions(pages, labels)).collect() if r["verdict"] == "block"]
    assert len(rule["tokens"]) == 1 and len(rule["members"][0]) == 400
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, labels, URL_RULES).collect()}
    assert [got[k] for k in range(200)] == ["block" if k % 4 == 0 else "allow" for k in range(200)]
    assert (got[900], got[901]) == ("block", "allow")


def slow_candidates(text):
    """(value, start, end, contexts) of runs of words with digits or an at sign, one blank apart."""
    words = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    runs, gaps, gap = [], [], []
    for k, (word, start, end) in enumerate(words):
        if not re.search("[0-9@]", word):
            gap.append(word)
        elif runs and not gap and text[words[k - 1][2] : start] == " ":
            runs[-1] = (runs[-1][0], end)
        else:
            gaps.append(gap)
            runs.append((start, end))
            gap = []
    gaps.append(gap)
    out = []
    for k, (start, end) in enumerate(runs):
        value = text[start:end]
        if len(re.sub("[^0-9]", "", value)) < 5 and "@" not in value:
            continue
        while value and not (value[0].isalnum() or value[0] in "+(@"):
            value, start = value[1:], start + 1
        while value and not value[-1].isalnum():
            value = value[:-1]
        before, after = [slow_plain(w) for w in gaps[k][-2:]], [slow_plain(w) for w in gaps[k + 1][:1]]
        contexts = {f"L1 {before[-1]}", f"L2 {' '.join(before)}"} if before else set()
        if value:
            out.append((value, start, start + len(value), contexts | {f"R1 {w}" for w in after}))
    return out


def slow_plain(word):
    return "".join(c for c in word.lower() if c.isalnum()) or word


def slow_kind(value):
    return next((k for k in BASE if any(valid(k, m[0]) for m in re.finditer(BASE[k], value))), None)


def slow_shaped(kind, value):
    n = len(re.sub("[^0-9]", "", value))
    return {
        "email": bool(re.fullmatch(r"[^ @]+@[^ @]+", value)),
        "ip": bool(re.fullmatch(r"[0-9]+([.:][0-9]+){3,7}", value)),
        "card": 12 <= n <= 19 and bool(re.fullmatch(r"[0-9][0-9 -]*", value)),
        "phone": 7 <= n <= 15 and bool(re.fullmatch(r"[0-9+(][0-9 ().+-]*", value)),
    }[kind]


def slow_discoveries(texts):
    """Spans beyond the base for each text, by plain dictionaries."""
    found = [slow_candidates(t) for t in texts]
    everywhere, standing, edges = Counter(), Counter(), set()
    for text in texts:
        plain = [slow_plain(w) for w in text.split()]
        for k, word in enumerate(plain):
            everywhere.update([f"L1 {word}", f"R1 {word}", f"L2 {' '.join(plain[max(0, k - 1) : k + 1])}"])
    for value, _, _, contexts in (c for row in found for c in row):
        standing.update(contexts)
        edges.update((p, value) for p in contexts)
    kind = {v: slow_kind(v) for _, v in edges}
    seeds = Counter((p, kind[v]) for p, v in edges if kind[v])
    named = {p for (p, _), n in seeds.items() if n >= 5 and standing[p] >= 0.5 * everywhere[p]}
    values = {p: {v for q, v in edges if q == p} for p in named}
    score = {(v, k): float(kind[v] == k) for p in named for v in values[p] for k in BASE}
    for _ in range(3):
        trust = {}
        for p in named:
            known = [v for v in values[p] if kind[v]]
            for k in BASE if len(known) >= 5 else ():
                mean = sum(score[v, k] for v in values[p]) / len(values[p])
                share = sum(kind[v] == k for v in known) / len(known)
                trust[p, k] = max(mean, share) * len(known) / (len(known) + 1)
        for v, k in score:
            if not kind[v]:
                miss = 1.0
                for p in named:
                    if v in values[p] and (p, k) in trust:
                        miss *= 1 - min(trust[p, k], 0.999)
                score[v, k] = 1 - miss
    best = {}
    for (v, k), s in score.items():
        if not kind[v] and s >= 0.9 and slow_shaped(k, v):
            best[v] = max(best.get(v, (0, "")), (s, k))
    return [sorted((best[v][1], a, b) for v, a, b, _ in row if v in best) for row in found]


def test_discoveries_are_brute_force(spark):
    rng = random.Random(15)
    filler = ["the", "house", "of", "stones", "was", "built", "near", "rivers", "and", "fields"]

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card(ok):
        while luhn(value := digits(16)) != ok:
            pass
        return value

    makers = {
        "pay by card number": lambda ok: card(ok),
        "phone us at": lambda ok: f"+44 20 {digits(7)}" if ok else f"0{digits(9)}",
        "write to address": lambda ok: f"{rng.choice(filler)}{digits(2)}@{'mail.example.org' if ok else 'intranet'}",
        "hosted on server": lambda ok: ".".join(str(rng.randint(1, 250)) for _ in range(4)) if ok else f"{digits(2)}.999.3.{digits(2)}",
    }
    texts, planted, other = [], [], 0
    for k in range(400):
        words = [rng.choice(filler) for _ in range(rng.randint(3, 9))]
        lead, make = rng.choice(list(makers.items()))
        ok = rng.random() < 0.8
        if k % 4 == 3:
            # Numbers of no kind in running text, and lead words without an identifier.
            texts.append(" ".join([*words, card(False), *words, lead.split()[0], "nothing", digits(6) + "."]))
            other += 2
            continue
        value = make(ok)
        start = len(" ".join([*words, lead])) + 1
        texts.append(" ".join([*words, lead, value]) + ", " + " ".join(words))
        if not ok:
            planted.append((k, start, start + len(value)))
    rows = {r["doc_id"]: r for r in pii_bootstrap.find(documents(spark, list(enumerate(texts)))).collect()}
    more = slow_discoveries(texts)
    order = list(BASE)
    for k, text in enumerate(texts):
        want = sorted({*base(text), *more[k]}, key=lambda s: (order.index(s[0]), *s[1:]))
        assert spans(rows[k]["spans"]) == want
    added = {(k, a, b) for k in rows for _, a, b in set(spans(rows[k]["spans"])) - set(base(texts[k]))}
    hits = added & set(planted)
    assert other == 200 and len(planted) > 40
    assert len(hits) >= 0.9 * len(planted) and len(hits) >= 0.95 * len(added)


def test_context_words_are_whole_however_far(spark):
    """The words beside a candidate, with long words and long gaps between them."""
    long = "w" * 500
    texts = [f"{long} call\n\n{' ' * 300}+49 30 123456 {' ' * 200}{long} now", "alone@example.org", f"one {long}@example.org, two"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r["c"] for r in frame.select(pii_bootstrap.candidates(frame["text"]).alias("c")).collect()]
    (first,), (second,), (third,) = found
    assert (first["left1"], first["left2"], first["right1"]) == ("call", f"{long} call", long)
    assert (second["left1"], second["left2"], second["right1"]) == ("", "", "")
    assert (third["left1"], third["left2"], third["right1"]) == ("one", "one", "two")
