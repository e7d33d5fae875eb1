import re
from collections import Counter

import numpy as np
import pytest

from braidwork.llm import licences, urlfilter


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, False, None, "allow")
    return host, path, best[2], best[3]


URLS = [
    "https://www.Example.ORG/en/19", "http://a.example.org/es/", "https://example.org", "https://example.org/", "http://x.com/fr/1?a=/de/", "http://X.com/de/#y", "com/de/", None, "", "://", "http:///de/",
    "http://example.org:80/es/", "http://notexample.org/es/x", "ftp://com/fr/\n", "http://www.example.org/en/2", "http://www.example.org/es/", "https://a.b.c.d.e.f.org/x",
]


def test_rules(spark):
    rows = [(i % 15, u, "extra") for i, u in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    rules = [*urlfilter.RULES, urlfilter.RULES[0]]
    got = urlfilter.judge_urls(pages, urlfilter.rule_table(spark, rules)).collect()
    assert Counter(map(tuple, got)) == Counter((i, *judged(u, rules)) for i, u, _ in rows)
    none = urlfilter.judge_urls(pages, urlfilter.rule_table(spark, rules).limit(0), "block").collect()
    assert {r.verdict for r in none} == {"block"} and len(none) == len(rows)
    assert urlfilter.judge_urls(pages.limit(0), urlfilter.rule_table(spark, rules)).count() == 0


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark)


def test_licence_families(spark, model):
    rows = [
        (1, "Some text here.\nReleased under the MIT License.\nMore."), (2, "Licensed under CC BY-NC 4.0."), (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "x\n\nLicensed under the Apache License, Version 2.0."), (5, "He is at MIT and reads about the general public."), (6, None), (7, ""), (8, " \n "),
        (9, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."), (1, "plain"), (None, "Released under the MIT License."), (10, "erthe onan thst " * 5000),
    ]
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()
    verdicts = Counter((r.doc_id, r.verdict) for r in got)
    assert verdicts == Counter([(1, "mit"), (2, "cc-by-nc"), (3, "gpl"), (4, "apache"), (5, "none"), (6, "none"), (7, "none"), (8, "none"), (9, "several"), (1, "none"), (None, "mit"), (10, "none")])
    assert licences.scan_licences(spark.createDataFrame([], "doc_id long, text string"), model=model).count() == 0


def test_held_out_phrasings_names_and_sentences(model):
    """What training never saw: whole phrasings, whole names, whole sentences."""
    assert set(model.recall) == {"phrasing", "name", "sentence"} and min(model.recall.values()) >= 0.9
    assert model.precision >= 0.95 and model.coverage >= 0.99 and model.threshold < 1


def test_lines_that_no_training_row_has(spark, model):
    lines = {
        "under GPLv2 only": "gpl", "This software is provided under the Mozilla licence": "mpl", "Le texte est sous licence CC BY-SA 4.0": "cc-by", "Apache 2": "apache", "Boost Software License - Version 1.0": "unknown",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.": "unknown", "driving license renewed": "none",
        "My fishing license was issued under the terms of the state": "none", "SPDX-License-Identifier: LGPL-2.1-or-later": "gpl", "The medical license of the surgeon was suspended in 2012.": "none",
    }
    trained = {r.text for r in licences.labelled_rows(spark).where("new is null").collect()}
    assert not trained & set(lines)
    got = licences.scan_licences(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), model=model).collect()
    assert {list(lines)[r.doc_id]: r.verdict for r in got} == lines


def test_unknown_licences_and_short_notices(spark, model):
    lines = {
        "All rights reserved.": "proprietary", "Licensed under the ISC License": "unknown", "released under the EUPL 1.2": "unknown", "GNU Affero General Public License v3": "gpl",
        "Code is MIT licensed": "mit", "Dual licensed under MIT or Apache-2.0": "several", "Available under the Creative Commons Attribution license": "cc-by", "MPL 2.0": "mpl",
        "They crossed under the bridge and reserved all seats.": "none", "The text of the book is in the house.": "none",
    }
    rows = [(i, f"Some words before.\n{x}") for i, x in enumerate(lines)]
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()
    assert {rows[r.doc_id][1].split("\n")[1]: r.verdict for r in got} == lines


def plain_words(text):
    folded = re.sub("(?<=[a-z])v?(?=[0-9])", " ", text.lower().replace("licenc", "licens"))
    return [w for w in re.split(r"[^\w+]+|_+", folded) if w]


def plain_grams(w, n):
    return [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]


def judge(model, weights, line):
    """Family and confirmed families of a line, from the model's weights alone."""
    w = plain_words(line)
    if not set(w) & set(model.content):
        return "none", []
    vocabulary, matrix, intercept = weights
    has = {g for n in (1, 2, 3) for g in plain_grams(w, n)}
    x = np.array([v in has for v in vocabulary], float)
    z = matrix @ x + intercept
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    family = model.families[int(p.argmax())]
    sure = []
    for f, templates in licences.TEMPLATES.items():
        share = 0
        for t in templates:
            n = min(3, len(t.split()))
            grams = set(plain_grams(t.split(), n))
            share = max(share, len(grams & set(plain_grams(w, n))) / len(grams))
        chance = p[model.families.index(f)]
        if share >= 0.75 and (family == f and chance >= model.threshold or family != "none" and chance >= licences.SECOND):
            sure.append(f)
    return family, [f for f in sure if f != "cc-by" or "cc-by-nc" not in sure]


def test_scan_equals_brute_force(spark, model):
    labelled = licences.labelled_rows(spark).collect()
    rows = [(i, "\n".join(["plain words stand here", *(r.text for r in labelled[i : i + 9])])) for i in range(0, len(labelled), 9)]
    rows += [(i, t) for i, t in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()]
    want = Counter()
    weights = model.vectors.vocabulary, model.model.coefficientMatrix.toArray(), model.model.interceptVector.toArray()
    for i, text in rows:
        found = [judge(model, weights, x) for x in (text or "").split("\n") if x.strip(" ")]
        families = sorted({f for _, sure in found for f in sure})
        unknown = sum(family != "none" and not sure for family, sure in found)
        verdict = families[0] if len(families) == 1 else "several" if families else "unknown" if unknown else "none"
        want[(i, len(found), sum(bool(sure) for _, sure in found), unknown, tuple(families), verdict)] += 1
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()
    assert Counter((r.doc_id, r.n_paragraphs, r.n_confirmed, r.n_unknown, tuple(r.families), r.verdict) for r in got) == want


def test_scan_on_the_corpus(docs, rows, model):
    got = {r.doc_id: r for r in licences.scan_licences(docs, model=model).collect()}
    assert got[68].families == ["mit"] and got[20].verdict == "none"
