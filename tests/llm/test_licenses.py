"""Licence scans: base phrases against a plain search, templates on notices and near misses."""

import random

import re

from strandline.llm import licenses

LONG = " ".join(f"w{k}" for k in range(30_000))
TEXTS = [
    None, "", "nothing here", "All Rights Reserved.", "CC-BY and cc by, all rights reserved", "cc cc by by", "GNU General\nPublic License, version 3", "Licensed under the Apache License, Version 2.0",
    "the apache license and other things, version one", "Released under the MIT License.\n" + LONG, LONG + " all rights reserved", "école cc by", "all rights, reserved all rights",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided when the following conditions are met", "cc by " * 50,
    "mit license released the under", "Released under the MIT License",
]


def base(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    starts, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        parts = phrase.split()
        found = [k for k in range(len(words) - len(parts) + 1) if words[k : k + len(parts)] == parts]
        starts += found
        labels |= {label} if found else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_report(spark):
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)], "doc_id bigint, text string, score string").repartition(3)
    rows = {r["doc_id"]: r for r in licenses.license_report(df).collect()}
    for k, text in enumerate(TEXTS):
        r = rows[k]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    labels = {k: r["labels"] for k, r in rows.items()}
    assert labels[7] == "apache-2.0" and labels[8] == "" and labels[9] == "mit" and labels[6] == "gpl" and labels[13] == "bsd" and labels[15] == "" and labels[16] == "mit"
    assert 0.75 <= rows[13]["score"] < 1 and rows[7]["score"] == 1 and rows[0]["score"] == 0


def test_every_template_finds_itself():
    scanner = licenses.Scanner({})
    for label, notice, _ in licenses.TEMPLATES:
        assert label in scanner.scan(f"before {notice} after")[5].split(",")


def test_document_frequencies(spark):
    df = spark.createDataFrame([(t,) for t in ("license license", "the license", None, "other")], "text string")
    idf = licenses.document_frequencies(df)
    assert round(idf[b"license"], 6) == round(__import__("math").log(5 / 3), 6) and idf[b"apache"] > idf[b"the"] > idf[b"license"]


def test_empty_table(spark):
    assert licenses.license_report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def brute_force(scanner, words):
    """Labels of all templates that are aligned with any stretch of the file."""
    out = set()
    for template in scanner.templates:
        size = len(template.words)
        for start in range(0, max(1, len(words) - size // 2)):
            stretch = words[start : start + size + licenses.DRIFT]
            table = [[0] * (len(stretch) + 1) for _ in range(size + 1)]
            for i, a in enumerate(template.words):
                for j, b in enumerate(stretch):
                    table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
            assert licenses.aligned(template.words, stretch) == table[-1][-1]
            if table[-1][-1] / size >= licenses.LEAST_MATCH and all(licenses.stands(p, stretch) for p in template.phrases):
                out.add(template.label)
                break
    return out


def test_notices_with_words_put_in_and_left_out():
    rnd = random.Random(5)
    scanner = licenses.Scanner({w: 1.0 + len(w) for w in licenses.Scanner({}).vocabulary})
    found = wanted = 0
    for label, notice, _ in licenses.TEMPLATES[:12] * 3:
        words = licenses.words_of(notice)
        for _ in range(rnd.randint(0, 5)):
            if rnd.random() < 0.5:
                words.insert(rnd.randrange(len(words) + 1), b"extra")
            elif len(words) > 8:
                del words[rnd.randrange(len(words))]
        text = [rnd.choice([b"lorem", b"free", b"software", b"under", b"the"]) for _ in range(20)] + words + [b"rest"] * 5
        want = brute_force(scanner, text)
        got = set(filter(None, scanner.scan(b" ".join(text).decode())[5].split(",")))
        found, wanted = found + len(got & want), wanted + len(want)
        assert got - want <= set(licenses.BASE.values())
    assert wanted > 20 and found >= 0.9 * wanted


def test_whole_licences_and_ties():
    scanner = licenses.Scanner({})  # all words have one IDF
    for label, notice, _ in licenses.TEMPLATES:
        labels, score = scanner.scan("before it\n" + notice.replace(" ", "\n", 3) + "\nafter it")[5:]
        assert label in labels.split(",") and score == 1.0
