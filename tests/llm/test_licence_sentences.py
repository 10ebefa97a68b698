"""Every known sentence, every rule, and time in proportion to the text."""

import random
import re
import time

import pytest

from gablestone.llm import licenses


def spelt(pattern: str, rng: random.Random) -> str:
    """A text that a pattern stands for: optional parts are in or out, free parts have a word or two."""
    out = pattern
    while m := re.search(r"\(\?:([^()]*(?:\\\([^()]*\\\)[^()]*)*)\)(\??)", out):
        chosen = rng.choice(m[1].split("|")) if not m[2] or rng.random() < 0.5 else ""
        out = out[: m.start()] + chosen + out[m.end() :]
    out = re.sub(r"\[(.)(.)\](\??)", lambda m: rng.choice([m[1], m[2]]) if not m[3] else rng.choice([m[1], m[2], ""]), out)
    out = re.sub(r"(\\?.)\?", lambda m: rng.choice([m[1], ""]), out)
    out = out.replace(r"\d{4}", "1999").replace(r"\d", "3").replace(".*", "acme corp")
    return re.sub(r"\\(.)", r"\1", out).strip()


@pytest.mark.parametrize("name, pattern", licenses.SENTENCES, ids=[n for n, _ in licenses.SENTENCES])
def test_each_sentence_is_known(name, pattern):
    rng = random.Random(name)
    for _ in range(12):
        text = spelt(pattern, rng)
        words = text.split(" ")
        for width in (10**6, 60, 24):  # wrapped or not
            lines, line = [], ""
            for w in words:
                if line and len(line) + len(w) >= width:
                    lines.append(line)
                    line = ""
                line = f"{line} {w}".strip()
            got = [k for _, k in licenses.Scanner().sequence("\n".join([*lines, line]))]
            assert name in got, (text, width, got)


def test_every_rule_is_reached():
    for licence, names in licenses.RULES:
        found, rest = licenses.Scanner().match([(i, n) for i, n in enumerate(names)])
        assert found == [licence] and rest == [], licence


@pytest.mark.parametrize("text, licences", [
    ("// SPDX-License-Identifier: MIT\nint main;", ["MIT"]), ("# SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]), ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
    ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]), ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which is here", ["EPL-2.0"]), ("SPDX-License-Identifier: NotOne", []),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS.", ["ISC"]),
])
def test_short_notices(text, licences):
    scanner = licenses.Scanner()
    assert scanner.match(scanner.sequence(text))[0] == licences


@pytest.mark.parametrize("line", ["neither the name of acme", "licensed under foo bar", "neither the name of a nor the names of b", "copyright 1999 x", "permission is hereby granted, free of charge, to any person or organization obtaining a copy", "dedicated to the public domain"])
def test_time_grows_with_the_text(line):
    n = 5_000_000 // (len(line) + 1)
    text = "\n".join([*[f"{line} {i % 97}" for i in range(n)], "all rights reserved"])
    began = time.time()
    assert licenses.Scanner().sequence(text)[-1][1] == "all-rights"
    assert time.time() - began < 60


def test_a_repeated_sentence_is_looked_up():
    scanner = licenses.Scanner()
    text = "Licensed under the Apache License, Version 2.0."
    first = scanner.sequence(text)
    scanner.identify = None  # nothing is searched again
    assert scanner.sequence(f"{text}\n\n{text}") == [(0, "apache2-under"), (1, "apache2-under")] and first == [(0, "apache2-under")]
