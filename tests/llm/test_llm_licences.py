"""The licence scan row by row against plain loops, near the least coefficient too."""

import random
import re

import pytest

from netpulse.llm import licences


def grams(words):
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def plain(text, least):
    """(license, dice, n_matches, licenses) of one text."""
    kept = re.sub(r"[^a-z0-9\n]+", " ", (text or "").lower())
    units = {" ".join(u.split()) for u in [*kept.split("\n"), *(b.replace("\n", " ") for b in re.split(r"\n[ ]*\n", kept))]}
    templates = {name: grams(licences._plain(t)) for name, t in licences.TEMPLATES.items()}
    best, names, n = None, set(), 0
    for unit in units:
        own = grams(unit.split())
        found = [(-2.0 * len(own & t) / (len(own) + len(t)), name) for name, t in templates.items() if own]
        found = [f for f in found if f[0] <= -least]
        n += bool(found)
        names |= {name for _, name in found}
        best = min([*found, *([best] if best else [])], default=None)
    return (best[1] if best else None, -best[0] if best else None, n, ",".join(sorted(names)))


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_scan_equals_a_plain_version(spark, least):
    """Notices with words lost, added and swapped, on one line, over two, and between other words."""
    rng = random.Random(8)
    texts = [None, "", "\n\n", "license", "the license the license"]
    for _ in range(500):
        words = rng.choice(list(licences.TEMPLATES.values())).split()
        for _ in range(rng.randint(0, 1 + len(words) // 4)):
            i = rng.randrange(len(words))
            words[i : i + rng.randint(0, 1)] = rng.choice([[], ["other"], ["the", "License"]])
            words = words or ["x"]
        i = rng.randrange(len(words))
        text = " ".join(words[:i]) + rng.choice([" ", "\n", " -- ", "\n \n"]) + " ".join(words[i:])
        texts.append(rng.choice(["", "Some words before.\n", "Title\n\n"]) + text + rng.choice(["", "\nand after", "\n\nmore"]))
    rows = [(i // 2, t, "n") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, units string")
    found = sorted((tuple(r) for r in licences.license_scan(docs, least=least).collect()), key=str)
    expected = sorted(((i, *plain(t, least)) for i, t, _ in rows), key=str)
    assert [f[:2] + f[3:] for f in found] == [e[:2] + e[3:] for e in expected]
    assert all(a[2] == b[2] or abs(a[2] - b[2]) < 1e-12 for a, b in zip(found, expected))
    assert sum(e[1] is not None for e in expected) > 100


def test_prefixes_lose_no_match():
    """Any set of bigrams that reaches the coefficient holds one of the prefix."""
    rng = random.Random(2)
    known = licences._templates(licences.TEMPLATES)
    prefix = set(licences._prefixes(known, 0.8))
    for _ in range(20_000):
        t = rng.choice(known)
        shared = rng.sample(t["grams"], rng.randint(0, t["n"]))
        extra = rng.randint(0, t["n"])
        if 2 * len(shared) >= 0.8 * (t["n"] + len(shared) + extra):
            assert prefix & set(shared)
    assert len(prefix) < 0.5 * sum(t["n"] for t in known)


def test_no_templates(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    assert [tuple(r) for r in licences.license_scan(docs, {}).collect()] == [(1, None, None, 0, "")]
