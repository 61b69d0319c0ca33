"""Phrases against plain counting, with limits so small that every container bursts and spills."""

import re
from collections import Counter

import numpy as np
import pytest

from postgrove.llm import collocations
from postgrove.llm.collocations import Container, HatTrie

SMALL = [
    ("a b c d e f. a b c d e f, a b c", "en"),
    ("A B c d e f\na\tb c d e g! a b x a b x a b", "en"),
    ("new york new york; new york city: new york city", "en"),
    ("new york", None),
    ("new york. new york city", "und"),
    ("x x x x x x x x", "fr"),
    ("x y x y x y x y x y x y", "fr"),
    ("été é été é été é", "fr"),
    ("same same. same same. other other. other other", "de"),
    ("", "de"),
    (None, "de"),
    (" .,; ", None),
]


def counted(rows, least, longest, best, cover=100):
    """What the docstring says, phrase by phrase."""
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = {key: n for key, n in f.items() if n >= least and len(key[1]) > 1}
    held = set()
    for (lang, longer), n in found.items():
        for size in range(2, len(longer)):
            for i in range(len(longer) - size + 1):
                part = lang, longer[i : i + size]
                if 100 * n >= cover * f[part]:
                    held.add(part)
    rows = []
    for (lang, phrase), a in found.items():
        if (lang, phrase) in held:
            continue
        cuts = [
            (1000 * a * total[lang] // (f[lang, phrase[:k]] * f[lang, phrase[k:]]), k, f[lang, phrase[:k]], f[lang, phrase[k:]])
            for k in range(1, len(phrase))
        ]
        score, _, left, right = min(cuts)
        rows.append((lang, " ".join(phrase), a, left, right, total[lang], score))
    result = []
    for lang in {row[0] for row in rows}:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        result += [(lang, i, *row[1:]) for i, row in enumerate(own[:best], 1)]
    return sorted(result)


@pytest.mark.parametrize(
    "best, cover, limits",
    [(2, 100, {}), (1000, 60, {"burst": 3, "full": 5}),
     (1000, 100, {"burst": 1, "full": 2, "most_words": 6, "most_nodes": 8})],
)
def test_equals_plain_counting(spark, limits, best, cover):
    docs = spark.createDataFrame(SMALL * 3, "text string, lang string").repartition(3)
    got = collocations.collocations(docs, least=6, best=best, cover=cover, **limits)
    assert sorted(map(tuple, got.collect())) == counted(SMALL * 3, 6, 5, best, cover)


def test_awkward_rows(spark, awkward):
    rows = [(row["text"], row["lang"]) for row in awkward.select("text", "lang").collect()]
    got = collocations.collocations(awkward, least=2, best=50)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == counted(rows, 2, 5, 50)


def test_nothing_frequent_and_nothing_at_all(awkward, nothing):
    assert collocations.collocations(nothing).collect() == []
    assert collocations.collocations(awkward, least=10**6).collect() == []


def test_counts_beyond_64_bits(spark):
    """The product of a score's counts passes 64 bits."""
    big = 3_000_000_000
    row = spark.range(1).selectExpr(f"{big}L as n", f"array({big}L) as left", f"array({big + 1}L) as right")
    from pyspark.sql import functions as F

    total = 10**14 + 7
    assert row.select(collocations._score(F.lit(total))).head()[0]["score"] == 1000 * big * total // (big * (big + 1))


@pytest.mark.parametrize("burst, full", [(1, 2), (4, 40), (1 << 16, 1 << 21)])
def test_trie_counts_and_spills_runs(burst, full):
    draw = np.random.default_rng(5)
    trie, seen, runs = HatTrie(100, burst, full), Counter(), []
    for _ in range(30):
        codes = draw.integers(0, 6, 50) * 100 + draw.integers(0, 40, 50)
        seen.update(codes.tolist())
        trie.add(codes)
        runs += trie.spill()
        assert sum(x.size for x in trie.containers) <= full
        assert all(x.size <= burst for x in trie.containers)
    runs += trie.spill(everything=True)
    found = Counter()
    for codes, n in runs:
        assert (np.diff(codes) > 0).all()
        found.update(dict(zip(codes.tolist(), n.tolist())))
    assert found == seen
    assert (np.diff(trie.lowest) > 0).all()


def test_container_grows():
    table = Container(4)
    for _ in range(3):
        table.add(np.arange(1000) * 977, np.ones(1000, np.int64))
    keys, counts = table.items()
    assert keys.tolist() == [977 * i for i in range(1000)] and (counts == 3).all()
