"""The learnt lexicon against plain Python."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from postgrove.operators import lexicon
from postgrove.operators.sentiment import with_polarity

SEEDS = {"good": 0.5, "bad": -0.75, "unseen": 1.0}


def made_texts():
    draw = random.Random(6)
    for i in range(60):
        side = ["good", "sunny", "warm"] if i % 2 else ["bad", "stormy", "cold"]
        yield " ".join(draw.choices(side + ["the", "day", "was"], k=12)) + (" Good." if i % 4 == 1 else " bad!")
    yield from (None, "", "the", "Été été ÉTÉ it's good")


def by_hand(texts, rounds, window, least_words, least_pairs):
    split = [[w for w in re.split(r"[^\w']+|[\d_]+", (t or "").lower()) if w] for t in texts]
    often = Counter(w for words in split for w in words)
    pairs = Counter()
    for words in split:
        for i, one in enumerate(words):
            for two in words[i + 1 : i + 1 + window]:
                if one != two and min(often[one], often[two]) >= least_words:
                    pairs[one, two] += 1
                    pairs[two, one] += 1
    size, total = Counter(), sum(pairs.values())
    for (one, _), n in pairs.items():
        size[one] += n
    links = {}
    for (one, two), n in pairs.items():
        weight = math.floor(1000 * math.log(n * total / (size[one] * size[two])))
        if n >= least_pairs and weight > 0:
            links.setdefault(one, {})[two] = weight
    seeds = {w: round(v * 10**6) for w, v in SEEDS.items()}
    known = dict(seeds)
    for _ in range(rounds):
        new = dict(seeds)
        for one, near in links.items():
            value = sum(w * known.get(two, 0) for two, w in near.items())
            mean = int(math.copysign(abs(value) // sum(near.values()), value))
            if one not in seeds and mean:
                new[one] = mean
        known = new
    return {w: v / 10**6 for w, v in known.items()}


@pytest.mark.parametrize("rounds, window, most", [(1, 5, 10**6), (3, 2, 10**6), (3, 2, 0)])
def test_equals_plain_python(spark, monkeypatch, rounds, window, most):
    monkeypatch.setattr(lexicon, "MAX_BROADCAST_WORDS", most)
    texts = list(made_texts())
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = lexicon.learn_lexicon(df, SEEDS, rounds=rounds, window=window, least_words=3, least_pairs=2)
    found = {row.word: row.polarity for row in got.collect()}
    assert found == by_hand(texts, rounds, window, 3, 2)
    assert found["good"] == 0.5 and found["sunny"] > 0 > found["stormy"]
    if rounds == 3 and most:
        scored = with_polarity(spark.createDataFrame([("a sunny day",)], "text string"), "text", "p", got)
        assert scored.head().p > 0


def test_without_texts_the_seeds_remain(spark):
    df = spark.createDataFrame([], "text string")
    assert {r.word: r.polarity for r in lexicon.learn_lexicon(df, SEEDS).collect()} == SEEDS


@pytest.mark.parametrize("held", [0, 3])
def test_pairs_sent_early_are_still_added_up(spark, monkeypatch, held):
    monkeypatch.setattr(lexicon, "HELD_PAIRS", held)
    texts = list(made_texts())
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = lexicon.learn_lexicon(df, SEEDS, rounds=2, window=2, least_words=3, least_pairs=2)
    assert {row.word: row.polarity for row in got.collect()} == by_hand(texts, 2, 2, 3, 2)


def test_a_task_sends_a_pair_of_many_texts_once():
    shared = type("Shared", (), {"value": ["a", "b", "c"]})
    batches = [pa.record_batch([pa.array(["b a", "x c b", None, "a B"])], names=["text"]) for _ in range(3)]
    sent = [batch.to_pydict() for batch in lexicon._known_pair_counter(shared, 2, 100)(iter(batches))]
    assert sent == [{"pair": [1, 5], "n": [6, 3]}]
