"""Scores of the tree against one of dictionaries, and its growth."""

import math
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postgrove.llm import suffix_tree

END = None


def tokens_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lower), END]


class ByHand:
    """The tree of the module's docstring, one token after the other."""

    def __init__(self, texts, contexts, counts, depth=2, prior=10.0, deviations=3.0):
        texts = [tokens_of(text) for text in texts]
        c = Counter(t for tokens in texts for t in tokens)
        self.total = sum(c.values())
        below = self.total + 0.1 * (len(c) + 1)
        self.p = lambda token: (c[token] + 0.1) / below
        least, head = math.sqrt(self.total) / contexts, math.sqrt(self.total) / counts
        self.context_words = {w for w, n in c.items() if w is not END and n >= least}
        self.head = {w for w, n in c.items() if w is END or n >= head}
        self.kept = {}
        for length in range(1, depth + 1):
            after = {}
            for tokens in texts:
                for i in range(length, len(tokens)):
                    before = tuple(tokens[i - length : i])
                    if self.context_words.issuperset(before):
                        after.setdefault(before, Counter())[tokens[i]] += 1
            grown = {}
            for before, found in after.items():
                total = sum(found.values())
                own = {w: n for w, n in found.items() if w in self.head and n >= head}
                if total < least or not own:
                    continue
                expected = {w: self.p(w) * self.gain(before[1:], w) for w in own}
                left, left_expected = total - sum(own.values()), max(1 - sum(expected.values()), 1e-9)
                ratio = 2 * sum(n * math.log(n / (total * expected[w])) for w, n in own.items())
                ratio += 2 * left * math.log(left / (total * left_expected)) if left else 0
                if ratio > len(own) + deviations * math.sqrt(2 * len(own)):
                    gains = {w: (n + prior * expected[w]) / (total + prior) / self.p(w) for w, n in own.items()}
                    share = (left + prior - prior * sum(expected.values())) / (total + prior)
                    grown[before] = gains, max(share, 1e-12) / left_expected
            self.kept |= grown

    def gain(self, before, token):
        """How much likelier a token is after its longest kept suffix than by itself."""
        value = 1.0
        for length in range(1, len(before) + 1):
            if before[-length:] in self.kept:
                gains, rest = self.kept[before[-length:]]
                value = gains.get(token, rest * value)
        return value

    def score(self, text, depth=2):
        tokens = tokens_of(text)
        return sum(
            math.log10(self.p(t) * self.gain(tuple(tokens[max(0, i - depth) : i]), t)) for i, t in enumerate(tokens)
        )


@pytest.mark.parametrize("contexts, counts", [(8.0, 64.0), (2.0, 4.0)])
def test_scores_equal_a_tree_of_dictionaries(spark, sf_dir, contexts, counts):
    documents = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    learnt = [x for x in documents if zlib.crc32(str(x["doc_id"]).encode()) % 10]
    tree = ByHand([x["text"] for x in learnt], contexts, counts)
    assert any(len(before) == 2 for before in tree.kept)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    training = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    rows = suffix_tree.scores(docs, training, contexts=contexts, counts=counts).collect()
    got = {row["doc_id"]: row["score"] for row in rows}
    for x in documents:
        assert got[x["doc_id"]] == pytest.approx(tree.score(x["text"]), rel=1e-9, abs=1e-6)


def test_the_tree_grows_with_the_corpus(sf_dir):
    """Four times the corpus keeps more contexts, and none that was seen less often than the rule says."""
    texts = [x["text"] for x in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()]
    small, large = ByHand(texts[:60], 8.0, 64.0), ByHand(texts[:240], 8.0, 64.0)
    assert len(large.kept) > 1.3 * len(small.kept)


@pytest.mark.parametrize("bucket", [suffix_tree.BUCKET, 250])
def test_no_context_is_too_rare(spark, sf_dir, monkeypatch, bucket):
    """Contexts and followers seen once count too, also where words fill more than a bucket."""
    monkeypatch.setattr(suffix_tree, "BUCKET", bucket)
    documents = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    held_out = {x["doc_id"]: zlib.crc32(str(x["doc_id"]).encode()) % 10 == 0 for x in documents}
    tree = ByHand([x["text"] for x in documents if not held_out[x["doc_id"]]], math.inf, math.inf)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learnt = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    for training in (learnt, docs.where(learnt)):
        got = {row["doc_id"]: row["score"] for row in suffix_tree.scores(docs, training).collect()}
        assert len(got) == len(documents)
        for x in documents:
            assert got[x["doc_id"]] == pytest.approx(tree.score(x["text"]), rel=1e-9, abs=1e-6)


@pytest.mark.parametrize("depth", [1, 3])
def test_other_depths_in_small_buckets(spark, monkeypatch, depth):
    monkeypatch.setattr(suffix_tree, "BUCKET", 8)
    texts = ["a b a b c a b a b c", "a a a a a a b", "c", "", "a b c d e a b c d e A B", "x a b c", "a b a b c a b a b c"]
    texts = [(i, x) for i, x in enumerate(texts * 3)]
    docs = spark.createDataFrame([*texts, (None, None), (3, "a b c q")], "doc_id int, text string").repartition(3)
    learnt = [x["text"] for x in docs.where("doc_id % 4 > 0").collect()]
    tree = ByHand(learnt, math.inf, math.inf, depth)
    assert any(len(before) == depth for before in tree.kept)
    rows = suffix_tree.scores(docs.withColumnRenamed("text", "t"), F.expr("doc_id % 4 > 0"), text="t", depth=depth).collect()
    want = sorted(round(tree.score(x["text"], depth), 6) for x in docs.collect())
    assert sorted(round(row["score"], 6) for row in rows) == want
