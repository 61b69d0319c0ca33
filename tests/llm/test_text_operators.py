"""Operators on texts against plain Python, and on awkward tables."""

import collections
import functools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postgrove.llm import language_vectors, lengths, minhash, mixing, quality_rules, suffix_tree
from postgrove.llm.words import Words, lowered, mixed, slices

WORD = re.compile("[^\x20\x09-\x0d]+")


def small(text):
    return re.sub("[A-Z]", lambda x: x[0].lower(), text or "")


@pytest.fixture(scope="module")
def documents(sf_dir):
    return pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


def test_words_are_cut_and_hashed_alike_wherever_they_stand():
    import pyarrow as pa

    texts = ["a bb\tccc", None, "", "ccc", "\n a", "é bb ", "bb" * 5000 + " a"]
    found = []
    for first, last, raw, offsets in slices(pa.array(texts), 16):
        words = Words(lowered(raw), offsets)
        hashes = words.hashes()
        for i in range(last - first):
            found.append(hashes[words.bounds[i] : words.bounds[i + 1]].tolist())
    assert [len(x) for x in found] == [len(WORD.findall(x or "")) for x in texts]
    assert found[0][2] == found[3][0] and found[0][0] == found[4][0] == found[6][1]
    assert found[0][1] == found[5][1] and len({h for own in found for h in own}) == 5


def base_of(text):
    words = WORD.findall(text or "")
    runs = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if runs[tuple(words[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(hit),
        len(words) < 10 or 100 * len(hit) > 20 * len(words),
    )


def test_quality_rules_equal_plain_python(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = by_id(quality_rules.quality_rules(docs, labels))
    good = {row["doc_id"] for row in labels.collect()}

    def runs(text):
        stream = b" ".join(x.encode() for x in WORD.findall(text or ""))
        # A text's first word has a space before it where the text has one.
        stream = b" " + stream if text and text[0] in " \t\n\v\f\r" and stream else stream
        return [bucket(stream[i : i + 3]) for i in range(len(stream) - 2)]

    @functools.cache
    def bucket(run):
        code = np.array([int.from_bytes(run, "big")], np.uint64)
        return int(mixed(code)[0] % np.uint64(quality_rules.BUCKETS))

    raw, trusted = collections.Counter(), collections.Counter()
    for doc in documents:
        own = runs(doc["text"])
        raw.update(own)
        if doc["doc_id"] in good:
            trusted.update(own)
    size = quality_rules.BUCKETS
    n_raw, n_trusted = sum(raw.values()) + size, sum(trusted.values()) + size
    for doc in documents:
        row = got[doc["doc_id"]]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert tuple(row[x] for x in names) == base_of(doc["text"])
        own = runs(doc["text"])
        ratio = [math.log((trusted[x] + 1) / n_trusted) - math.log((raw[x] + 1) / n_raw) for x in own]
        assert row["score"] == pytest.approx(np.mean(ratio) if ratio else 0, abs=1e-9)
        assert row["kept"] == (not row["base_failed"] and row["score"] >= quality_rules.THRESHOLD)


def test_quality_rules_part_labelled_texts(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = quality_rules.quality_rules(docs, labels.where("quality = 1")).join(labels, "doc_id").collect()
    assert all(row["kept"] for row in rows if row["quality"] == 1 and not row["base_failed"])
    bad = [row["kept"] for row in rows if row["quality"] == 0]
    assert sum(bad) <= 0.05 * len(bad)


def test_quality_rules_on_awkward_rows(awkward, nothing):
    ids = awkward.select("doc_id")
    rows = quality_rules.quality_rules(awkward, ids).collect()
    assert len(rows) == awkward.count()
    got = {row["doc_id"]: row for row in rows}
    assert got[1]["n_words"] == got[2]["n_words"] == got[3]["n_words"] == 0
    assert got[1]["base_failed"] and not got[1]["kept"]
    assert got[6]["n_words"] == 60_000 and got[6]["base_failed"]
    assert quality_rules.quality_rules(nothing, ids).collect() == []
    without = quality_rules.quality_rules(awkward, ids.where("false")).collect()
    assert {row["score"] for row in without} == {0.0}


def test_mixing_on_awkward_rows(awkward, nothing):
    rows = mixing.mix_plan(awkward).collect()
    assert len(rows) == awkward.count()
    assert mixing.mix_plan(nothing).collect() == [] == mixing.mixed_documents(nothing).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_plan(awkward).collect()))
    sizes = {row["doc_id"]: row["size"] for row in rows}
    assert sizes[1] == sizes[2] == sizes[3] == 0 and sizes[6] == 60_000
    assert all(row["target"] <= 2 * row["source_size"] and row["taken"] <= 2 * row["size"] for row in rows)
    of_null = [row for row in rows if row["doc_id"] == 3]
    assert of_null[0]["source_size"] == 0 and of_null[0]["taken"] == 0
    mixed = mixing.mixed_documents(awkward)
    assert mixed.columns == awkward.columns
    assert mixed.count() == sum(row["copies"] for row in rows)


def test_mixing_fills_targets_by_weight(spark):
    names = ["a", "b", "c", "d", None]
    rows = [(i * 10_000 + j, "w " * (1 + j % 7), names[i]) for i in range(5) for j in range(100 + 400 * i)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    plan = mixing.mix_plan(docs).withColumn("source", F.floor(F.col("doc_id") / 10_000)).collect()
    size = collections.Counter()
    for row in plan:
        size[row["source"]] += row["size"]
    total, left, weights = 1.5 * sum(size.values()), set(size), {i: (3, 1, 2)[i % 3] for i in size}
    target = {}
    while True:
        unit = (total - sum(target.values())) / sum(weights[i] for i in left)
        full = {i for i in left if weights[i] * unit >= 2 * size[i]}
        if not full:
            break
        target |= {i: 2.0 * size[i] for i in full}
        left -= full
    target |= {i: weights[i] * unit for i in left}
    taken = collections.Counter()
    for row in plan:
        assert row["source_size"] == size[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]])
        taken[row["source"]] += row["taken"]
    assert all(abs(taken[i] - target[i]) < 0.12 * target[i] for i in size)


def sets_of(text, width):
    words = WORD.findall(small(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def grouped(texts, width, percent=80):
    """Component of each text by comparing all pairs."""
    sets = [sets_of(x, width) for x in texts]
    least = list(range(len(texts)))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))], [len(x) for x in sets]


def test_near_duplicates_of_a_large_group_of_near_copies(spark):
    """Every copy differs from the base elsewhere: about all pairs are near the limit."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(240)]
    texts = []
    for _ in range(250):
        own = list(base)
        for at in rng.choice(len(base), int(rng.integers(0, 9)), replace=False):
            own[at] = f"x{rng.integers(1 << 40)}"
        texts.append(" ".join(own))
    texts += [f"another text of its own with number {i} and {i * 7} in it" for i in range(50)]
    component, sizes = grouped(texts, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    # The group is cut into pieces here as a larger one would be.
    piece, minhash.PIECE = minhash.PIECE, 64
    try:
        got = by_id(minhash.near_duplicates(docs))
    finally:
        minhash.PIECE = piece
    assert [got[i]["component_id"] for i in range(len(texts))] == component
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(got[i]["kept"] == (component[i] == i) for i in range(len(texts)))


def test_near_duplicates_hold_a_few_pieces_of_a_large_bucket_at_once(spark, monkeypatch):
    """Buckets of many texts that share keys with each other and are linked with none."""
    rng = np.random.default_rng(6)
    texts = []
    for i in range(300):
        own = [f"w{j}" for j in range(240)]
        for at in rng.choice(len(own), 8, replace=False):
            own[at] = f"x{i}y{at}"
        texts.append(" ".join(own))
    piece, comparer = 8, minhash._comparer

    def watched(*arguments):
        compare = comparer(*arguments)

        def run(rows):
            if rows.num_rows > 16 * piece:
                raise ValueError(f"{rows.num_rows} rows at once")
            return compare(rows)

        return run

    monkeypatch.setattr(minhash, "PIECE", piece)
    monkeypatch.setattr(minhash, "_comparer", watched)
    component, _ = grouped(texts, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = by_id(minhash.near_duplicates(docs))
    assert [got[i]["component_id"] for i in range(len(texts))] == component


def test_near_duplicates_on_awkward_rows(awkward, nothing):
    rows = minhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    got = {row["doc_id"]: row for row in rows}
    for i in (1, 2, 3):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[4]["n_shingles"] == got[5]["n_shingles"] == 1
    assert got[7]["component_id"] == 6 and not got[7]["kept"]
    assert got[21]["component_id"] == got[22]["component_id"] == 20
    assert got[30]["component_id"] == 30 and got[None]["component_id"] is None and got[None]["kept"]
    assert minhash.near_duplicates(nothing).collect() == []


def test_any_two_signatures_within_the_threshold_share_a_key(spark):
    rng = np.random.default_rng(5)
    choices = minhash._choices(minhash.CHUNKS, minhash.CHUNK, minhash.ERRORS)
    symbols = minhash.CHUNKS * minhash.CHUNK
    threshold = minhash.CHUNKS * (minhash.ERRORS + 1) - 1
    pairs = []
    for _ in range(300):
        one = rng.integers(0, 1 << 16, symbols).astype("<u2")
        two = one.copy()
        two[rng.choice(symbols, threshold, replace=False)] += 1
        pairs.append((bytearray(one.tobytes()), bytearray(two.tobytes())))
    df = spark.createDataFrame(pairs, "a binary, b binary")
    shared = F.arrays_overlap(minhash._keys(F.col("a"), choices), minhash._keys(F.col("b"), choices))
    assert df.where(shared).count() == len(pairs)


def test_pairs_of_a_bucket_are_compared_whatever_their_other_symbols():
    """Their sets are equal but for one shingle; their signatures agree in one key alone."""
    symbols = minhash.CHUNKS * minhash.CHUNK
    choices = minhash._choices(minhash.CHUNKS, minhash.CHUNK, minhash.ERRORS)
    number = 7
    one, two = np.zeros(symbols, "<u2"), np.ones(symbols, "<u2")
    two[choices[number]] = 0
    lows = [np.arange(100, dtype="<u2"), np.arange(99, dtype="<u2")]
    rows = pa.table({
        "key": pa.array([number, number], pa.int64()),
        "low_part": pa.array([0, 0], pa.int32()),
        "high_part": pa.array([0, 0], pa.int32()),
        "part": pa.array([0, 0], pa.int32()),
        "id": pa.array([4, 9], pa.int64()),
        "component": pa.array([1, 2], pa.int64()),
        "signature": pa.array([one.tobytes(), two.tobytes()], pa.binary()),
        "low": pa.array([x.tobytes() for x in lows], pa.binary()),
    })
    compare = minhash._comparer(minhash.CHUNKS, minhash.CHUNK, minhash.ERRORS, minhash.PERCENT)
    assert compare(rows).to_pylist() == [{"a": 4, "b": 9}]


def test_language_of_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    profiles = language_vectors.learn(docs.where(~held))
    rows = language_vectors.identify(docs.where(held), profiles).join(docs, "doc_id").collect()
    assert sum(row["lang_pred"] == row["lang"] for row in rows) >= 0.98 * len(rows)
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_language_vectors_equal_plain_sums(spark):
    """Prototype and cosine of short texts, from letter vectors one by one."""
    docs = spark.createDataFrame([("ab c", "x"), ("b, A", "x"), ("ccc", "y")], "text string, lang string")
    profiles = language_vectors.learn(docs, dimensions=256)
    letter = {c: language_vectors._letter_vectors(np.array([ord(c)], np.uint32), 256)[0] for c in " abc"}

    def vector(text):
        folded = " " + " ".join(re.findall("[a-z]+", text.lower())) + " "
        total = np.zeros(256)
        for a, b, c in zip(folded, folded[1:], folded[2:]):
            total += np.roll(letter[a], 2) * np.roll(letter[b], 1) * letter[c]
        return total

    expected = {"x": vector("ab c") + vector("b a"), "y": vector("ccc")}
    for name, row in zip(profiles.names, profiles.vectors):
        assert np.allclose(row, expected[name] / np.linalg.norm(expected[name]), atol=1e-5)


def test_language_on_awkward_rows(awkward, nothing):
    profiles = language_vectors.learn(awkward)
    rows = language_vectors.identify(awkward, profiles).collect()
    got = {row["doc_id"]: row for row in rows}
    assert len(rows) == awkward.count()
    assert {got[i]["lang_pred"] for i in (1, 2, 3, 8)} == {"und"} and got[1]["score"] == 0
    assert got[9]["lang_pred"] == "el"
    assert language_vectors.identify(nothing, profiles).collect() == []
    unlearnt = language_vectors.learn(nothing)
    assert {x["lang_pred"] for x in language_vectors.identify(awkward, unlearnt).collect()} == {"und"}


def tokens_of(text):
    return [*WORD.findall(small(text)), None]


def test_base_score_and_gain_of_the_tree(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    training = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    got = by_id(suffix_tree.scores(docs, training, fine=1e-3))
    learnt = [x for x in documents if zlib.crc32(str(x["doc_id"]).encode()) % 10]
    counts = collections.Counter(t for x in learnt for t in tokens_of(x["text"]))
    total = sum(counts.values())
    below = math.log10(total + 0.1 * (len(counts) + 1))
    for doc in documents:
        own, row = tokens_of(doc["text"]), got[doc["doc_id"]]
        assert row["n_tokens"] == len(own) and row["train_tokens"] == total
        assert row["n_known"] == sum(counts[t] > 0 for t in own)
        assert row["base_score"] == pytest.approx(sum(math.log10(counts[t] + 0.1) - below for t in own))
    held = [x["doc_id"] for x in documents if x not in learnt]
    assert sum(got[i]["score"] - got[i]["base_score"] for i in held) > 0


def test_distributions_of_the_tree_sum_to_one():
    """Root, and contexts of one and two words, over the words they may see."""
    rng = np.random.default_rng(1)
    head = suffix_tree.Head(np.arange(6, dtype=np.uint64), np.arange(6), 6)
    root = np.log10(np.array([0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.1]))  # 0.05 is outside the head
    tree = suffix_tree.Tree(head, root)
    for length in (1, 2):
        context, next, n, total = [], [], [], []
        for _ in range(4):
            ranks = rng.integers(0, 6, length)
            code = 0
            for r in ranks:
                code = code * 7 + int(r) + 1
            if code in context:
                continue
            seen = rng.choice(7, 3, replace=False)
            own = rng.integers(50, 400, 3)
            context += [code] * 3
            next += seen.tolist()
            n += own.tolist()
            total += [int(own.sum()) + 100] * 3
        tree.grow(length, np.array(context), np.array(next), np.array(n, float), np.array(total, float), 10.0, 3.0)
        level = tree.levels[-1]
        assert len(level.contexts)
        for code in level.contexts:
            before = [int(code) // 7**i % 7 - 1 for i in range(length)][::-1]
            ranks = np.array([[*before, x] for x in range(-1, 7)])
            gains = np.array([tree.gains(row, np.arange(length + 1))[-1] for row in ranks])
            outside = 10 ** (np.log10(0.05) + gains[0])
            assert outside + (10 ** (root + gains[1:])).sum() == pytest.approx(1.0)


def test_tree_on_awkward_rows(awkward, nothing):
    rows = suffix_tree.scores(awkward, awkward).collect()
    assert len(rows) == awkward.count()
    got = {row["doc_id"]: row for row in rows}
    assert got[1]["n_tokens"] == got[2]["n_tokens"] == got[3]["n_tokens"] == 1
    assert got[1]["score"] == got[1]["base_score"] < 0
    assert all(math.isfinite(row["score"]) for row in rows)
    assert suffix_tree.scores(nothing, awkward).collect() == []
    unlearnt = suffix_tree.scores(awkward, nothing).collect()
    assert {(row["n_known"], row["train_tokens"]) for row in unlearnt} == {(0, 0)}


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return lengths.read_ranks(path), public_tokenizers.PATTERN


def test_lengths_answer_every_limit(spark, sf_dir, documents, vocabulary):
    import tiktoken

    ranks, pattern = vocabulary
    encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    own = [len(encoding.encode_ordinary(x["text"] or "")) for x in documents]
    span, lengths.SPAN = lengths.SPAN, 64
    try:
        sums = lengths.suffix_sums(
            lengths.histogram(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks, pattern)
        ).cache()
        rows = {row["length"]: row for row in sums.collect()}
    finally:
        lengths.SPAN = span
    assert set(rows) == set(own)
    for limit, row in rows.items():
        assert row["n_docs"] == own.count(limit) and row["total_tokens"] == sum(own)
        assert row["truncated_tokens"] == sum(min(x, limit) for x in own)
        assert row["docs_cut"] == sum(x > limit for x in own)
        assert row["share_within"] == pytest.approx(sum(x <= limit for x in own) / len(own))
    for limit in (0, 1, 100, 333, 10**9):
        answer = lengths.truncated_total(sums, limit).head()
        assert answer["truncated_tokens"] == sum(min(x, limit) for x in own)
        assert answer["docs_cut"] == sum(x > limit for x in own)
    median = lengths.quantiles(sums, [0.5, 1.0]).collect()
    assert {row["share"]: row["length"] for row in median} == {
        0.5: sorted(own)[math.ceil(len(own) / 2) - 1], 1.0: max(own),
    }


def test_lengths_on_awkward_rows(awkward, nothing, vocabulary):
    counts = lengths.histogram(awkward, *vocabulary)
    assert counts.agg(F.sum("n_docs")).head()[0] == awkward.count()
    assert counts.where("length = 0").head()["n_docs"] == 2
    empty = lengths.suffix_sums(lengths.histogram(nothing, *vocabulary))
    assert empty.collect() == []
    assert lengths.truncated_total(empty, 10).head()["truncated_tokens"] == 0
