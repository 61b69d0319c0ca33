"""Search, encoding and classification against brute force, round trips and held-out rows."""

import collections
import heapq
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postgrove.llm import cotraining, huffman, neighbours, pieces

SPACE = "▁"


def nearest_by_hand(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], float)
    found = {}
    for i, vector in queries:
        distance = np.sqrt(((matrix - np.array(vector, float)) ** 2).sum(axis=1))
        order = [x for x in np.lexsort((ids, distance)) if ids[x] != i][:k]
        found[i] = [(int(ids[x]), float(distance[x])) for x in order]
    return found


def test_neighbours_find_nine_of_ten(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/embeddings.parquet")
    rows = [(x["vec_id"], x["embedding"]) for x in vectors.collect()]
    exact = nearest_by_hand(rows, [x for x in rows if x[0] % 100 == 0], 10)
    # Several blocks of rows and of queries.
    sizes = neighbours.ROWS_PER_BLOCK, neighbours.QUERIES_PER_BLOCK
    neighbours.ROWS_PER_BLOCK, neighbours.QUERIES_PER_BLOCK = 700, 8
    try:
        found = neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0")).collect()
    finally:
        neighbours.ROWS_PER_BLOCK, neighbours.QUERIES_PER_BLOCK = sizes
    by_query = collections.defaultdict(list)
    for row in sorted(found, key=lambda x: x["rank"]):
        by_query[row["query_id"]].append((row["vec_id"], row["score"]))
    assert set(by_query) == set(exact)
    hit = sum(len({i for i, _ in by_query[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hit >= 0.95 * sum(map(len, exact.values()))
    scores = dict(rows)
    for query, own in by_query.items():
        assert len(own) == 10 and own == sorted(own, key=lambda x: (x[1], x[0]))
        for i, score in own:
            difference = np.array(scores[i], float) - np.array(scores[query], float)
            assert score == np.sqrt((difference**2).sum())


def test_neighbours_on_awkward_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same, "x") for i in range(30)]
    rows += [
        (100, None, "x"), (200, [0.0, 0.0, 0.0], "x"), (300, [1.0, None, 2.0], "x"),
        (400, [float("nan"), 1.0, 1.0], "x"), (500, [float("inf"), 1.0, 1.0], "x"),
        (600, [1.0, 2.0], "x"), (700, [1.0, 2.5], "x"), (None, same, "x"), (7, same, "again"),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")
    found = neighbours.nearest(df, df.where("vec_id % 100 = 0 or vec_id = 7"), k=5).collect()
    got = collections.defaultdict(list)
    for row in sorted(found, key=lambda x: (x["query_id"], x["rank"])):
        got[row["query_id"]].append((row["rank"], row["vec_id"], row["score"]))
    assert got[0] == [(i, i, 0.0) for i in (1, 2, 3, 4, 5)]
    assert got[7] == [(i + 1, i, 0.0) for i in range(5)]
    assert got[600] == [(1, 700, 0.5)] and got[700] == [(1, 600, 0.5)]
    assert set(got) == {0, 7, 600, 700}
    assert neighbours.nearest(df.where("false"), df.where("false")).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))


def by_hand(vocabulary, text):
    """The best sum of scores by trying every piece at every position."""
    scores = {vocabulary.pieces[i]: vocabulary.scores[i] for i in vocabulary.usable}
    lowest = min(scores.values()) - pieces.PENALTY
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            score = scores.get(text[start:end], lowest if end - start == 1 else float("-inf"))
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_pieces_have_the_best_score(vocabulary, sf_dir):
    texts = pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()[:40]
    encode, decode = pieces.encoder(vocabulary), pieces.decoder(vocabulary)
    lowest = min(vocabulary.scores[i] for i in vocabulary.usable) - pieces.PENALTY
    for text in [x[:1500] for x in texts] + ["a  b   c\n\n\td", "漢字 \U0001f600x", "   ", "x" * 40]:
        ids = np.frombuffer(encode(text), "<i4")
        assert decode(ids) == text
        total, at = 0.0, 0
        usable = set(vocabulary.usable)
        while at < len(ids):
            if int(ids[at]) in usable:
                total, at = total + vocabulary.scores[ids[at]], at + 1
            else:
                first = int(vocabulary.pieces[ids[at]][1:-1], 16)
                total, at = total + lowest, at + (1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4)
        assert total == pytest.approx(by_hand(vocabulary, SPACE + text.replace(" ", SPACE)))


def test_pieces_equal_another_library(vocabulary, sf_dir):
    tokenizers = pytest.importorskip("tokenizers")
    scored = [(p, vocabulary.scores[i] if i in set(vocabulary.usable) else -1e9) for i, p in enumerate(vocabulary.pieces)]
    library = tokenizers.models.Unigram(scored, vocabulary.unknown, True)
    solve = pieces.solver(vocabulary)
    words = {w for x in pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()[:30] for w in x.split()}
    for word in sorted(words)[:3000]:
        if word.isascii() and word.isalpha():
            assert solve(SPACE + word) == [x.id for x in library.tokenize(SPACE + word)]


def test_pieces_across_spaces_are_solved_whole():
    vocabulary = pieces.Vocabulary(
        ["<unk>", SPACE, "a", "b", f"a{SPACE}b", f"{SPACE}a"], [0.0, -1.0, -2.0, -2.0, -0.5, -2.5],
        [1, 2, 3, 4, 5], {}, 0,
    )
    encode, decode = pieces.encoder(vocabulary), pieces.decoder(vocabulary)
    assert np.frombuffer(encode("a b"), "<i4").tolist() == [1, 4]
    assert np.frombuffer(encode("z"), "<i4").tolist() == [1, 0]
    assert decode(np.array([1, 4])) == "a b"


def test_pieces_on_awkward_rows(awkward, nothing, vocabulary):
    encoded = pieces.encode(awkward, vocabulary, keep=("doc_id", "text", "ids", "row"), name="found")
    assert encoded.columns == ["doc_id", "text", "ids", "row", "found"]
    rows = pieces.decode(encoded, vocabulary, ids="found", name="back", keep=("doc_id", "text", "found")).collect()
    assert len(rows) == awkward.count()
    assert all(row["back"] == row["text"] for row in rows)
    got = {row["doc_id"]: row["found"] for row in rows}
    assert got[1] is None and got[2] == []
    assert pieces.encode(nothing, vocabulary).collect() == []


def plain_huffman(counts):
    """Total bits of an unlimited Huffman code."""
    heap = [int(x) for x in counts if x]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def best_limited(counts, limit):
    """Least total bits within a limit, by trying all sorted lengths."""
    counts = sorted((int(x) for x in counts if x), reverse=True)

    def search(i, before, room):
        if i == len(counts):
            return 0
        options = []
        for bits in range(before, limit + 1):
            if room - 2.0**-bits >= -1e-12:
                rest = search(i + 1, bits, room - 2.0**-bits)
                options += [counts[i] * bits + rest] if rest is not None else []
        return min(options) if options else None

    return search(0, 1, 1.0)


def test_code_lengths():
    rng = np.random.default_rng(2)
    for _ in range(20):
        counts = (rng.pareto(0.6, int(rng.integers(2, 200))) * 10).astype(np.int64)
        lengths = huffman.code_lengths(counts, 60)
        if (counts > 0).sum() > 1:
            assert int((counts * lengths).sum()) == plain_huffman(counts)
        short = huffman.code_lengths(counts, 9)
        assert short.max() <= 9 and (2.0 ** -short[short > 0].astype(float)).sum() <= 1
        assert ((short > 0) == (counts > 0)).all()
    for counts in ([1, 1, 2, 3, 5, 8, 13], [1, 1, 1, 1, 100], [7, 1], [3, 3, 3, 3, 3, 3]):
        for limit in (3, 4, 5):
            lengths = huffman.code_lengths(np.array(counts), limit)
            assert int((np.array(counts) * lengths).sum()) == best_limited(counts, limit)
    assert huffman.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    symbols = [rng.zipf(1.3, size).clip(0, 4999) for size in (0, 1, 255, 256, 257, 5000)]
    counts = np.bincount(np.concatenate(symbols), minlength=5000)
    lengths = huffman.code_lengths(counts, 14)
    codes = huffman.canonical(lengths)
    blocks = [(*huffman.pack(x, codes, lengths), len(x)) for x in symbols]
    for some in (blocks, blocks[:1], blocks[1:2], blocks[::-1]):
        back = huffman.unpack([(b, o, n) for b, o, n in some], lengths, codes, 14)
        assert [len(x) for x in back] == [n for _, _, n in some]
    assert all((a == b).all() for a, b in zip(huffman.unpack(blocks, lengths, codes, 14), symbols))


def ids_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(ids_of, "library"):
        ids_of.library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        ids_of.library.encode_special_tokens = True
    return [*ids_of.library.encode(text or "", add_special_tokens=False).ids, 0]


def test_files_hold_every_document_in_order(spark, sf_dir, awkward, tmp_path):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(
        awkward.where("doc_id <> 6 and doc_id <> 7").select(F.col("doc_id") + 100_000, "text")
    )
    sizes = huffman.BLOCK, huffman.ROWS_PER_PART
    huffman.BLOCK, huffman.ROWS_PER_PART = 5_000, 60
    try:
        huffman.write(docs, f"{tmp_path}/files", public_tokenizers.path("byte_bpe_50k.json"))
    finally:
        huffman.BLOCK, huffman.ROWS_PER_PART = sizes
    texts = sorted((row["doc_id"], row["text"]) for row in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    got = huffman.read(spark, f"{tmp_path}/files").orderBy("start").collect()
    digests = {r["start"]: r["ids_crc32"] for r in huffman.read(spark, f"{tmp_path}/files", digest=True).collect()}
    start = 0
    assert [row["doc_id"] for row in got] == [i for i, _ in texts]
    for row, (_, text) in zip(got, texts):
        ids = ids_of(text)
        assert row["ids"] == ids and (row["start"], row["n_tokens"]) == (start, len(ids))
        assert digests[start] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_files_of_awkward_tables(spark, awkward, nothing, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    huffman.write(nothing, f"{tmp_path}/none", path)
    assert huffman.read(spark, f"{tmp_path}/none").collect() == []
    huffman.write(awkward, f"{tmp_path}/some", path)
    rows = huffman.read(spark, f"{tmp_path}/some", digest=True).orderBy("start").collect()
    assert len(rows) == awkward.count() and rows[0]["doc_id"] is None
    got = {row["doc_id"]: row["n_tokens"] for row in rows}
    assert got[1] == got[2] == 1 and got[6] == len(ids_of(awkward.where("doc_id = 6").head()["text"]))


def test_tokens_do_not_depend_on_where_texts_are_cut():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        encode = huffman._tokenizer(file.read())
    texts = [
        "a  b   c d\n e \n\n f", " lead and trail ", "it's we'll  don't", "x y z", "\x1c a \x1c b",
        "<|endoftext|> as text", "　 a   b", "1 2 34 ,5 . ; a", "",
    ]
    for text, ids in zip(texts, encode(texts)):
        assert [*ids.tolist(), 0] == ids_of(text), text


def random_texts(count, seed):
    """Texts of characters at which a cut may be wrong, mixed with words."""
    rng = np.random.default_rng(seed)
    some = [
        *" \n\t\r\x0b\x0c\x1c\x1f\x7f\x85", *"  \u2003\u2028\u200b　", *"aZé.,;'’…!-—1２٣", *"漢の。ñßяΩ", "\U0001f600",
        " the", " the", " don't", "'ll", ". ", ".\n", "\n\n", "  ", " (x)", " été", " élan.", "\nWort", "<|end", "oftext|>",
    ]
    return ["".join(some[i] for i in rng.integers(0, len(some), int(n))) for n in rng.integers(0, 40, count)]


@pytest.mark.parametrize("specials_as_text", [True, False])
def test_parts_have_the_tokens_of_whole_texts(monkeypatch, specials_as_text):
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    library = Tokenizer.from_str(definition)
    library.encode_special_tokens = specials_as_text
    # Parts are forgotten, and learnt again, all the time.
    monkeypatch.setattr(huffman, "MAX_REMEMBERED", 60)
    monkeypatch.setattr(huffman, "LONGEST_REMEMBERED", 4)
    monkeypatch.setattr(huffman, "PIECE_BYTES", 300)
    encode = huffman._tokenizer(definition, specials_as_text)
    for seed in range(6):
        texts = [*random_texts(500, seed), None, "", "x<|endoftext|>y z", "", " "]
        expected = [library.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert [x.tolist() for x in encode(texts)] == expected
    assert encode([]) == []


def test_tasks_of_a_worker_share_what_the_library_gave():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    assert huffman._tokenizer(definition, False) is huffman._tokenizer("".join(definition), False)


def test_definitions_of_other_forms_encode_texts_whole():
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        parts = json.load(file)
    texts = ["Ein Élan ist da. Und é noch", "a b", "", None, "in a\nline  of words"]
    accents = {"type": "Sequence", "normalizers": [{"type": "NFD"}, {"type": "StripAccents"}]}
    spaces = {**parts["pre_tokenizer"], "add_prefix_space": True}
    joining = {"id": 50257, "content": "a b", "single_word": False, "lstrip": False, "rstrip": False,
               "normalized": False, "special": False}
    for change in ({"normalizer": accents}, {"pre_tokenizer": spaces}, {"added_tokens": [*parts["added_tokens"], joining]}):
        definition = json.dumps(parts | change)
        library = Tokenizer.from_str(definition)
        expected = [library.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert [x.tolist() for x in huffman._tokenizer(definition, False)(texts)] == expected, change
    # The parts " a" and " b" stand in no text together, but meet when the library is asked.
    assert [x.tolist() for x in huffman._tokenizer(definition, False)(["x a", "x b"])] == [
        library.encode(x, add_special_tokens=False).ids for x in ("x a", "x b")
    ]


def test_special_tokens_in_texts_get_the_ids_of_the_library(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [
        "a <|endoftext|> b", "a<|endoftext|>b c", "<|endoftext|>", "x  <|endoftext|>  y", "a\n<|endoftext|> é b",
        "no such token", "<|endoftext|><|endoftext|> d <|endoftext|>", "a <|endoftext|", "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    huffman.write(docs, f"{tmp_path}/own", path)
    rows = huffman.read(spark, f"{tmp_path}/own").orderBy("start").collect()
    assert [row["ids"] for row in rows] == [[*library.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    assert rows[0]["ids"] == [64, 220, 50256, 275, 0]
    huffman.write(docs, f"{tmp_path}/text", path, specials_as_text=True)
    rows = huffman.read(spark, f"{tmp_path}/text").orderBy("start").collect()
    assert [row["ids"] for row in rows] == [ids_of(x) for x in texts]


def test_classifier_agrees_with_held_out_labels(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = cotraining.train(docs, labels.where(~held), labelled=1500, pool=1500)
    rows = cotraining.classify(docs, model).join(labels.where(held), "doc_id").collect()
    assert np.mean([row["kept"] == (row["quality"] == 1) for row in rows]) >= 0.97
    good = [row["kept"] for row in rows if row["quality"] == 1]
    assert np.mean(good) >= 0.99


def pages_of_two_kinds(spark, count):
    """Even ids are prose, odd ones marks."""
    rows = [
        (i, f"quiet words about number {i} and the sea", "web", "en", 40) if i % 2 == 0 else (i, f"### $$$ {i} >>>", "web", "en", 15)
        for i in range(count)
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")


def test_labels_of_other_rows_take_no_place_of_the_sample(spark):
    docs = pages_of_two_kinds(spark, 60)
    labels = spark.range(100_000).selectExpr("id doc_id", "cast(1 - id % 2 as int) quality")
    rows = cotraining.classify(docs, cotraining.train(docs, labels, labelled=50)).collect()
    assert all(row["kept"] == (row["doc_id"] % 2 == 0) for row in rows)


def test_every_unlabelled_row_may_teach(spark, monkeypatch):
    """The pool is all rows without a label, not a sample of them."""
    docs = pages_of_two_kinds(spark, 12_000)
    labels = spark.range(60).selectExpr("id doc_id", "cast(1 - id % 2 as int) quality")
    seen = []
    known = cotraining._surest_on_spark

    def watched(rows, sure):
        seen.append(rows.count())
        return known(rows, sure)

    monkeypatch.setattr(cotraining, "_surest_on_spark", watched)
    rows = cotraining.classify(docs, cotraining.train(docs, labels)).collect()
    assert seen == [12_000 - 60]
    assert all(row["kept"] == (row["doc_id"] % 2 == 0) for row in rows)


def test_surest_rows_on_spark_are_those_of_memory(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = cotraining._columns(docs, "doc_id", "text", "source", "lang", "n_chars")
    table = rows.select(F.xxhash64("id").alias("key"), "text", "source", "lang", "chars")
    found = table.orderBy("key").toArrow().combine_chunks().to_batches()[0]
    parts = [x[2:] for x in cotraining._features(*found.columns[1:5])]
    pool = [np.concatenate([x[i] for x in parts]) for i in (0, 1)]
    rng = np.random.default_rng(4)
    weights = [rng.normal(size=x.shape[1] + 1) for x in pool]
    near, far = cotraining._surest_in_memory(pool, 0.6), cotraining._surest_on_spark(table.repartition(5), 0.6)
    for _ in range(3):
        for (a, x), (b, y) in zip(near(weights, [(7, 4), (3, 9)]), far(weights, [(7, 4), (3, 9)])):
            assert x.tolist() == y.tolist() and len(a) and np.allclose(a, b)


def test_views_teach_each_other():
    """One view is nearly blind on the few labelled rows and learns from the other."""
    rng = np.random.default_rng(8)
    label = rng.integers(0, 2, 4000)
    one = label[:, None] * 2.0 + rng.normal(size=(4000, 2))
    two = np.where(rng.random((4000, 40)) < 0.5 + 0.06 * (2 * label[:, None] - 1), 1.0, 0.0)
    views = [one, two]
    first, pool, rest = slice(0, 60), slice(60, 2000), slice(2000, 4000)

    def accuracy(rounds):
        model = cotraining.co_train(
            [x[first] for x in views], label[first], [x[pool] for x in views], rounds=rounds, sure=0.8
        )
        logit = two[rest] @ model.views[1][:-1] + model.views[1][-1]
        return np.mean((logit > 0) == (label[rest] == 1))

    assert accuracy(6) > accuracy(0) + 0.02


def test_classifier_on_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(5, 1, 0), (6, 1, 0), (7, 0, 0), (7, 1, 0), (8, 0, 1), (None, 1, 0), (9, None, 0), (999, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    model = cotraining.train(awkward, labels)
    rows = cotraining.classify(awkward, model).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= row["score"] <= 1 for row in rows)
    twice = [tuple(row) for row in rows if row["doc_id"] == 30]
    assert twice[0] == twice[1]
    assert cotraining.classify(nothing, model).collect() == []
    for unlabelled in (labels.where("false"), labels.where("quality = 1")):
        kept = cotraining.classify(awkward, cotraining.train(awkward, unlabelled)).collect()
        assert all(row["kept"] for row in kept)
    assert cotraining.classify(nothing, cotraining.train(nothing, labels)).collect() == []


def test_every_stage_keeps_clean_rows_and_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    for name, stage in corpus_pipeline.STAGES[:2]:
        before = docs.join(labels, "doc_id", "left_semi").count()
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.join(labels, "doc_id", "left_semi").count() >= 0.98 * before, name
    unique = corpus_pipeline.without_near_duplicates(spark, docs, sf_dir).cache()
    assert unique.columns == docs.columns
    from test_text_operators import grouped

    rows = sorted((row["doc_id"], row["text"]) for row in docs.collect())
    component, _ = grouped([text for _, text in rows], corpus_pipeline.WIDTH)
    assert {row["doc_id"] for row in unique.collect()} == {rows[i][0] for i in set(component)}
    done = corpus_pipeline.encoded(spark, corpus_pipeline.mixed(spark, unique, sf_dir), sf_dir).collect()
    assert all(row["restored"] for row in done)
    assert max(collections.Counter(row["doc_id"] for row in done).values()) == 2


def test_texts_of_a_language_that_was_not_learnt_are_rejected(spark, sf_dir):
    import corpus_pipeline

    folder = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    unnamed = docs.withColumn("lang", F.when(F.col("lang") != "de", F.col("lang")))
    kept = {row["doc_id"] for row in corpus_pipeline.in_known_language(spark, unnamed, folder).collect()}
    clean = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    rows = docs.join(clean, "doc_id", "left_semi").select("doc_id", "lang").collect()
    left_out = [row["doc_id"] in kept for row in rows if row["lang"] == "de"]
    learnt = [row["doc_id"] in kept for row in rows if row["lang"] != "de"]
    assert len(left_out) > 10 and np.mean(left_out) <= 0.1
    assert np.mean(learnt) >= 0.98


def test_pipeline_on_awkward_rows(spark, awkward, nothing, tmp_path):
    import corpus_pipeline

    schema = "doc_id bigint, quality int, toxic int"
    spark.createDataFrame([(5, 1, 0), (6, 1, 0)], schema).write.parquet(f"{tmp_path}/labels.parquet")
    for table in (awkward, nothing):
        docs = table
        for name, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == awkward.columns, name
        assert corpus_pipeline.encoded(spark, docs, str(tmp_path)).where("not restored").count() == 0
    deduplicated = corpus_pipeline.without_near_duplicates(spark, awkward, str(tmp_path)).collect()
    ids = collections.Counter(row["doc_id"] for row in deduplicated)
    assert ids[30] == ids[None] == ids[20] == 1 and ids[21] == ids[7] == 0
