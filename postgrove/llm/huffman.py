"""Token ids as files of canonical Huffman code, read back block by block.

Three passes: texts are encoded once and their ids stored with the counts of
each task; the counts of the whole corpus give one code, of limited length, by
the package-merge method; rows in order of id are written as blocks of code.

The format is a Parquet table with a row per block: the ids of its documents and
their numbers of tokens, how many tokens the file part holds before it, the code
bits, and the bit offset of every 256th token. A block needs nothing but the
table of code lengths, so blocks are decoded independently, and the offsets let
all stretches of 256 tokens of a block be decoded in step, one table look-up
per token. Spark's writer makes the files, so a lost executor leaves no half
written ones, and any shared store will do.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postgrove.functions.batches import parts
from postgrove.llm.stored import small_batches, stored
from postgrove.llm.words import slices
from postgrove.session import shared_folder

END = 0
LIMIT = 18
BLOCK = 1 << 16
STRETCH = 256
# Parts of texts remembered by a worker, of so many bytes at most. Beyond that number those
# not seen again for as many others are forgotten.
MAX_REMEMBERED, LONGEST_REMEMBERED = 250_000, 64
# Parts given to the library as one text, texts given to it at once, and bytes of texts cut at once.
TOGETHER = 64
PIECE_BYTES = 4 << 20
# Rows put in order by one task.
ROWS_PER_PART = 20_000

Batches = Iterator[pa.RecordBatch]


# What a byte of UTF-8 may be: a blank texts are cut at, visible and of these a letter or a mark, or of a longer character.
BLANK, VISIBLE, LETTER, MARK, BEYOND = 1, 2, 4, 8, 16
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x0A]] = BLANK
KINDS[0x21:0x7F] = VISIBLE | MARK
KINDS[ord("0") : ord("9") + 1] = VISIBLE
for first in "Aa":
    KINDS[ord(first) : ord(first) + 26] = VISIBLE | LETTER
KINDS[0x80:] = BEYOND
# The first two bytes of white space of three, and the first bytes of white space.
WIDE_SPACES = (0xE19A, 0xE280, 0xE281, 0xE380)
SPACE_BEGINS = (0xC2, 0xE1, 0xE2, 0xE3)


def cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts, given as bytes and offsets, are cut; the parts have the tokens of the whole.

    A byte-level pattern always begins anew at white space after another character,
    after one line break between two other characters, and at a mark after a letter.
    Where a character might be white space, or no letter, there is no cut.
    """
    kinds = KINDS[raw]
    blank = np.flatnonzero(kinds == BLANK)
    blank = blank[blank > 0]
    before = kinds[blank - 1]
    lead = raw[blank - 2]
    pair = raw[np.maximum(blank - 3, 0)].astype(np.int32) * 256 + lead
    wide = (lead == 0xC2) | np.isin(pair, WIDE_SPACES)
    blank = blank[((before & VISIBLE) > 0) | ((before == BEYOND) & ~wide)]
    line = blank[raw[blank] == 0x0A]
    line = line[line + 1 < len(raw)] + 1
    after = kinds[line]
    line = line[((after & VISIBLE) > 0) | ((after == BEYOND) & ~np.isin(raw[line], SPACE_BEGINS))]
    found = np.zeros(len(raw) + 1, bool)
    found[1:-1] = ((kinds[1:] & MARK) > 0) & ((kinds[:-1] & LETTER) > 0)
    found[blank] = found[line] = found[offsets] = True
    return np.flatnonzero(found[:-1])


def _cuttable(definition: str) -> bool:
    """Whether tokens are those of a plain byte-level pattern, and stand for all the bytes of a text."""
    from tokenizers import pre_tokenizers

    parts = json.loads(definition)
    model, pattern = parts["model"], parts["pre_tokenizer"] or {}
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix")
    return (
        not any(parts.get(x) for x in ("normalizer", "truncation", "padding"))
        and (pattern.get("type"), pattern.get("add_prefix_space"), pattern.get("use_regex", True))
        == ("ByteLevel", False, True)
        and model.get("type") == "BPE"
        and not any(model.get(x) for x in options)
        and set(pre_tokenizers.ByteLevel.alphabet()) <= set(model["vocab"])
    )


@functools.lru_cache(maxsize=1)
def _tokenizer(definition: str, specials_as_text: bool = True) -> Callable[[Sequence[str | None]], list[np.ndarray]]:
    """Ids of many texts, by the tokenizers library; what it learnt stays for later tasks of a worker.

    A special token of the definition that stands in a text is encoded like any
    other text, or with ``specials_as_text`` off as its own id, the library's default.

    Texts are cut, and the library encodes each distinct part once. It is given many
    parts as one text; as tokens of a byte-level vocabulary stand for bytes, their
    lengths tell where a part ends. Texts with added tokens, and all texts of a
    definition of another form, are encoded whole.
    """
    # The cores of an executor have tasks of their own.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(definition)
    library.encode_special_tokens = specials_as_text
    cuttable = _cuttable(definition)
    size = library.get_vocab_size()
    narrow = _narrow(size)
    bytes_of = np.array([len(library.id_to_token(i) or "") for i in range(size)])
    added = [x for x in library.get_added_tokens_decoder().values() if not (x.special and specials_as_text)]
    remembered: dict[bytes, bytes] = {}
    earlier: dict[bytes, bytes] = {}

    def whole(texts: list[str]) -> list[np.ndarray]:
        found: list[np.ndarray] = []
        # The library's results are far larger than the ids.
        for i in range(0, len(texts), TOGETHER):
            some = library.encode_batch_fast(texts[i : i + TOGETHER], add_special_tokens=False)
            found += [np.array(x.ids, narrow) for x in some]
        return found

    def learn(parts: list[bytes]) -> list[bytes]:
        texts = [x.decode("utf-8") for x in parts]
        # White space at an end could join with what comes next to it; a line break or a space cannot with what is before.
        apart = [x[-1].isspace() or (x[0] not in " \n" and x[0].isspace()) for x in texts]
        joined = [i for i, x in enumerate(apart) if not x]
        led = [texts[i] if texts[i][0] in " \n" else "\n" + texts[i] for i in joined]
        together = ["".join(led[i : i + TOGETHER]) for i in range(0, len(led), TOGETHER)]
        ids = np.concatenate([np.zeros(0, narrow), *whole(together)])
        ends = np.concatenate(([0], np.cumsum(bytes_of[ids])))
        lengths = np.array([len(parts[i]) for i in joined], np.int64)
        stops = np.cumsum(lengths + [len(x) - len(texts[i]) for i, x in zip(joined, led)])
        wanted = np.stack((stops - lengths, stops))
        edges = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
        if (ends[edges] != wanted).any():
            # An added token came about where two parts meet.
            return [own.tobytes() for own in whole(texts)]
        data, edges = ids.tobytes(), edges * ids.itemsize
        found: list[bytes] = [b""] * len(parts)
        for i, start, stop in zip(joined, *edges.tolist()):
            found[i] = data[start:stop]
        others = [i for i, x in enumerate(apart) if x]
        for i, own in zip(others, whole([texts[i] for i in others])):
            found[i] = own.tobytes()
        return found

    def tokens_of(parts: list[bytes]) -> list[bytes]:
        nonlocal remembered, earlier
        found = [remembered.get(x) for x in parts]
        for i in [i for i, x in enumerate(found) if x is None]:
            found[i] = earlier.get(parts[i])
            if found[i] is not None:
                remembered[parts[i]] = found[i]
        new = [i for i, x in enumerate(found) if x is None]
        for i, own in zip(new, learn([parts[i] for i in new])):
            found[i] = own
            if len(parts[i]) <= LONGEST_REMEMBERED:
                remembered[parts[i]] = own
        if len(remembered) > MAX_REMEMBERED:
            earlier, remembered = remembered, {}
        return found

    def by_parts(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        starts = cuts(raw, offsets)
        edges = np.append(starts, len(raw)).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(raw)])
        coded = parts.dictionary_encode()
        found = tokens_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, code = np.frombuffer(b"".join(found), narrow), coded.indices.to_numpy()
        # A text, and so the ids of a piece, are fewer than 2 ** 31.
        counts = np.array([len(x) for x in found], np.int32) // ids.itemsize
        begins = np.cumsum(counts, dtype=np.int32) - counts
        ends = np.concatenate((np.zeros(1, np.int32), np.cumsum(counts[code], dtype=np.int32)))
        where = np.repeat(begins[code] - ends[:-1], counts[code])
        where += np.arange(len(where), dtype=np.int32)
        return np.split(ids[where], ends[np.searchsorted(starts, offsets[1:-1])])

    def encode(texts: Sequence[str | None]) -> list[np.ndarray]:
        texts = pa.array(texts, pa.string())
        alike = np.full(len(texts), not cuttable)
        for token in added if cuttable else []:
            alike |= pc.match_substring(texts, token.content).fill_null(False).to_numpy(zero_copy_only=False)
        encoded = [None] * len(texts)
        rows = np.flatnonzero(alike)
        for i, own in zip(rows, whole([x or "" for x in texts.take(pa.array(rows)).to_pylist()])):
            encoded[i] = own
        rows = np.flatnonzero(~alike)
        rest = texts.take(pa.array(rows)) if alike.any() else texts
        for first, last, raw, offsets in slices(rest, PIECE_BYTES):
            for i, own in zip(rows[first:last], by_parts(raw, offsets)):
                encoded[i] = own
        return encoded

    return encode


def _narrow(size: int) -> str:
    """Numbers that hold the ids of so many symbols."""
    return "<u2" if size <= 1 << 16 else "<u4"


def _encoding(definition, size: int, specials_as_text: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encode = _tokenizer(definition.value, specials_as_text)
        end = np.array([END], _narrow(size))
        counts = np.zeros(size, np.int64)

        def rows(ids: pa.Array, tokens: list[np.ndarray], kind: int) -> pa.RecordBatch:
            return pa.record_batch(
                [
                    ids,
                    pa.array([kind] * len(ids), pa.int32()),
                    pa.array([len(x) for x in tokens], pa.int64()),
                    pa.array([x.tobytes() for x in tokens], pa.binary()),
                ],
                names=["id", "kind", "n_tokens", "tokens"],
            )

        for batch in batches:
            first = 0
            for texts in parts(batch.column(1), PIECE_BYTES):
                tokens = [np.concatenate((x, end)) for x in encode(texts)]
                counts += np.bincount(np.concatenate(tokens), minlength=size)
                yield rows(batch.column(0).slice(first, len(texts)), tokens, 0)
                first += len(texts)
        yield rows(pa.array([None], pa.int64()), [counts.astype("<i8")], 1)

    return run


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of the code of each symbol, at most ``limit``; 0 for symbols that do not occur.

    Package-merge: of ``limit`` levels, each merges the symbols with the pairs of
    the level before; a symbol's length is how often it is among the cheapest
    2n - 2 items, followed down the levels.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    symbols = counts[order].astype(np.int64)
    levels, packages = [], symbols[:0]
    for _ in range(limit):
        merged = np.concatenate((symbols, packages))
        ranked = np.argsort(merged, kind="stable")
        levels.append(ranked < len(symbols))
        merged = merged[ranked]
        merged = merged[: len(merged) // 2 * 2]
        packages = merged[::2] + merged[1::2]
    bits = np.zeros(len(symbols), np.int64)
    take = 2 * len(symbols) - 2
    for is_symbol in reversed(levels):
        chosen = int(is_symbol[:take].sum())
        bits[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[order] = bits
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol: counted up in order of length, then of symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        length = int(lengths[symbol])
        if length:
            code <<= length - before
            codes[symbol], before = code, length
            code += 1
    return codes


def pack(symbols: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The code bits of symbols, and the bit offset of every stretch."""
    bits = lengths[symbols].astype(np.int64)
    ends = np.cumsum(bits)
    begins = ends - bits
    word, shift = begins >> 5, (64 - bits - (begins & 31)).astype(np.uint64)
    placed = codes[symbols] << shift
    count = int(ends[-1] >> 5) + 2 if len(ends) else 1
    # Codes do not overlap, so adding sets bits; sums stay below 2 ** 32, exact in doubles.
    high = np.bincount(word, (placed >> np.uint64(32)).astype(float), count)
    low = np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(float), count)
    return (high + low).astype(">u4").tobytes(), begins[::STRETCH]


def unpack(
    blocks: list[tuple[bytes, np.ndarray, int]], lengths: np.ndarray, codes: np.ndarray, limit: int
) -> list[np.ndarray]:
    """The symbols of blocks given as (bits, offsets of stretches, number of symbols)."""
    table_symbol, table_bits = decoding_table(lengths, codes, limit)
    sizes = np.array([count for _, _, count in blocks], np.int64)
    raw = np.frombuffer(b"".join([bits + b"\0\0\0\0" for bits, _, _ in blocks]) + b"\0" * 4, np.uint8)
    wide = raw.astype(np.uint32)
    window = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    byte = np.concatenate(([0], np.cumsum([len(bits) + 4 for bits, _, _ in blocks])))
    at = np.concatenate([np.zeros(0, np.int64)] + [x + 8 * b for (_, x, _), b in zip(blocks, byte)])
    stretches = -(-sizes // STRETCH)
    left = np.full(int(stretches.sum()), STRETCH)
    last = np.cumsum(stretches)[sizes > 0] - 1
    left[last] = (sizes[sizes > 0] - 1) % STRETCH + 1
    found = np.zeros((STRETCH, len(at)), np.uint32)
    for step in range(STRETCH):
        peek = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - limit)
        found[step] = table_symbol[peek]
        at = np.where(left > step + 1, at + table_bits[peek], at)
    symbols = found.T[np.arange(STRETCH)[None, :] < left[:, None]]
    return np.split(symbols, np.cumsum(sizes)[:-1])


def decoding_table(lengths: np.ndarray, codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For all ``limit`` next bits, the symbol they begin with and the bits of its code."""
    symbol, bits = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = np.int64(1) << (limit - lengths[order].astype(np.int64))
    total = int(span.sum())
    symbol[:total] = np.repeat(order, span)
    bits[:total] = np.repeat(lengths[order], span)
    return symbol, bits


def _packing(shared, size: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        lengths = shared.value
        codes = canonical(lengths)
        narrow = _narrow(size)
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        block = before = waiting = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, before, waiting
            tokens = np.concatenate([np.frombuffer(x, narrow) for _, x in held])
            bits, offsets = pack(tokens, codes, lengths)
            step = np.dtype(narrow).itemsize
            row = pa.record_batch(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([len(tokens)], pa.int64()),
                    pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
                    pa.array([[len(x) // step for _, x in held]], pa.list_(pa.int64())),
                    pa.array([offsets.tolist()], pa.list_(pa.int64())),
                    pa.array([bits], pa.binary()),
                ],
                names=["part", "block", "before", "n_tokens", "ids", "sizes", "offsets", "bits"],
            )
            block, before, waiting = block + 1, before + len(tokens), 0
            held.clear()
            return row

        for batch in batches:
            for i, tokens in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append((i, tokens.as_py()))
                waiting += len(held[-1][1]) // np.dtype(narrow).itemsize
                if waiting >= BLOCK:
                    yield flush()
        if held:
            yield flush()

    return run


LAYOUT = (
    "part int, block int, before bigint, n_tokens bigint, ids array<bigint>, sizes array<bigint>, "
    "offsets array<bigint>, bits binary"
)


def write(
    docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text", limit: int = LIMIT,
    specials_as_text: bool = False,
) -> None:
    """Encode texts with a tokenizers definition and write them at ``path`` in order of id.

    A document's tokens are followed by id 0; a NULL or empty text has that one
    alone. Rows without an id come first, rows with equal ids stand together.
    An empty table writes a table without blocks. Other columns are not read.
    A special token that stands in a text gets its own id, as by the library's
    default, or with ``specials_as_text`` the ids of its letters.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    size = Tokenizer.from_str(definition).get_vocab_size()
    shared = spark.sparkContext.broadcast(definition)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    kinds = "id bigint, kind int, n_tokens bigint, tokens binary"
    encoded = stored(rows.mapInArrow(_encoding(shared, size, specials_as_text), kinds), "tokens")
    counts = np.zeros(size, np.int64)
    summed = encoded.where("kind = 1").select("tokens").mapInArrow(_counts, "id int, n bigint")
    table = summed.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts[table["id"].to_numpy()] = table["n"].to_numpy()
    lengths = code_lengths(counts, limit)
    code = pa.table({"id": pa.array(np.flatnonzero(lengths), pa.int32()), "bits": lengths[lengths > 0].astype(np.int32)})
    spark.createDataFrame(code, "id int, bits int").write.parquet(f"{path}/code")
    texts = encoded.where("kind = 0").select("id", "tokens")
    parts = texts.count() // ROWS_PER_PART + 1
    parts = max(parts, min(spark.sparkContext.defaultParallelism, 8))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("tokens")]
    (
        texts.repartitionByRange(parts, F.col("id").asc_nulls_first())
        .sortWithinPartitions(*order)
        .mapInArrow(_packing(spark.sparkContext.broadcast(lengths), size), LAYOUT)
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )


def _counts(batches: Batches) -> Batches:
    total = 0
    for batch in batches:
        for x in batch.column(0):
            total = total + np.frombuffer(x.as_py(), "<i8")
    used = np.flatnonzero(total)
    yield pa.record_batch(
        [used.astype(np.int32), np.asarray(total)[used] if len(used) else np.zeros(0, np.int64)],
        names=["id", "n"],
    )


def _unpacking(shared, digest: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        lengths, limit = shared.value
        codes = canonical(lengths)
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                some = batch.slice(start, 16)
                part, before, count, ids, sizes, offsets, bits = (
                    some.column(i).to_pylist() for i in range(7)
                )
                blocks = [(b, np.array(o, np.int64), n) for b, o, n in zip(bits, offsets, count)]
                rows: list[list] = [[], [], [], [], []]
                for i, tokens in enumerate(unpack(blocks, lengths, codes, limit)):
                    edges = np.concatenate(([0], np.cumsum(sizes[i])))
                    for j, own in enumerate(ids[i]):
                        mine = tokens[edges[j] : edges[j + 1]].astype("<u4")
                        data = zlib.crc32(mine.tobytes()) if digest else mine.astype(np.int64)
                        for row, x in zip(rows, (part[i], own, before[i] + int(edges[j]), len(mine), data)):
                            row.append(x)
                last = pa.array(rows[4], pa.int64() if digest else pa.list_(pa.int64()))
                yield pa.record_batch(
                    [
                        pa.array(rows[0], pa.int32()),
                        *(pa.array(rows[k], pa.int64()) for k in (1, 2, 3)),
                        last,
                    ],
                    names=["part", "id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return run


def read(
    spark: SparkSession, path: str, id: str = "doc_id", digest: bool = False
) -> DataFrame:
    """(id, start, n_tokens, ids) of every document of the files at ``path``.

    ``start`` is the number of tokens of all documents before it. With ``digest``
    there is ``ids_crc32`` in place of ids: the unsigned CRC-32 of the ids as
    little-endian unsigned 32-bit numbers.
    """
    code = spark.read.parquet(f"{path}/code").toArrow()
    ids, bits = code["id"].to_numpy(), code["bits"].to_numpy()
    lengths = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint8)
    lengths[ids] = bits
    shared = spark.sparkContext.broadcast((lengths, int(bits.max()) if len(bits) else 1))
    blocks = spark.read.parquet(f"{path}/blocks")
    # A row per file part, in one task.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier")
    )
    chosen = blocks.select("part", "before", "n_tokens", "ids", "sizes", "offsets", "bits")
    last = "ids_crc32 bigint" if digest else "ids array<bigint>"
    rows = chosen.mapInArrow(
        _unpacking(shared, digest), f"part int, id bigint, start bigint, n_tokens bigint, {last}"
    )
    return rows.join(F.broadcast(parts), "part").select(
        F.col("id").alias(id),
        (F.col("start") + F.col("earlier")).alias("start"),
        "n_tokens",
        last.split()[0],
    )


def new_folder(spark: SparkSession) -> str:
    """A place for files in the folder executors share."""
    return shared_folder(spark, "huffman")
