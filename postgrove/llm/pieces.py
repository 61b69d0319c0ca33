"""SentencePiece encoding and decoding with an Aho-Corasick automaton and Viterbi.

The automaton over all pieces reads a text once. At each position it reports,
along its output links, every piece that ends there, longest first; each relaxes
the best score of that position from the position where the piece begins. A
character that no piece covers alone costs the lowest score and a penalty, and is
written as the pieces of its bytes. The path of the highest sum of scores is read
back from the end; on a tie the longest last piece wins.

No piece holds a space after another character, so a best path always cuts before
a space that follows one. Texts are cut there and every distinct cut is solved
once per task; a vocabulary with such pieces is solved over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postgrove.llm.stored import small_batches

SPACE = "▁"
PENALTY = 10.0
# Distinct cuts remembered by a task; then it starts anew.
MAX_REMEMBERED = 200_000
# Texts or lists of ids worked on at a time: ids are several times a text's size.
ROWS_AT_ONCE = 256

Batches = Iterator[pa.RecordBatch]


@dataclass
class Vocabulary:
    """Pieces by id, with what they stand for."""

    pieces: list[str]
    scores: list[float]
    # Ids that may be found in a text, the id of each byte, and that of the unknown.
    usable: list[int]
    bytes: dict[int, int]
    unknown: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a SentencePiece model file on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in ids]
        special = [
            model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i) for i in ids
        ]
        return cls(
            pieces,
            [float(model.get_score(i)) for i in ids],
            [i for i in ids if not special[i] and pieces[i]],
            {int(pieces[i][1:-1], 16): i for i in ids if model.is_byte(i)},
            model.unk_id(),
        )


def solver(vocabulary: Vocabulary) -> Callable[[str], list[int]]:
    """A function from a text, spaces already written as pieces have them, to ids."""
    automaton = ahocorasick.Automaton()
    for i in vocabulary.usable:
        piece = vocabulary.pieces[i]
        automaton.add_word(piece, (len(piece), vocabulary.scores[i], i))
    if vocabulary.usable:
        automaton.make_automaton()
    lowest = min((vocabulary.scores[i] for i in vocabulary.usable), default=0.0) - PENALTY
    of_byte, unknown = vocabulary.bytes, vocabulary.unknown

    def spelt(character: str) -> list[int]:
        ids = [of_byte.get(x, -1) for x in character.encode("utf-8")]
        return [unknown] if -1 in ids else ids

    def solve(text: str) -> list[int]:
        size = len(text)
        best, back = [float("-inf")] * (size + 1), [(1, -1)] * (size + 1)
        best[0], single = 0.0, [False] * (size + 1)
        done = 0

        def close(end: int) -> None:
            # Positions up to ``end`` hear of no more pieces.
            nonlocal done
            while done < end:
                done += 1
                if not single[done] and best[done - 1] + lowest > best[done]:
                    best[done], back[done] = best[done - 1] + lowest, (1, -1)

        for last, (length, score, i) in automaton.iter(text) if vocabulary.usable else ():
            close(last)
            end = last + 1
            if length == 1:
                single[end] = True
            candidate = best[end - length] + score
            if candidate > best[end]:
                best[end], back[end] = candidate, (length, i)
        close(size)
        path, end = [], size
        while end:
            length, i = back[end]
            path.append([i] if i >= 0 else spelt(text[end - 1]))
            end -= length
        return [i for ids in reversed(path) for i in ids]

    return solve


def encoder(vocabulary: Vocabulary) -> Callable[[str], bytes]:
    """A function from a text to its ids, as little-endian 32-bit numbers.

    As usual with this kind of model, a space is put before a text and spaces
    are written as U+2581. A U+2581 of the text itself is spelt by its bytes, so
    that it comes back as what it was.
    """
    solve, space = solver(vocabulary), SPACE
    own = [vocabulary.bytes.get(x, vocabulary.unknown) for x in space.encode("utf-8")]
    usable = [vocabulary.pieces[i] for i in vocabulary.usable]
    alone = [c for c in "\n\t\r" if not any(c in piece for piece in usable)]
    other = "[^ " + "".join(map(re.escape, alone)) + "]"
    across = any(re.search(f"[^{space}]{space}", piece) for piece in usable)
    cut = re.compile(r"(?s).+" if across else f" +{other}*|{other}+|(?s:.)")
    remembered: dict[str, bytes] = {}
    most = MAX_REMEMBERED

    def solved(part: str) -> bytes:
        pieces: list[int] = []
        for i, text in enumerate(part.split(space)):
            pieces += (own if i else []) + solve(text.replace(" ", space))
        return np.array(pieces, "<i4").tobytes()

    def encode(text: str) -> bytes:
        if not text:
            return b""
        found = []
        for part in cut.findall(" " + text):
            ids = remembered.get(part)
            if ids is None:
                if len(remembered) >= most:
                    remembered.clear()
                ids = remembered[part] = solved(part)
            found.append(ids)
        return b"".join(found)

    return encode


def decoder(vocabulary: Vocabulary) -> Callable[[np.ndarray], str]:
    """A function from ids to the text they were made of."""
    spelt = [piece.replace(SPACE, " ").encode("utf-8") for piece in vocabulary.pieces]
    for value, i in vocabulary.bytes.items():
        spelt[i] = bytes([value])

    def decode(ids: np.ndarray) -> str:
        return b"".join([spelt[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")

    return decode


def _lists(parts: list[bytes | None]) -> pa.Array:
    sizes = [len(x) // 4 if x is not None else 0 for x in parts]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.frombuffer(b"".join([x for x in parts if x is not None]), "<i4")
    empty = pa.array([x is None for x in parts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()), mask=empty)


def _encoding(shared) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encode = encoder(Vocabulary(*shared.value))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                texts = part.column(part.num_columns - 1)
                ids = [None if x is None else encode(x) for x in texts.to_pylist()]
                names = [*part.schema.names[:-1], "ids"]
                yield pa.record_batch([*part.columns[:-1], _lists(ids)], names=names)

    return run


def _checking(shared) -> Callable[[Batches], Batches]:
    """Ids of each text and whether they give it again, in one worker and one pass."""

    def run(batches: Batches) -> Batches:
        vocabulary = Vocabulary(*shared.value)
        encode, decode = encoder(vocabulary), decoder(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids, same = [], []
                for text in part.column(part.num_columns - 1).to_pylist():
                    ids.append(None if text is None else encode(text))
                    same.append(text is None or decode(np.frombuffer(ids[-1], "<i4")) == text)
                names = [*part.schema.names[:-1], "ids", "restored"]
                yield pa.record_batch([*part.columns[:-1], _lists(ids), pa.array(same, pa.bool_())], names=names)

    return run


def _decoding(shared) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        decode = decoder(Vocabulary(*shared.value))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                texts = [
                    None if not x.is_valid else decode(x.values.to_numpy(zero_copy_only=False))
                    for x in part.column(part.num_columns - 1)
                ]
                names = [*part.schema.names[:-1], "text"]
                yield pa.record_batch([*part.columns[:-1], pa.array(texts, pa.string())], names=names)

    return run


def _applied(
    df: DataFrame, vocabulary: Vocabulary, column: str, run: Callable, name: str, kind: str, keep: list[str]
) -> DataFrame:
    small_batches(df.sparkSession)
    # Lists and dictionaries alone: workers have no copy of this class to read it by.
    fields = vocabulary.pieces, vocabulary.scores, vocabulary.usable, vocabulary.bytes, vocabulary.unknown
    shared = df.sparkSession.sparkContext.broadcast(fields)
    kept = [F.col(x).alias(f"_{i}") for i, x in enumerate(keep)]
    layout = ", ".join(f"_{i} {df.schema[x].dataType.simpleString()}" for i, x in enumerate(keep))
    rows = df.select(*kept, F.col(column).alias("_value"))
    done = rows.mapInArrow(run(shared), f"{layout}{', ' if keep else ''}{kind}")
    back = [F.col(f"_{i}").alias(x) for i, x in enumerate(keep)]
    value, *more = done.columns[len(keep) :]
    return done.select(*back, F.col(value).alias(name), *more)


def encode(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", name: str = "ids",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` and the ids of each text, an array; nothing is shuffled.

    A NULL text has NULL ids, an empty one has none.
    Whole texts are encoded; repeated rows and an empty table need no care.
    """
    return _applied(df, vocabulary, text, _encoding, name, "ids array<int>", list(keep))


def encode_and_check(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", name: str = "ids",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """As :func:`encode`, and ``restored``: whether decoding the ids gives the text again, true for NULL.

    Only the ids and the outcome leave the task, not the text.
    """
    return _applied(df, vocabulary, text, _checking, name, "ids array<int>, restored boolean", list(keep))


def decode(
    df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", name: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` and the text of each array of ids; NULL for NULL."""
    return _applied(df, vocabulary, ids, _decoding, name, "text string", list(keep))


