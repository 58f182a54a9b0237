"""Byte-level BPE: texts to ids with offsets, and ids back to bytes and text.

The vocabulary is a file of ranks (base64 token, rank). The tokenizers library works on
characters, so each byte stands for one printable character by a fixed rule, and merges
are recovered from the ranks: the two halves of a token are what is left when the pairs
of lower rank have been merged. Texts are split by a pattern first and each match is
merged by itself; a match that is a token as a whole is taken as it is.

``encode`` works on Arrow batches. A match is given to the library once and then looked up,
as the same ones come again and again. Texts with characters that the two readers of the
pattern may put in different classes are split by the library itself. A long text is
cut where white space follows something else, which no match of the pattern spans. It
returns, per row, the ids and where each token starts, as byte and as character (of the
character that holds its first byte). ``decode`` reverses the byte table. A character may
be split between tokens, so bytes are joined before they become text; in ``pieces`` it
comes with the token that completes it.

Null and empty texts have no ids, null and empty lists of ids no bytes. An id outside the
vocabulary makes the decoded columns null, and bytes that are no UTF-8 become U+FFFD in
texts only. Repeated rows and null keys are rows like others. Columns other than key, text
or ids are not read by ``encode``; ``decode`` replaces columns of its own names.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from spoorlens.llm.common import slices_by_size, text_of

RANKS = "byte_bpe_50k.tiktoken"
BATCH_CHARS = 1 << 19
SLICE_BYTES = 8 << 20
ROWS = 512
# Matches of which ids are kept, and characters of one; about 60 MB in all.
KNOWN = 300_000
KNOWN_CHARS = 64
# Characters that ``regex`` and the library may class differently, as their Unicode versions
# differ. All others were compared (test_byte_bpe.py).
_UNSURE = re.compile("[^\x00-\u052f\u2010-\u208e\u20a0-\ua7cd]")
# White space after something else: a match of the pattern starts here.
_CUT = re.compile(r"(?<=\S)[ \n]")


def byte_characters() -> list[str]:
    """The character of each byte: printable Latin-1 bytes stand for themselves, the others
    for the characters from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The pair whose merge makes the token: its bytes, merged by the lower ranks alone."""
    own, parts = ranks[token], [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= own:
            raise ValueError(f"token {token!r} does not come from two tokens of lower rank")
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class Known(dict):
    """Ids of a match, as bytes. Emptied when it has grown large."""

    def __init__(self, encode: Callable[[str], np.ndarray]):
        self.encode = encode

    def __missing__(self, match: str) -> bytes:
        ids = self.encode(match).tobytes()
        if len(match) <= KNOWN_CHARS:
            if len(self) >= KNOWN:
                self.clear()
            self[match] = ids
        return ids


class Codec:
    """Both directions over one vocabulary."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        ranks = read_ranks(path)
        shown = byte_characters()

        def spelled(token: bytes) -> str:
            return "".join([shown[b] for b in token])

        by_rank = sorted(ranks, key=ranks.__getitem__)
        merges = [tuple(map(spelled, halves(token, ranks))) for token in by_rank if len(token) > 1]
        vocabulary = {spelled(token): rank for token, rank in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        self.matches = regex.compile(pattern)
        self.known = Known(self._encoded)
        # Back again: characters of a token to bytes, by the reversed table.
        bytes_of = {c: b for b, c in enumerate(shown)}
        self.tokens = {i: bytes(bytes_of[c] for c in token) for token, i in self.tokenizer.get_vocab().items()}
        by_id = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)  # all tokens, one after another
        self.widths = np.array([len(token) for token in by_id], np.int32)
        self.places = np.cumsum(self.widths, dtype=np.int64) - self.widths

    def _encoded(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.int32)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, a bounded part at a time."""
        for text in texts:
            ids = []
            for a, b in chunks(text):
                part = text[a:b]
                if _UNSURE.search(part):
                    ids.append(self._encoded(part))
                else:
                    ids.append(np.frombuffer(b"".join(map(self.known.__getitem__, self.matches.findall(part))), np.int32))
            yield np.concatenate(ids)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
        """Bytes of each list of ids; the lists lie one after another, with borders ``ends``."""
        known = (ids >= 0) & (ids < len(self.widths))
        known[known] = self.widths[ids[known]] > 0
        ids = np.where(known, ids, 0)
        sizes = np.where(known, self.widths[ids], 0).astype(np.int64)
        stops = np.cumsum(sizes)
        data = self.blob[np.repeat(self.places[ids] - (stops - sizes), sizes) + np.arange(int(sizes.sum()))].tobytes()
        borders = np.concatenate(([0], stops))[ends].tolist()
        unknown = np.concatenate(([0], np.cumsum(~known)))[ends]
        whole = (np.diff(unknown) == 0).tolist()
        return [data[x:y] if ok else None for x, y, ok in zip(borders, borders[1:], whole)]

    def pieces(self, ids: list[int]) -> list[str] | None:
        """The text that each token completes."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        try:
            out = [reader.decode(self.tokens[i]) for i in ids]
        except KeyError:
            return None
        if out:
            out[-1] += reader.decode(b"", True)
        return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def chunks(text: str) -> list[tuple[int, int]]:
    """Parts of about ``BATCH_CHARS``, cut before white space that follows something else."""
    out, start = [], 0
    while len(text) - start > BATCH_CHARS:
        found = _CUT.search(text, start + BATCH_CHARS)
        if found is None:
            break
        out.append((start, found.start()))
        start = found.start()
    return [*out, (start, len(text))]


def public_vocabulary(ranks: str = RANKS) -> tuple[str, str]:
    """Path of a public vocabulary and its split pattern."""
    import public_tokenizers

    return public_tokenizers.path(ranks), public_tokenizers.PATTERN


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int32, copy=False)))


def flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of lists, and the borders of the lists; null lists are empty."""
    if lists.null_count:
        lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32()))
    ends = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.slice(int(ends[0]), int(ends[-1] - ends[0]))
    return values.fill_null(-1).to_numpy(zero_copy_only=False), ends - ends[0]


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Key, ``ids``, and per token ``byte_start`` and ``char_start``."""
    own_path, own_pattern = public_vocabulary()
    path, pattern = path or own_path, pattern or own_pattern
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(f"`{text}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for whole in batches:
            for batch, _, _ in slices_by_size(whole, 1, SLICE_BYTES):
                texts = batch.column("text").to_pylist()
                ids, byte_starts, char_starts = [], [], []
                for t, found in zip(texts, tool.encode(texts)):
                    starts = np.cumsum(tool.widths[found], dtype=np.int32) - tool.widths[found]
                    data = np.frombuffer(t.encode(), np.uint8)
                    # Character of each byte: one less than the lead bytes up to it.
                    character = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32) - 1
                    ids.append(found)
                    byte_starts.append(starts)
                    char_starts.append(character[starts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), _lists(ids), _lists(byte_starts), _lists(char_starts)],
                    ["key", "ids", "byte_start", "char_start"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(work, f"key {kind}, ids array<int>, byte_start array<int>, char_start array<int>")
    return out.withColumnRenamed("key", key)


def decode(
    rows: DataFrame, ids: str = "ids", path: str | None = None, pattern: str | None = None, pieces: bool = False
) -> DataFrame:
    """``rows`` with ``decoded`` (bytes), and where asked for ``pieces``, the text that
    each token completes."""
    own_path, own_pattern = public_vocabulary()
    path, pattern = path or own_path, pattern or own_pattern
    new = [StructField("decoded", BinaryType())]
    if pieces:
        new.append(StructField("pieces", ArrayType(StringType())))
    kept = [c for c in rows.columns if c not in {f.name for f in new}]
    given = rows.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                part = batch.slice(start, ROWS)
                ids_at, ends = flat(part.column(at))
                columns = [*part.columns, pa.array(tool.decode(ids_at, ends), pa.binary())]
                if pieces:
                    texts = [tool.pieces(ids_at[x:y].tolist()) for x, y in zip(ends, ends[1:])]
                    columns.append(pa.array(texts, pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *[f.name for f in new]])

    return given.mapInArrow(work, StructType([*given.schema.fields, *new]))
