"""Packing of tokenised documents into sequences: first-fit decreasing with a tournament tree.

Tokens are counted on the cluster. A document longer than a sequence is cut there; each whole sequence
stands for itself, and the remainders are packed. Remainders are dealt at random (by hash of their row)
into groups of about ``group_pieces``, and each group is packed alone: largest piece first, each into the
first bin with room, found in a tournament tree whose nodes hold the largest room below. Groups are small
and bounded, so no task depends on the size of the table, and with thousands of pieces of all sizes
hardly any room is lost. Where the documents have an order to keep, groups are dealt within runs of it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from stepmill.llm.common import fresh, text_of, with_position
from stepmill.session import materialise, quoted

#: Chunks, and words, whose ids a task remembers at most.
REMEMBERED = 700_000
#: How this vocabulary cuts lower-case chunks into words.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Byte-level vocabularies write printable bytes as themselves and the others from code point 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}


class Encoder(dict):
    """Token ids of whole texts, as unsigned 32-bit bytes, by remembering the ids of blank-free chunks.

    For tokenizers that drop white space and never look across it (as the vocabulary used here), the ids of
    a text are those of its chunks in a row. Chunks are cut at the six ASCII blanks only. Chunks of ASCII
    and Latin-1 letters go to the vocabulary's merges word by word; any other chunk (other scripts,
    combining marks, special tokens) goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        for text in texts:
            parts = []
            for at, end in _cuts(text, 1 << 20):
                if len(self) > REMEMBERED:
                    self.clear()
                parts.append(b"".join(map(self.__getitem__, text[at:end].split())))
            yield parts[0] if len(parts) == 1 else b"".join(parts)

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            ids = b"".join(map(self._word, _WORDS.findall(text.lower())))
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[chunk] = ids
        return ids

    def _word(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            if len(self.words) > REMEMBERED:
                self.words.clear()
            shown = word if word.isascii() else "".join(map(_SHOWN.__getitem__, word.encode("utf-8")))
            known = self.words[word] = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        return known


def _cuts(text: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end at blanks."""
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield at, end
        at = end


def pieces(docs: DataFrame, encoder: Callable[[], Callable[[list[bytes]], Iterator[bytes]]], *, text: str = "text", length: int = 2048, end_id: int | None = 1, with_ids: bool = False) -> DataFrame:
    """Each document as pieces of at most ``length`` ids: ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, and ``ids`` if asked for.

    A null text counts as empty; a document of no ids at all gives no piece. ``encoder`` makes, in each task,
    a function from texts (UTF-8) to their ids (little-endian 32-bit). Other columns of ``docs`` stay,
    but those of the added names.
    """
    added = ["start", "length", "ids_crc32", "doc_tokens", "ids"]
    others = [c for c in docs.columns if c.lower() not in added]
    source = fresh(docs, "_text")
    schema = docs.select(*[quoted(c) for c in others]).schema
    for name in added[:4]:
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                take, start, size, check, total, ids = [], [], [], [], [], []
                for row, data in enumerate(encode(batch.column(len(others)).to_pylist())):
                    data += tail
                    for first in range(0, len(data), 4 * length):
                        part = data[first : first + 4 * length]
                        take.append(row)
                        start.append(first // 4)
                        size.append(len(part) // 4)
                        check.append(zlib.crc32(part))
                        total.append(len(data) // 4)
                        if with_ids:
                            ids.append(np.frombuffer(part, "<i4"))
                kept = batch.select(list(range(len(others)))).take(pa.array(take, pa.int64()))
                columns = [*kept.columns, *[pa.array(x, pa.int64()) for x in (start, size, check, total)]]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=others + added[: 5 if with_ids else 4])

    return docs.select(*[quoted(c) for c in others], text_of(text).cast("binary").alias(source)).mapInArrow(cut, schema)


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces of equal size go in the given order."""
    count = len(sizes)
    leaves = 1 << max(0, (count - 1).bit_length())
    tree = [room] * (2 * leaves)  # tree[1] is the root; a node holds the largest room below it
    bins, offsets = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node = 2 * node if tree[2 * node] >= size else 2 * node + 1
        bins[i], offsets[i] = node - leaves, room - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            most = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == most:
                break
            tree[node] = most
    return bins, offsets


def packed(cut: DataFrame, *, length: int = 2048, group_pieces: int = 8192, order: Sequence[str] = (), window: int = 4) -> DataFrame:
    """Pieces (with ``length``) get ``sequence_id`` and ``offset``, gapless from 0 within each sequence.

    Pieces are dealt to random groups, each packed for itself. With ``order`` (columns; ties in any order) only the
    ``window`` groups of a run of pieces are dealt at random, and the sequences of a run come before those of
    later ones: a prefix of sequences holds a prefix of the pieces, to one run. Sequence ids are unique, not
    gapless. Pieces of ``length`` ids are sequences of their own. Empty table: no rows. Existing columns
    of the two names are replaced, all others stay.
    """
    others = [c for c in cut.columns if c.lower() not in ("sequence_id", "offset")]
    kept = cut.select(*[quoted(c) for c in others])
    row, group = fresh(kept, "_row"), fresh(kept, "_group")
    schema = StructType([*kept.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    if order:
        # Landed before it is sorted, or the sort's look at its bounds would cut the texts a second time.
        held = with_position(materialise(kept, "pieces"), [F.col(quoted(c)) for c in order], row)
        number, stride = F.expr(f"`{row}` div {window * group_pieces}") * window + F.pmod(F.xxhash64(row), F.lit(window)), window
        parts = held
    else:
        held = materialise(kept.withColumn(row, F.monotonically_increasing_id()), "pieces")
        parts = held.filter(F.col("length") < length)
        groups = max(1, -(-parts.count() // group_pieces))
        number, stride = F.pmod(F.xxhash64(row), F.lit(groups)), groups

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by(row)  # the same packing in every run
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), length)
        of = key[0].as_py()
        # A run's groups have no more bins than it has pieces.
        ids = of // window * (window * window * group_pieces) + bins * window + of % window if order else (bins * stride + of) * 2
        return table.select(others).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    small = parts.withColumn(group, number).groupBy(group).applyInArrow(fit, schema)
    if order:
        return small
    whole = held.filter(F.col("length") >= length).select(
        *[quoted(c) for c in others], (F.col(row) * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return small.unionByName(whole)


def sequences(placed: DataFrame, pad_id: int = 0, length: int = 2048) -> DataFrame:
    """Pieces with ``ids`` joined to ``sequence_id``, ``ids``, padded to ``length`` unless their number is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    size = F.size("ids")
    power = size.bitwiseAND(size - 1) == 0
    padded = F.slice(F.concat("ids", F.array_repeat(F.lit(pad_id), length)), 1, length)
    return joined.withColumn("ids", F.when(power, F.col("ids")).otherwise(padded))
