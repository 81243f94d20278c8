"""SentencePiece encoding and decoding with a table of distinct chunks.

Where no piece of a model has a white-space marker after another character, no piece can cross from one
marked word (a run of markers and what follows up to the next) into another, so a text's ids are the ids of
its marked words in order. The marked words of the corpus go into one table, in which each is segmented once.

Texts are not shuffled to meet that table: a task numbers the different marked words of a block of texts and writes the
block as numbers. The table is dealt by hashes of its words. A block asks each part that it has words of for their ids, in
one packed row; the task of a part segments what is there once, whichever blocks ask for it, and answers each in the order
of its question; the ids go back into the block by position. Blocks have a bounded number of words and parts a bounded
number of questions, and a block never asks more parts than it has words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, pieces, texts

MARK = "▁"
#: Marked words of a block; a longer text is a block of its own.
BLOCK_WORDS = 4_000_000
#: Questions for words that a part of the table gets from all blocks.
PART_WORDS = 500_000
CHUNKS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class ChunkEncoder:
    """The library's model at path, and the marked words of texts."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces_ = [self.lib.id_to_piece(k) for k in range(self.lib.get_piece_size())]
        # a model whose pieces cross marked words, or that changes texts before it cuts them, has no chunks to share
        crossing = any(MARK in p.lstrip(MARK) for p in pieces_)
        plain = all(self.lib.normalize(x) == MARK + x.replace(" ", MARK) for x in ("a  b ", " \t x", "ÅÅ ﬁ"))
        self.shared = plain and not crossing
        self.mark = self.lib.piece_to_id(MARK)
        self.pieces, self.ids = pieces_, {p: k for k, p in enumerate(pieces_)}

    def segment(self, words: list[str]) -> list[tuple[int, list[int], str]]:
        """Of each marked word, given without its first marker: number of ids, ids, decoded."""
        found = self.lib.encode(words, num_threads=1)
        found = [ids if word else [self.mark] for word, ids in zip(words, found, strict=True)]
        return [(len(ids), ids, text) for ids, text in zip(found, self.lib.decode(found), strict=True)]

    def cuts(self, word: str, ids: list[int]) -> list[int] | None:
        """The lengths of a word's pieces, from which spelt() has its ids again; None if it has other ones."""
        cuts = [len(self.pieces[k]) for k in ids]
        return cuts if self.spelt(word, cuts) == ids else None

    def spelt(self, word: str, cuts: list[int]) -> list[int]:
        marked, at, out = MARK + word, 0, []
        for n in cuts:
            out.append(self.ids.get(marked[at : at + n], -1))
            at += n
        return out

    def words(self, text: str) -> list[str]:
        """The marked words of a text, each without its first marker."""
        if not text:
            return []
        if "  " not in text and MARK not in text and text[0] != " ":
            return text.split(" ")
        return [x[1:] for x in CHUNKS.findall(MARK + text.replace(" ", MARK))]

    def whole(self, batch: list[str]) -> list[tuple[int, str, str]]:
        """Of whole texts: number of ids, ids joined by commas, decoded."""
        ids = self.lib.encode(batch, num_threads=1)
        return [(len(x), ",".join(map(str, x)), y) for x, y in zip(ids, self.lib.decode(ids), strict=True)]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def output(digest: bool) -> tuple[str, list[str], list[pa.DataType]]:
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids array<int>, decoded string"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()] if digest else [pa.int64(), pa.list_(pa.int32()), pa.string()]
    return schema, [x.split()[0] for x in schema.split(", ")], kinds


def arranged(rows: list[tuple[int, str, str]], digest: bool) -> list[tuple]:
    """(number of ids, ids, decoded) as the columns of the output but doc_id."""
    if digest:
        return [(n, *(hashlib.sha256(x.encode()).hexdigest() for x in found)) for n, *found in rows]
    return [(list(map(int, ids.split(","))) if n else [], text) for n, ids, text in rows]


BLOCK = "block long, ids array<long>, sizes binary, numbers binary, words binary, n_words long"
BLOCK_ARROW = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 3, pa.int64()]
ASK = "part int, block long, words binary"
ANSWER = "part int, asked long, sizes binary, cuts binary, unlike binary, ids binary, others binary, decoded binary"
#: What the tables and exchanges take on disk counts for more than the seconds of a higher level.
LEVEL = 12


def squeeze(values) -> bytes:
    """Unsigned 32-bit integers by byte planes, compressed."""
    planes = np.asarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=LEVEL).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def squeeze_texts(values: list[str]) -> bytes:
    raw = [v.encode() for v in values]
    sizes = squeeze([len(r) for r in raw])
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(raw))


def unsqueeze_texts(data: bytes) -> list[str]:
    at = 4 + int.from_bytes(data[:4], "little")
    sizes, raw = unsqueeze(data[4:at]), zstandard.ZstdDecompressor().decompress(data[at:])
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [raw[a:b].decode() for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def arranged_words(words: list[str], counts: np.ndarray) -> np.ndarray:
    """The words' places in the order in which they are numbered: frequent ones first, as small numbers take less room, and of about
    the same frequency by their letters, as sorted words take less room."""
    alphabetic = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    return alphabetic[np.argsort(-np.frexp(counts[alphabetic])[1], kind="stable")]


def dealt(words: list[str], parts: int) -> list[tuple[int, list[int]]]:
    """The parts of the table that have some of the words, with the places of these, sorted by word. parts is a power of two."""
    own: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        own.setdefault(xxhash.xxh32_intdigest(w) & (parts - 1), []).append(k)
    return [(part, sorted(places, key=words.__getitem__)) for part, places in sorted(own.items())]


def word_blocks(docs: DataFrame, model: str, block_words: int) -> DataFrame:
    """Blocks of documents: their ids, how many marked words each has, the words as numbers, and the different words."""
    names = [x.split()[0] for x in BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, block = encoder(model), TaskContext.get().partitionId() << 32
        ids, sizes, numbers, table = [], [], [], {}

        def row() -> pa.RecordBatch:
            found, words = np.array(numbers, np.int64), list(table)
            order = arranged_words(words, np.bincount(found, minlength=len(table)))
            rank = np.empty(len(table), np.int64)
            rank[order] = np.arange(len(table))
            values = [block, ids, squeeze(sizes), squeeze(rank[found]), squeeze_texts([words[k] for k in order.tolist()]), len(words)]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, BLOCK_ARROW, strict=True)], names)

        for batch in pieces(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = codec.words(text)
                ids.append(doc_id)
                sizes.append(len(words))
                numbers.extend([table.setdefault(w, len(table)) for w in words])
                if len(numbers) >= block_words:
                    yield row()
                    block += 1
                    ids, sizes, numbers, table = [], [], [], {}
        if ids:
            yield row()

    return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCK)


def ask(blocks: DataFrame, parts: int) -> DataFrame:
    """A row for each block and part of the table that the block has words of."""
    names = [x.split()[0] for x in ASK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            words = unsqueeze_texts(row["words"])
            out = [(part, row["block"], squeeze_texts([words[k] for k in at])) for part, at in dealt(words, parts)]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return blocks.select("block", "words").mapInArrow(run, ASK)


def answer(asked: DataFrame, model: str) -> DataFrame:
    """The ids of the words, and what they decode to where that is another text, in the order in which a block has asked.
    Each word of a part is segmented once. Ids go as lengths of pieces, which take less room, but for words that their pieces do not
    spell."""
    names = [x.split()[0] for x in ANSWER.split(", ")]

    def run(group: pa.Table) -> pa.Table:
        rows = [(r["part"], r["block"], unsqueeze_texts(r["words"])) for r in group.to_pylist()]
        words = sorted({w for _, _, own in rows for w in own})
        codec = encoder(model)
        table = {w: (n, ids, text, codec.cuts(w, ids)) for w, (n, ids, text) in zip(words, codec.segment(words), strict=True)}
        out = []
        for part, block, own in rows:
            found = [table[w] for w in own]
            unlike = [k for k, (_, _, _, cuts) in enumerate(found) if cuts is None]
            cuts = np.fromiter((x for _, ids, _, own_cuts in found for x in (own_cuts or [0] * len(ids))), np.uint32)
            ids = np.fromiter((x for k in unlike for x in found[k][1]), np.uint32)
            other = [k for k, (w, (_, _, text, _)) in enumerate(zip(own, found, strict=True)) if text != w]
            packed = [[n for n, *_ in found], cuts, unlike, ids, other]
            out.append((part, block, *map(squeeze, packed), squeeze_texts([found[k][2] for k in other])))
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 6)
        return pa.Table.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return asked.groupBy("part").applyInArrow(run, ANSWER)


def encode_and_decode(docs: DataFrame, model: str, digest: bool = False, block_words: int = BLOCK_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """Encodes each text of docs(doc_id, text) with the SentencePiece model at path model and decodes the ids.

    Returns one row per input row: doc_id, ids (array of int) and decoded; with digest instead n_tokens,
    ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 (of the decoded text in UTF-8).

    A null text is empty and has no ids. A null doc_id and repeated rows are kept as they are; other columns
    are ignored. An empty table gives no rows. The model file must be at the same path on every executor. Texts go to
    the library whole if the model's pieces cross marked words.
    """
    schema, names, kinds = output(digest)

    def table(ids: list, rows: list[tuple]) -> list[pa.Array]:
        return [pa.array(ids, kinds[0]), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds[1:]))]

    if not encoder(model).shared:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                rows = arranged(encoder(model).whole(batch.column(1).to_pylist()), digest)
                yield pa.RecordBatch.from_arrays(table(batch.column(0).to_pylist(), rows), names)

        return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)

    work = Work(docs.sparkSession, "sentencepiece")
    blocks = work.save(word_blocks(docs, model, block_words), "blocks")
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    parts = 1 << max(4, (max(1, total // part_words) - 1).bit_length())
    # read once, so only the exchange has it
    answers = answer(ask(blocks, parts), model)

    def back(block: pa.Table, found: pa.Table) -> pa.Table:
        (row,) = block.to_pylist()
        codec, words = encoder(model), unsqueeze_texts(row["words"])
        decoded, ids, n = np.empty(len(words), object), np.empty(len(words), object), np.zeros(len(words), np.int64)
        decoded[:] = words
        places = dict(dealt(words, parts))
        for r in found.to_pylist():
            at, sizes, cuts = np.array(places[r["part"]]), unsqueeze(r["sizes"]), unsqueeze(r["cuts"]).tolist()
            n[at] = sizes
            ends = np.cumsum(sizes, dtype=np.int64).tolist()
            for k, start, end in zip(at.tolist(), [0, *ends[:-1]], ends, strict=True):
                ids[k] = ",".join(map(str, codec.spelt(words[k], cuts[start:end])))
            given, start = unsqueeze(r["ids"]).tolist(), 0
            for k in unsqueeze(r["unlike"]).tolist():
                end = start + int(sizes[k])
                ids[at[k]], start = ",".join(map(str, given[start:end])), end
            for k, text in zip(at[unsqueeze(r["others"])].tolist(), unsqueeze_texts(r["decoded"]), strict=True):
                decoded[k] = text
        numbers, ends = unsqueeze(row["numbers"]), np.cumsum(unsqueeze(row["sizes"]), dtype=np.int64)
        rows = []
        for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            at = numbers[start:end]
            # a marked word decodes without the marker in front, which stands for the space before it
            rows.append((int(n[at].sum()), ",".join(ids[at]), " ".join(decoded[at])))
        return pa.Table.from_arrays(table(row["ids"], arranged(rows, digest)), names)

    return blocks.drop("n_words").groupBy("block").cogroup(answers.groupBy("asked")).applyInArrow(back, schema)
