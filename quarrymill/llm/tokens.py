"""Token ids of whole texts, kept in ORC files and read back.

Text is encoded by the `tokenizers` library's model.  White space separates pre-tokens and is dropped by the
vocabularies used here, so that the ids of a text are those of its chunks between white space, in order; each worker
keeps the ids of chunks and pre-tokens that it has seen, in tables of bounded size.

Edge cases: a null or empty text has no ids but the end id; documents with equal ids (or a null one, which comes first)
are kept as rows of their own, in the order of their texts; other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrymill.llm.work import WORKER_TABLES, Work, shared_dir, table

END_ID = 2
CHUNKS = 250_000
VOCABULARY = "word_bpe_49k.json"

#: White space by the Unicode property; str.split() takes four separators more.
_WHITE = (*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
_SPACE = re.compile("[" + "".join(map(chr, _WHITE)) + "]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def chunks(text: str) -> list[str]:
    """The runs of characters between white space."""
    if _SEPARATORS.search(text):
        return [x for x in _SPACE.split(text) if x]
    return text.split()


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next letter from U+0100 on."""
    out, spare = [], 0x100
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Pretokenizer:
    """What comes before the merges of a vocabulary like `word_bpe_49k.json`: special tokens, NFC, lower case, a split."""

    def __init__(self, spec: dict, path: str):
        import regex

        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: only NFC, white space and lower case, then a split, are implemented")
        if not model["end_of_word_suffix"] or model["dropout"] or spec.get("decoder"):
            raise ValueError(f"{path}: only vocabularies with word ends, without dropout and decoder are implemented")
        self.split = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.marked = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.letters = dict(enumerate(byte_letters()))

    def pieces(self, chunk: str) -> list[str | int] | tuple[str, ...]:
        """Pre-tokens of a text without white space, and the ids of special tokens in it."""
        low = chunk.lower()
        if low.isascii() or (unicodedata.is_normalized("NFC", chunk) and "\u03a3" not in chunk):
            # most are letters, or letters and one other character
            if low.isalpha():
                return (low,)
            if low[:-1].isalpha():
                return low[:-1], low[-1]
        if self.marked is None or not self.marked.search(chunk):
            return self._plain(chunk)
        out: list[str | int] = []
        for part in self.marked.split(chunk):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._plain(part)
        return out

    def _plain(self, part: str) -> list[str]:
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
        # letter by letter, the library knows no final sigma
        return self.split("".join(c.lower() for c in part) if "\u03a3" in part else part.lower())

    def in_letters(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece
        return piece.encode().decode("latin-1").translate(self.letters)


class _Generations(dict):
    """Values by key, made when first met.  When it is full it becomes the older of two generations, whose entries are
    kept on if they are met again."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class _Pieces(_Generations):
    """Ids of pre-tokens, as bytes."""

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            letters = piece if piece.isascii() and piece.isprintable() else self.make(piece)
            found = array("I", [t.id for t in self.tokenize(letters)]).tobytes()
        self[piece] = found
        return found


class _Chunks(_Generations):
    """Ids of chunks, as bytes; ASCII words, alone or before one other character, are their own pre-tokens."""

    def __missing__(self, chunk: str) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            low = chunk.lower()
            if not low.isascii():
                found = self.make(chunk)
            elif low.isalpha():
                found = self.pieces[low]
            elif low[:-1].isalpha():
                found = self.pieces[low[:-1]] + self.pieces[low[-1]]
            else:
                found = self.make(chunk)
        self[chunk] = found
        return found


class Encoder:
    """Little-endian unsigned 32-bit ids of texts, from the library's model for each pre-token not seen before."""

    _by_path: dict[str, Encoder] = {}
    WORKER_TABLES.append(_by_path)

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.before = Pretokenizer(spec, path)
        self.pieces = _Pieces(self.before.in_letters, CHUNKS)
        self.pieces.tokenize = self.model.tokenize
        self.chunks = _Chunks(self._chunk, CHUNKS)
        self.chunks.pieces = self.pieces

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One for each Python worker."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def _chunk(self, chunk: str) -> bytes:
        found = self.before.pieces(chunk)
        if type(found) is tuple:
            return self.pieces[found[0]] if len(found) == 1 else self.pieces[found[0]] + self.pieces[found[1]]
        return b"".join([array("I", [x]).tobytes() if isinstance(x, int) else self.pieces[x] for x in found])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        get = self.chunks.__getitem__
        out = []
        for text in texts:
            out.append(b"".join(map(get, chunks(text))) if text else b"")
            self.chunks.turn()
            self.pieces.turn()
        return out


def text_parts(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch where its texts reach a size."""
    total, start = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        total += int(n)
        if total > size:
            yield batch.slice(start, i + 1 - start)
            total, start = 0, i + 1
    if start < batch.num_rows:
        yield batch.slice(start)


TOKEN_SCHEMA = "doc_id bigint, part int, at bigint, n_tokens bigint, ids array<int>"


def write_token_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Writes `documents` as ORC of TOKEN_SCHEMA in ascending order of doc_id: files in order, rows in order.

    `part` is the file's place and `at` the ids before the row in its file.  Ids are integer columns, which ORC keeps
    run-length encoded (and not compressed further) in stripes that readers take in parallel; row indexes and Bloom filters on doc_id let a reader
    that looks for some documents skip stripes and row groups.
    """
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = Encoder.of(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in text_parts(whole, "text"):
                found = [x + end for x in encoder.encode(batch.column("text").to_pylist())]
                lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
                starts = np.concatenate([[0], np.cumsum(lengths)])
                values = pa.Array.from_buffers(pa.int32(), int(starts[-1]), [None, pa.py_buffer(b"".join(found))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(np.full(len(found), part, np.int32)), pa.array(at + starts[:-1]),
                        pa.array(lengths), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values),
                    ],
                    ["doc_id", "part", "at", "n_tokens", "ids"],
                )
                at += int(starts[-1])

    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").repartitionByRange("doc_id")
    (
        ordered.sortWithinPartitions("doc_id", "text").mapInArrow(run, TOKEN_SCHEMA).write
        .option("compression", "none").option("orc.create.index", "true").option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20)).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; a filter on doc_id is pushed down to stripes, row groups and Bloom filters."""
    return spark.read.schema(TOKEN_SCHEMA).orc(path)


def digests(rows: DataFrame) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32.

    A file's ids before it are the sum over earlier files: one row per file is summed in one task and broadcast, which
    is as many rows as the files' writing had tasks.
    """
    per_file = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_file.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            bounds = (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
            data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            crc = [zlib.crc32(data[a:b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "part", "at")] + [
                    pa.array(np.diff(bounds) // 4, pa.int64()), pa.array(crc, pa.int64())
                ], ["doc_id", "part", "at", "n_tokens", "ids_crc32"],
            )

    read = rows.select("doc_id", "part", "at", "ids").mapInArrow(
        run, "doc_id bigint, part int, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return read.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents' ids and returns the digests of what the files hold."""
    work = Work(spark, "token-ids")
    path = f"{work.root}/orc"
    write_token_ids(table(spark, sf_dir, "documents"), path)
    work.release()
    return work.result(digests(read_token_ids(spark, path)))


__all__ = ["Encoder", "digests", "op5", "read_token_ids", "shared_dir", "write_token_ids"]
