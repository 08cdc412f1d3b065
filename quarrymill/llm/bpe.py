"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token there is exactly one token that ends its encoding.  An automaton over the vocabulary
gives, at each place, the tokens that end there; the one whose left neighbour (the last token of the prefix before it)
may stand beside it is stored, and following the stored tokens from the end gives the ids.  No merge is ever carried
out, and the work grows with the length of a text, not with its square.

Two tokens may stand side by side if no merge across their border would come before the merges that built them.  Merge
ranks rise with every merge that builds on another (checked when a vocabulary is read), so that the pieces beside the
border can be walked back in time, from the tokens to their first symbols.

Edge cases: a null or empty text has no ids and decodes to an empty text; repeated rows, and rows with equal or null ids,
are encoded each by itself; very long texts are encoded whole, as one row like others; other columns do not matter; an
empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.tokens import CHUNKS, Pretokenizer, _Generations, chunks, default_vocabulary, text_parts
from quarrymill.llm.work import WORKER_TABLES, table

_LAST = 0x400
_NEVER = 1 << 60


class PrefixEncoder:
    """Encoder of vocabularies with byte letters, word ends and the pre-tokenization of `word_bpe_49k.json`."""

    _by_path: dict[str, PrefixEncoder] = {}
    WORKER_TABLES.append(_by_path)

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.before = Pretokenizer(spec, path)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.before.special.items()}

        def symbols(token: str) -> str:
            word = token.removesuffix(suffix)
            return word if word == token else word[:-1] + chr(ord(word[-1]) + _LAST)

        vocab = model["vocab"]
        size = max(vocab.values()) + 1
        self.length = [0] * size
        self.made, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.rank: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            if max(self.made[x], self.made[y]) >= rank or self.made[made] >= 0:
                raise ValueError(f"{path}: a merge comes before what it joins, or makes a token again")
            self.made[made], self.left[made], self.right[made], self.rank[x, y] = rank, x, y, rank
        self.automaton = ahocorasick.Automaton()
        whole: set[int] = set()
        for token, i in sorted(vocab.items(), key=lambda x: self.made[x[1]]):
            a, b, at = self.left[i], self.right[i], self.made[i]
            # a token's own letters must encode to it, else it ends no prefix
            if at < 0 or (a in whole and b in whole and self._apart(a, b, at)):
                whole.add(i)
                self.length[i] = len(symbols(token))
                self.automaton.add_word(symbols(token), i)
        self.automaton.make_automaton()
        self.beside: dict[int, bool] = {}
        self.pieces = _Generations(self._letters, CHUNKS)
        self.texts = _Generations(self._texts, CHUNKS // 2)

    @classmethod
    def of(cls, path: str) -> PrefixEncoder:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def _apart(self, x: int, y: int, until: int = _NEVER) -> bool:
        """Whether x and y, side by side, stay apart: for ever, or until the merge of that rank takes them both."""
        made, ranks = self.made, self.rank
        x_until = y_until = until
        while True:
            # they meet until the earlier of the merges that take them up; of equal merges the left one goes first
            rank = ranks.get((x, y))
            if rank is not None and rank < x_until and rank <= y_until:
                return False
            if made[x] > made[y]:
                x_until, x = made[x], self.right[x]
            elif made[y] >= 0:
                y_until, y = made[y], self.left[y]
            else:
                return True

    def piece(self, letters: str) -> list[int]:
        """Ids of one pre-token in byte letters, the last of which is marked."""
        last = [-1] * len(letters)
        length, beside = self.length, self.beside
        for end, token in self.automaton.iter(letters):
            if last[end] < 0:
                before = end - length[token]
                if before < 0:
                    last[end] = token
                else:
                    left = last[before]
                    pair = left << 32 | token
                    stands = beside.get(pair)
                    if stands is None:
                        stands = beside[pair] = self._apart(left, token)
                    if stands:
                        last[end] = token
        if len(beside) > 1_000_000:
            beside.clear()
        out, i = [], len(letters) - 1
        while i >= 0:
            out.append(last[i])
            i -= length[last[i]]
        return out[::-1]

    def _letters(self, piece: str) -> list[int]:
        letters = self.before.in_letters(piece)
        return self.piece(letters[:-1] + chr(ord(letters[-1]) + _LAST))

    def chunk(self, text: str) -> list[int]:
        """Ids of a text without white space."""
        out: list[int] = []
        for piece in self.before.pieces(text):
            if isinstance(piece, int):
                out.append(piece)
            else:
                out += self.pieces[piece]
        return out

    def _texts(self, chunk: str) -> tuple[str, str]:
        """Ids in decimal, and their decoding."""
        ids = self.chunk(chunk)
        return " ".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str | None) -> list[int]:
        return [i for c in chunks(text or "") for i in self.chunk(c)]

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: the tokens' own names, between single blanks."""
        return " ".join(self.names[i] for i in ids)


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per document: doc_id, text, ids and the decoding of the ids."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PrefixEncoder.of(vocabulary)
        for whole in batches:
            for batch in text_parts(whole, "text", 1 << 20):
                ids = [encoder.encode(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(ids, pa.list_(pa.int32())),
                     pa.array([encoder.decode(x) for x in ids], pa.string())], ["doc_id", "text", "ids", "decoded"]
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, text string, ids array<int>, decoded string"
    )


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256; by the ids and decodings of chunks seen before."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PrefixEncoder.of(vocabulary)
        get = encoder.texts.__getitem__
        for whole in batches:
            for batch in text_parts(whole, "text"):
                counts, ids_sha, texts_sha = [], [], []
                for text in batch.column("text").to_pylist():
                    found = list(map(get, chunks(text or "")))
                    ids, back = " ".join([x for x, _ in found]), " ".join([x for _, x in found])
                    encoder.texts.turn()
                    encoder.pieces.turn()
                    counts.append(ids.count(" ") + 1 if ids else 0)
                    ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                    texts_sha.append(hashlib.sha256(back.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                     pa.array(texts_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
