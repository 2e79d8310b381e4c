"""Byte-level BPE encoding and decoding.

A rank file (base64 token, rank) becomes a sentencepiece BPE model: each byte is one private character, each
token one piece whose score is its negative rank, and the normalisation is the identity. Sentencepiece then merges the
adjacent pair of best rank first, leftmost on ties, which is what byte-level BPE means. Texts are cut into
pre-tokens by a pattern; each pre-token is encoded alone; decoding maps ids back to bytes.

Defined results: a null text counts as empty; an empty text has no ids, n_tokens 0, and the hashes of the empty string.
Lone surrogates can't occur in Spark strings. Rows stay rows: repeated rows give repeated results, and extra
columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tractlake.llm.common import chunks, table

#: The pattern's white space, as tiktoken's engine reads it (the Unicode property, without the separators 1C-1F).
SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
#: A cache of encoded words holds so many entries at most; beyond that, new ones are encoded again each time.
CACHE_ENTRIES = 600_000
#: Documents whose unknown words are encoded in one call.
DOCS_A_CALL = 128

_codecs: dict[tuple[str, str], "ByteBPE"] = {}


class _Cache(dict):
    """Holds encoded strings up to CACHE_ENTRIES; the rest lives for one call only, in extra."""

    def __init__(self) -> None:
        super().__init__()
        self.extra: dict[str, str] = {}

    def __missing__(self, key: str) -> str:
        return self.extra[key]

    def put(self, key: str, value: str) -> None:
        if len(self) < CACHE_ENTRIES and len(key) <= 64:
            self[key] = value
        else:
            self.extra[key] = value


class ByteBPE:
    """Encoder and decoder for one rank file and one pre-token pattern. Ids travel as decimal text joined by commas."""

    def __init__(self, rank_file: str, pattern: str) -> None:
        with open(rank_file, "rb") as lines:
            self.whole = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        self.bytes_of = {rank: token for token, rank in self.whole.items()}
        self.bytes_of_text = {str(rank): token for token, rank in self.whole.items()}
        by_rank = sorted(self.bytes_of)
        self.text_of_piece = ["", *map(str, by_rank)]
        self.private = {b: 0x100 + b for b in range(256)}
        proto = model_pb2.ModelProto()
        proto.pieces.add(piece="<unk>", score=0.0, type=model_pb2.ModelProto.SentencePiece.UNKNOWN)
        for rank in by_rank:
            proto.pieces.add(piece=self._mapped(self.bytes_of[rank]), score=-float(rank), type=model_pb2.ModelProto.SentencePiece.NORMAL)
        proto.trainer_spec.model_type = model_pb2.TrainerSpec.BPE
        proto.trainer_spec.vocab_size = len(by_rank) + 1
        proto.normalizer_spec.name = "identity"
        proto.normalizer_spec.add_dummy_prefix = False
        proto.normalizer_spec.remove_extra_whitespaces = False
        proto.normalizer_spec.escape_whitespaces = False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))
        self.cache = _Cache()

    def _mapped(self, token: bytes) -> str:
        """One character above U+0100 for each byte, so that no byte looks like white space."""
        return token.decode("latin-1").translate(self.private)

    def _encode_pretokens(self, words: list[str]) -> list[str]:
        """The ids of pre-tokens. A token of the vocabulary stands for itself; the others are merged."""
        raws = [x.encode() for x in words]
        todo = [i for i, raw in enumerate(raws) if raw not in self.whole]
        out = [str(self.whole.get(raw, "")) for raw in raws]
        name = self.text_of_piece.__getitem__
        for part in chunks(todo, 5000):
            for i, ids in zip(part, self.model.encode([self._mapped(raws[i]) for i in part], num_threads=1), strict=True):
                out[i] = ",".join(map(name, ids))
        return out

    def _learn(self, spans: list[str]) -> None:
        """Puts the ids of spans, " word" or the like, into the cache."""
        alone = [x for x in spans if x[0] == " " and x[1:].isalpha()]  # each is one pre-token
        for x, ids in zip(alone, self._encode_pretokens(alone), strict=True):
            self.cache.put(x, ids)
        mixed = {x: self.pattern.findall(x) for x in spans if not (x[0] == " " and x[1:].isalpha())}
        parts = list({p for found in mixed.values() for p in found})
        known = dict(zip(parts, self._encode_pretokens(parts), strict=True))
        for x, found in mixed.items():
            self.cache.put(x, ",".join([known[p] for p in found]))

    def _spans(self, text: str) -> list[str]:
        """Parts of a text that no pre-token crosses: cut before single spaces, or not at all."""
        if "  " in text:
            return [text]
        spans = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]
        return spans if spans[0] else spans[1:]

    def encode_text(self, texts: list[str]) -> list[str]:
        """For each text its ids, as decimal text."""
        split = [self._spans(x) for x in texts]
        self.cache.extra = {}
        cache = self.cache
        self._learn(list({x for spans in split for x in spans if x not in cache}))
        return [",".join(map(cache.__getitem__, spans)) for spans in split]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [[int(i) for i in x.split(",")] if x else [] for x in self.encode_text(texts)]

    def decode_text(self, ids: str) -> tuple[int, bytes]:
        """How many ids there are, and their bytes."""
        each = ids.split(",") if ids else []
        return len(each), b"".join(map(self.bytes_of_text.__getitem__, each))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec(rank_file: str, pattern: str) -> ByteBPE:
    """One codec for each Python worker."""
    key = (rank_file, pattern)
    if key not in _codecs:
        _codecs[key] = ByteBPE(rank_file, pattern)
    return _codecs[key]


def _parameters(rank_file: str | None, pattern: str | None) -> tuple[str, str]:
    return rank_file or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) for each row of docs(doc_id, text)."""
    key = _parameters(rank_file, pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(*key)
        for batch in batches:
            for part in chunks(list(range(len(batch))), DOCS_A_CALL):
                rows = batch.iloc[part]
                yield pd.DataFrame({"doc_id": rows["doc_id"], "ids": bpe.encode(list(rows["text"]))})

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, decoded binary) for each row of encoded(doc_id, ids); null ids count as none."""
    key = _parameters(rank_file, pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(*key)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "decoded": [bpe.decode(x if x is not None else ()) for x in batch["ids"]]})

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInPandas(run, "doc_id long, decoded binary")


def digest(docs: DataFrame, rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """Round trip of each text: doc_id, n_tokens, ids_sha256, decoded_sha256, without moving the ids out of the task."""
    key = _parameters(rank_file, pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(*key)
        for batch in batches:
            out = []
            for part in chunks(list(batch["text"]), DOCS_A_CALL):
                for ids in bpe.encode_text(part):
                    n, raw = bpe.decode_text(ids)
                    out.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": [x[0] for x in out], "ids_sha256": [x[1] for x in out], "decoded_sha256": [x[2] for x in out]})

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


QUERIES = {"op4_byte_bpe": op4_byte_bpe}
ORACLE: dict[str, str] = {}
