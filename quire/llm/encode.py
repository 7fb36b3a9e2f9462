"""Encoding of a corpus with a public byte-level BPE vocabulary.

A sentencepiece model is written directly from the rank file: piece `i` is the token of rank `i` with
every byte mapped to one printable character, its score is `-i`, so sentencepiece's best-score merge is
the lowest-rank merge of byte-level BPE.  The normaliser is the identity: no dummy prefix, no white
space escaping or removal.  One piece beyond the ranks is the unknown piece; byte coverage means that
it is never produced.  A text is cut by the vocabulary's pre-token pattern, each pre-token is
byte-mapped and encoded by itself, and ids are concatenated.  Decoding inverts the piece map.

Results: null and empty texts give an empty list; every other text, however long, gives ids whose
decoding is the text again.  Strings that look like special tokens are ordinary text.  Repeated rows
give repeated rows; only the two named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
import os
import struct
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pre-token pattern of the rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pre-tokens remembered by one Python worker; beyond it the memory starts anew.
MEMO = 200_000


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """Place of a vocabulary file: `folder`, else $QUIRE_TOKENIZERS, else /opt/tokenizers."""
    return os.path.join(folder or os.environ.get("QUIRE_TOKENIZERS", "/opt/tokenizers"), name)


def byte_letters() -> list[str]:
    """One printable character for each byte: itself where printable, else the next free one from U+0100."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(free)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, payload: bytes | int | float | str) -> bytes:
    """One protobuf field: varint for int, 32-bit for float, length-delimited for the rest."""
    if isinstance(payload, bool) or isinstance(payload, int):
        return _varint(number << 3) + _varint(int(payload))
    if isinstance(payload, float):
        return _varint(number << 3 | 5) + struct.pack("<f", payload)
    raw = payload.encode() if isinstance(payload, str) else payload
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a rank file (base64 token and rank on each line); ranks must be dense."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for tok, rank in pairs:
        tokens[int(rank)] = base64.b64decode(tok)
    return tokens


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto whose ids are the ranks of `tokens`, plus one unknown piece."""
    letters = byte_letters()
    unk = len(tokens)
    pieces = [_field(1, _field(1, "".join(letters[b] for b in t)) + _field(2, -float(i)) + _field(3, 1)) for i, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2)))
    # TrainerSpec: model_type BPE (3), vocab_size (4), unk_id (40); bos, eos, pad absent (-1)
    minus = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, unk + 1) + _field(40, unk) + _field(41, minus) + _field(42, minus) + _field(43, minus)
    # NormalizerSpec: identity, add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces off
    normal = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normal)


class Encoder:
    """Text to ids and back for one rank file."""

    def __init__(self, path: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.cut = regex.compile(PATTERN).findall
        self.map = {chr(b): c for b, c in enumerate(byte_letters())}
        self.table = str.maketrans(self.map)
        self.memo: dict[str, list[int]] = {}

    def _learn(self, new: list[str]) -> None:
        mapped = [w.encode("utf-8", "replace").decode("latin-1").translate(self.table) for w in new]
        self.memo.update(zip(new, self.model.encode(mapped, out_type=int, num_threads=1)))

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        cut = [self.cut(t) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list({w for ws in cut for w in ws}.difference(self.memo))
        if new:
            self._learn(new)
        get = self.memo.__getitem__
        return [[i for w in ws for i in get(w)] for ws in cut]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's own encoder; built once in each Python process."""
    return Encoder(path)


def ids_column(text: Column, path: str | None = None) -> Column:
    """Column of token ids (array<int>) of a text column."""
    path = path or tokenizer_path()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(encoder(path).encode_batch([t if isinstance(t, str) else None for t in texts]))

    return encode(text)


def count_column(text: Column, path: str | None = None) -> Column:
    """Column with the number of token ids (int) of a text column; 0 for null."""
    path = path or tokenizer_path()

    @F.pandas_udf(T.IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(x) for x in encoder(path).encode_batch([t if isinstance(t, str) else None for t in texts])], dtype="int32")

    return count(text)


def text_column(ids: Column, path: str | None = None) -> Column:
    """Inverse of `ids_column`: the text of a column of ids; null for null."""
    path = path or tokenizer_path()

    @F.pandas_udf(T.StringType())
    def decode(lists: pd.Series) -> pd.Series:
        d = encoder(path).decode
        return pd.Series([None if x is None else d(x) for x in lists], dtype=object)

    return decode(ids)


def encode(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """Rows `key, ids` for every row of `df`."""
    return df.select(F.col(key), ids_column(F.col(text), path).alias("ids"))
