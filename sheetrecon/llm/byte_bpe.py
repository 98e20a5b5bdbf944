"""Byte-level BPE encoding and decoding with the tokenizers library
(operator 4).

A rank file becomes a ``tokenizers`` BPE model over mapped characters (the
usual byte-to-character table). Texts are cut where no match of the split
pattern can cross, each distinct piece of a batch is encoded once, and decoding
goes back over the byte table, so characters that two tokens share come out
whole.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, release, text_bytes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Distinct pieces that a task keeps before it forgets all but those of the next step.
CACHE = 1 << 18
#: A blank before a character that is no white space starts a match of the
#: pattern, whatever comes before it.
PIECES = re.compile(r" (?=\S)")


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 characters
    stand for themselves, the others take the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The ``tokenizers`` model of a rank file.

    Every way to make a token of two others is a merge, in the order of the
    token's rank, as the rank rule allows each of them; a piece that is a token
    is taken whole.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    ranks = read_ranks(path)
    chars = byte_characters()
    name = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
    merges = [(name[t[:i]], name[t[i:]]) for t in sorted(ranks, key=ranks.get) if len(t) > 1
              for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    made = Tokenizer(models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    made.decoder = decoders.ByteLevel()
    return made


class Codec:
    """Encoder with a bounded cache of pieces, and decoder, of one rank file."""

    def __init__(self, path: str):
        self.model = tokenizer(path)
        # ids (32-bit) of pieces that start a text, and of those after a blank, which is left out
        self.heads: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.model.get_vocab()
        self.token_bytes: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(map(back.__getitem__, token))
        self.sizes = np.array([len(t) for t in self.token_bytes], np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [PIECES.split(text) for text in texts]
        if len(self.known) + len(self.heads) > CACHE:
            last = {p for pieces in cut for p in pieces[1:]}.intersection(self.known)
            self.known = {p: self.known[p] for p in last}
            self.heads.clear()
        known, heads = self.known, self.heads
        first = list({pieces[0] for pieces in cut}.difference(heads))
        for piece, found in zip(first, self.model.encode_batch_fast(first, add_special_tokens=False)):
            heads[piece] = np.array(found.ids, np.uint32).tobytes()
        new = list({p for pieces in cut for p in pieces[1:]}.difference(known))
        for at in range(0, len(new), 1 << 12):
            self.learn(new[at:at + (1 << 12)])
        return [np.frombuffer(heads[pieces[0]] + b"".join(map(known.__getitem__, pieces[1:])), np.uint32)
                for pieces in cut]

    def learn(self, pieces: list[str]) -> None:
        """Encode many pieces as one text: no token crosses their borders."""
        found = self.model.encode_batch_fast([" " + " ".join(pieces)], add_special_tokens=False)
        ids = np.array(found[0].ids, np.uint32)
        ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        cuts = 4 * (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1)
        data, at = ids.tobytes(), 0
        for piece, end in zip(pieces, cuts.tolist()):
            self.known[piece] = data[at:end]
            at = end

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def offsets(self, text: bytes, ids: np.ndarray) -> tuple[list[int], list[int]]:
        """Start byte of each token, and the character that this byte lies in (a
        token may start inside a character that the token before began)."""
        sizes = self.sizes[ids]
        starts = np.cumsum(sizes) - sizes
        begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        return starts.tolist(), (np.cumsum(begins)[starts] - 1).tolist() if len(ids) else []


def digest_udf(path: str):
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                         T.StructField("decoded_sha256", T.StringType())])

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Codec(path)  # its cache ends with the task
        decimal = [str(i) for i in range(len(coder.token_bytes))]
        for text in batches:
            sizes, of_ids, of_text = [], [], []
            for texts in text_bytes(text):
                for ids in map(np.ndarray.tolist, coder.encode([t.decode() for t in texts])):
                    sizes.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    of_text.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()),
                                              pa.array(of_text, pa.string())], kind.names)
        del coder
        release()

    return run


def token_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 and decoded_sha256 of the encoded
    and decoded whole text (null: empty). Other columns are ignored; repeated
    rows give repeated results."""
    return batched(docs).select(F.col(id_col).alias("doc_id"), digest_udf(path)(F.col(text_col)).alias("t")).select(
        "doc_id", "t.*")


def encoded(docs: DataFrame, text_col: str = "text", path: str = RANKS, with_offsets: bool = False) -> DataFrame:
    """``docs`` with tokens: a struct of ids, and with ``with_offsets`` the start
    byte (bytes) and character (chars) of each."""
    names = ["ids", "bytes", "chars"] if with_offsets else ["ids"]
    kind = T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in names])

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Codec(path)
        for text in batches:
            rows: list = []
            for texts in text_bytes(text):
                for t, ids in zip(texts, coder.encode([t.decode() for t in texts])):
                    rows.append((ids, *coder.offsets(t, ids)) if with_offsets else (ids,))
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.list_(pa.int32()))
                                              for i in range(len(names))], names)

    return batched(docs).withColumn("tokens", run(F.col(f"`{text_col}`")))


def decoded(rows: DataFrame, ids_col: str = "tokens.ids", path: str = RANKS) -> DataFrame:
    """``rows`` with decoded: the bytes that the ids stand for (null: null)."""
    @F.arrow_udf(T.BinaryType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Codec(path)
        for ids in batches:
            yield pa.array([None if x is None else coder.decode(x) for x in ids.to_pylist()], pa.binary())

    return batched(rows).withColumn("decoded", run(F.col(ids_col)))
