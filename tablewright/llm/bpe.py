"""Byte-level BPE with tiktoken and a local rank file.

Every match of the split pattern is encoded on its own, so a text may be cut
wherever one match must end and the next begin. Long texts are cut at such
places and encoded piece by piece: before white space that follows anything
else, and between letters, digits and other signs where no contraction can
span. A cut decides nothing but memory. A run without any such place is one
match, and is encoded whole. Long white space is cut by the pattern's own rule,
because tiktoken's pattern engine runs out of stack on it: all of it is one match
at the end of a text, else all but the last sign, which begins what follows.

Tasks read the rank file from the path they are given (the installed package
has it on every machine) and build the encoder once per process. Work is per
row in Arrow batches; there is no shuffle.

Defined results: a null text counts as empty and gives no ids; ids that are no
valid UTF-8 alone decode to raw bytes. Unpaired surrogates cannot occur in
Spark strings. Extra columns stay where rows are returned.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import documents, whole
from tablewright.llm.registry import query

RANKS = "byte_bpe_50k.tiktoken"
_HELD = 1 << 18

#: White space as the split pattern sees it.
_WHITE = r"\t-\r \x85\xa0  -     　"
_LETTER = r"A-Za-zぁ-ゖァ-ヺ一-龥"
_STOP = r".,;:()、。！，：；？"
_SAFE = regex.compile(
    rf"(?<=[^{_WHITE}])(?=[{_WHITE}])"  # a match never goes on into white space
    rf"|(?<=[{_LETTER}])(?=[0-9{_STOP}])|(?<=[0-9])(?=[{_LETTER}{_STOP}])"
)


_GAP = 4096
_LONG_WHITE = re.compile(rf"[{_WHITE}]{{{_GAP},}}")


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int) -> Iterator[str]:
    """Parts of at least ``size`` characters whose encodings, put together, are that of the text."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(enc: tiktoken.Encoding, text: str, size: int = 1 << 16) -> Iterator[list[int]]:
    start = 0
    for gap in _LONG_WHITE.finditer(text) if len(text) >= _GAP else ():
        for piece in pieces(text[start : gap.start()], size):
            yield enc.encode_ordinary(piece)
        start = gap.end() - (gap.end() < len(text))
        yield enc._encode_single_piece(text[gap.start() : start])
    for piece in pieces(text[start:], size):
        yield enc.encode_ordinary(piece)


@functools.lru_cache(maxsize=4)
def _decimals(n: int) -> list[str]:
    return [str(i) for i in range(n)]


def tokenized(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, ``ids`` (array of int) and ``decoded`` (the bytes they stand for) of every row."""
    rows = docs.select(F.struct(*keep).alias("row"), whole(F.col(text)).alias("text"))
    schema = T.StructType(
        [rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)

        def out(batch: pa.RecordBatch, start: int, ids: list[list[int]]) -> pa.RecordBatch:
            decoded = pa.array([enc.decode_bytes(x) for x in ids], pa.binary())
            rows = batch["row"].slice(start, len(ids))
            return pa.RecordBatch.from_arrays([rows, pa.array(ids, pa.list_(pa.int32())), decoded], ["row", "ids", "decoded"])

        for batch in batches:
            start, ids, held = 0, [], 0
            for i in range(batch.num_rows):
                ids.append([t for part in encode(enc, batch["text"][i].as_py()) for t in part])
                held += len(ids[-1])
                if held > _HELD:  # so that long texts don't pile up
                    yield out(batch, start, ids)
                    start, ids, held = i + 1, [], 0
            if ids:
                yield out(batch, start, ids)

    return rows.mapInArrow(run, schema).select("row.*", "ids", "decoded")


def token_digests(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256); digests grow piece by piece, ids are not kept."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def digest(enc: tiktoken.Encoding, names: list[str], text: str) -> tuple[int, str, str]:
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for part in encode(enc, text):
            if part:
                ids.update((" " * (n > 0) + " ".join([names[t] for t in part])).encode())
                decoded.update(enc.decode_bytes(part))
                n += len(part)
        return n, ids.hexdigest(), decoded.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        names = _decimals(enc.n_vocab)
        for batch in batches:
            out = [digest(enc, names, t.as_py()) for t in batch["text"]]
            n, ids, decoded = map(list, zip(*out)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows.mapInArrow(run, schema)


@query("op3_byte_bpe")
def op3_byte_bpe(spark, sf_dir):
    return token_digests(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path(RANKS))
