"""Byte-level BPE by a rank file: encoding and raw-byte decoding with tiktoken.

Texts are coded where they stand, so nothing is shuffled. tiktoken's splitting
pattern backtracks, which exhausts its stack on very long runs of white space;
long texts are therefore cut first, only where the pattern must start a new
match whatever stands on either side:

* between a non-space and a space character: no alternative of the pattern
  crosses from one to the other, and its only look-ahead follows white space;
* before the last character of a run of white space that a non-space follows:
  all but that character is one match.

Cases: a null text is coded as an empty one and has no ids; an empty id list
decodes to empty bytes; null ids decode to null. Rows are independent, so
repeated rows, ties and empty tables need no rule. Columns called like the
result are replaced, all others are passed through.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import common

#: Characters per piece handed to the pattern, and the longest run of white space that it may see.
PIECE = 1 << 15
LONG_RUN = 1 << 12
#: Ids gathered before a batch is handed on.
BATCH_IDS = 1 << 20
#: Fixed value: white space in Unicode, as the pattern's own class has it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_START = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")
_RUN = re.compile(f"[{SPACE}]{{{LONG_RUN},}}")

_coders: dict = {}


def coder(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file, kept per worker process."""
    import tiktoken

    key = (rank_file, pattern)
    if key not in _coders:
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _coders[key] = tiktoken.Encoding("rank-file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _coders[key]


def cut(text: str) -> list[tuple[bool, str]]:
    """(is one match, piece) in order; the matches of the pieces are those of the text."""
    if len(text) <= PIECE:
        return [(False, text)]
    pieces, at = [], 0
    spans = [m.span() for m in _RUN.finditer(text)]
    for start, end in [*spans, (len(text), len(text))]:
        while start - at > PIECE:
            found = _START.search(text, at + PIECE, start)
            to = found.start() if found else start
            pieces.append((False, text[at:to]))
            at = to
        if at < start:
            pieces.append((False, text[at:start]))
        at = end if end == len(text) else end - 1
        if start < at:
            pieces.append((True, text[start:at]))
    return pieces


def encode_text(encoding, text: str) -> list[int]:
    if len(text) <= PIECE:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for whole, piece in cut(text):
        ids += encoding._encode_single_piece(piece) if whole else encoding.encode_ordinary(piece)
    return ids


def _columns(batch: pa.RecordBatch, made: dict[str, pa.Array], schema: T.StructType, lo: int, hi: int):
    cols = [made[f.name] if f.name in made else batch.column(batch.schema.get_field_index(f.name)).slice(lo, hi - lo)
            for f in schema.fields]
    return pa.RecordBatch.from_arrays(cols, [f.name for f in schema.fields])


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", out: str = "ids", digest: str | None = None) -> DataFrame:
    """``df`` with ``out``: the ids of ``text``, without special tokens, as tiktoken gives them.

    With ``digest`` also the SHA-256 of the bytes that the ids decode to, found
    in the same pass by the same worker.
    """
    base = common.without(df, [out] + ([digest] if digest else []))
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False), False),
                           *([T.StructField(digest, T.StringType(), False)] if digest else [])])

    def run(batch):
        encoding, offsets, parts, sums, lo = coder(rank_file, pattern), [0], [], [], 0
        texts = batch.column(batch.schema.get_field_index(text))
        for i in range(batch.num_rows):
            ids = encode_text(encoding, texts[i].as_py() or "")
            if digest:
                sums.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
            parts.append(np.array(ids, np.int32))
            offsets.append(offsets[-1] + len(ids))
            if offsets[-1] >= BATCH_IDS or i == batch.num_rows - 1:
                made = {out: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))}
                if digest:
                    made[digest] = pa.array(sums, pa.string())
                yield _columns(batch, made, schema, lo, i + 1)
                offsets, parts, sums, lo = [0], [], [], i + 1

    return common.map_arrow(base, run, schema)


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``df`` with ``out``: the raw bytes of ``ids``; bytes of a cut character stay as they are."""
    base = common.without(df, [out])
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batch):
        encoding = coder(rank_file, pattern)
        lists, lo, made, size = batch.column(batch.schema.get_field_index(ids)), 0, [], 0
        for i in range(batch.num_rows):
            one = lists[i]
            made.append(encoding.decode_bytes(one.values.to_pylist()) if one.is_valid else None)
            size += len(made[-1] or b"")
            if size >= 4 * BATCH_IDS or i == batch.num_rows - 1:
                yield _columns(batch, {out: pa.array(made, pa.binary())}, schema, lo, i + 1)
                made, size, lo = [], 0, i + 1

    return common.map_arrow(base, run, schema)


def digests(df: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the bytes that they decode to."""
    docs = common.narrow(df, doc_id=doc_id, text=text)
    ids = encode(docs, rank_file, pattern, "_text", "_ids").select("_doc_id", "_ids")
    back = decode(ids, rank_file, pattern, "_ids", "_bytes")
    return back.select(
        F.col("_doc_id").alias("doc_id"), F.size("_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("_ids", " "), 256).alias("ids_sha256"), F.sha2("_bytes", 256).alias("decoded_sha256"))
