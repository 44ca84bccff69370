"""Remove words covered by windows that occur elsewhere, found by recompression.

A window is ``size`` consecutive words of one document. It is repeated if its
word sequence also starts anywhere else, in the same document or another.

1. Texts are parsed by recompression. Each window elects one of the symbols
   that lie surely inside it; equal windows elect equal symbols. The elected
   symbols, with all the words that settle them, are counted: far fewer rows
   than windows, added up before the shuffle.
2. Symbols found twice or more are marked in a bitmap of fixed size, the only
   thing sent to all tasks. Windows that elect a marked symbol are candidates; a
   wrong mark costs work, not correctness.
3. Candidates are verified by 96-bit hashes of their words. Documents travel in
   blocks; a block sends each distinct candidate once, packed by bucket, and
   gets back the places of those that another block has too. So a passage that
   a third of all documents share costs one entry per block.

Cases: a null text has no words, like an empty one, and stays as it is; texts of
fewer than ``size`` words are left alone. Repeated rows are repeats of each
other. Words are runs of other characters than space and tab to carriage
return. Whole texts are read; a text is parsed in one piece, some 200 bytes of
memory a word. Empty tables give no rows. All columns are passed through, the
text replaced by its remaining words, joined by one space, where words were
removed; columns called like the results are replaced.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import common, recompression

SIZE = 35
BITS = 1 << 26
PIECE_WORDS = 1 << 17


class Piece:
    """The words of some consecutive rows, and which windows elect which symbols."""

    def __init__(self, texts: list[bytes], hashes: common.WordHashes, size: int):
        split = [t.split() for t in texts]
        n = np.array([len(s) for s in split], np.int64)
        self.ends = np.cumsum(n)
        self.starts = self.ends - n
        self.words = hashes.of([w for s in split for w in s])
        doc = np.repeat(np.arange(len(n)), n)
        self.windows = np.flatnonzero(np.arange(len(self.words)) + size <= self.ends[doc]) if len(doc) else np.zeros(0, np.int64)
        self.size = size
        if len(self.windows):
            parse = recompression.levels(self.words, doc, self.starts, self.ends)
            level, symbol = recompression.elected(parse, self.windows, size)
            self.span = recompression.span_hashes(self.words, recompression.BASES[0])
            self.keys = np.empty(len(self.windows), np.uint64)
            found = []
            for height, one in enumerate(parse):
                mine = level == height
                if mine.any():
                    distinct, at = np.unique(symbol[mine], return_inverse=True)
                    key = common.mix(self.span(one.a[distinct], one.b[distinct]), height)
                    self.keys[mine] = key[at]
                    found.append(key)
            self.elected = np.concatenate(found)  # once per symbol


def pieces(texts: pa.Array):
    """Ranges of rows with about PIECE_WORDS words (six bytes each)."""
    lo = size = 0
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for i, n in enumerate(lengths):
        size += n
        if size >= 6 * PIECE_WORDS or i == len(lengths) - 1:
            yield lo, i + 1
            lo, size = i + 1, 0


def _symbols(docs: DataFrame, size: int) -> DataFrame:
    """(key, n) of elected symbols, added up per piece."""
    def run(batches):
        hashes = common.WordHashes()
        for batch in batches:
            for lo, hi in pieces(batch.column(0)):
                piece = Piece(common.text_bytes(batch.column(0).slice(lo, hi - lo)), hashes, size)
                if len(piece.windows):
                    key, n = np.unique(piece.elected, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(common.signed(key)), pa.array(n.astype(np.int32))], ["key", "n"])

    return docs.mapInArrow(common.tidy(run), "key bigint, n int")


def _bitmap(symbols: DataFrame) -> np.ndarray:
    """Marks of the symbols found twice, BITS bits, packed before they come to the driver."""
    block = 1 << 17

    def pack(group):
        out = np.zeros(block, bool)
        out[group["bit"].to_numpy() % block] = True
        return pa.table({"block": pa.array([group["block"][0].as_py()], pa.int64()), "bits": pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())})

    marks = (symbols.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
             .select(F.pmod("key", F.lit(BITS)).cast("bigint").alias("bit")).withColumn("block", F.floor(F.col("bit") / block)))
    out = np.zeros(BITS // 8, np.uint8)
    for b, data in marks.groupBy("block").applyInArrow(pack, "block bigint, bits binary").collect():
        out[b * block // 8:(b + 1) * block // 8] = np.frombuffer(data, np.uint8)
    return out


def _blocks(docs: DataFrame, text: str, size: int, marks, buckets: int) -> DataFrame:
    """kind 0: rows of a block; kind 1: its candidates in a bucket; kind 2: places repeated inside it."""
    def run(batches):
        hashes = common.WordHashes()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for lo, hi in pieces(texts):
                piece, block = Piece(common.text_bytes(texts.slice(lo, hi - lo)), hashes, size), uuid.uuid4().int >> 65
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                    writer.write_batch(batch.slice(lo, hi - lo))
                out = [(0, block, -1, sink.getvalue().to_pybytes())]
                if len(piece.windows):
                    bit = (common.signed(piece.keys) % BITS).astype(np.int64)
                    at = piece.windows[(marks.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
                    out += _requests(piece, at, size, block, buckets)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in
                                                  enumerate((pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["kind", "block", "bucket", "data"])

    return docs.mapInArrow(common.tidy(run), "kind int, block bigint, bucket bigint, data binary")


ENTRY = np.dtype([("first", "<u8"), ("second", "<u4"), ("at", "<u4")])
TWICE = np.uint32(0xFFFFFFFF)


def _requests(piece: Piece, at: np.ndarray, size: int, block: int, buckets: int) -> list[tuple]:
    if not len(at):
        return []
    first = piece.span(at, at + size)
    second = (recompression.span_hashes(piece.words, recompression.BASES[1])(at, at + size) >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((second, first))
    first, second, at = first[order], second[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(at)))
    entries = np.empty(len(begin), ENTRY)
    entries["first"], entries["second"] = first[begin], second[begin]
    entries["at"] = np.where(n > 1, TWICE, at[begin].astype(np.uint32))
    own = at[np.repeat(n > 1, n)].astype(np.uint32)
    out = [(2, block, -1, own.tobytes())] if len(own) else []
    bucket = (entries["first"] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    entries, bucket = entries[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for part, b in zip(np.split(entries, cuts), bucket[np.concatenate([[0], cuts])]):
        out.append((1, block, int(b), part.tobytes()))
    return out


def _replies(requests: DataFrame) -> DataFrame:
    """kind 3: places of a block whose window another block, or the block itself, has too."""
    def run(group):
        blocks = group["block"].to_numpy()
        parts = [np.frombuffer(x.as_py(), ENTRY) for x in group["data"]]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        all_ = np.concatenate(parts)
        order = np.lexsort((all_["second"], all_["first"]))
        all_, owner = all_[order], owner[order]
        new = np.ones(len(all_), bool)
        new[1:] = (all_["first"][1:] != all_["first"][:-1]) | (all_["second"][1:] != all_["second"][:-1])
        group_of = np.cumsum(new) - 1
        repeated = (np.bincount(group_of) > 1)[group_of] & (all_["at"] != TWICE)
        owner, at = owner[repeated], all_["at"][repeated]
        order = np.argsort(owner, kind="stable")
        owner, at = owner[order], at[order]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        found = list(zip(np.split(at, cuts), owner[np.concatenate([[0], cuts])])) if len(at) else []
        return pa.table({"kind": pa.array([3] * len(found), pa.int32()), "block": pa.array([int(blocks[o]) for _, o in found], pa.int64()),
                         "data": pa.array([np.sort(a).tobytes() for a, _ in found], pa.binary())})

    return requests.groupBy("bucket").applyInArrow(run, "kind int, block bigint, data binary")


def dedup_passages(docs: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with the remaining text, ``n_words`` before and ``n_removed``."""
    spark = docs.sparkSession
    base = common.without(docs, ["n_words", "n_removed"])
    marks = spark.sparkContext.broadcast(_bitmap(_symbols(base.select(f"`{text}`"), size)))
    blocks = common.kept_by(_blocks(base, text, size, marks, common.slots(spark)), "blocks", "kind")
    replies = common.kept(_replies(blocks["read"](1).select("bucket", "block", "data")), "replies")
    blocks["delete"](1)  # answered
    rows = replies
    for kind in (0, 2):
        rows = rows.unionByName(blocks["read"](kind).select(F.lit(kind).alias("kind"), "block", "data"))
    schema = T.StructType([*base.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def finish(group):
        kind = group["kind"].to_numpy()
        data = group["data"]
        table = pa.ipc.open_stream(data[int(np.flatnonzero(kind == 0)[0])].as_py()).read_all().combine_chunks()
        places = [np.frombuffer(data[int(i)].as_py(), np.uint32) for i in np.flatnonzero(kind != 0)]
        at = np.concatenate(places).astype(np.int64) if places else np.zeros(0, np.int64)
        texts = table[text].combine_chunks() if isinstance(table[text], pa.ChunkedArray) else table[text]
        split = [t.split() for t in common.text_bytes(texts)]
        ends = np.cumsum([len(s) for s in split])
        change = np.zeros((int(ends[-1]) if len(ends) else 0) + size + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + size, -1)
        gone = np.cumsum(change) > 0
        removed, new = [], []
        for i, (words, old) in enumerate(zip(split, texts)):
            lost = gone[ends[i] - len(words):ends[i]]
            removed.append(int(lost.sum()))
            new.append(b" ".join(w for w, x in zip(words, lost) if not x).decode() if removed[-1] else old.as_py())
        made = {text: pa.array(new, texts.type), "n_words": pa.array([len(s) for s in split], pa.int64()), "n_removed": pa.array(removed, pa.int64())}
        common.give_back()
        return pa.table({f.name: made.get(f.name, table[f.name] if f.name in table.column_names else None) for f in schema.fields})

    return rows.groupBy("block").applyInArrow(finish, schema)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Per document: words, removed words and the digest of the remaining ones, joined by one space."""
    out = dedup_passages(common.narrow(docs, doc_id=doc_id, text=text), "_text", size)
    words = F.btrim(F.regexp_replace(F.coalesce("_text", F.lit("")), "[\\x20\\x09-\\x0D]+", " "), F.lit(" "))
    return out.select(F.col("_doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))
