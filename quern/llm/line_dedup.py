"""Drop lines that recur over documents, by probing perfect-hash arrays.

A line's key is the line without spaces at its ends, A-Z in lower case. Keys of
at least ``min_chars`` code points found in at least ``min_docs`` rows are kept
only in the row(s) with the largest id among their holders.

1. Each document gives its distinct keys as 128-bit hashes; one aggregation,
   combined before the shuffle, counts holders and finds the largest id.
2. The keys with enough holders are dealt into shards; each shard gets a minimal
   perfect hash and, in its order, arrays of fingerprints, counts and owners.
3. Documents probe the arrays instead of being joined with lines. The keys of
   the largest counts, BROADCAST_KEYS at most, go to every task. The rest, if
   any, stays in shards: documents' keys are routed to them in sorted streams,
   one shard in memory at a time, and only the keys to drop come back. As the
   frequent keys never take that way, no line is hot on it.

Cases: a null or empty text is one empty line. Lines of a text that is all
dropped leave an empty text. Repeated lines of one document count once; rows
that repeat an id count as documents of their own and keep or lose the same
lines. A null id ranks below every other. Texts of any length are read whole.
Empty tables give no rows. Columns called like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import common, perfect_hash

BLANK = b" \t\n\x0b\x0c\r"
BROADCAST_KEYS = 2_000_000
SHARD_KEYS = 50_000
SALTS = 8
NO_ID = -(1 << 63)

INDEX = ("shard bigint, sizes array<bigint>, words binary, rest binary, prints binary, counts binary, owners binary")


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, if it has enough code points."""
    key = line.strip(BLANK)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key.lower()


def hash_key(key: bytes) -> tuple[int, int]:
    both = xxhash.xxh3_128_intdigest(key)
    return both >> 64, both & 0xFFFFFFFFFFFFFFFF


def keyed(texts: list[bytes], min_chars: int):
    """All lines of a batch: lines per text, (row, line, key, print) of the long lines."""
    lines = [t.split(b"\n") for t in texts]
    rows, at, first, second = [], [], [], []
    for i, own in enumerate(lines):
        for j, line in enumerate(own):
            if len(line) >= min_chars and (key := line_key(line, min_chars)) is not None:
                a, b = hash_key(key)
                rows.append(i)
                at.append(j)
                first.append(a)
                second.append(b)
    return (lines, np.array(rows, np.int64), np.array(at, np.int64), np.array(first, np.uint64),
            np.array(second, np.uint64))


def _ids(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def holders(docs: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """(key, print, id) once per row and key."""
    def run(batch):
        ids = _ids(batch, "_doc_id")
        _, rows, _, key, prints = keyed(common.text_bytes(batch.column(1)), min_chars)
        if len(rows):
            order = np.lexsort((prints, key, rows))
            rows, key, prints = rows[order], key[order], prints[order]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (key[1:] != key[:-1]) | (prints[1:] != prints[:-1])
            return pa.RecordBatch.from_arrays(
                [pa.array(common.signed(key[new])), pa.array(common.signed(prints[new])), pa.array(ids[rows[new]])],
                ["key", "print", "id"])

    return common.map_arrow(common.narrow(docs, doc_id=doc_id, text=text), run, "key bigint, print bigint, id bigint")


def repeated_keys(docs: DataFrame, text: str, doc_id: str, min_chars: int, min_docs: int) -> DataFrame:
    return (holders(docs, text, doc_id, min_chars).groupBy("key", "print")
            .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("owner")).where(F.col("n") >= min_docs))


def index(keys: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard of the distinct keys."""
    def build(group):
        table = group.to_pydict()
        key = common.unsigned(np.array(table["key"]))
        prints = np.array(table["print"], np.int64)
        slot_key = key ^ common.mix(common.unsigned(prints))
        distinct, first = np.unique(slot_key, return_index=True)  # equal 128-bit keys cannot occur twice
        sizes, words, rest = perfect_hash.build(distinct)
        places = perfect_hash.Places(sizes, words, rest).of(distinct)
        order = np.empty(len(distinct), np.int64)
        order[places] = first
        column = lambda name, kind: np.array(table[name], kind)[order].tobytes()
        return pa.table({"shard": pa.array([table["shard"][0]], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                         "words": pa.array([words.tobytes()], pa.binary()), "rest": pa.array([rest.tobytes()], pa.binary()),
                         "prints": pa.array([column("print", np.int64)], pa.binary()),
                         "counts": pa.array([column("n", np.int64)], pa.binary()),
                         "owners": pa.array([column("owner", np.int64)], pa.binary())})

    sharded = keys.withColumn("shard", F.pmod("key", F.lit(shards)).cast("bigint"))
    return sharded.groupBy("shard").applyInArrow(build, INDEX)


class Shard:
    def __init__(self, sizes, words, rest, prints, counts, owners):
        self.places = perfect_hash.Places(sizes, np.frombuffer(words, np.uint64), np.frombuffer(rest, np.uint64))
        self.prints, self.counts, self.owners = (np.frombuffer(x, np.int64) for x in (prints, counts, owners))

    def lost(self, key: np.ndarray, prints: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """True where the key is indexed and the row does not own it."""
        prints = common.signed(prints)
        place = self.places.of(key ^ common.mix(common.unsigned(prints)))
        at = np.maximum(place, 0)
        return (place >= 0) & (self.prints[at] == prints) & (self.owners[at] != ids)


def _lost(held: dict[int, Shard], shards: int, key: np.ndarray, prints: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = np.zeros(len(key), bool)
    shard = np.mod(common.signed(key), shards) if len(key) else np.zeros(0, np.int64)
    for s in np.unique(shard):
        if (one := held.get(int(s))) is not None:
            mine = shard == s
            out[mine] = one.lost(key[mine], prints[mine], ids[mine])
    return out


def _routed(docs: DataFrame, rare: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """(id, prints): the keys that each id loses by the shards of the rarer keys."""
    spark = docs.sparkSession
    parts = common.slots(spark)
    shards = max(2 * parts, -(-common.total_rows(rare) // SHARD_KEYS))
    arrays = index(rare, shards).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    probes = holders(docs, text, doc_id, min_chars).withColumns(
        {"shard": F.pmod("key", F.lit(shards)).cast("bigint"), "salt": F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")})
    both = arrays.withColumn("kind", F.lit(0)).unionByName(probes.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    fields = ["shard", "salt", "kind", "sizes", "words", "rest", "prints", "counts", "owners", "key", "print", "id"]
    streams = both.select(*fields).repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")

    def run(batches):
        now, held = None, None
        for batch in batches:
            kind = batch.column(2).to_numpy()
            shard, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = [0, *(np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1), batch.num_rows]
            for lo, hi in zip(starts, starts[1:]):
                if lo == hi:
                    continue
                if kind[lo] == 0:
                    now = (shard[lo], salt[lo])
                    held = Shard(*[batch.column(3 + i)[lo].as_py() for i in range(6)])
                elif held is not None and now == (shard[lo], salt[lo]):
                    key, prints, ids = (batch.column(9 + i).slice(lo, hi - lo).to_numpy() for i in range(3))
                    lost = held.lost(common.unsigned(key), common.unsigned(prints), ids)
                    if lost.any():
                        yield pa.RecordBatch.from_arrays([pa.array(ids[lost]), pa.array(prints[lost])], ["_id", "_print"])

    out = streams.mapInArrow(common.tidy(run), "_id bigint, _print bigint")
    return out.groupBy("_id").agg(F.collect_set("_print").alias("_lost"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 40, min_docs: int = 5,
                broadcast_keys: int | None = None) -> DataFrame:
    """``docs`` with ``text`` without the lost lines, ``n_lines`` before and ``n_dropped``."""
    spark = docs.sparkSession
    most = BROADCAST_KEYS if broadcast_keys is None else broadcast_keys
    keys = common.kept(repeated_keys(docs, text, doc_id, min_chars, min_docs), "line-keys")
    # Smallest count (a power of two) from which on all keys fit the bound; at most 64 rows come back.
    sizes = dict(keys.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).count().collect())
    floor, taken = 62, 0
    for b in sorted(sizes, reverse=True):
        if taken + sizes[b] > most:
            break
        floor, taken = b, taken + sizes[b]
    shards = max(1, -(-taken // SHARD_KEYS))
    rows = index(keys.where(F.col("n") >= 2**floor), shards).collect() if taken else []
    shared = spark.sparkContext.broadcast([tuple(r) for r in rows])
    base = common.without(docs, ["n_lines", "n_dropped"])
    schema = T.StructType([*base.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    routed = taken < sum(sizes.values())
    if routed:
        rare = _routed(docs, keys.where(F.col("n") < 2**floor), text, doc_id, min_chars)
        base = (base.withColumn("_id", F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NO_ID)))
                .join(rare, "_id", "left").drop("_id"))

    def run(batches):
        held = {r[0]: Shard(*r[1:]) for r in shared.value}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = _ids(batch, doc_id)
            lines, rows, at, key, prints = keyed(common.text_bytes(batch.column(batch.schema.get_field_index(text))), min_chars)
            lost = _lost(held, shards, key, prints, ids[rows] if len(rows) else ids[:0])
            if routed:
                gone = [set(x or ()) for x in batch.column(batch.schema.get_field_index("_lost")).to_pylist()]
                lost |= np.fromiter((int(p) in gone[r] for r, p in zip(rows, common.signed(prints))), bool, len(rows))
            dropped = np.bincount(rows[lost], minlength=batch.num_rows) if len(rows) else np.zeros(batch.num_rows, np.int64)
            drop: dict[int, set] = {}
            for r, j in zip(rows[lost].tolist(), at[lost].tolist()):
                drop.setdefault(r, set()).add(j)
            texts = batch.column(batch.schema.get_field_index(text))
            if drop:
                new = [b"\n".join(x for j, x in enumerate(lines[i]) if j not in drop[i]) if i in drop else None
                       for i in range(batch.num_rows)]
                kind = texts.type
                texts = pa.array([n.decode() if n is not None else old for n, old in zip(new, texts.to_pylist())], kind)
            result = {"n_lines": pa.array([len(x) for x in lines], pa.int64()), "n_dropped": pa.array(dropped, pa.int64()), text: texts}
            yield pa.RecordBatch.from_arrays(
                [result[f.name] if f.name in result else batch.column(batch.schema.get_field_index(f.name)) for f in schema.fields],
                [f.name for f in schema.fields])

    return base.mapInArrow(common.tidy(run), schema)


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """Per document: lines, dropped lines and the digest of what is left."""
    out = dedup_lines(common.narrow(docs, doc_id=doc_id, text=text), "_text", "_doc_id", **settings)
    return out.select(F.col("_doc_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2(F.coalesce("_text", F.lit("")), 256).alias("kept_sha256"))
