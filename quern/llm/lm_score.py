"""Language-model scores by a hierarchical Pitman-Yor model, trained and applied in Spark.

Words (A-Z in lower case) and one end per text are tokens. A token's context is
the word before it; contexts share CONTEXTS restaurants, by hash, so that their
totals have a bounded size, and all restaurants share one parent over words.

1. Texts become blocks of (word, context, document, count) entries, packed by
   bucket of the word and shuffled once. The commonest words, 1 / HOT_SHARE of
   the tokens or more each, are split over buckets by context. Each bucket is
   written down: its distinct (word, context) pairs with their training counts,
   and which documents hold them.
2. Every Gibbs sweep is one pass over the pairs of all buckets. Pairs are seated
   given the tables of the sweep before; what buckets need of one another are
   only sums per context and per common word, which are added up in Spark. The
   draws follow from seed, sweep and bucket, so a later pass or a repeated task
   seats them again alike, and no seating is ever stored or lost.
3. A last pass seats all sweeps again, averages the predictive probability of
   every pair over the sweeps after burn-in, and adds up log10 per document.

The model grows with the corpus: all training documents are counted, none is
sampled. Draws depend on the number of buckets, the shuffle partitions.

Cases: a null or empty text is its end alone. A word never seen in training
(or any, if there is no training text) has the parent's share for unseen words.
Null ids count as an empty id for the fold. Repeated rows are texts of their
own. Empty tables give no rows. Texts are read whole; other columns are not
looked at.
"""

from __future__ import annotations

import pickle
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common
from quern.llm.language_id import remainder
from quern.llm.pitman_yor import discount_of, log_stirling, predictive, seat

CONTEXTS = 1 << 16
HOT_SHARE = 512
BLOCK_TOKENS = 1 << 19
BLOCK_DOCS = 1 << 15
#: Buckets per shuffle partition, so that a bucket stays small, and documents whose sums a task holds at most.
BUCKETS = 4
HELD_DOCS = 1 << 20
ROWS = 256
SWEEPS = 3
BURN_IN = 1
STRENGTH = 1.0
SEED = 11
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
#: Places after the contexts in a vector of sums.
TOTALS = ("tokens", "words", "once", "twice", "customers", "tables", "root_once", "root_twice")


def pack(*arrays: np.ndarray) -> bytes:
    return pickle.dumps([(a.dtype.str, len(a), pa.compress(a.tobytes(), "zstd", asbytes=True)) for a in arrays], protocol=5)


def unpack(data: bytes) -> list[np.ndarray]:
    return [np.frombuffer(pa.decompress(x, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind) for kind, n, x in pickle.loads(data)]


def _common_words(docs: DataFrame) -> list[int]:
    """Hashes of the words with a share of 1 / HOT_SHARE of the tokens or more: HOT_SHARE at most."""
    def often(words):
        word, n = np.unique(words, return_counts=True)
        some = n * 4 * HOT_SHARE >= n.sum()
        return pa.RecordBatch.from_arrays([pa.array(np.append(common.signed(word[some]), 0)), pa.array(np.append(n[some], 0)),
                                           pa.array(np.append(np.zeros(int(some.sum()), np.int64), n.sum()))], ["word", "n", "total"])

    def run(batches):
        hashes = common.WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 16 * ROWS):
                words = [hashes.of(t.lower().split()) for t in common.text_bytes(batch.column(0).slice(lo, 16 * ROWS))]
                yield often(np.concatenate([*words, np.full(len(words), END)]))

    rows = common.kept(docs.mapInArrow(common.tidy(run), "word bigint, n bigint, total bigint").groupBy("word")
                       .agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "common-words")
    rows = rows.where(F.col("total") > 0).unionByName(rows.orderBy(F.desc("n"), "word").limit(HOT_SHARE)).collect()
    total = max([r["total"] for r in rows], default=0)
    return sorted({r["word"] & 0xFFFFFFFFFFFFFFFF for r in rows if r["n"] * HOT_SHARE >= total and r["n"]})


def _blocks(docs: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """kind 0: documents of a block; kind 1: its entries in a bucket."""
    def flush(ids, held, words):
        n = np.array([len(w) for w in words], np.int64) + 1
        tokens, before = np.empty(n.sum(), np.uint64), np.empty(n.sum(), np.uint64)
        ends = np.cumsum(n)
        inner = np.ones(len(tokens), bool)
        inner[ends - 1] = False
        tokens[inner], tokens[~inner] = np.concatenate(words), END
        before[1:] = tokens[:-1]
        before[ends - n] = START
        context = (common.mix(before, 21) % np.uint64(CONTEXTS)).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), n)
        low = (context << 16) | doc
        order = np.lexsort((low, tokens))
        tokens, low = tokens[order], low[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (low[1:] != low[:-1])
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(tokens))).astype(np.uint32)
        word, low = tokens[first], low[first]
        key = np.where(np.isin(word, hot), word ^ common.mix((low >> 16).astype(np.uint64), 22), word)
        bucket = (common.mix(key, 23) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        word, low, many, bucket = word[order], low[order], many[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        block = uuid.uuid4().int >> 65
        train = np.packbits(~np.array(held, bool), bitorder="little")
        out = [(0, block, -1, pickle.dumps((ids, held, n.tolist()), protocol=5))]
        for w, x, m, b in zip(np.split(word, cuts), np.split(low, cuts), np.split(many, cuts), bucket[np.concatenate([[0], cuts])].tolist()):
            run = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            out.append((1, block, b, pack(w[run], np.diff(np.append(run, len(w))).astype(np.uint32), (x >> 16).astype(np.uint16),
                                          (x & 0xFFFF).astype(np.uint16), m, train)))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in
                                           enumerate((pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["kind", "block", "bucket", "data"])

    def run(batches):
        hashes = common.WordHashes()
        for batch in batches:
            ids, held, words, size = [], [], [], 0
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                for one, out, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), common.text_bytes(part.column(2))):
                    own = hashes.of(text.lower().split())
                    if ids and (size + len(own) > BLOCK_TOKENS or len(ids) >= BLOCK_DOCS):
                        yield flush(ids, held, words)
                        ids, held, words, size = [], [], [], 0
                    ids.append(one)
                    held.append(out)
                    words.append(own)
                    size += len(own) + 1
            if ids:
                yield flush(ids, held, words)

    return docs.mapInArrow(common.tidy(run), "kind int, block bigint, bucket bigint, data binary")


def _buckets(blocks: DataFrame) -> DataFrame:
    """One row per bucket: ``pairs`` (words, pairs per word, contexts, counts) and ``held`` (which documents of which blocks)."""
    def merge(group):
        blocks = group["block"].to_numpy()
        parts = [unpack(x.as_py()) for x in group["data"]]
        words, word = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        key = np.repeat(word, np.concatenate([p[1] for p in parts])) << 16
        key |= np.concatenate([p[2] for p in parts])
        many, doc = np.concatenate([p[4] for p in parts]), np.concatenate([p[3] for p in parts])
        train = np.concatenate([np.unpackbits(p[5], bitorder="little")[p[3]] for p in parts]).astype(bool)
        n = np.array([len(p[2]) for p in parts], np.uint32)
        del parts, word
        pair, at = np.unique(key, return_inverse=True)
        del key
        count = np.bincount(at[train], weights=many[train], minlength=len(pair)).astype(np.uint32)
        pairs = pack(words, np.bincount(pair >> 16, minlength=len(words)).astype(np.uint32), (pair & 0xFFFF).astype(np.uint16), count)
        first = np.cumsum(n) - n
        step = np.diff(at, prepend=0)
        step[first] = at[first]  # ascending inside a block
        held = pack(blocks.astype(np.int64), n, step.astype(np.uint32), doc, many)
        del at, step, doc, many, train
        common.give_back()
        return pa.table({"bucket": pa.array([group["bucket"][0].as_py()], pa.int64()), "pairs": pa.array([pairs], pa.binary()),
                         "held": pa.array([held], pa.binary())})

    return blocks.where("kind = 1").select("block", "bucket", "data").groupBy("bucket").applyInArrow(
        merge, "bucket bigint, pairs binary, held binary")


@dataclass
class State:
    """Sums after a sweep; of the common words, training count, customers and tables at the parent."""

    context_customers: np.ndarray
    context_tables: np.ndarray
    customers: float
    tables: float
    hot_counts: np.ndarray
    hot_customers: np.ndarray
    hot_tables: np.ndarray


@dataclass
class Model:
    hot: np.ndarray
    seed: int = SEED
    strength: float = STRENGTH
    discount: float = 0.5
    root_discount: float = 0.5
    tokens: int = 0
    words: int = 0
    states: list[State] = field(default_factory=list)


class Bucket:
    """The pairs of a bucket, and their seating after each sweep."""

    def __init__(self, number: int, data: bytes, model: Model):
        self.number, self.model = number, model
        self.words, per_word, context, count = unpack(data)
        self.word = np.repeat(np.arange(len(self.words)), per_word)
        self.context, self.count = context.astype(np.int64), count.astype(np.int64)
        at = np.minimum(np.searchsorted(model.hot, self.words), max(len(model.hot) - 1, 0))
        found = model.hot[at] == self.words if len(model.hot) else np.zeros(len(self.words), bool)
        self.hot = np.where(found, at, -1)
        self.tables = np.minimum(self.count, 1)  # before the first sweep: one table per pair
        self._root(None)

    def _sum(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=values, minlength=len(self.words)).astype(np.int64)

    def _root(self, rng) -> None:
        """Customers and tables of the words at the parent; of common words, only this bucket's customers."""
        self.customers = self._sum(self.tables)
        if rng is None:
            self.root_tables = np.where(self.hot < 0, np.minimum(self.customers, 1), 0)
            return
        model, now = self.model, self.model.states[self.at]
        own = np.flatnonzero((self.hot < 0) & (self.customers > 0))
        new = np.zeros(len(self.words), np.int64)
        base = np.full(len(own), 1 / (model.words + 1))
        new[own] = seat(self.customers[own], np.maximum(now.tables - self.root_tables[own], 0), base, model.strength,
                        model.root_discount, log_stirling(model.root_discount), rng)
        self.root_tables = new

    def parent(self, state: State) -> np.ndarray:
        """The parent's probability of each word, by the bucket's own seating and the sums of ``state``."""
        model, mine = self.model, self.hot >= 0
        customers, tables = self.customers.copy(), self.root_tables.copy()
        customers[mine], tables[mine] = state.hot_customers[self.hot[mine]], state.hot_tables[self.hot[mine]]
        return predictive(customers, tables, state.customers, state.tables, 1 / (model.words + 1), model.strength, model.root_discount)

    def sweep(self, at: int) -> None:
        """Seat all pairs again, given the sums after sweep ``at``."""
        self.at, model, state = at, self.model, self.model.states[at]
        rng = np.random.default_rng([model.seed, at, self.number])
        parent = self.parent(state)[self.word]
        some = np.flatnonzero(self.count > 0)
        others = np.maximum(state.context_tables[self.context[some]] - self.tables[some], 0)
        new = np.zeros(len(self.count), np.int64)
        new[some] = seat(self.count[some], others, parent[some], model.strength, model.discount, log_stirling(model.discount), rng)
        self.tables = new
        self._root(rng)

    def sums(self) -> np.ndarray:
        """Tables per context, customers of common words at the parent, totals."""
        own = self.hot < 0
        context = np.bincount(self.context, weights=self.tables, minlength=CONTEXTS)
        hot = np.bincount(self.hot[~own], weights=self.customers[~own], minlength=len(self.model.hot))
        return np.concatenate([context, hot, [self.customers[own].sum(), self.root_tables[own].sum()]]).astype(np.int64)

    def counts(self) -> np.ndarray:
        """Customers per context, training counts of common words, and the totals."""
        own, word = self.hot < 0, self._sum(self.count)
        context = np.bincount(self.context, weights=self.count, minlength=CONTEXTS)
        hot = np.bincount(self.hot[~own], weights=word[~own], minlength=len(self.model.hot))
        root = self.customers[own]
        totals = [self.count.sum(), (word[own] > 0).sum(), (self.count == 1).sum(), (self.count == 2).sum(), 0, 0,
                  (root == 1).sum(), (root == 2).sum()]
        return np.concatenate([context, hot, totals]).astype(np.int64)


    def logs(self, burn_in: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per pair: log10 of the averaged probability, log10 of the base probability, whether the word is known."""
        model = self.model
        chance, taken = np.zeros(len(self.count)), 0
        for at, state in enumerate(model.states):
            if at:
                self.sweep(at - 1)
            if at > burn_in or at == len(model.states) - 1:
                parent = self.parent(state)[self.word]
                chance += predictive(self.count, self.tables, state.context_customers[self.context],
                                     state.context_tables[self.context], parent, model.strength, model.discount)
                taken += 1
        seen, mine = self._sum(self.count), self.hot >= 0
        seen[mine] = model.states[0].hot_counts[self.hot[mine]]
        base = np.log10((seen + 1) / (model.tokens + 1 * (model.words + 1)))
        return np.log10(chance / taken), base[self.word], (seen > 0)[self.word].astype(np.float64)


def _added(buckets: DataFrame, model: Model, vector) -> np.ndarray:
    """The sum over all buckets of a vector of fixed length."""
    shared = buckets.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        own = shared.value
        for i in range(batch.num_rows):
            bucket = Bucket(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), own)
            for at in range(len(own.states)):
                bucket.sweep(at)
            values = vector(bucket)
            place = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(values[place])], ["place", "n"])

    rows = common.map_arrow(buckets.select("bucket", "pairs"), run, "place bigint, n bigint")
    found = rows.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CONTEXTS + len(model.hot) + len(TOTALS), np.int64)
    out[found["place"].to_numpy()] = found["n"].to_numpy()
    return out


def _state(model: Model, sums: np.ndarray, counts: np.ndarray, sweep: int) -> State:
    h = len(model.hot)
    customers, last = sums[CONTEXTS:CONTEXTS + h], model.states[-1] if model.states else None
    if last is None:
        tables = np.minimum(customers, 1)
    else:
        rng = np.random.default_rng([model.seed, sweep, 1 << 40])
        tables = seat(customers, np.maximum(last.tables - last.hot_tables, 0), np.full(h, 1 / (model.words + 1)), model.strength,
                      model.root_discount, log_stirling(model.root_discount), rng)
    return State(counts[:CONTEXTS], sums[:CONTEXTS], float(customers.sum() + sums[CONTEXTS + h]), float(tables.sum() + sums[CONTEXTS + h + 1]),
                 counts[CONTEXTS:CONTEXTS + h], customers, tables)


def train(buckets: DataFrame, hot: np.ndarray, sweeps: int = SWEEPS, seed: int = SEED) -> Model:
    model = Model(hot, seed)
    counts = _added(buckets, model, Bucket.counts)
    h = len(hot)
    total = dict(zip(TOTALS, counts[CONTEXTS + h:].tolist()))
    model.tokens = total["tokens"]
    model.words = total["words"] + int((counts[CONTEXTS:CONTEXTS + h] > 0).sum())
    model.discount = discount_of(total["once"], total["twice"])
    model.root_discount = discount_of(total["root_once"], total["root_twice"])
    for sweep in range(sweeps + 1):
        model.states.append(_state(model, _added(buckets, model, Bucket.sums), counts, sweep))
    return model


def _sums_per_doc(buckets: DataFrame, model: Model, burn_in: int) -> DataFrame:
    """Per bucket and block: documents, log10 scores, log10 base scores, known tokens."""
    shared = buckets.sparkSession.sparkContext.broadcast(model)

    def emitted(sums):
        for block, total in sums.items():
            some = np.flatnonzero(total[3])
            data = pack(some.astype(np.uint16), total[0][some], total[1][some], total[2][some].astype(np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([block], pa.int64()), pa.array([data], pa.binary())],
                                             ["kind", "block", "data"])

    def run(batches):
        own, sums, docs = shared.value, {}, 0
        for batch in batches:
            for i in range(batch.num_rows):
                bucket = Bucket(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), own)
                values = bucket.logs(burn_in)
                blocks, n, step, doc, many = unpack(batch.column(2)[i].as_py())
                ends = np.cumsum(n.astype(np.int64))
                for block, lo, hi in zip(blocks.tolist(), ends - n, ends):
                    pair, d, m = np.cumsum(step[lo:hi].astype(np.int64)), doc[lo:hi].astype(np.int64), many[lo:hi]
                    size = int(d.max()) + 1
                    if block not in sums:
                        sums[block] = [np.zeros(0)] * 4
                    for k, x in enumerate((*values, None)):
                        new, old = np.bincount(d, weights=m if x is None else x[pair] * m, minlength=size), sums[block][k]
                        if len(old) > len(new):
                            new, old = old, new
                        new[:len(old)] += old
                        docs += len(new) - len(old) if k == 0 else 0
                        sums[block][k] = new
                if docs > HELD_DOCS:
                    yield from emitted(sums)
                    sums, docs = {}, 0
        yield from emitted(sums)

    return buckets.select("bucket", "pairs", "held").mapInArrow(common.tidy(run), "kind int, block bigint, data binary")


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", divisor: int = 7, held_fold: int = 2,
           sweeps: int = SWEEPS, burn_in: int = BURN_IN, seed: int = SEED) -> DataFrame:
    """Scores of all texts by a model of those outside the held-out fold; with ``perplexity`` per token."""
    spark = docs.sparkSession
    rows = common.narrow(docs, doc_id=doc_id, text=text)
    rows = rows.select(F.col("_doc_id").cast("bigint").alias("id"), (remainder(F.col("_doc_id"), divisor) == held_fold).alias("held"), "_text")
    hot = np.array(_common_words(rows.select("_text")), np.uint64)
    made = common.kept(_blocks(rows, hot, BUCKETS * common.slots(spark)), "blocks")
    buckets = common.kept(_buckets(made), "buckets")
    model = train(buckets, hot, sweeps, seed)
    parts = _sums_per_doc(buckets, model, burn_in).unionByName(made.where("kind = 0").select("kind", "block", "data"))
    tokens = model.tokens

    def finish(group):
        kind, data = group["kind"].to_numpy(), group["data"]
        ids, held, n = pickle.loads(data[int(np.flatnonzero(kind == 0)[0])].as_py())
        total = [np.zeros(len(ids)) for _ in range(3)]
        for i in np.flatnonzero(kind == 1):
            doc, *sums = unpack(data[int(i)].as_py())
            for t, s in zip(total, sums):
                t[doc] += s
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(n, pa.int64()),
                         "n_known": pa.array(total[2].astype(np.int64)), "train_tokens": pa.array([tokens] * len(ids), pa.int64()),
                         "base_score": pa.array(total[1]), "score": pa.array(total[0])})

    out = parts.groupBy("block").applyInArrow(
        finish, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
