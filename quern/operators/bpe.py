"""Learning and applying a byte-level BPE vocabulary.

Learning works on the table of distinct pieces. A piece is a string with one
character per token. Many merges are guessed and tried together (``trials``); a
few, or those that trials leave, are learned in rounds. There merging a pair is
``replace`` and counting pairs is one aggregate, both inside generated code. All
runs are counted once; the most
frequent ones, a bounded number, are known on the driver from then on. A round
takes all merges that are sure from these counts, finds the pieces they change
(a scan that compares a piece before and after, with no exchange), and exchanges
only the runs of those, old ones with a negative sign, so that known counts stay
exact. Runs are counted anew when the next pair is no longer above all that is
unknown. Merges are at most 65,536, as ids have 16 bits.

Coding a text shuffles nothing: the pieces come from the JVM, and each Arrow
batch codes its distinct pieces once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import trials
from quern.operators.pieces import (BYTE_SYMBOLS, END_OF_TEXT, from_symbols, gram_counts, piece_counts,
                                    split_pieces, to_symbols)
from quern.plans.stage import RollingTable, complete

MAX_VOCAB = 65_536
KNOWN_GRAMS = 8_192   # most frequent runs known after a count
MOST_KNOWN = 65_536  # runs known at most before they are counted anew
TRIAL_LEAST = 100    # merges from which on they are guessed and tried; rounds make fewer
CUT_EVERY = 64       # merges applied on the fly before the piece table is rewritten
PLAN_STEP = 16
CACHE_PIECES = 200_000
MOST_IN_TURN = 1_024      # merges up to here are made on all new pieces at once
STRETCH_PIECES = 100_000  # pieces coded at a time, so that a task's memory does not follow its rows


@dataclass(frozen=True)
class Vocabulary:
    """Token strings by id, and merges (left id, right id, merged id) by rank."""

    tokens: tuple[str, ...]
    merges: tuple[tuple[int, int, int], ...]
    specials: tuple[str, ...] = (END_OF_TEXT,)

    @property
    def size(self) -> int:
        return len(self.tokens)

    @property
    def eot_id(self) -> int:
        return self.tokens.index(END_OF_TEXT)

    @property
    def fingerprint(self) -> str:
        """Digest of the content, to record beside every table coded with it."""
        return hashlib.sha256(json.dumps([self.tokens, self.merges, self.specials]).encode()).hexdigest()[:16]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.tokens)), "token_id int, token string")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, *m) for rank, m in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, `left` int, `right` int, merged int")

    def save(self, spark: SparkSession, path: str) -> None:
        self.merge_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
        self.table(spark).withColumn("special", F.col("token").isin(*self.specials)).coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/vocab")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Vocabulary:
        vocab = spark.read.parquet(f"{path}/vocab").orderBy("token_id").collect()
        merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        return Vocabulary(tuple(r["token"] for r in vocab),
                          tuple((r["left"], r["right"], r["merged"]) for r in merges),
                          tuple(r["token"] for r in vocab if r["special"]))

    @staticmethod
    def from_json(spark: SparkSession, path: str) -> Vocabulary:
        """Read the public single-file JSON form (vocab, merges, added tokens)."""
        data = json.loads(spark.read.text(path, wholetext=True).first()[0])
        ids = dict(data["model"]["vocab"])
        specials = [t["content"] for t in data.get("added_tokens", []) if t.get("special")]
        ids.update({t["content"]: t["id"] for t in data.get("added_tokens", [])})
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        return Vocabulary(tuple(sorted(ids, key=ids.get)),
                          tuple((ids[a], ids[b], ids[a + b]) for a, b in pairs), tuple(specials))


def _char_of(token_id: int, n_specials: int) -> str:
    """One character per token, in id order: bytes are themselves, merges follow."""
    at = token_id - n_specials
    if at < 256:
        return sorted(BYTE_SYMBOLS)[at]
    code = 0x200 + at - 256
    return chr(code if code < 0xD800 else code + 0x800)  # step over the surrogates


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replaced(merges: list[tuple[str, str]]) -> str:
    # Filled up to a round number of replacements (of characters no piece holds):
    # plans of equal shape share their generated code from round to round.
    filled = merges + [("\0\0", "\0")] * (-len(merges) % PLAN_STEP)
    col = "symbols"
    for pair, merged in filled:
        col = f"replace({col}, {_quoted(pair)}, {_quoted(merged)})"
    # ``explode`` of one element keeps the optimiser from copying the chain of
    # replacements into every place that uses the result.
    return f"explode(array({col}))"


def _merge_all(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    return words.selectExpr(f"{_replaced(merges)} AS symbols", "n")


def _safe_batch(top: list[tuple[str, int]], unseen: int) -> list[str]:
    """Leading pairs that merging one at a time would also pick, in this order.

    ``top`` holds runs of two and three by (count desc, run asc); all others are
    at most as frequent as ``unseen``. Merging ``ab`` makes pairs no more
    frequent than the runs ``xab`` and ``abc`` were, and changes only pairs that
    start with ``b`` or end with ``a``: of the pair ``bc`` it uses up those in
    ``abc``, all of them if a and b differ. So a further pair is safe while it
    is unchanged and strictly more frequent than all that is unseen and
    everything a merge made or changed (``bar``).
    """
    count = dict(top)
    longer: dict[str, int] = {}
    for gram, n in top:
        if len(gram) == 3:
            for pair in (gram[:2], gram[1:]):
                longer[pair] = max(longer.get(pair, 0), n)
    taken, bar = [], unseen
    starts: dict[str, list[str]] = {}
    ends: dict[str, list[str]] = {}
    for gram, n in top:
        if len(gram) != 2:
            continue
        if n <= bar:
            break
        touching = [*ends.get(gram[0], ()), *(p for p in starts.get(gram[1], ()) if p[1] != gram[0])]
        if not touching:
            taken.append(gram)
            starts.setdefault(gram[0], []).append(gram)
            ends.setdefault(gram[1], []).append(gram)
            bar = max(bar, longer.get(gram, unseen))
            continue
        left = n
        if len(touching) == 1 and touching[0][0] != touching[0][1] and gram != touching[0][::-1]:
            a, b = touching[0]
            left = n - count.get(a + gram if gram[0] == b else gram + b, 0)
        bar = max(bar, left)
    return taken


def _counted(words: DataFrame, size: int) -> tuple[dict[str, int], int]:
    """The ``size`` most frequent runs, and a bound of all others."""
    rows = gram_counts(words, triples=True).orderBy(F.desc("n"), "gram").limit(size).collect()
    return {r["gram"]: r["n"] for r in rows}, rows[-1]["n"] if len(rows) == size else 0


def _changes(words: DataFrame, pending: list[tuple[str, str]], made: list[tuple[str, str]], known: dict[str, int], floor: int) -> list:
    """(run, change of its count) by the merges ``made``, of known runs and of those that rise above ``floor``.

    A run with a new token comes up in the round of that token and only gets
    rarer later, so one that stays at or below the floor need not be known.
    """
    both = (_merge_all(words, pending).selectExpr("symbols", "n", f"{_replaced(made)} AS after").where("symbols <> after")
            .selectExpr("inline(array(struct(symbols AS symbols, -n AS n), struct(after AS symbols, n AS n)))"))
    touched = {c for pair, _ in made for c in pair}
    listed = ", ".join(_quoted(g) for g in known if not touched.isdisjoint(g))
    return gram_counts(both, triples=True).where(f"n > {floor} OR (n <> 0 AND gram IN ({listed}))").collect()


def train(counts: DataFrame, vocab_size: int, specials: tuple[str, ...] = (END_OF_TEXT,)) -> Vocabulary:
    """Learn merges from a (piece, n) table until the vocabulary is full.

    Merges are those of one-at-a-time learning: most frequent pair first, ties
    by lower ids.
    """
    if not len(specials) + 256 <= vocab_size <= MAX_VOCAB:
        raise ValueError(f"vocab_size must be between {len(specials) + 256} and {MAX_VOCAB}")
    alphabet = sorted(BYTE_SYMBOLS)
    tokens = [*specials, *alphabet]
    id_of = {t: i for i, t in enumerate(tokens)}
    char_of = {i: _char_of(i, len(specials)) for i in range(len(specials), len(tokens))}
    id_of_char = {c: i for i, c in char_of.items()}
    merges: list[tuple[int, int, int]] = []
    spark = counts.sparkSession
    # A round is bound by computing, not by bytes: spread the table over every
    # core instead of letting it shrink to a few partitions of default size.
    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stage = RollingTable(spark, "pieces")
    words = stage.put(counts.select(to_symbols(F.col("piece")).alias("symbols"), "n")
                      .where(F.char_length("symbols") > 1).repartition(spread))
    if vocab_size - len(tokens) >= TRIAL_LEAST:
        names = trials.Names({ord(c): tokens[i] for i, c in char_of.items()}, len(tokens), lambda i: ord(_char_of(i, len(specials))))
        kept, words = trials.learn(words, stage, names, vocab_size)
        for left, right, merged in kept:
            if chr(merged) not in id_of_char:
                id_of_char[chr(merged)] = id_of[names.spelled[merged]] = len(tokens)
                char_of[len(tokens)] = chr(merged)
                tokens.append(names.spelled[merged])
            merges.append(tuple(id_of_char[chr(c)] for c in (left, right, merged)))
    pending: list[tuple[str, str]] = []
    known: dict[str, int] = {}
    floor, size, fresh = None, KNOWN_GRAMS, False
    while len(tokens) < vocab_size:
        if floor is None:
            known, floor = _counted(_merge_all(words, pending), size)
            fresh = True
        batch = _safe_batch(sorted(known.items(), key=lambda g: (-g[1], g[0])), floor)
        if not batch:
            if fresh and floor == 0:
                break
            size, floor = size * 2 if fresh else size, None  # a count that shows no sure pair was too short
            continue
        fresh, respelled, made = False, False, []
        for k, gram in enumerate(batch):
            left, right = id_of_char[gram[0]], id_of_char[gram[1]]
            token = tokens[left] + tokens[right]
            found = id_of.get(token)
            if found is not None and k > 0:
                break  # changes the counts of a token already in use: take it alone
            if found is None:
                found = len(tokens)
                tokens.append(token)
                id_of[token] = found
                char_of[found] = _char_of(found, len(specials))
                id_of_char[char_of[found]] = found
            else:
                respelled = True
            merges.append((left, right, found))
            made.append((gram, char_of[found]))
            if respelled or len(tokens) == vocab_size:
                break
        if len(tokens) == vocab_size:
            break
        if respelled or len(known) > MOST_KNOWN:
            floor = None  # runs of a token in use may rise again: count anew
        else:
            for gram, change in _changes(words, pending, made, known, floor):
                known[gram] = known.get(gram, 0) + change
                if known[gram] <= floor:
                    del known[gram]
        pending += made
        if len(pending) >= CUT_EVERY:
            words = stage.put(_merge_all(words, pending).where(F.char_length("symbols") > 1))
            pending = []
    stage.drop()
    return Vocabulary(tuple(tokens), tuple(merges), tuple(specials))


def ensure(spark: SparkSession, path: str, vocab_size: int, docs: DataFrame | None = None,
           text: str = "text", required: bool = False) -> Vocabulary:
    """The vocabulary at ``path``; learned from ``docs`` and saved there if absent.

    With ``required`` an absent vocabulary is an error: tables coded with
    another one would not fit the ids a model was trained on.
    """
    if complete(spark, f"{path}/vocab") and complete(spark, f"{path}/merges"):
        return Vocabulary.load(spark, path)
    if required:
        raise FileNotFoundError(f"a vocabulary is required at {path!r}; a new one is not learned in its place")
    if docs is None:
        raise FileNotFoundError(f"no vocabulary at {path!r} and no documents to learn one from")
    found = train(piece_counts(docs, text), vocab_size)
    found.save(spark, path)
    return found


def _coder(vocabulary: Vocabulary):
    """Arrow function from arrays of pieces to arrays of ids."""
    first = len(vocabulary.specials)
    order = {s: i for i, s in enumerate(sorted(BYTE_SYMBOLS))}
    byte_ids = [first + order[s] for s in BYTE_SYMBOLS]
    ranks = {(a, b): (rank, m) for rank, (a, b, m) in reversed(list(enumerate(vocabulary.merges)))}
    special_ids = {s: vocabulary.tokens.index(s) for s in vocabulary.specials}
    cache_limit = CACHE_PIECES
    merges = vocabulary.merges
    # Merges may be made one after another if each token comes from one merge only, of tokens made before it.
    made = {m: rank for rank, (_, _, m) in enumerate(merges)}
    in_turn = len(merges) == len(made) <= MOST_IN_TURN and all(
        made.get(t, -1) < rank for rank, (a, b, _) in enumerate(merges) for t in (a, b))

    def code_piece(piece: str) -> list[int]:
        """Merge the lowest-ranked neighbours first, from a heap over a linked list."""
        import heapq

        ids = [byte_ids[b] for b in piece.encode("utf-8")]
        n = len(ids)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*ranks[p], i, *p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in ranks]
        heapq.heapify(heap)
        while heap:
            _, merged, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = merged, -1
            after[i] = after[j]
            if after[i] < n:
                ahead[after[i]] = i
            for l, r in ((ahead[i], i), (i, after[i])):
                if l >= 0 and r < n and (p := (ids[l], ids[r])) in ranks:
                    heapq.heappush(heap, (*ranks[p], l, *p))
        return [t for t in ids if t >= 0]

    def code_together(found: list[str]):
        """The ids of all pieces, kept in one string with a character per token: a merge is one replacement."""
        import numpy as np

        shown = np.zeros(256, np.uint16)  # 0 ends a piece; no byte of UTF-8 is 255
        shown[:255] = np.array(byte_ids[:255]) + 256
        text = shown[np.frombuffer(b"\xff".join(p.encode("utf-8") for p in found), np.uint8)].tobytes().decode("utf-16-le")
        for a, b, merged in merges:
            text = text.replace(chr(a + 256) + chr(b + 256), chr(merged + 256))
        flat = np.frombuffer(text.encode("utf-16-le"), np.uint16).astype(np.int32)
        ends = [*np.flatnonzero(flat == 0).tolist(), len(flat)]
        flat -= 256
        return [flat[lo:hi] for lo, hi in zip([0, *[e + 1 for e in ends]], ends)]

    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa

        cache: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in stretches(whole)):
            distinct = batch.flatten().dictionary_encode()
            if len(cache) > cache_limit:
                cache.clear()
            here = distinct.dictionary.to_pylist()
            fresh = [p for p in here if p not in cache]
            if in_turn and fresh:
                cache.update(zip(fresh, code_together(fresh)))
            else:
                cache.update((p, np.array(code_piece(p), dtype=np.int32)) for p in fresh)
            cache.update((p, np.array([special_ids[p]], dtype=np.int32)) for p in fresh if p in special_ids)
            coded = [cache[p] for p in here]
            sizes = np.array([len(c) for c in coded], dtype=np.int32)
            pool = np.concatenate(coded) if coded else np.empty(0, np.int32)
            starts = np.cumsum(sizes, dtype=np.int32) - sizes
            which = distinct.indices.to_numpy(zero_copy_only=False)
            lengths = sizes[which]
            ends = np.cumsum(lengths, dtype=np.int32)
            gather = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
            gather += np.repeat(starts[which] - (ends - lengths), lengths)
            bounds = np.concatenate([np.zeros(1, np.int32), ends])
            per_row = batch.offsets.to_numpy() - batch.offsets[0].as_py()
            yield pa.ListArray.from_arrays(pa.array(bounds[per_row]), pa.array(pool[gather]))

    def stretches(batch: pa.Array) -> Iterator[pa.Array]:
        """Runs of rows with about STRETCH_PIECES pieces; a row is never cut."""
        import numpy as np

        ends, lo = batch.offsets.to_numpy()[1:] - batch.offsets[0].as_py(), 0
        while lo < len(batch):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + STRETCH_PIECES, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi

    return F.arrow_udf(code, "array<int>")


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each text. End-of-text spelled out in a text takes its own id."""
    pieces = split_pieces(F.coalesce(F.col(text), F.lit("")), vocabulary.specials[0])
    return df.withColumn(ids, _coder(vocabulary)(pieces))


def with_eot(df: DataFrame, eot_id: int, ids: str = "ids") -> DataFrame:
    """End every document with the end-of-text id."""
    return df.withColumn(ids, F.concat(F.col(ids), F.array(F.lit(eot_id))))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of each id array; special and unknown ids are left out.

    The vocabulary is one foldable literal (line feeds never occur in its
    alphabet), so decoding is a lookup per id inside the row: no join, no shuffle.
    """
    shown = ["" if t in vocabulary.specials else t for t in vocabulary.tokens]
    table = F.split(F.lit("\n".join(shown)), "\n")
    return df.withColumn(text, from_symbols(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")))
