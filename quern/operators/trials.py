"""Learning a long run of merges at once: guess them, follow them over all pieces, keep what was right.

A first guess is learned on the driver from the most frequent pieces, a bounded
number. A trial makes the guessed merges on every piece, in tasks, and adds up by
how much each merge changes the count of each pair. With these sums, which are
exact over all pieces, the driver can tell for each merge whether its pair was the
most frequent one at its turn. The merges before the first wrong one are kept; the
sums also show in which order the others should have come, which is the next guess.
What is learned does not depend on the guess, only the number of trials does.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.plans.stage import RollingTable

GUESS_PIECES = 65_536  # pieces that the first guess is learned from
MOST_TRIED = 4_096     # merges guessed at a time
REWRITE_FROM = 384     # merges kept from which on the pieces are written anew, so that trials need not make them again
MOST_ROWS = 400_000    # changes of counts that the driver takes at most
PORTION = 1 << 20      # bytes of pieces that a task follows at a time
BITS = 17              # of the code point of a symbol; a pair is two of them
MASK = (1 << BITS) - 1

Merge = tuple[int, int, int]  # left, right and merged symbol as code points


def _follower(merges: list[Merge], base: int, rewrite: bool):
    """Arrow function from (symbols, n) to (change, n), or to the pieces with all ``merges`` made.

    A change is a step and a pair in one number. Steps count from ``base`` on:
    0 stands for the counts after that many merges.
    """
    by_pair = sorted((a << BITS | b) << BITS | t for t, (a, b, _) in enumerate(merges, 1))
    merged = [0, *(c for _, _, c in merges)]
    never = len(merges) + 1

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        keys, into = np.array([*by_pair, 1 << 62]), np.array(merged)

        def joined_to_next(x):
            return np.append(x[1:] == x[:-1], False)

        def next_step(pair, after):
            """The first step later than ``after`` that merges ``pair``."""
            found = keys[np.searchsorted(keys, (pair << BITS) + after + 1)]
            return np.where(found >> BITS == pair, found & MASK, never)

        def run(symbols, n):
            """All merges on some pieces: each iteration makes the next merge of every piece."""
            codes = np.frombuffer("\0".join(symbols).encode("utf-32-le"), np.uint32).astype(np.int64)
            piece, tok = np.cumsum(codes == 0)[codes != 0], codes[codes != 0]
            noted, by, ended = [], [], []

            def note(step, at, sign):
                if not rewrite:
                    noted.append(step << 2 * BITS | tok[at] << BITS | tok[at + 1])
                    by.append(sign * n[piece[at]])

            at = np.flatnonzero(joined_to_next(piece))
            due = np.ones(len(tok), bool)  # pieces that are not at ``base`` yet
            turn = np.full(len(tok), never)
            turn[at] = next_step(tok[at] << BITS | tok[at + 1], 0)
            while len(tok):
                first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
                step = np.repeat(np.minimum.reduceat(turn, first), np.diff(np.append(first, len(tok))))
                at = np.flatnonzero(joined_to_next(piece) & due & (step > base))
                note(0, at, 1)
                due &= step <= base
                live = step < never
                if not live.all():
                    ended.append((piece[~live], tok[~live]))
                    tok, piece, turn, step, due = (x[live] for x in (tok, piece, turn, step, due))
                    if not len(tok):
                        break
                hit = turn == step
                again = hit & np.append(False, hit[:-1])
                if again.any():  # a run of one symbol: every other pair, from the left
                    place = np.arange(len(hit))
                    hit &= (place - np.maximum.accumulate(np.where(hit & ~again, place, 0))) % 2 == 0
                second = np.append(False, hit[:-1])
                at = np.flatnonzero(joined_to_next(piece) & ~due & (hit | second | np.append(hit[1:], False)))
                note(step[at] - base, at, -1)
                tok = np.where(hit, into[step], tok)
                tok, piece, turn, step, hit, due = (x[~second] for x in (tok, piece, turn, step, hit, due))
                turn[hit] = never
                at = np.flatnonzero(joined_to_next(piece) & (hit | np.append(hit[1:], False)))
                turn[at] = next_step(tok[at] << BITS | tok[at + 1], step[at])
                at = at[~due[at]]
                note(step[at] - base, at, 1)
            return noted, by, ended

        for symbols, n in portions(batches):
            noted, by, ended = run(symbols, n)
            if rewrite:
                piece, tok = (np.concatenate(x) for x in zip(*ended))
                order = np.argsort(piece, kind="stable")
                piece, tok = piece[order], tok[order]
                tok = np.insert(tok, np.flatnonzero(piece[1:] != piece[:-1]) + 1, 0)
                yield pa.record_batch({"symbols": tok.astype(np.uint32).tobytes().decode("utf-32-le").split("\0"), "n": n})
                continue
            change, by = np.concatenate(noted), np.concatenate(by)
            if not len(change):
                continue
            order = np.argsort(change)
            change, by = change[order], by[order]
            first = np.flatnonzero(np.append(True, change[1:] != change[:-1]))
            sums = np.add.reduceat(by, first)
            yield pa.record_batch({"change": change[first][sums != 0], "n": sums[sums != 0]})

    def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Pieces and their counts, about PORTION bytes at a time, whatever the size of the batches."""
        import pyarrow as pa

        held, size = [], 0
        for batch in batches:
            rows = max(1, batch.num_rows * PORTION // max(batch.nbytes, PORTION))
            for lo in range(0, batch.num_rows, rows):
                held.append(batch.slice(lo, rows))
                size += held[-1].nbytes
                if size >= PORTION:
                    whole = pa.Table.from_batches(held)
                    held, size = [], 0
                    yield whole["symbols"].to_pylist(), whole["n"].to_numpy()
        if held:
            whole = pa.Table.from_batches(held)
            yield whole["symbols"].to_pylist(), whole["n"].to_numpy()

    return follow


def rewritten(words: DataFrame, merges: list[Merge]) -> DataFrame:
    """The (symbols, n) table with all ``merges`` made."""
    return words.select("symbols", "n").mapInArrow(_follower(merges, 0, True), "symbols string, n bigint")


def changes(words: DataFrame, merges: list[Merge], base: int) -> DataFrame:
    """By how much (n) each merge after the first ``base`` changes the count of each pair; step 0 holds the counts before.

    ``top`` bounds what the pair counts at any step: all that it ever gains.
    """
    parts = words.select("symbols", "n").mapInArrow(_follower(merges, base, False), "change bigint, n bigint")
    sums = (parts.groupBy("change").agg(F.sum("n").alias("n")).where("n <> 0")
            .selectExpr(f"change & {(1 << 2 * BITS) - 1} AS pair", f"CAST(shiftright(change, {2 * BITS}) AS INT) AS step", "n"))
    return sums.selectExpr("pair", "step", "n", "sum(greatest(n, 0L)) OVER (PARTITION BY pair) AS top")


def _sample(words: DataFrame, size: int) -> list[tuple[str, int]]:
    """About ``size`` pieces with weights, by priority sampling: sums over them are unbiased, frequent pieces are sure to be there."""
    table = words.withColumn("priority", F.expr("n / ((pmod(xxhash64(symbols), 1048576) + 1) / 1048576D)"))
    # Each task of a sort with a limit sends as many rows to the driver: leave little more than the limit in all of them.
    level, above = F.floor(F.log2("priority") * 8), 0
    for r in table.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        above += r["count"]
        if above > size:
            table = table.where(level >= r["level"])
            break
    drawn = table.orderBy(F.desc("priority"), "symbols").limit(size + 1).collect()
    least = int(drawn.pop()["priority"]) if len(drawn) > size else 0
    return [(r["symbols"], max(r["n"], least)) for r in drawn]


def _taken(table: DataFrame, floor: int) -> tuple[dict[int, list], int]:
    """Changes by step of all pairs that may rise above ``floor``, which is raised if they are too many."""
    while True:
        rows = table.where(F.col("top") > floor).select("step", "pair", "n").limit(MOST_ROWS + 1).toArrow()
        if rows.num_rows <= MOST_ROWS:
            break
        floor = 2 * floor + 1
    by_step: dict[int, list] = defaultdict(list)
    for step, pair, n in zip(*(rows[c].to_pylist() for c in ("step", "pair", "n"))):
        by_step[step].append((pair, n))
    return by_step, floor


class Names:
    """Symbols of tokens: a merge that spells a token in use gets its symbol, others the next free one."""

    def __init__(self, spelled: dict[int, str], size: int, symbol: Callable[[int], int]):
        self.spelled, self.size, self.symbol = dict(spelled), size, symbol
        self.of = {text: code for code, text in self.spelled.items()}

    def copy(self) -> Names:
        return Names(self.spelled, self.size, self.symbol)

    def merge(self, left: int, right: int) -> int:
        text = self.spelled[left] + self.spelled[right]
        if text not in self.of:
            self.of[text] = code = self.symbol(self.size)
            self.spelled[code] = text
            self.size += 1
        return self.of[text]


class Counts:
    """Counts of pairs with the most frequent at hand, the lowest first among equals."""

    def __init__(self):
        self.n: dict[int, int] = defaultdict(int)
        self.heap: list = []

    def add(self, pair: int, n: int, rank: int | None = None) -> None:
        self.n[pair] += n
        if self.n[pair] > 0:
            heapq.heappush(self.heap, (-self.n[pair], pair if rank is None else rank, pair))

    def best(self) -> tuple[int, int]:
        """(pair, count), or (-1, 0) without any."""
        while self.heap and -self.heap[0][0] != self.n[self.heap[0][2]]:
            heapq.heappop(self.heap)
        return (self.heap[0][2], -self.heap[0][0]) if self.heap else (-1, 0)


def first_guess(sample: list[tuple[str, int]], names: Names, size: int) -> tuple[list[Merge], int]:
    """Merges learned from some pieces alone, and how often the last one occurs in them."""
    names, counts, holders = names.copy(), Counts(), defaultdict(set)
    words = [[ord(c) for c in symbols] for symbols, _ in sample]

    def pairs(word):
        return [a << BITS | b for a, b in zip(word, word[1:])]

    starting: dict[int, int] = defaultdict(int)
    for i, word in enumerate(words):
        for p in pairs(word):
            starting[p] += sample[i][1]
            holders[p].add(i)
    for p, n in starting.items():
        counts.add(p, n)
    merges, last = [], 0
    while len(merges) < size:
        pair, n = counts.best()
        if pair < 0:
            break
        left, right = pair >> BITS, pair & MASK
        merges.append((left, right, names.merge(left, right)))
        last, changed = n, defaultdict(int)
        for i in holders.pop(pair):
            word, k, out = words[i], 0, []
            while k < len(word):
                if k + 1 < len(word) and word[k] == left and word[k + 1] == right:
                    out.append(merges[-1][2])
                    k += 2
                else:
                    out.append(word[k])
                    k += 1
            if len(out) == len(word):
                continue
            for p in pairs(word):
                changed[p] -= sample[i][1]
            for p in pairs(out):
                changed[p] += sample[i][1]
                holders[p].add(i)
            words[i] = out
        for p, n in changed.items():
            if n:
                counts.add(p, n)
    return merges, last


def judged(by_step: dict[int, list], tried: list[Merge], floor: int, names: Names, most: int, wanted: int) -> tuple[list, list, int]:
    """(merges that are right, the next guess after them, a floor for it).

    ``names`` takes up the tokens of the merges that are right. After them the
    recorded changes are played in the order that they call for: those of two
    merges with no symbol in common do not depend on which came first.
    """
    counts, right, guess = Counts(), [], []
    steps: dict[int, list[int]] = defaultdict(list)
    for t, (a, b, _) in reversed(list(enumerate(tried, 1))):
        steps[a << BITS | b].append(t)
    unborn = {c for _, _, c in tried} - names.spelled.keys()
    now: dict[int, int] = {}  # symbol in ``tried`` -> symbol in the next guess
    waiting: dict[int, list] = defaultdict(list)
    made, sure, last = names, True, None

    def put(pair, n):
        missing = [c for c in (pair >> BITS, pair & MASK) if c in unborn]
        if missing:
            counts.n[pair] += n
            waiting[missing[0]].append(pair)
        else:
            left, right = (now.get(c, c) for c in (pair >> BITS, pair & MASK))
            counts.add(pair, n, left << BITS | right)

    for pair, n in by_step.get(0, ()):
        put(pair, n)
    while len(right) + len(guess) < wanted:
        pair, n = counts.best()
        if n <= floor:
            break
        t = steps[pair].pop() if steps[pair] else None
        if sure and (t != len(right) + 1 or t > most):
            sure, made = False, names.copy()
        left, after = (now.get(c, c) for c in (pair >> BITS, pair & MASK))
        (right if sure else guess).append((left, after, made.merge(left, after)))
        last = n
        changed = list(by_step.get(t, ())) if t else []
        if t and tried[t - 1][2] in unborn:
            unborn.remove(tried[t - 1][2])
            now[tried[t - 1][2]] = made.of[made.spelled[left] + made.spelled[after]]
            changed += [(p, 0) for p in waiting.pop(tried[t - 1][2], ())]
        for p, d in changed:
            put(p, d)
        if not sure and counts.n[pair] > 0:
            counts.n[pair] = 0  # how often it occurs now was not recorded
    else:
        return right, guess, last * 9 // 10
    made, played = names.copy() if sure else made, {(a, b) for a, b, _ in right + guess}
    for a, b, c in tried:  # the others as they came, if their symbols are made
        left, after = now.get(a, a), now.get(b, b)
        if unborn.isdisjoint((a, b)) and (left, after) not in played:
            guess.append((left, after, made.merge(left, after)))
            if c in unborn:
                unborn.remove(c)
                now[c] = guess[-1][2]
    return right, guess[: wanted - len(right)], floor // 2


def learn(words: DataFrame, stage: RollingTable, names: Names, size: int) -> tuple[list[Merge], DataFrame]:
    """Merges of a (symbols, n) table until ``names`` holds ``size`` tokens, and the table, kept in ``stage``, with them made.

    They end earlier if no more pairs are left, or if two trials in a row kept no merge.
    """
    table, merges, idle = RollingTable(words.sparkSession, "trial"), [], 0
    while names.size < size and idle < 2:
        block = min(size - names.size, MOST_TRIED)
        wanted = block + block // 4 + 64  # some more, so that the changes of those that may take a place are known
        guess, last = first_guess(_sample(words, GUESS_PIECES), names, wanted)
        kept: list[Merge] = []
        floor, idle = max(last * 9 // 10 - 1, 0), 0 if guess else 2
        while len(kept) < block and idle < 2:
            tried = changes(words, kept + guess, len(kept)).where(F.col("top") > floor)
            by_step, floor = _taken(table.put(tried), floor)
            right, guess, floor = judged(by_step, guess, floor, names, block - len(kept), wanted - len(kept))
            kept += right
            idle = 0 if right else idle + 1
            if REWRITE_FROM <= len(kept) < block:
                words = stage.put(rewritten(words, kept).where(F.char_length("symbols") > 1))
                merges += kept
                block, wanted, kept = block - len(kept), wanted - len(kept), []
        merges += kept
        if names.size < size and kept:
            words = stage.put(rewritten(words, kept).where(F.char_length("symbols") > 1))
    table.drop()
    return merges, words
