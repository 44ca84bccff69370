"""Learning many merges by trials: the same merges as one at a time, in few passes over the pieces."""

import random

import pytest

from quern.operators import bpe, pieces, trials
from tests.test_bpe import by_hand


@pytest.fixture
def tried(monkeypatch):
    """Trials made, as (merges followed, those of them known before)."""
    seen, plain = [], trials.changes
    monkeypatch.setattr(trials, "changes", lambda words, merges, base: (seen.append((len(merges), base)), plain(words, merges, base))[1])
    return seen


def no_round(*_):
    raise AssertionError("a round scanned all pieces")


def test_many_merges_take_few_passes(spark, documents, tried, monkeypatch):
    """Rounds of sure merges took a scan of all pieces for about eleven merges."""
    counts = pieces.piece_counts(documents)
    monkeypatch.setattr(bpe, "TRIAL_LEAST", 10_000)
    want = bpe.train(counts, 257 + 110).merges
    monkeypatch.setattr(bpe, "TRIAL_LEAST", 100)
    monkeypatch.setattr(bpe, "_changes", no_round)
    monkeypatch.setattr(bpe, "_counted", no_round)
    assert bpe.train(counts, 257 + 110).merges == want and len(tried) <= 2
    del tried[:]
    monkeypatch.setattr(trials, "GUESS_PIECES", 300)
    assert bpe.train(counts, 257 + 110).merges == want and 1 < len(tried) <= 11


@pytest.mark.parametrize("guessed, most", [(65_536, 4_096), (6, 4_096), (6, 9)])
def test_trials_of_small_corpora(spark, tried, monkeypatch, guessed, most):
    """Overlapping pairs, ties, respelled tokens and pairs that run out, with good and with poor guesses."""
    monkeypatch.setattr(bpe, "TRIAL_LEAST", 1)
    monkeypatch.setattr(trials, "GUESS_PIECES", guessed)
    monkeypatch.setattr(trials, "MOST_TRIED", most)
    monkeypatch.setattr(trials, "PORTION", 64)
    monkeypatch.setattr(trials, "REWRITE_FROM", 7)
    rng = random.Random(12)
    for case in range(3):
        words = {"".join(rng.choice("abcd"[: 2 + case % 3]) for _ in range(rng.randrange(1, 14))): rng.randrange(1, 9)
                 for _ in range(30)}
        found = bpe.train(spark.createDataFrame(list(words.items()), "piece string, n bigint"), 257 + 40)
        assert list(found.merges) == by_hand(words, 257 + 40), case
    assert tried


def test_more_changes_than_the_driver_takes(spark, documents, monkeypatch):
    counts = pieces.piece_counts(documents)
    want = bpe.train(counts, 257 + 60).merges
    monkeypatch.setattr(bpe, "TRIAL_LEAST", 1)
    monkeypatch.setattr(trials, "MOST_ROWS", 400)
    assert bpe.train(counts, 257 + 60).merges == want


def test_changes_add_up_to_the_counts_after_all_merges(spark):
    words = [("aaaaa", 2), ("abab", 3), ("xyz" * 700, 1), ("\U0001f600b".replace("\U0001f600", "Ã"), 4)]
    a, b, x, y, z, new = map(ord, "abxyzȀ")
    merges = [(a, a, new), (a, b, new + 1), (x, y, new + 2), (new + 2, z, new + 3), (new + 1, new + 1, new + 4)]
    df = spark.createDataFrame(words, "symbols string, n bigint")
    for base in (0, 2, 5):
        got = {}
        for r in trials.changes(df, merges, base).collect():
            got[r.pair] = got.get(r.pair, 0) + r.n
        made = trials.rewritten(df, merges)
        want = {r.gram: r.n for r in pieces.gram_counts(made).collect()}
        assert {chr(p >> trials.BITS) + chr(p & trials.MASK): n for p, n in got.items() if n} == want
    plain = words
    for left, right, merged in merges:
        plain = [(w.replace(chr(left) + chr(right), chr(merged)), n) for w, n in plain]
    assert sorted(tuple(r) for r in made.collect()) == sorted(plain)
