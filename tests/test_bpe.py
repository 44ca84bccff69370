import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

from quern import catalog
from quern.operators import bpe, pieces
from quern.plans.stage import fresh_path

SIZE = 420
EDGE = ["", " ", "a<|endoftext|> b  <|endoftext|>", "<|endoftext|>", "<|endoftext|", "\U0001f600 é 　 x\n\n  y", "aaaa" * 700,
        "don't I'll we've", " \u0085 ​\u001c x", "\x00\x00a\x00", "１２ 12 Ⅻ ²", "﻿á"]


@pytest.fixture(scope="module")
def texts(documents):
    return [r[0] for r in documents.orderBy("doc_id").select("text").collect()]


@pytest.fixture(scope="module")
def package(texts, tmp_path_factory):
    tok = Tokenizer(models.BPE(unk_token=None))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    tok.train_from_iterator(iter(texts), trainer=trainers.BpeTrainer(
        vocab_size=SIZE, special_tokens=["<|endoftext|>"], initial_alphabet=pre_tokenizers.ByteLevel.alphabet(),
        show_progress=False))
    path = str(tmp_path_factory.mktemp("tok") / "tokenizer.json")
    tok.save(path)
    return tok, path


@pytest.fixture(scope="module")
def learned(spark, documents):
    return bpe.train(pieces.piece_counts(documents), SIZE)


def test_training_matches_the_public_package(spark, learned, package):
    tok, path = package
    assert {t: i for i, t in enumerate(learned.tokens)} == tok.get_vocab()
    assert learned == bpe.Vocabulary.from_json(spark, path)
    assert learned.eot_id == 0 and learned.size == SIZE


def trained_by_the_package(spark, texts, size, path):
    tok = Tokenizer(models.BPE(unk_token=None))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.train_from_iterator(iter(texts), trainer=trainers.BpeTrainer(
        vocab_size=size, special_tokens=["<|endoftext|>"], initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False))
    tok.save(path)
    return bpe.Vocabulary.from_json(spark, path)


def test_training_2048_ids_matches_the_public_package(spark, sf, tmp_path):
    docs = catalog.plain_documents(spark, sf)
    want = trained_by_the_package(spark, [r[0] for r in docs.select("text").collect()], 2_048, str(tmp_path / "tokenizer.json"))
    assert want.size == 2_048
    got = catalog.QUERIES["bpe_train_large"](spark, sf).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(k, *m) for k, m in enumerate(want.merges)]


@pytest.mark.parametrize("known, most, every", [(60, 80, 5), (3, 10_000, 1)])
def test_training_with_few_known_runs(spark, documents, package, monkeypatch, known, most, every):
    """Counts that are soon too short, and pieces rewritten at once, change nothing."""
    monkeypatch.setattr(bpe, "KNOWN_GRAMS", known)
    monkeypatch.setattr(bpe, "MOST_KNOWN", most)
    monkeypatch.setattr(bpe, "CUT_EVERY", every)
    small = 300
    tok, path = package
    assert bpe.train(pieces.piece_counts(documents), small).merges == bpe.Vocabulary.from_json(spark, path).merges[:small - 257]


def test_rounds_exchange_only_what_changed(spark, documents, monkeypatch):
    """After the first count a round handles the runs of changed pieces, not those of all."""
    counts, seen = [], []
    plain = bpe.gram_counts
    monkeypatch.setattr(bpe, "gram_counts", lambda words, **k: (seen.append(words.count()), plain(words, **k))[1])
    monkeypatch.setattr(bpe, "_counted", lambda words, size, f=bpe._counted: (counts.append(words.count()), f(words, size))[1])
    bpe.train(pieces.piece_counts(documents), 330)
    changed = seen[1:]
    assert len(counts) == 1 and seen[0] == counts[0] and sum(changed) / len(changed) < counts[0]


def test_training_small_corpora_one_at_a_time(spark):
    """Short alphabets make overlapping pairs, ties and respelled tokens common."""
    rng = random.Random(11)
    for case in range(6):
        words = {"".join(rng.choice("abc"[: 2 + case % 2]) for _ in range(rng.randrange(1, 14))): rng.randrange(1, 9)
                 for _ in range(30)}
        found = bpe.train(spark.createDataFrame(list(words.items()), "piece string, n bigint"), 257 + 40)
        assert list(found.merges) == by_hand(words, 257 + 40), case


def by_hand(words, size):
    alphabet = sorted(pieces.BYTE_SYMBOLS)
    tokens = ["<|endoftext|>", *alphabet]
    table = [([tokens.index(c) for c in w], n) for w, n in words.items()]
    merges = []
    while len(tokens) < size:
        counts = {}
        for ids, n in table:
            for p in zip(ids, ids[1:]):
                counts[p] = counts.get(p, 0) + n
        if not counts:
            break
        a, b = min(counts, key=lambda p: (-counts[p], p))
        spelled = tokens[a] + tokens[b]
        if spelled not in tokens:
            tokens.append(spelled)
        new = tokens.index(spelled)
        merges.append((a, b, new))
        for ids, _ in table:
            i = 0
            while i < len(ids) - 1:
                if (ids[i], ids[i + 1]) == (a, b):
                    ids[i: i + 2] = [new]
                i += 1
    return merges


def test_vocabulary_size_bounds(spark):
    for size in (256, 65_537):
        with pytest.raises(ValueError):
            bpe.train(spark.createDataFrame([("a", 1)], "piece string, n bigint"), size)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_coding_matches_the_public_package(spark, learned, package, texts, parts):
    tok, _ = package
    df = spark.createDataFrame(list(enumerate(texts + EDGE)), "i int, text string").repartition(parts)
    rows = bpe.decode(bpe.encode(df, learned), learned).collect()
    assert len(rows) == len(texts) + len(EDGE)
    for r in rows:
        assert r.ids == tok.encode(r.text, add_special_tokens=False).ids
        assert r.decoded == tok.decode(r.ids)
        assert r.decoded == r.text.replace("<|endoftext|>", "")


def test_a_batch_is_coded_in_stretches_of_few_rows(spark, learned, texts, monkeypatch):
    """The widest buffer a task makes follows STRETCH_PIECES, not the rows of its batch."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    whole = {r.i: r.ids for r in bpe.encode(df, learned).collect()}
    monkeypatch.setattr(bpe, "STRETCH_PIECES", 50)
    monkeypatch.setattr(bpe, "MOST_IN_TURN", 0)
    coder = bpe._coder(learned).func
    pieces = df.select(bpe.split_pieces(F.col("text"), bpe.END_OF_TEXT).alias("p")).toArrow()["p"].combine_chunks()
    parts = list(coder(iter([pieces])))
    assert len(parts) > len(texts) // 50 and [ids for p in parts for ids in p.to_pylist()] == [whole[i] for i in range(len(texts))]


def test_merges_that_respell_a_token_are_made_by_rank(spark):
    """``abc`` has two spellings, and its pair with ``d`` ranks between them: one pass over the merges would miss it."""
    at = {c: 1 + sorted(pieces.BYTE_SYMBOLS).index(c) for c in "abcdx"}
    tokens = (bpe.END_OF_TEXT, *sorted(pieces.BYTE_SYMBOLS), "xa", "abc", "abcd", "bc")
    plain = ((at["x"], at["a"], 257), (at["b"], at["c"], 260))
    again = (*plain, (258, at["d"], 259), (at["a"], 260, 258))
    for merges, text, ids in ((plain, "xabc", [257, 260]), (again, "abcd", [259]), (again, "aé\nbc", None)):
        got = bpe.encode(spark.createDataFrame([(text,)], "text string"), bpe.Vocabulary(tokens, merges)).first().ids
        assert ids is None or got == ids
        assert bpe.decode(spark.createDataFrame([(got,)], "ids array<int>"), bpe.Vocabulary(tokens, merges)).first().decoded == text


def test_null_text_has_no_ids(spark, learned):
    df = spark.createDataFrame([(None,)], "text string")
    assert bpe.encode(df, learned).first()["ids"] == []
    assert bpe.encode(df.where("1 = 0"), learned).count() == 0


def test_decoding_any_ids(spark, learned, package):
    tok, _ = package
    rng = random.Random(1)
    rows = [(i, [rng.randrange(SIZE) for _ in range(rng.randrange(1, 25))]) for i in range(500)]
    for r in bpe.decode(spark.createDataFrame(rows, "i int, ids array<int>"), learned).collect():
        assert r.decoded == tok.decode(r.ids)


def test_half_a_character_decodes_to_the_replacement_character(spark, learned):
    ids = [learned.tokens.index(pieces.BYTE_SYMBOLS[0xC3])]
    assert bpe.decode(spark.createDataFrame([(ids,)], "ids array<int>"), learned).first()["decoded"] == "�"


def test_pieces_are_lossless_and_match_the_package(spark, texts):
    tok = pre_tokenizers.ByteLevel(add_prefix_space=False)
    df = spark.createDataFrame(list(enumerate(texts + EDGE)), "doc_index int, text string")
    shown = pieces.pretokenize(df).withColumn("s", pieces.to_symbols(F.col("piece")))
    got = {r.doc_index: (r.p, r.s) for r in shown.groupBy("doc_index").agg(
        F.sort_array(F.collect_list(F.struct("pos", "piece")))["piece"].alias("p"),
        F.sort_array(F.collect_list(F.struct("pos", "s")))["s"].alias("s")).collect()}
    for i, text in enumerate(texts + EDGE):
        p, s = got.get(i, ([], []))
        assert "".join(p) == text
        assert s == [t for t, _ in tok.pre_tokenize_str(text)]


@pytest.mark.parametrize("triples", [False, True])
def test_gram_counts_of_long_and_short_pieces(spark, triples):
    words = [("a", 5), ("ab", 2), ("aaa", 3), ("xyz" * 700, 1), ("q" * 513, 1), ("r" * 514, 2)]
    want = {}
    for w, n in words:
        for width in (2, 3) if triples else (2,):
            for i in range(len(w) - width + 1):
                want[w[i: i + width]] = want.get(w[i: i + width], 0) + n
    df = spark.createDataFrame(words, "symbols string, n bigint")
    assert {r.gram: r.n for r in pieces.gram_counts(df, triples=triples).collect()} == want


def test_pair_counts_are_over_bytes(spark):
    df = spark.createDataFrame([(" é", 3)], "piece string, n bigint")
    got = {(r.left, r.right): r.n for r in pieces.pair_counts(df).collect()}
    assert got == {("Ġ", "Ã"): 3, ("Ã", "©"): 3}


def test_symbols_round_trip_for_every_byte(spark):
    df = spark.createDataFrame([(chr(c),) for c in range(0x500)], "t string")
    assert df.where(pieces.from_symbols(pieces.to_symbols(F.col("t"))) != F.col("t")).count() == 0


def test_guard(spark, learned, documents):
    path = fresh_path(spark, "vocab")
    with pytest.raises(FileNotFoundError, match="required"):
        bpe.ensure(spark, path, SIZE, documents, required=True)
    with pytest.raises(FileNotFoundError):
        bpe.ensure(spark, path, SIZE)
    learned.save(spark, path)
    again = bpe.ensure(spark, path, SIZE, required=True)
    assert again == learned and again.fingerprint == learned.fingerprint
    assert learned.table(spark).count() == SIZE and learned.merge_table(spark).count() == len(learned.merges)


def test_eot(spark):
    df = spark.createDataFrame([([5],), ([],)], "ids array<int>")
    assert [r.ids for r in bpe.with_eot(df, 0).collect()] == [[5, 0], [0]]
