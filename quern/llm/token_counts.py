"""Token counts of texts by a sentencepiece model, without making their ids.

The model joins neighbouring symbols only to pieces of its vocabulary. Where two
neighbours stand side by side in no piece, no symbol ever spans that place, so a
text may be cut there: before white space, around line feeds and digits, between
letters and signs. The pre-tokens between such cuts are coded alike wherever
they stand. That every piece of the vocabulary is one pre-token is checked when
the model is opened.

1. pre-tokens are counted over all texts (per task first, then in one exchange);
2. each distinct one is coded once, for the number of its pieces only;
3. per-document frequencies meet these numbers and are summed up. The most
   frequent pre-tokens, a table of bounded size, are sent to every task and
   summed where the text is read; only the rest is joined by exchange, and as
   each of them is rare, no key of that join is hot.

Cases: a null or empty text has no bytes and no tokens. Documents are told apart
by a number of their own in the table of frequencies, so repeated rows, null ids
and ids with several texts keep a row each. Texts of any length are cut as a whole; a pre-token may be as long as its
text. Other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common

#: Fixed value: how the library writes a space inside pieces.
MARK = "▁"
#: Pre-tokens sent to every task, and the longest one among them: 30 MB at most.
COMMON = 1 << 18
COMMON_CHARS = 24
#: Frequencies are told apart in steps of this part of a doubling to find how many pre-tokens are common.
STEPS = 16
#: Distinct pre-tokens a task gathers before it hands them on.
GATHERED = 1 << 17
#: Characters of pre-tokens coded, and rows emitted, at a time.
CODED_CHARS = 1 << 20
ROWS = 1 << 14

_PRE_TOKEN = regex.compile(r" *(?:[\p{L}\p{M}]+|[0-9]|[^\p{L}\p{M}0-9 \n]+)| +|\n")
#: A line feed is coded by itself, so what follows it is coded as in the midst of a text.
ANCHOR = "\n"

_models: dict = {}


def model(path: str):
    """The model at ``path``, kept per worker process."""
    import sentencepiece

    if path not in _models:
        found = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [found.id_to_piece(i) for i in range(found.vocab_size()) if not (found.is_control(i) or found.is_byte(i) or found.is_unknown(i))]
        if any("\n" in p or len(_PRE_TOKEN.findall(p.replace(MARK, " "))) != 1 for p in pieces):
            raise ValueError(f"{path}: a piece spans a place where texts are cut")
        if found.encode("   ", out_type=str)[-1:] != [MARK] or found.encode(ANCHOR, out_type=str)[0] != MARK:
            raise ValueError(f"{path}: the model does not keep white space as it is, after a mark of its own")
        _models[path] = found
    return _models[path]


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens in order. A text begins with a mark of its own; a mark written out is a space to the model."""
    return _PRE_TOKEN.findall(" " + text.replace(MARK, " ")) if text else []


def piece_numbers(processor, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token."""
    alone = len(processor.encode(ANCHOR))
    out, lo, chars = [], 0, 0
    for i, token in enumerate(tokens):
        chars += len(token)
        if chars >= CODED_CHARS or i == len(tokens) - 1:
            out += [len(ids) - alone for ids in processor.encode([ANCHOR + t for t in tokens[lo:i + 1]], num_threads=1)]
            lo, chars = i + 1, 0
    return out


def _texts(batch: pa.RecordBatch, name: str):
    column = batch.column(batch.schema.get_field_index(name))
    for i in range(batch.num_rows):  # one at a time: a batch of long texts is not unpacked at once
        yield column[i].as_py() or ""


def vocabulary(docs: DataFrame, text: str) -> DataFrame:
    """(token, seen): every distinct pre-token and how often it occurs."""
    def run(batches):
        seen: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_pydict({"token": list(seen), "seen": list(seen.values())},
                                             pa.schema([("token", pa.string()), ("seen", pa.int64())]))

        for batch in batches:
            for value in _texts(batch, text):
                seen.update(pre_tokens(value))
                if len(seen) >= GATHERED:
                    yield from out()
                    seen.clear()
        yield from out()

    return docs.select(text).mapInArrow(common.tidy(run), "token string, seen bigint").groupBy("token").agg(F.sum("seen").alias("seen"))


def coded_vocabulary(docs: DataFrame, text: str, model_file: str) -> DataFrame:
    """(token, seen, pieces), each pre-token coded once; written once."""
    def run(batch):
        tokens = batch.column(0).to_pylist()
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(piece_numbers(model(model_file), tokens), pa.int64())], [*batch.schema.names, "pieces"])

    return common.kept(common.map_arrow(vocabulary(docs, text), run, "token string, seen bigint, pieces bigint"), "pre-tokens")


def common_pieces(coded: DataFrame) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens, COMMON at most: all from some frequency on."""
    short = coded.where(F.char_length("token") <= COMMON_CHARS).withColumn("step", F.floor(F.log2(F.col("seen")) * STEPS))
    least, held = None, 0
    for step, n in sorted(short.groupBy("step").count().collect(), reverse=True):  # STEPS * 63 rows at most
        held += n
        if held > COMMON:
            break
        least = step
    if least is None:
        return {}
    table = short.where(F.col("step") >= least).select("token", "pieces").toArrow()
    return dict(zip(table.column("token").to_pylist(), table.column("pieces").to_pylist()))


def frequencies(docs: DataFrame, doc_id: str, text: str, known) -> DataFrame:
    """Per document one row with the pieces of its common pre-tokens, and one per other pre-token with its frequency.

    Columns: row, id, n_bytes, known, token, n. In a document's own row
    ``token`` and ``n`` are null, in the others ``id``, ``n_bytes`` and
    ``known``; ``row`` is its number in the table. ``known`` is a broadcast of
    pieces by common pre-token. Written once, so that the numbers stand.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batch):
        pieces_of, ids = known.value, batch.column(batch.schema.get_field_index(doc_id))
        numbers = batch.column(batch.schema.get_field_index("row")).to_pylist()
        at, rows = [], []

        def out():
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            row, n_bytes, known_pieces, token, n = [pa.array(c, k) for c, k in zip(cols, kinds)]
            return pa.RecordBatch.from_arrays([row, ids.take(pa.array(at, pa.int32())), n_bytes, known_pieces, token, n],
                                              ["row", "id", "n_bytes", "known", "token", "n"])

        for i, value in enumerate(_texts(batch, text)):
            total = 0
            for token, n in Counter(pre_tokens(value)).items():
                pieces = pieces_of.get(token)
                if pieces is None:
                    rows.append((numbers[i], None, None, token, n))
                    at.append(None)
                else:
                    total += n * pieces
            rows.append((numbers[i], len(value.encode()), total, None, None))
            at.append(i)
            if len(rows) >= ROWS:
                yield out()
                at.clear()
                rows.clear()
        if rows:
            yield out()

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), doc_id, text)
    return common.kept(common.map_arrow(numbered, run, f"row bigint, id {kind}, n_bytes bigint, known bigint, token string, n bigint"), "frequencies")


def count_tokens(df: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_bytes and n_tokens of the text, without begin, end or other special tokens."""
    docs = common.narrow(df, doc_id=doc_id, text=text)
    coded = coded_vocabulary(docs, "_text", model_file)
    known = df.sparkSession.sparkContext.broadcast(common_pieces(coded))
    found = frequencies(docs, "_doc_id", "_text", known)
    known.destroy()
    whole = found.where(F.col("token").isNull()).select("row", "id", "n_bytes", F.col("known").alias("pieces"))
    rest = (found.where(F.col("token").isNotNull()).select("row", "token", "n").join(coded.select("token", F.col("pieces").alias("each")), "token")
            .select("row", F.lit(None).cast(whole.schema["id"].dataType).alias("id"), F.lit(None).cast("bigint").alias("n_bytes"),
                    (F.col("n") * F.col("each")).alias("pieces")))
    sums = whole.unionByName(rest).groupBy("row").agg(F.max("id").alias("id"), F.max("n_bytes").alias("n_bytes"), F.sum("pieces").alias("pieces"))
    return sums.select(F.col("id").alias(doc_id), "n_bytes", F.col("pieces").alias("n_tokens"))


def limits(df: DataFrame, model_file: str, most: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``count_tokens`` and whether a text has more than ``most`` tokens."""
    return count_tokens(df, model_file, doc_id, text).withColumn("over_limit", F.col("n_tokens") > most)
