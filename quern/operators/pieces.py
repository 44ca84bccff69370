"""Pre-tokenising text into pieces, and counting pieces and adjacent pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The public GPT-2 splitting pattern (whitespace spelled as the
# Unicode property) and the marker between documents.
PIECE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+"
    r"|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
)
END_OF_TEXT = "<|endoftext|>"

STRETCH = 512  # symbols of a piece handled at a time
HELD_BYTES = 32 << 20  # stretches of text and their counts that a task holds before it adds them up

# White space as the pattern has it, for Arrow's expressions.
_WHITE = r"[\x09-\x0d \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# The byte alphabet: printable Latin-1 bytes stand for themselves, the others
# take the code points from 256 on, in byte order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _PRINTABLE]
RAW_CHARS = "".join(map(chr, _HIDDEN))
SHOWN_CHARS = "".join(chr(256 + i) for i in range(len(_HIDDEN)))
BYTE_SYMBOLS = [chr(b) if b in _PRINTABLE else chr(256 + _HIDDEN.index(b)) for b in range(256)]


def split_pieces(text: Column, special: str | None = None) -> Column:
    """Array of pieces of ``text``. Text equal to ``special`` is a piece of its own,
    and the text on either side of it is split separately."""
    def plain(col: Column) -> Column:
        return F.regexp_extract_all(col, F.lit(PIECE_PATTERN), F.lit(0))

    if special is None:
        return plain(text)
    quoted = "".join("\\" + c if c in r"\|.^$*+?()[]{}" else c for c in special)
    parts = F.transform(
        F.split(text, quoted),
        lambda part, i: F.concat(F.when(i > 0, F.array(F.lit(special))).otherwise(F.array().cast("array<string>")),
                                 plain(part)))
    # Most texts hold no special token: keep them on the one-pass expression.
    return F.when(F.contains(text, F.lit(special)), F.flatten(parts)).otherwise(plain(text))


def pretokenize(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_index",)) -> DataFrame:
    """One row per piece: the kept columns, ``pos`` and ``piece``."""
    return df.select(*keep, F.posexplode(split_pieces(F.col(text))).alias("pos", "piece"))


def _stretch_counter():
    """Arrow function from texts to (stretch, n): texts cut before each space that follows something else than white space.

    Nothing that the pattern matches goes on past such a place or looks beyond
    it, so the pieces of a text are those of its stretches.
    """
    white, most = _WHITE, HELD_BYTES

    def stretches(texts):
        """The first stretch of each text, and all others without the space that they start with."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words = pc.split_pattern(texts, " ")
        values, sizes = words.flatten(), pc.list_value_length(words).to_numpy()
        first = np.zeros(len(values), bool)
        first[np.cumsum(sizes) - sizes] = True
        if pc.any(pc.match_substring_regex(texts, white + " ")).as_py():
            open_end = pc.match_substring_regex(values, rf"(^|{white})\z").to_numpy(zero_copy_only=False)
            own = first | ~np.append(False, open_end[:-1])
            starts = np.append(np.flatnonzero(own), len(own)).astype(np.int32)
            values, first = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts), values), " "), first[own]
        return values.filter(pa.array(first)), values.filter(pa.array(~first))

    def added_up(held):
        import pyarrow as pa

        sums = pa.concat_tables(held).group_by("stretch", use_threads=False).aggregate([("n", "sum")])
        return sums.select(["stretch", "n_sum"]).rename_columns(["stretch", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        import pyarrow.compute as pc

        held = []
        for batch in batches:
            texts = batch.column(0).drop_null()
            if not len(texts):
                continue
            for values, lead in zip(stretches(texts), ("", " ")):
                counted = pc.value_counts(values)
                found = pc.binary_join_element_wise(lead, counted.field("values"), "")
                held.append(pa.table({"stretch": found, "n": counted.field("counts")}))
            if sum(part.nbytes for part in held) > most:
                held = [added_up(held)]
                if held[0].nbytes > most // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from added_up(held).to_batches()

    return count


def piece_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """How often each distinct piece occurs.

    Tasks count stretches of text; the pattern is matched on the distinct ones of a task only.
    """
    counted = df.select(F.col(text).alias("text")).mapInArrow(_stretch_counter(), "stretch string, n bigint")
    return (counted.select(F.explode(split_pieces(F.col("stretch"))).alias("piece"), "n")
            .groupBy("piece").agg(F.sum("n").alias("n")))


def to_symbols(piece: Column) -> Column:
    """A piece as a string with one byte-alphabet character per UTF-8 byte."""
    return F.translate(F.decode(F.encode(piece, "UTF-8"), "ISO-8859-1"), RAW_CHARS, SHOWN_CHARS)


def from_symbols(symbols: Column) -> Column:
    """Inverse of ``to_symbols``; bytes that are not UTF-8 become replacement characters."""
    # ``translate`` deletes what it maps to NUL, so NUL is put back separately.
    chars = F.replace(F.translate(symbols, SHOWN_CHARS[1:], RAW_CHARS[1:]), F.lit(SHOWN_CHARS[0]), F.lit("\0"))
    return F.make_valid_utf8(F.encode(chars, "ISO-8859-1").cast("string"))


def gram_counts(words: DataFrame, symbols: str = "symbols", n: str = "n", triples: bool = False) -> DataFrame:
    """Weighted counts of neighbouring symbols, as (gram, n): pairs, and triples if asked.

    One row per position, cut out by ``substring``, stays in generated code.
    Finding a position takes a walk from the start of the string, so a long
    piece is first cut into stretches that overlap by two symbols.
    """
    parts = words.selectExpr(
        f"`{symbols}` AS s", f"`{n}` AS n",
        f"explode(CASE WHEN char_length(`{symbols}`) > 1 "
        f"THEN sequence(1, char_length(`{symbols}`) - 1, {STRETCH}) ELSE array() END) AS at",
    ).selectExpr(f"substring(s, at, {STRETCH + 2}) AS part", "n",
                 f"explode(sequence(1, least({STRETCH}, char_length(s) - at))) AS i")
    if triples:
        grams = parts.selectExpr("substring(part, i, 3) AS run", "n").selectExpr(
            "explode(CASE WHEN char_length(run) = 3 THEN array(left(run, 2), run) ELSE array(run) END) AS gram", "n")
    else:
        grams = parts.selectExpr("substring(part, i, 2) AS gram", "n")
    return grams.groupBy("gram").agg(F.sum("n").alias(n))


def pair_counts(words: DataFrame, piece: str = "piece", n: str = "n") -> DataFrame:
    """Weighted counts of adjacent byte pairs over a (piece, n) table."""
    shown = words.select(to_symbols(F.col(piece)).alias("symbols"), F.col(n).alias("n"))
    return (gram_counts(shown)
            .select(F.substring("gram", 1, 1).alias("left"), F.substring("gram", 2, 1).alias("right"), "n"))
