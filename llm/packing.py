"""Best-fit packing of tokenised documents, planned on a histogram of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from pathlib import Path
from struct import pack as packed_ids
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import partitions, stored

#: Tokens of a sequence, and the id that ends a document.
CAPACITY = 4096
END_ID = 1
ID_BYTES = 4
SHORT_BYTES = 2
#: Words whose ids a task remembers, and signs of texts that it takes at a time.
CACHED_WORDS = 800_000
SIGNS = 1 << 20
#: Pieces whose ids a task widens at a time.
PIECES_AT_A_TIME = 1_000

#: Marks that end words: neither letters, digits nor blanks.
MARKS = ".,;:!?%&*$#|()[]{}\"'-+=/<>~^_`@\\"
#: Below it, lower case and composition are the same everywhere.
PLAIN = "\u0130"
#: How byte-level vocabularies show bytes that have no sign of their own.
SHOWN = {
    byte: 256 + i
    for i, byte in enumerate([*range(33), *range(127, 161), 173])
}
#: Ranks that a planned range is joined by.
RANKS = 64

#: ``ids`` are a piece's ids as little-endian numbers of ``ID_BYTES`` bytes; until the
#: pieces have their places, of ``SHORT_BYTES`` if no id of the vocabulary needs more.
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class WordIds:
    """The ids of texts, from those of their words between blanks.

    The vocabulary's splitting rule, special tokens and normaliser never see beyond
    a blank or line end, which they drop, so a text's ids are those of its words one after the
    other, and each distinct word is encoded once. Letters form a run of their own,
    and so do marks behind them; plain letters go to the vocabulary's model at once,
    anything else through all of the tokenizer.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian numbers of four bytes."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > SIGNS:
                yield from self._encoded(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        if held:
            yield from self._encoded(held)

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        """Words are numbered by Arrow, and numpy puts the ids of their numbers in order."""
        texts = pa.array([x.replace("\n", " ") for x in texts], pa.large_string())
        split = pc.split_pattern(texts, " ")
        numbered = split.flatten().dictionary_encode()
        names = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        words = self.words
        if len(words) + len(names) > CACHED_WORDS:
            if len(words) + sum(x not in words for x in names) > CACHED_WORDS:
                words.clear()
                self.runs = {"": b""}
        ids = [words[x] if x in words else self._word(x) for x in names]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // ID_BYTES
        flat, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        number = numbered.indices.to_numpy()
        sizes = sizes[number]
        ends = np.cumsum(sizes)
        place = np.repeat(starts[number] - (ends - sizes), sizes)
        place += np.arange(len(place))
        ids = flat[place]
        bounds = np.append(0, ends)[split.offsets.to_numpy()]
        for low, high in zip(bounds, bounds[1:], strict=False):
            yield ids[low:high].tobytes()

    def _word(self, word: str) -> bytes:
        letters = word.rstrip(MARKS)
        if letters.isalpha() and (letters.isascii() or max(letters) < PLAIN):
            found = self._letters(letters.lower()) + self._any(word[len(letters) :])
        else:
            found = self._any(word)
        self.words[word] = found
        return found

    def _letters(self, run: str) -> bytes:
        found = self.runs.get(run)
        if found is None:
            shown = run if run.isascii() else run.encode().decode("latin-1").translate(SHOWN)
            ids = [x.id for x in self.model.tokenize(shown)]
            found = self.runs[run] = packed_ids(f"<{len(ids)}I", *ids)
        return found

    def _any(self, word: str) -> bytes:
        found = self.runs.get(word)
        if found is None:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = self.runs[word] = packed_ids(f"<{len(ids)}I", *ids)
        return found


def tokenised(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each row of ``docs`` (doc_id, text, ...).

    A document is its ids and one end id; a null or empty text is the end id alone.
    Documents of more than ``capacity`` ids are cut after every ``capacity``. The
    driver reads the vocabulary's file, which executors needn't have.
    """
    rules = compress(Path(vocabulary).read_bytes())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(decompress(rules))
        words = WordIds(tokenizer)
        largest = max(END_ID, *tokenizer.get_vocab(with_added_tokens=True).values())
        short = largest < 1 << 8 * SHORT_BYTES
        end = END_ID.to_bytes(ID_BYTES, "little")
        step = capacity * ID_BYTES
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc_id, packed in zip(ids, words.encode(texts), strict=True):
                packed += end
                for piece, at in enumerate(range(0, len(packed), step)):
                    own = packed[at : at + step]
                    held = np.frombuffer(own, "<u4").astype("<u2").tobytes() if short else own
                    rows.append((doc_id, piece, at // 4, len(own) // 4, crc32(own), held))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(cut, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Best-fit, longest first, over counts of lengths.

    Returns (length, first, last, each, sequence, offset): of the pieces of that
    length, ranks first to last go to sequences from ``sequence`` on, ``each`` of
    them one after the other from ``offset``. Sequences that hold the same lengths
    are one group here, so the work depends on the number of lengths alone.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # by room left: (first, sequences)
    rooms: list[int] = []  # in order
    out, sequences = [], 0

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                insort(rooms, room)
            groups.setdefault(room, []).append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = min(room // length, left)
            used = min(n, left // each)
            out.append((length, rank, rank + used * each, each, first, capacity - room))
            add(room - each * length, first, used)
            add(room, first + used, n - used)
            rank, left = rank + used * each, left - used * each
    return out


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; columns but those of PIECES are left out.

    The histogram, of at most ``capacity`` lengths, is all that the driver sees. A
    piece's rank within its length is its number within a slice of that length plus
    the sizes of the slices before; slices are dealt by a hash of the stored row's
    number, so pieces that share a length, or are alike in all columns, are spread.
    The plan's ranges meet the pieces by length and block of ranks, without the ids:
    these join what was planned by a number that each stored piece has. Repeated rows
    are packed each; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    slices = 4 * partitions(spark)
    names = [x.split()[0] for x in PIECES.split(", ")]
    whole = stored(pieces.select(*names, F.monotonically_increasing_id().alias("_row")))
    cut = F.pmod(F.xxhash64("_row"), F.lit(slices))
    pieces = stored(whole.drop("ids").withColumn("_slice", cut))
    sizes = stored(pieces.groupBy("length", "_slice").agg(F.count("*").alias("n")))
    totals = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()
    ranges = plan({x.length: x.n for x in totals}, capacity)
    schema = "length long, first long, last long, each long, sequence long, offset0 long"
    ranges = spark.createDataFrame(ranges, schema)
    blocks = F.sequence(F.expr(f"first div {RANKS}"), F.expr(f"(last - 1) div {RANKS}"))
    ranges = ranges.withColumn("block", F.explode(blocks))

    before = Window.partitionBy("length").orderBy("_slice")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("length", "_slice").orderBy("_row")
    ranked = pieces.withColumn("number", F.row_number().over(within) - 1)
    ranked = ranked.join(starts.drop("n"), ["length", "_slice"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("number"))
    ranked = ranked.withColumn("block", F.expr(f"rank div {RANKS}"))

    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    slot = F.col("rank") - F.col("first")
    found = ranked.join(ranges, ["length", "block"]).where(inside)
    found = found.select(
        "_row",
        (F.col("sequence") + F.expr("(rank - first) div each")).alias("sequence_id"),
        (F.col("offset0") + slot % F.col("each") * F.col("length")).alias("offset"),
    )
    found = whole.join(found, "_row").select(*names, "sequence_id", "offset")
    return found.mapInArrow(_widened, found.schema)


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with ids of ``ID_BYTES`` bytes; each piece has one id or more."""
    for batch in batches:
        for at in range(0, len(batch), PIECES_AT_A_TIME):
            part = batch.slice(at, PIECES_AT_A_TIME)
            place = part.schema.get_field_index("ids")
            held, lengths = part.column(place).to_pylist(), part.column("length").to_pylist()
            wide = [
                x if len(x) == n * ID_BYTES else np.frombuffer(x, "<u2").astype("<u4").tobytes()
                for x, n in zip(held, lengths, strict=True)
            ]
            yield part.set_column(place, "ids", pa.array(wide, pa.binary()))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs``, with their ids, in sequences of at most ``capacity`` tokens.

    A sequence's ids are those of its pieces by ``offset``, one after the other.
    """
    return packed(tokenised(docs, vocabulary, capacity), capacity)


def vocabulary_path() -> str:
    """The file of the public vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

