"""Packing into training sequences by power-of-two decomposition.

A document is cut into pieces whose lengths are powers of two: as many pieces of the longest length as
fit, then the binary digits of the rest, longest first. Equal lengths form a bucket, every piece is a
sequence of its own, and so no sequence crosses documents and none is padded. A training step takes
its batch from one bucket.

The work is row-local: nothing is shuffled, a document is held by one task while it is cut, and a lost
executor costs only its tasks. The vocabulary's ids per word are kept in a cache of bounded size.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger.llm.common import give_back, in_batches

MAX_LENGTH = 4096
END_ID = 2
#: Bytes that a worker spends on the runs and ids it remembers, and those of a run besides its text and ids.
CACHE_BYTES, RUN_BYTES = 64 << 20, 100
#: Letters that stand for themselves in every normal form, and marks other than quotes and brackets.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzäöüßñáéíóúàèìòùâêîôûçÄÖÜÑÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÇ"
MARKS = b"!\"#$%&()*+,-./:;=?@"
#: Kinds of bytes.
SPACE, LETTER, MARK = 1, 2, 3
BATCH_BYTES = 2 << 20
#: Runs that the whole tokenizer sees at a time.
LEARN_RUNS = 1000

_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of a text, found run by run.

    The tokenizer's own pattern never joins characters across a space, nor a letter and a mark of
    `MARKS`. Texts are parted there, equal runs of a batch are encoded once, and remembered: a dictionary
    has the place of each run, an Arrow array the ids by place.
    """

    def __init__(self, path: str):
        import numpy as np
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already; threads beside them cost CPU and memory
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in LETTERS if not c.isascii()}
        self.letters = re.compile(f"[{LETTERS}]+").fullmatch
        self.known: dict[str, int] = {}
        self.ids, self.used, self.turn, self.bytes = pa.array([], pa.large_binary()), np.zeros(0, np.int64), 0, 0

    def _learn(self, runs: list[str]) -> pa.Array:
        found, other = [b""] * len(runs), []
        for place, run in enumerate(runs):
            if self.letters(run):  # one token run, normal but for its case: only the merges are left to do
                tokens = self.model.tokenize(run.lower().translate(self.as_bytes))
                found[place] = array("I", [t.id for t in tokens]).tobytes()
            else:
                other.append(place)
        for at in range(0, len(other), LEARN_RUNS):
            some = other[at : at + LEARN_RUNS]
            encoded = self.tokenizer.encode_batch_fast([runs[p] for p in some], add_special_tokens=False)
            for place, one in zip(some, encoded, strict=True):
                found[place] = array("I", one.ids).tobytes()
        return pa.array(found, pa.large_binary())

    def _forget(self) -> None:
        """Beyond CACHE_BYTES, the half of the runs that was used last stays, so frequent runs do; none, if few long ones fill it."""
        import numpy as np

        if self.bytes + self.ids.nbytes > CACHE_BYTES:
            kept = np.sort(np.argsort(-self.used, kind="stable")[: len(self.used) // 2])
            runs = list(self.known)  # in the order of their places
            self._keep([runs[place] for place in kept.tolist()], kept)
            if self.bytes + self.ids.nbytes > CACHE_BYTES:
                self._keep([], kept[:0])

    def _keep(self, runs: list[str], places) -> None:
        self.ids, self.used = self.ids.take(pa.array(places)), self.used[places]
        self.known = dict(zip(runs, range(len(runs)), strict=True))
        self.bytes = _size(runs)

    def _places(self, runs: list[str]):
        """The places of different runs."""
        import numpy as np

        self._forget()
        known = self.known
        places = np.fromiter((known.get(run, -1) for run in runs), np.int64, len(runs))
        new = np.flatnonzero(places < 0)
        learnt = [runs[i] for i in new.tolist()]
        ids = pa.concat_arrays([self.ids, self._learn(learnt)])
        places[new] = np.arange(len(self.ids), len(ids))
        known.update(zip(learnt, range(len(self.ids), len(ids)), strict=True))
        self.ids, self.used, self.bytes = ids, np.append(self.used, np.zeros(len(new), np.int64)), self.bytes + _size(learnt)
        self.turn += 1
        self.used[places] = self.turn
        return places

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; NULL has none."""
        import numpy as np

        runs, first_run = part(texts)
        coded = runs.dictionary_encode()
        places = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        picked = self.ids.take(pa.array(places[coded.indices.to_numpy(zero_copy_only=False)]))
        bounds = np.frombuffer(picked.buffers()[1], np.int64)[first_run].tolist()
        data = memoryview(picked.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def _size(runs: list[str]) -> int:
    return sum(map(sys.getsizeof, runs)) + RUN_BYTES * len(runs)


def part(texts: pa.Array):
    """The runs of all texts, one after another, and where those of each text begin (and the last ones end).

    Runs are parted by blanks, line ends and tabs, and where a listed letter and a listed mark meet. All listed letters beyond
    ASCII are two bytes that begin with C3, so this is read off the bytes.
    """
    import numpy as np
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = np.zeros(256, np.uint8)
    kind[list(b" \n\t")], kind[list(MARKS)] = SPACE, MARK
    kind[[ord(c) for c in LETTERS if c.isascii()]] = LETTER
    second = np.zeros(256, bool)
    second[[c.encode()[1] for c in LETTERS if not c.isascii()]] = True

    of = kind[data]
    letter_starts = of == LETTER
    letter_ends = letter_starts.copy()
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[second[data[lead + 1]]]
    letter_starts[lead] = True
    letter_ends[lead + 1] = True
    mark, inside = of == MARK, of != SPACE
    edge = np.zeros(len(data) + 1, bool)  # a run begins here, where no blank does
    edge[1:-1] = ~inside[:-1] | (letter_ends[:-1] & mark[1:]) | (mark[:-1] & letter_starts[1:])
    edge[offsets] = True
    starts = np.flatnonzero(edge[:-1] & inside)
    ends = np.concatenate(([0], np.cumsum(inside, dtype=np.int32 if len(data) < 2**31 else np.int64)))  # runs follow one another once the blanks are gone
    places = ends[starts]
    bounds = np.append(places, ends[-1])
    text = pa.py_buffer(np.ascontiguousarray(data[inside]))
    runs = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int64)), text)
    return runs, np.searchsorted(starts, offsets)


def piece_lengths(n: int, longest: int) -> list[int]:
    """As many of the longest as fit, then the binary digits of the rest from high to low."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(path: str, end_id: int, longest: int):
    """A function over Arrow batches (key, text): one row per piece."""
    import numpy as np

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(path) or _encoders.setdefault(path, WordEncoder(path))
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            give_back()
            for part in _bounded(batch):
                rows, starts, lengths, ids, totals = [], [], [], [], []
                for row, found in enumerate(encoder.encode(part.column(1))):
                    found += end
                    n, start = len(found) // 4, 0
                    for length in piece_lengths(n, longest):
                        rows.append(row)
                        starts.append(start)
                        lengths.append(length)
                        ids.append(found[4 * start : 4 * (start + length)])
                        totals.append(n)
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())],
                    names=["key", "start", "length", "ids", "doc_tokens"],
                )

    return cut


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about BATCH_BYTES of text each; a longer document is a part of its own."""
    rows = max(1, int(batch.num_rows * BATCH_BYTES // max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def pack(
    documents: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, longest: int = MAX_LENGTH,
) -> DataFrame:
    """One row per piece: the document's other columns are left out, `doc_id` keeps its name and type.

    * `start`, `length`: where the piece lies in the document's ids, the end id included; `doc_tokens`:
      how many those are; `ids`: the piece's ids as little-endian unsigned 32-bit numbers.
    * `bucket`: log2 of the length; `sequence_id`: one per piece; `offset`: 0, as a piece opens its sequence.

    NULL and empty texts are the end id alone. Repeated rows and rows with a NULL `doc_id` are packed
    each on its own. An empty table gives no rows. Other columns, whatever their names, are not read.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest length must be a power of two")
    read = documents.select(F.col(doc_id).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("key", read.schema["key"].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
    ])
    pieces = in_batches(read).mapInArrow(_pieces(tokenizer_path, end_id, longest), schema)
    return pieces.select(
        F.col("key").alias(doc_id), "start", "length", "ids", "doc_tokens",
        F.round(F.log2("length")).cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the sequences by bucket, so that a reader draws batches of one length without padding."""
    pieces.write.partitionBy("bucket").parquet(path)
