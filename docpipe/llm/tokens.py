"""Operator 8: tokens counted in overlapping chunks that are spliced where both sides agree."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import attach, table, text_of

MODEL = "piece_bpe_32k.model"
#: Bytes of a chunk, and of its overlap with the chunk before; longer texts are cut.
CHUNK, OVERLAP = 4096, 64
LIMIT = 4096


class Encoder:
    """A sentencepiece BPE model whose tokens have byte offsets.

    The model must keep texts as they are (no normalisation, no dropped spaces) and have byte
    fallback; `__init__` tries that out. A text's `▁` stands for a space, as in the library.
    """

    PROBE = "a  b \n\tc é 日本   ﬁ x "

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.bytes = np.array(
            [
                1 if self.model.is_byte(k)
                else len(self.model.id_to_piece(k).replace("▁", " ").encode())
                for k in range(size)
            ],
            np.int64,
        )
        tokens, ends = self.encode(self.PROBE.encode())
        if ends[-1] != len(self.PROBE.encode()):
            raise ValueError(f"{path} doesn't keep texts as they are")

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Token ids and the byte where each ends; the space that the library puts first counts none."""
        ids = np.array(self.model.encode(data.decode(), num_threads=1), np.int64)
        ends = np.cumsum(self.bytes[ids])
        return ids, ends - 1 if len(ends) else ends


def _cut(data: bytes, at: int) -> int:
    """The last start of a character at or before a byte."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return max(at, 0)


def _shared(left: tuple, right: tuple) -> tuple[int, int] | None:
    """The last token, by number in either list, that both have at the same place.

    Both are (ids, starts, ends) in bytes of the text.
    """
    same_end = np.isin(left[2], right[2])
    for i in np.flatnonzero(same_end)[::-1]:
        j = int(np.searchsorted(right[2], left[2][i]))
        while j < len(right[2]) and right[2][j] == left[2][i]:
            if right[0][j] == left[0][i] and right[1][j] == left[1][i] < left[2][i]:
                return int(i), j
            j += 1
    return None


def count(text: str, encoder: Encoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """How many tokens the library gives for the whole text, with one chunk encoded at a time.

    Byte-pair merges give the one cut of a text in which every two neighbours, taken alone, merge
    to just those two. So if two chunks that overlap both have a token at the same place, the
    tokens up to it from the left chunk and those after it from the right one are the tokens of
    both together: every two neighbours are neighbours in one of the chunks. Where the overlap has
    no such token it is doubled to the left, up to the whole left chunk; then the right chunk
    grows to the right, up to all of the text.
    """
    data = text.replace("▁", " ").encode()
    if len(data) <= chunk:
        return len(encoder.model.encode(text, num_threads=1))

    def piece(start: int, stop: int) -> tuple:
        ids, ends = encoder.encode(data[start:stop])
        begins = np.concatenate([[0], ends[:-1]])
        return ids, begins + start, ends + start

    start, stop = 0, _cut(data, chunk)
    left, done = piece(start, stop), 0
    while stop < len(data):
        width, reach = overlap, chunk
        while True:
            begin = _cut(data, max(start, stop - width))
            end = _cut(data, min(len(data), stop + reach))
            right = piece(begin, end)
            found = _shared(left, right)
            if found:
                break
            if begin > start:
                width *= 2
            elif end < len(data):
                reach *= 2
            else:
                # the pieces are as wide as they can be and share nothing: the text in one piece
                return len(piece(0, len(data))[0])
        done += found[0] + 1
        left = tuple(x[found[1] + 1 :] for x in right)
        start, stop = begin, end
    return done + len(left[0])


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, text: str = "text"
) -> DataFrame:
    """`docs` with `n_bytes` (UTF-8), `n_tokens` and `over_limit` of each whole text.

    Tokens are the library's for the model at `path`, without begin, end or added special tokens;
    control strings inside texts are ordinary text. Null is empty: no bytes, no tokens. A text of
    more than `chunk` bytes is encoded in overlapping chunks, so a task holds the text and the
    tokens of two chunks. Repeated rows are counted each; columns with the new names are replaced;
    an empty table stays empty.
    """

    def compute():
        encoder = Encoder(path)

        def step(batch: pa.RecordBatch) -> list:
            counts = [count(t.as_py(), encoder, chunk) for t in batch.column(0)]
            return [pa.array(counts, pa.int64())]

        return step

    counted = attach(docs, {"text": text_of(text)}, [T.StructField("n_tokens", T.LongType())], compute)
    return counted.withColumns(
        {
            "n_bytes": F.octet_length(text_of(text)).cast("long"),
            "over_limit": F.col("n_tokens") > limit,
        }
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")
