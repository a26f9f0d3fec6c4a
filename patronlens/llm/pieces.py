"""SentencePiece encoding and decoding: Viterbi over shared prefixes.

A text becomes "_" and itself with spaces as "_" (the mark U+2581), and falls apart into
marked words: a run of marks with what follows it, and single line breaks. No piece of the
vocabulary reaches over such a border, so the best segmentation of a text is that of its
words. The distinct words of a group of texts are sorted, which is the order of a depth-first
walk through their trie: where a word begins like the one before, the best scores of the common
prefixes are there already and only the rest is computed. The best segmentation has the
largest sum of piece scores; of equal sums the one whose last piece is longest, and so on
backwards. A character without a piece costs more than any piece and becomes its UTF-8 bytes.

Pieces and scores come from a vocabulary file whose path is a parameter; nothing is trained.
Words met before are kept, up to `CACHED_WORDS` for each worker; long texts go through in
slices. Decoding gives the text back exactly, unless it holds the mark itself.

Defined cases: null and empty texts have no ids and decode to the empty text; ids outside the
vocabulary are left out of a decoded text, broken byte sequences become U+FFFD; repeated rows
are encoded each; other columns stay."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from patronlens.llm import common

MARK = "▁"
CACHED_WORDS = 300_000
SLICE = 1 << 20

_WORD = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces by text with score and id, all ends of pieces, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.found: dict[str, tuple[float, int] | None] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        lowest = 0.0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.found[piece] = (model.get_score(i), i)
                lowest = min(lowest, model.get_score(i))
                self.bytes_of.append(piece.replace(MARK, " ").encode("utf-8"))
        for piece in list(self.found):
            for start in range(1, len(piece)):
                self.found.setdefault(piece[start:], None)
        self.unknown = lowest - 10

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Each of the words with its ids, in sorted order."""
        found, unknown = self.found.get, self.unknown
        before = ""
        best, back = [0.0], [(0, -1)]  # of each prefix: score; begin and id of its last piece
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del best[shared + 1:], back[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                top, last = -np.inf, (end - 1, -1)
                begin = end - 1
                while begin >= 0:
                    piece = found(word[begin:end], 0)
                    if piece == 0:  # neither a piece nor the end of one
                        if begin == end - 1:
                            top = best[begin] + unknown
                        break
                    if piece is None:
                        if begin == end - 1:
                            top = best[begin] + unknown
                    else:
                        score = best[begin] + piece[0]
                        if score >= top:
                            top, last = score, (begin, piece[1])
                    begin -= 1
                best.append(top)
                back.append(last)
            ids: list[int] = []
            end = len(word)
            while end > 0:
                begin, piece = back[end]
                if piece < 0:
                    ids += [self.byte_ids[b] for b in reversed(word[begin:end].encode("utf-8"))]
                else:
                    ids.append(piece)
                end = begin
            ids.reverse()
            yield word, ids
            before = word


def marked_words(text: str) -> Iterator[list[str]]:
    """The marked words of a text, a slice at a time."""
    if not text:
        return
    text = MARK + text.replace(" ", MARK)
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        while end < len(text) and not (text[end] == MARK and text[end - 1] != MARK):
            end += 1
        yield _WORD.findall(text[at:end])
        at = end


class Known:
    """Ids of the words a worker has met. Words seen in one group of texts only make room when
    there are too many."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids: dict[str, bytes] = {}
        self.once: set[str] = set()

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        distinct = set().union(*texts)
        self.once.difference_update(distinct)
        new = distinct - self.ids.keys()
        for word, ids in self.vocabulary.encode_words(list(new)):
            self.ids[word] = array("i", ids).tobytes()
        self.once.update(new)
        out = [b"".join(map(self.ids.__getitem__, words)) for words in texts]
        if len(self.ids) > CACHED_WORDS:
            for word in self.once:
                del self.ids[word]
            self.once.clear()
            if len(self.ids) > CACHED_WORDS:
                self.ids.clear()
        return out


def _of_worker(kept, path: str) -> Known:
    """A broadcast value lives as long as the worker: each fills its own for all its tasks."""
    if path not in kept.value:
        kept.value[path] = Known(Vocabulary(path))
    return kept.value[path]


def _encode(path: str, column: str, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _of_worker(kept, path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, last in _spans([len(t or "") for t in texts]):
                encoded: list[bytes] = []
                if last - first == 1:
                    encoded.append(b"".join(known.encode([words])[0]
                                            for words in marked_words(texts[first] or "")))
                else:
                    encoded = known.encode([[w for part in marked_words(t or "") for w in part]
                                            for t in texts[first:last]])
                offsets = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
                ids = np.frombuffer(b"".join(encoded), np.int32)
                part = batch.slice(first, last - first)
                columns = dict(zip(part.schema.names, part.columns))
                yield pa.RecordBatch.from_pydict(columns | {
                    column: pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))})

    return run


def _spans(sizes: list[int], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Begin and end of groups of rows of about `most` characters."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def _decode(path: str, column: str, to: str, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = _of_worker(kept, path).vocabulary.bytes_of
        for batch in batches:
            texts = []
            for ids in batch.column(column):
                found = ids.values.drop_null().to_numpy() if ids.is_valid else np.zeros(0, np.int32)
                found = found[(found >= 0) & (found < len(bytes_of))]
                data = b"".join(map(bytes_of.__getitem__, found.tolist()))
                texts.append(data.removeprefix(b" ").decode("utf-8", "replace"))
            columns = dict(zip(batch.schema.names, batch.columns))
            yield pa.RecordBatch.from_pydict(columns | {to: pa.array(texts, pa.string())})

    return run


def encode(docs: DataFrame, path: str | None = None, to: str = "ids") -> DataFrame:
    """`docs` (with a text column) and the ids of the text; a column of that name is replaced."""
    docs = docs.drop(to)
    kept = docs.sparkSession.sparkContext.broadcast({})
    return docs.mapInArrow(_encode(path or vocabulary_path(), to, kept),
                           common.extended(docs.schema, **{to: T.ArrayType(T.IntegerType())}))


def decode(docs: DataFrame, path: str | None = None, ids: str = "ids",
           to: str = "decoded") -> DataFrame:
    """`docs` and the text that their ids stand for; a column of that name is replaced."""
    docs = docs.drop(to)
    kept = docs.sparkSession.sparkContext.broadcast({})
    return docs.mapInArrow(_decode(path or vocabulary_path(), ids, to, kept),
                           common.extended(docs.schema, **{to: "string"}))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.char_length("decoded").cast("long").alias("n_chars_decoded"),
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))
