"""Encoding of the whole corpus with a public byte-level BPE vocabulary.

Texts are cut where a blank follows something that is not blank; no word of the pattern crosses such a place and none looks back over it, so the ids of a text are those of its pieces one after another. Pieces are cut, counted and
numbered on flat Arrow buffers. The pieces of all documents are counted; the most frequent ones are compiled with their ids into a minimal acyclic transducer (see lexicon), which is written to the shared folder, handed to the
executors by Spark (which copies it to their disks) and memory-mapped there. Each distinct piece is looked up once per worker; an unseen one is divided into words by the pattern, and its words are merged exactly. The result is that of
the public tokenizer, whatever the lexicon holds.
"""

from __future__ import annotations

import uuid
from array import array as numbers
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestra.arrow import array
from nestra.llm.lexicon import Lexicon, compile_lexicon, merge, read_ranks
from nestra.runtime import shared_dir

LEXICON_WORDS = 1 << 15  # frequent pieces that are compiled
LONGEST_WORD = 64  # bytes; longer pieces are neither compiled nor kept but encoded each time
BYTES_AT_ONCE = 1 << 22
FLUSH = 1 << 18  # distinct pieces that a counting task holds
CACHED = 1 << 22  # ids of seen pieces that a worker keeps

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _groups(texts) -> list[tuple[int, pa.Array]]:
    """A column of texts, null as empty, in slices of about BYTES_AT_ONCE; a text is never divided."""
    texts = array(texts).fill_null("").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    out, i = [], 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + BYTES_AT_ONCE, "right")) - 1)
        out.append((i, texts.slice(i, j - i)))
        i = j
    return out


def pieces_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(pieces per text, all pieces one after another) of texts without nulls."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    blank = _BLANK[data]
    at = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    before, second, third = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    # Behind a letter or sign beyond ASCII, unless its bytes may be those of some other kind of blank.
    beyond = (before >= 0x80) & (second != 0xC2) & ~(np.isin(second, (0x80, 0x81, 0x9A)) & (third >= 0xE1) & (third <= 0xE3))
    mark = np.zeros(len(data), bool)
    mark[at[_SOLID[before] | beyond]] = True
    mark[ends[:-1][ends[1:] > ends[:-1]]] = True
    start = np.flatnonzero(mark)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.r_[start, len(data)].astype(np.int64)), pa.py_buffer(data)])
    return np.diff(np.searchsorted(start, ends)), found


def _count_pieces(batches):
    held: list[pa.Table] = []

    def total() -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    for b in batches:
        for _, texts in _groups(b.column(0)):
            counts = pc.value_counts(pieces_of(texts)[1])
            word = counts.field("values").cast(pa.binary())
            t = pa.table({"word": word, "n": counts.field("counts")})
            held.append(t.filter(pc.less_equal(pc.binary_length(word), LONGEST_WORD)))
            if sum(t.num_rows for t in held) >= FLUSH:
                held = [total()]
                if held[0].num_rows >= FLUSH // 2:
                    yield from held[0].to_batches()
                    held = []
    if held:
        yield from total().to_batches()


def frequent_pieces(documents: DataFrame, most: int = LEXICON_WORDS) -> list[bytes]:
    """The ``most`` pieces that occur most often in all texts, at least twice (ties: smaller bytes first)."""
    total = documents.select("text").mapInArrow(_count_pieces, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    return [bytes(r.word) for r in total.orderBy(F.desc("n"), "word").limit(most).collect()]


def ship_lexicon(spark: SparkSession, data: bytes) -> str:
    """Write the file to the shared folder and let Spark hand it to every executor; the name to ask SparkFiles for."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(data)
    stream.close()
    spark.sparkContext.addFile(path.toString())
    return name


def build_lexicon(documents: DataFrame, ranks_path: str | None = None, pattern: str | None = None, lexicon_words: int = LEXICON_WORDS) -> str:
    """Count, compile and ship the lexicon of a corpus; its name serves any number of calls of encode and token_counts on the session."""
    ranks, words = read_ranks(ranks_path or _public("byte_bpe_50k.tiktoken")), regex.compile(pattern or _pattern())
    known = lru_cache(1 << 18)(lambda word: merge(word, ranks))
    ids = lambda piece: [i for w in words.findall(piece.decode()) for i in known(w.encode())]
    return ship_lexicon(documents.sparkSession, compile_lexicon(frequent_pieces(documents, lexicon_words), ranks, ids))


class Encoder:
    """What a worker needs: the lexicon, the word pattern and the ids of the pieces it has seen."""

    _open: dict[str, "Encoder"] = {}

    def __init__(self, path: str, pattern: str):
        self.lexicon, self.words = Lexicon(path), regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.start, self.size, self.pool = numbers("q"), numbers("q"), numbers("i")
        self.word = lru_cache(1 << 16)(lambda word: merge(word, self.lexicon.ranks))

    @classmethod
    def get(cls, name: str, pattern: str) -> "Encoder":
        if name not in cls._open:
            cls._open.clear()
            cls._open[name] = cls(SparkFiles.get(name), pattern)
        return cls._open[name]

    def _words_of(self, piece: bytes) -> list[bytes]:
        return [w.encode() for w in self.words.findall(piece.decode())]

    def _number(self, raw: list[bytes]) -> np.ndarray:
        """The entry of each piece among start and size; new ones are looked up, or divided and merged."""
        out = [self.seen.get(piece, -1) for piece in raw]
        new = [k for k, n in enumerate(out) if n < 0]
        id_at, ids = self.lexicon.id_at, self.lexicon.ids
        for k, rank in zip(new, self.lexicon.find([raw[k] for k in new]).tolist() if new else (), strict=True):
            piece, begin = raw[k], len(self.pool)
            if rank >= 0:
                self.pool.extend(ids[id_at[rank] : id_at[rank + 1]].tolist())
            else:
                for w in self._words_of(piece):
                    self.pool.extend(self.word(w) if len(w) <= LONGEST_WORD else merge(w, self.lexicon.ranks))
            out[k] = len(self.start)
            self.start.append(begin)
            self.size.append(len(self.pool) - begin)
            if len(piece) <= LONGEST_WORD:
                self.seen[piece] = out[k]
        return np.array(out, np.int64)

    def encode(self, texts: pa.Array, only_size: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """(ids per text, flat ids) of texts without nulls."""
        if len(self.pool) > CACHED:
            self._forget()
        per_text, found = pieces_of(texts)
        coded = found.dictionary_encode()
        number = self._number(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(found) else np.zeros(0, np.int64)
        n = np.frombuffer(self.size, np.int64)[number] if len(number) else number
        total, ends = np.r_[0, np.cumsum(n)], np.cumsum(per_text)
        sizes = total[ends] - total[ends - per_text]
        if only_size:
            return sizes, None
        start = np.frombuffer(self.start, np.int64)[number] if len(number) else number
        at = np.arange(int(total[-1])) + np.repeat(start - total[:-1], n)
        return sizes, np.frombuffer(self.pool, np.int32)[at] if len(at) else np.zeros(0, np.int32)


def _encode(name: str, pattern: str, only_size: bool, batches):
    encoder = Encoder.get(name, pattern)
    for b in batches:
        for i, texts in _groups(b.column("text")):
            n, flat = encoder.encode(texts, only_size)
            ids = b.column("doc_id").slice(i, len(texts))
            if only_size:
                yield pa.RecordBatch.from_arrays([ids, pa.array(n)], ["doc_id", "n_tokens"])
            else:
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(flat))], ["doc_id", "ids"])


def _run(documents: DataFrame, only_size: bool, schema: str, lexicon: str | None, pattern: str | None, **build) -> DataFrame:
    p = pattern or _pattern()
    name = lexicon or build_lexicon(documents, pattern=p, **build)
    return documents.select("doc_id", "text").mapInArrow(lambda batches: _encode(name, p, only_size, batches), schema)


def encode(documents: DataFrame, ranks_path: str | None = None, pattern: str | None = None, lexicon_words: int = LEXICON_WORDS, lexicon: str | None = None) -> DataFrame:
    """``doc_id, ids``: the token ids of every document without special tokens; strings that spell a special token are ordinary text.

    ``ranks_path`` is a .tiktoken file (default: byte_bpe_50k). ``pattern`` divides a text into words; none of its words may hold a blank behind something that is not blank. ``lexicon`` names one that build_lexicon has shipped
    with the same vocabulary and pattern. Null and empty texts have an empty list. One row per row of ``documents``, repeated rows and null doc_ids included; texts are encoded whole, however long; an empty table gives no rows.
    """
    return _run(documents, False, "doc_id bigint, ids array<int>", lexicon, pattern, ranks_path=ranks_path, lexicon_words=lexicon_words)


def token_counts(documents: DataFrame, ranks_path: str | None = None, pattern: str | None = None, lexicon_words: int = LEXICON_WORDS, lexicon: str | None = None) -> DataFrame:
    """``doc_id, n_tokens``: the same, but only the number of ids; 0 for null and empty texts."""
    return _run(documents, True, "doc_id bigint, n_tokens bigint", lexicon, pattern, ranks_path=ranks_path, lexicon_words=lexicon_words)
