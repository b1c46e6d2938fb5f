"""SentencePiece encoding and decoding with a given byte-pair model, by a table of each prefix's last token.

Byte-pair merging has one result for every text, and the tokens of a prefix that ends at one of its borders are the first
tokens of the whole. So one token per prefix is enough: the last one. A token that ends a prefix is the last one exactly
where it is compatible with the last token of what comes before it, which means that merging the two texts put together
gives just these two. The automaton of all pieces names the tokens that end at each place, the table is filled from left to
right, and the ids are read from its end backwards. Compatibility is found out by merging the two short texts (best score
first, leftmost among equals) and remembered.

No merge crosses a place whose two characters stand side by side in no piece. There a text is cut into words, and each
different word is encoded once per worker as long as it is remembered.

Characters without a piece become the pieces of their bytes. Null and empty texts have no ids. Very long texts, also those
without white space, are encoded whole; rows are taken in slices of about a megabyte. Repeated rows stay, an empty table
gives an empty result, and other columns, whatever their names, go on in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm.frames import arrow_map, table, with_doc
from peerbench.llm.tokens import slices

SPACE = "▁"
#: What a worker remembers at most; beyond that it starts anew, which costs time only.
WORDS_KEPT = 400_000
PAIRS_KEPT = 2_000_000
_LONG = 64


class PrefixTable(dict):
    """Ids of words as bytes of 32-bit integers, by word. Builds its automaton from the bytes of a model file."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib, size = self.library, self.library.vocab_size()
        if lib.normalize(" a　 ﬁ ") != f"{SPACE}{SPACE}a　{SPACE}ﬁ{SPACE}":
            raise ValueError("only models that leave the text as it is, with a space before it, are supported")
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(lib.is_byte(i) for i in self.byte_ids):
            raise ValueError("only models with a piece for every byte are supported")
        plain = [i for i in range(size) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.size, self.piece = size, {i: lib.id_to_piece(i) for i in plain}
        self.score = {piece: lib.get_score(i) for i, piece in self.piece.items()}
        self.length = [len(self.piece.get(i, "")) for i in range(size)]
        self.automaton = ahocorasick.Automaton()
        for i, piece in self.piece.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.histories: dict[int, list[tuple[float, str, str]] | None] = {}
        characters = sorted({c for piece in self.score for c in piece})
        self.kind = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.kind[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.kinds = len(characters) + 1
        self.joined = np.zeros(self.kinds * self.kinds, bool)
        for piece in self.score:
            known = self.kind[[ord(c) for c in piece]]
            self.joined[known[:-1] * self.kinds + known[1:]] = True

    def text(self, token: int) -> str:
        """Text of a token; from ``size`` on the tokens are characters without a piece."""
        return self.piece[token] if token < self.size else chr(token - self.size)

    def history(self, token: int) -> list[tuple[float, str, str]] | None:
        """Merges that make up a token, in their order: score, and the first and last symbol afterwards.

        The first entry stands for the single characters. None if merging its text ends at something else.
        """
        if token in self.histories:
            return self.histories[token]
        symbols, score = [*self.text(token)], self.score
        steps = [(np.inf, symbols[0], symbols[-1])]
        while len(symbols) > 1:
            found = [score.get(x + y, -np.inf) for x, y in zip(symbols, symbols[1:])]
            best = max(found)
            if best == -np.inf:
                break
            at = found.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append((best, symbols[0], symbols[-1]))
        known = self.histories[token] = steps if len(symbols) == 1 else None
        return known

    def compatible(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before`` (-1: begins the text).

        Plays the merges of both in the order of the scores, the left one first among equals; a merge over the border
        whose turn comes before theirs parts the two.
        """
        right = self.history(token)
        if right is None or before < 0:
            return right is not None
        left, score = self.history(before), self.score
        i = j = 1
        x, y = left[0][2], right[0][1]
        across = score.get(x + y)
        while True:
            if i < len(left) and (j == len(right) or left[i][0] >= right[j][0]):
                if across is not None and across > left[i][0]:
                    return False
                moved = left[i][2] is not x
                x, i = left[i][2], i + 1
            elif j < len(right):
                if across is not None and across >= right[j][0]:
                    return False
                moved = right[j][1] is not y
                y, j = right[j][1], j + 1
            else:
                return across is None
            if moved:
                across = score.get(x + y)

    def last_tokens(self, text: str) -> list[int]:
        """The last token of every prefix of ``text`` that is not empty."""
        last, length, pairs, done = [], self.length, self.pairs, 0
        for end, token in self.automaton.iter(text):
            if done > end:
                continue
            while done < end:
                last.append(self.size + ord(text[done]))
                done += 1
            start = end + 1 - length[token]
            before = last[start - 1] if start else -1
            key = before << 21 | token if start else ~token
            known = pairs.get(key)
            if known is None:
                if len(pairs) >= PAIRS_KEPT:
                    pairs.clear()
                known = pairs[key] = self.compatible(before, token)
            if known:
                last.append(token)
                done += 1
        last.extend(self.size + ord(c) for c in text[done:])
        return last

    def ids(self, text: str) -> list[int]:
        """Ids of a text in which white space is escaped, read backwards from its last prefix."""
        last, found, at = self.last_tokens(text), [], len(text)
        while at:
            token = last[at - 1]
            if token < self.size:
                found.append(token)
                at -= self.length[token]
            else:
                found.extend(self.byte_ids[b] for b in reversed(chr(token - self.size).encode()))
                at -= 1
        return found[::-1]

    def __missing__(self, word: str) -> bytes:
        found = np.array(self.ids(word), np.int32).tobytes()
        if len(word) <= _LONG:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = found
        return found

    def words(self, text: str) -> list[str]:
        """The text cut between characters that stand side by side in no piece; no merge crosses these places."""
        kind = self.kind[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        cuts = (np.flatnonzero(~self.joined[kind[:-1] * self.kinds + kind[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if not text:
            return np.zeros(0, np.int32)
        return np.frombuffer(b"".join(map(self.__getitem__, self.words(SPACE + text.replace(" ", SPACE)))), np.int32)


_tables: dict[bytes, PrefixTable] = {}


def prefix_table(model: bytes) -> PrefixTable:
    """The table of a model in this process; the model used last is kept."""
    if model not in _tables:
        _tables.clear()
        _tables[model] = PrefixTable(model)
    return _tables[model]


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, keep: Sequence[str] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), ids, and with ``decoded`` the text the library decodes them to.

    The model, whose size does not depend on the data, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = prefix_table(shared.value)
        for lo, hi in slices(batch.column("text")):
            found = [pieces.encode(text or "") for text in batch.column("text").slice(lo, hi - lo).to_pylist()]
            first = np.zeros(len(found) + 1, np.int64)
            np.cumsum([len(ids) for ids in found], out=first[1:])
            ids = pa.LargeListArray.from_arrays(first, pa.array(np.concatenate(found)))
            columns = [batch.column("doc").slice(lo, hi - lo), ids.cast(pa.list_(pa.int32()))]
            if decoded:
                columns.append(pa.array([pieces.library.decode(ids.tolist()) for ids in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "ids", "decoded"][: len(columns)])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, with_doc(rows, "ids array<int>, decoded string" if decoded else "ids array<int>"))


def decode(rows: DataFrame, model: bytes, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per row with a column ``ids``: ``doc`` (the columns named in ``keep``) and text; null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        library = prefix_table(shared.value).library
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [library.decode(ids or []) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(texts, pa.string())], ["doc", "text"])

    taken = rows.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("ids").cast("array<int>").alias("ids"))
    return arrow_map(taken, run, with_doc(taken, "text string"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every document, and the digest of the text they decode to."""
    import public_tokenizers

    model = read_model(public_tokenizers.path("piece_bpe_32k.model"))
    found = encode(table(spark, sf_dir, "documents"), model, decoded=True)
    return found.select(
        "doc.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
