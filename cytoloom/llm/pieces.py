"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

The vocabulary and its scores come from a public model file; nothing is trained. A BPE model stores
merge ranks instead of log-probabilities, which Zipf's law makes out of them. The text is
marked (a space becomes U+2581, one is put in front) and cut into marked words: a run of marks with the
letters behind it. Letters that only ever stand alone in the vocabulary, line ends among them, are words
of their own. No piece crosses such a border, so the best segmentation of a text is that of its
words, one after the other.

The distinct words a task has not met yet are sorted and walked as a trie, depth first: the
forward scores of a prefix are computed once for all words that begin with it. A letter without a piece
becomes its UTF-8 bytes. Decoding turns ids back into text; encoding a literal U+2581 as
bytes keeps it apart from a space, so the round trip is exact for every text.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoloom.llm.text import blocks, map_batches, texts_of

TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
MARK = "▁"
# Distinct words whose ids a task remembers.
REMEMBERED_WORDS = 300_000
# A byte stands for a letter without piece; it must lose against every segmentation into pieces.
BYTE_SCORE = -1e9
# Fields of a vocabulary node.
NEXT, PIECE, PARENT, LETTER, FAIL, ENDING, DEPTH = range(7)


class Pieces:
    """A vocabulary with scores, read from a SentencePiece model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb2

        proto = pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.normalizer_spec.name != "identity" or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("an exact round trip needs a model that leaves texts as they are")
        kinds = proto.SentencePiece
        self.text, self.byte_ids, self.score, self.unknown = [], {}, {}, 0
        self.ids: dict[str, int] = {}
        for i, p in enumerate(proto.pieces):
            self.text.append(p.piece)
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
            elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.ids[p.piece] = i
                self.score[p.piece] = p.score
            elif p.type == kinds.UNKNOWN:
                self.unknown = i
        if len(self.byte_ids) < 256:
            raise ValueError("an exact round trip needs a piece for every byte")
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("pieces with a mark behind a letter are not supported")
        if proto.trainer_spec.model_type != proto.trainer_spec.UNIGRAM:
            # the scores of a BPE model are merge ranks; Zipf's law turns a rank into a log-probability
            total = np.log(np.sum(1 / (np.arange(len(self.ids)) + 1.0)))
            self.score = {piece: float(-np.log(rank + 1.0) - total) for rank, piece in enumerate(self.ids)}
        self.byte_at = {i: b for b, i in self.byte_ids.items()}
        # the vocabulary as a trie; what continues a piece's suffix is linked while walking
        self.root: list = [{}, None, None, "", None, None, 0]
        for piece, i in self.ids.items():
            node = self.root
            for c in piece:
                child = node[NEXT].get(c)
                if child is None:
                    child = node[NEXT][c] = [{}, None, node, c, None, None, node[DEPTH] + 1]
                node = child
            node[PIECE] = (self.score[piece], (i,))
        joined = {c for piece in self.ids if len(piece) > 1 for c in piece} - {MARK}
        # letters that occur in no longer piece are words of their own
        letters = "".join(re.escape(c) for c in sorted(joined))
        self.words = re.compile(f"{MARK}+[{letters}]*|[{letters}]+|[^{letters}{MARK}]", re.DOTALL)
        self.decoded = [
            None if i in self.byte_at else t.replace(MARK, " ") for i, t in enumerate(self.text)
        ]

    def _letter(self, c: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass"))

    def _fall_back(self, node: list) -> list:
        """The node of the longest proper suffix that begins a piece."""
        if node[FAIL] is None:
            parent = node[PARENT]
            node[FAIL] = self.root if parent is self.root else self._step(self._fall_back(parent), node[LETTER])
        return node[FAIL]

    def _step(self, node: list, c: str) -> list:
        """The node reached with one more letter; filled in when first needed."""
        found = node[NEXT].get(c)
        if found is None:
            found = self.root if node is self.root else self._step(self._fall_back(node), c)
            node[NEXT][c] = found
        return found

    def _ending(self, node: list) -> list:
        """(length, score, ids) of all pieces that end at a node, longest first."""
        if node[ENDING] is None:
            own = [(node[DEPTH], *node[PIECE])] if node[PIECE] else []
            node[ENDING] = own if node is self.root else own + self._ending(self._fall_back(node))
        return node[ENDING]

    def segment(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """The best segmentation of every word: the highest sum of scores, a longer last piece on a tie.

        A depth-first walk over the trie of the sorted words. The lists hold one entry per depth of
        the current path, so what a word shares with the one before is still there.
        """
        longest = max(map(len, words), default=0) + 1
        best = [0.0] * longest  # forward score of the prefix
        begin = [0] * longest  # where its last piece begins
        ids: list[tuple] = [()] * longest  # the ids of its last piece, last first
        nodes = [self.root] * longest  # its longest suffix that begins a piece
        step, ending, low, out, last = self._step, self._ending, float("-inf"), {}, ""
        for word in sorted(words):
            size = len(word)
            depth, top = 0, min(size, len(last))
            while depth < top and word[depth] == last[depth]:
                depth += 1
            node = nodes[depth]
            for at in range(depth + 1, size + 1):
                c = word[at - 1]
                node = node[NEXT].get(c) or step(node, c)
                pieces = node[ENDING]
                if pieces is None:
                    pieces = ending(node)
                most, found, start = low, (), at - 1
                for length, score, piece in pieces:
                    score += best[at - length]
                    if score > most:
                        most, found, start = score, piece, at - length
                if not pieces or pieces[-1][0] > 1:
                    spelled = self._letter(c)
                    score = best[at - 1] + BYTE_SCORE * len(spelled)
                    if score > most:
                        most, found, start = score, spelled[::-1], at - 1
                best[at] = most
                begin[at] = start
                ids[at] = found
                nodes[at] = node
            # back from the end; what lies on the path belongs to this word
            at, path = size, []
            while at:
                path += ids[at]
                at = begin[at]
            path.reverse()
            out[word] = tuple(path)
            last = word
        return out


class Encoder:
    """Encodes texts with the words it has already met at hand."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        split, literal = self.pieces.words.findall, self.pieces._letter(MARK)
        words = []
        for t in texts:
            if MARK not in t:
                words.append(split(MARK + t.replace(" ", MARK)) if t else [])
                continue
            # a literal mark is spelled in bytes; "" stands for it between the words
            parts: list[str] = []
            for i, part in enumerate((" " + t).split(MARK)):
                if i:
                    parts.append("")
                parts += split(part.replace(" ", MARK))
            words.append(parts)
        new = set(chain.from_iterable(words)).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED_WORDS:
            self.known.clear()
            new = set(chain.from_iterable(words))
        new.discard("")
        self.known.update(self.pieces.segment(list(new)))
        self.known[""] = literal
        ids = self.known.__getitem__
        return [list(chain.from_iterable(map(ids, w))) for w in words]

    def decode(self, ids: list[int]) -> str:
        """The text of ids made by ``encode``."""
        text, byte_at = self.pieces.decoded, self.pieces.byte_at
        parts = list(map(text.__getitem__, ids))
        if None in parts:
            out, run = [], bytearray()
            for i, part in zip(ids, parts):
                if part is None:
                    run.append(byte_at[i])
                    continue
                if run:
                    out.append(run.decode("utf-8", "surrogatepass"))
                    run = bytearray()
                out.append(part)
            if run:
                out.append(run.decode("utf-8", "surrogatepass"))
            parts = out
        return "".join(parts)[1:]


def read_model(path: str = os.path.join(TOKENIZERS, MODEL)) -> bytes:
    """The model file, read on the driver: half a MB that travels with the task."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, n_chars, n_tokens, token_ids, text_sha256, decoded_sha256) for every row.

    ``decoded_sha256`` is the digest of the text decoded from ``token_ids``; it equals ``text_sha256`` for
    every text. A null text counts as empty and has no tokens. Texts are encoded whole. Repeated rows
    return a row each, other columns are ignored, an empty table gives an empty table.
    """

    def run(batches):
        encoder = Encoder(Pieces(model))
        for batch in batches:
            for block in blocks(batch):
                texts = texts_of(block)
                ids = encoder.encode(texts)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                digest = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
                back = [hashlib.sha256(encoder.decode(i).encode()).hexdigest() for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"), pa.array(list(map(len, texts)), pa.int64()), pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(digest), pa.array(back),
                    ],
                    ["doc_id", "n_chars", "n_tokens", "token_ids", "text_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_chars long, n_tokens long, token_ids array<int>, text_sha256 string, decoded_sha256 string"
    return map_batches(rows, run, schema)


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) of a table with ``doc_id`` and ``token_ids``; null ids decode to an empty text."""

    def run(batches):
        encoder = Encoder(Pieces(model))
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "token_ids"), run, "doc_id long, text string")
