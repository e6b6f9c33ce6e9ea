"""SentencePiece encoding and decoding through a table of last tokens.

The tokenizer merges, again and again, the adjacent pair whose joined piece has the best
score (the leftmost of equal ones). Two facts make a table of prefixes enough:

* each prefix of a text has one encoding, so one last token;
* a run of tokens is an encoding exactly if each two neighbours are one by themselves, as
  merges inside one token's characters never depend on its neighbour's.

So the last token of a prefix is the one piece that ends there and goes with the last token
of the prefix before it. An automaton finds the pieces that end at each character, the pair
test picks one, and the ids of the text are read off the table from its end: linear in the
text, whatever its length.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import kept, read

SPACE = "▁"
#: Segments whose ids a worker remembers, and the longest one it remembers.
MEMO_SEGMENTS, MEMO_CHARS = 300_000, 40
#: Tests of a token after another that a worker remembers.
MEMO_PAIRS = 400_000
#: Characters of text in one result batch.
BATCH_CHARS = 4_000_000
NEVER = float("inf")


class _Memo(dict):
    """Ids by segment; those of the first short segments are remembered."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, segment: str) -> list[int]:
        ids = self.encode(segment)
        if len(segment) <= MEMO_CHARS and len(self) < MEMO_SEGMENTS:
            self[segment] = ids
        return ids


class PieceCodec:
    """Encoder and decoder of one merge-type model with byte fallback."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.vocab_size())
        plain = [i for i in ids if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))]
        self.pieces = {sp.id_to_piece(i): i for i in plain}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        if any(sp.is_unused(i) for i in plain) or len(self.bytes) != 256:
            raise ValueError("only models with byte fallback and without unused pieces are supported")
        if any(c not in self.pieces for p in self.pieces for c in p):
            raise ValueError("every character of a piece must be a piece")
        self.text = {i: p for p, i in self.pieces.items()}
        # Time at which a merge takes place: the worse the score of what it makes, the later.
        self.time = {i: -sp.get_score(i) for i in plain}
        times = sorted(self.time[i] for i in plain if len(self.text[i]) > 1)
        self.tied = {a for a, b in zip(times, times[1:]) if a == b}
        self.edges_of: dict[int, tuple | None] = {}
        self.known_pairs = 0
        self.memo = _Memo(self._segment)
        self.automaton = ahocorasick.Automaton()
        self.size = {i: len(p) for p, i in self.pieces.items()}
        for p, i in self.pieces.items():
            # With the piece goes what is known of it after other last tokens (-1: none).
            self.automaton.add_word(p, (i, len(p), {}))
        self.automaton.make_automaton()
        # If no piece goes on after a space mark, no token spans the start of a word.
        cuts = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.segments = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if cuts else r"(?s).+")

    def merges(self, text: str) -> list[tuple]:
        """Reference encoding of a short text of known characters: its tokens as trees
        (id, time at which it was made, left tree, right tree)."""
        nodes: list[tuple | None] = [(self.pieces[c], 0.0, None, None) for c in text]
        after = [*range(1, len(nodes)), -1]
        before = list(range(-1, len(nodes) - 1))
        queue: list[tuple] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0:
                joined = self.pieces.get(self.text[nodes[a][0]] + self.text[nodes[b][0]])
                if joined is not None:
                    heapq.heappush(queue, (self.time[joined], a, b, joined, nodes[a], nodes[b]))

        for a in range(len(nodes) - 1):
            offer(a, a + 1)
        while queue:
            time, a, b, joined, left, right = heapq.heappop(queue)
            if nodes[a] is not left or nodes[b] is not right:
                continue
            nodes[a], nodes[b] = (joined, time, left, right), None
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [n for n in nodes if n]

    def _edges(self, token: int) -> tuple | None:
        """(symbols at the left edge, symbols at the right edge) while the piece is merged:
        (id, time at which it is merged further). None if merge times do not simply rise."""
        if token not in self.edges_of:
            tree = self.merges(self.text[token])

            def simple(node: tuple) -> bool:
                kids = [k for k in node[2:] if k]
                return all(k[1] < node[1] and simple(k) for k in kids) and node[1] not in self.tied

            def edge(side: int) -> list[tuple[int, float]]:
                out, node, until = [], tree[0], NEVER
                while node:
                    out.append((node[0], until))
                    node, until = node[side], node[1]
                return out[::-1]

            ok = len(tree) == 1 and simple(tree[0])
            self.edges_of[token] = (edge(2), edge(3)) if ok else None
        return self.edges_of[token]

    def goes_with(self, a: int, b: int) -> bool:
        """Whether the text of the pieces ``a`` and ``b`` is encoded as just these two."""
        left, right = self._edges(a), self._edges(b)
        if left is None or right is None:
            return [t[0] for t in self.merges(self.text[a] + self.text[b])] == [a, b]
        xs, ys, i, j = left[1], right[0], 0, 0
        while True:
            (x, x_until), (y, y_until) = xs[i], ys[j]
            joined = self.pieces.get(self.text[x] + self.text[y])
            # A merge over the border comes first if it is due before x changes, and not after y does.
            if joined is not None and self.time[joined] < x_until and self.time[joined] <= y_until:
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def fits(self, before: int, token: int, known: dict[int, bool]) -> bool:
        """Whether the token can follow the last token ``before``; -1 is the start of the text or an
        unknown character, where only a piece that encodes to itself stands. Remembered in ``known``."""
        if before >= 0:
            fits = self.goes_with(before, token)
        else:
            fits = len(self.merges(self.text[token])) == 1 if self._edges(token) is None else True
        if self.known_pairs < MEMO_PAIRS:
            known[before] = fits
            self.known_pairs += 1
        return fits

    def last_tokens(self, text: str) -> list[int]:
        """For each prefix of a normalised text the id of its last token; -1 for a character of no piece."""
        return self._prefixes(text)[1:]

    def _prefixes(self, text: str) -> list[int]:
        """As ``last_tokens``, with -1 for the empty prefix at the front."""
        last, done, test = [-1] * (len(text) + 1), -1, self.fits
        for end, (token, size, known) in self.automaton.iter(text):
            if end != done:
                before = last[end + 1 - size]
                fits = known.get(before)
                if fits is None:
                    fits = test(before, token, known)
                if fits:
                    last[end + 1], done = token, end
        return last

    def _segment(self, text: str) -> list[int]:
        last, ids, at, size = self._prefixes(text), [], len(text), self.size
        while at:
            token = last[at]
            if token < 0:
                ids += [self.bytes[b] for b in reversed(text[at - 1].encode())]
                at -= 1
            else:
                ids.append(token)
                at -= size[token]
        ids.reverse()
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of the whole text; a null text counts as empty."""
        if not text:
            return []
        found = self.segments.findall(self.sp.normalize(text))
        return list(chain.from_iterable(map(self.memo.__getitem__, found)))

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


def codec(model_file: str) -> PieceCodec:
    """The worker's codec of a model; it outlives a task."""
    return kept(("codec", model_file), lambda: PieceCodec(model_file))


def encoded(docs: DataFrame, model_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array of int), decoded (the text that the ids give back).

    A null or empty text has no ids and decodes to the empty text; ids may be null or repeat,
    each row is coded by itself and whole. Other columns are not read. Empty tables give no
    rows. ``model_file`` is read on the executors. No shuffle: a lost task codes its rows again.
    """
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))

    def code(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file)
        for f in frames:
            at = 0
            while at < f.num_rows:
                ids, ends, texts, chars, start = array("i"), [0], [], 0, at
                while at < f.num_rows and chars < BATCH_CHARS:
                    text = f.column(1)[at].as_py() or ""
                    own = coder.encode(text)
                    ids.fromlist(own)
                    ends.append(len(ids))
                    texts.append(coder.decode(own))
                    chars += len(text)
                    at += 1
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [f.column(0).slice(start, at - start), lists, pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(code, f"doc_id {id_type.simpleString()}, ids array<int>, decoded string")


MODEL = "piece_bpe_32k.model"


def op13_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers
    out = encoded(read(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
                      digest(F.col("decoded")).alias("decoded_sha256"))


QUERIES = {"op13_piece_codec": op13_piece_codec}
ORACLES: dict[str, str] = {}
