"""Token counts of a piece model by a finite-state transducer that is compiled as it is used."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from vistaflow.llm.arrow_text import record_batch, slices

SPACE = "▁"
MAX_STATES = 400_000
CACHE_CHUNKS = 300_000
LONG_CHUNK = 256


class Pieces:
    """What a piece model says: pieces in order of merging, and how it normalises."""

    def __init__(self, model: bytes):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        # The transducer is built for this normalisation; any other model is refused.
        if library.normalize(" ﬁ  x ") != f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("only models without text normalisation, with a dummy prefix")
        self.rank = {}
        for i in range(library.get_piece_size()):
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i)):
                self.rank[library.id_to_piece(i)] = -library.get_score(i)
        for piece in self.rank:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError("only models whose pieces do not run over a space")
        self.single = {p for p in self.rank if len(p) == 1}
        if {c for p in self.rank for c in p} - self.single:
            raise ValueError("only models that know every character of their pieces")

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """Pieces of a short text by merging the best pair, leftmost first, down to ``stop``."""
        parts, rank = list(text), self.rank
        while len(parts) > stop:
            best, at = min(
                (rank.get(a + b, float("inf")), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            )
            if best == float("inf"):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class Transducer:
    """Reads characters, emits how the token count changes; compiled from the merge order.

    A text read so far has one last token: the longest vocabulary suffix that the merges
    leave beside the last token of what stands before it. A state is what later characters
    can depend on: for every suffix that may still grow into a token, the last token before
    it and by how much the count there differs from the count now. A transition finds the
    new last token, and carries the difference of the counts. States and transitions are
    interned when first met and kept up to MAX_STATES.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        # Tokens that the merges can really produce, and all prefixes of them.
        self.made: dict[str, tuple[float, str, str]] = {}
        self.tokens = {p for p in pieces.rank if self._keep(p)}
        self.prefixes = {p[:k] for p in self.tokens for k in range(1, len(p) + 1)}
        self.side_by_side: dict[tuple[str, str], bool] = {}
        self._reset()

    def _reset(self):
        self.states = [(("", "", 0),)]
        self.number = {self.states[0]: 0}
        self.next: list[dict[str, tuple[int, int]]] = [{}]

    def _keep(self, piece: str) -> bool:
        """Whether merging gives the piece itself; notes its last merge."""
        if len(piece) == 1:
            return True
        parts = self.pieces.merge(piece, stop=2)
        if "".join(parts) != piece or len(parts) != 2:
            return False
        self.made[piece] = (self.pieces.rank[piece], *parts)
        return True

    def _stay(self, left: str, right: str) -> bool:
        """Whether the merges of both texts together leave these two tokens.

        Undoes their merges from the last one back. What then touches the seam was there
        together until the undone merge, so it must not have been able to merge before it.
        """
        if not left:
            return True
        key = (left, right)
        known = self.side_by_side.get(key)
        if known is not None:
            return known
        if len(self.side_by_side) > MAX_STATES:
            self.side_by_side.clear()
        bound, made, rank = float("inf"), self.made, self.pieces.rank
        while True:
            if rank.get(left + right, bound) < bound:
                known = False
                break
            of_left, of_right = made.get(left), made.get(right)
            if of_left is None and of_right is None:
                known = True
                break
            if of_right is None or (of_left is not None and of_left[0] > of_right[0]):
                bound, _, left = of_left
            else:  # of equal merges the left one comes first, so one at the seam wins a tie
                bound, right = of_right[0] + 0.5, of_right[1]
        self.side_by_side[key] = known
        return known

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        """The transition from a state by a known character."""
        last, change, kept = "", 0, []
        for suffix, before, less in self.states[state]:  # longest suffix first
            grown = suffix + char
            if grown not in self.prefixes:
                continue
            if not last and grown in self.tokens and self._stay(before, grown):
                last, change = grown, less + 1
            kept.append((grown, before, less))
        key = (*((s, b, n - change) for s, b, n in kept), ("", last, 0))
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        self.next[state][char] = found, change
        return found, change

    def count(self, chunk: str) -> int:
        """Tokens of a chunk of known characters, read from the reset state."""
        if len(self.states) > MAX_STATES:
            self._reset()
        state = total = 0
        following = self.next
        for char in chunk:
            step = following[state].get(char)
            if step is None:
                step = self._compile(state, char)
            state = step[0]
            total += step[1]
        return total


class Counter:
    """Counts of texts: cut where the transducer resets, chunk counts composed by a scan.

    Between two characters that no piece holds side by side, and on both sides of a character
    that the model does not know, every state goes to the reset state, as no merge can cross
    these places (beyond ASCII only the places before a space are looked for). The map of a chunk that begins there is a constant: reset state, plus a count.
    Composing such maps is adding counts, so a cumulative sum over the chunks of a slice is
    their prefix scan, and a text's count is the difference at its ends.
    """

    def __init__(self, model: bytes):
        self.pieces = Pieces(model)
        self.transducer = Transducer(self.pieces)
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(c) for c in self.pieces.single]] = True
        self.apart = np.ones((128, 128), bool)
        for piece in self.pieces.rank:
            near = piece.replace(SPACE, " ")
            for a, b in zip(near, near[1:]):
                if a < "\x80" and b < "\x80":
                    self.apart[ord(a), ord(b)] = False
        self.kept: dict[str, int] = {}

    def _chunk(self, chunk: str) -> int:
        first = ord(chunk[0])
        if not self.known[first]:
            return len(chunk.encode("utf-8"))  # a byte piece for each byte
        return self.transducer.count(chunk)

    def _counts(self, chunks: list[str]) -> np.ndarray:
        if len(self.kept) + len(chunks) > CACHE_CHUNKS:
            self.kept = {}
        kept, out = self.kept, []
        for chunk in chunks:
            count = kept.get(chunk)
            if count is None:
                count = self._chunk(chunk)
                if len(chunk) <= LONG_CHUNK:
                    kept[chunk] = count
            out.append(count)
        return np.array(out, np.int64)

    def count(self, texts: list[str]) -> np.ndarray:
        """Token counts; an empty text has none."""
        # The dummy prefix is a space before each text that is not empty.
        joined = "".join([" " + t for t in texts if t]).replace(" ", SPACE)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        text_at = np.concatenate(([0], np.cumsum(lengths)))
        if not len(points):
            return np.zeros(len(texts), np.int64)
        reset = np.zeros(len(points) + 1, bool)
        reset[text_at] = True
        space, unknown = points == ord(SPACE), ~self.known[points]
        reset[1:-1] |= (space[1:] & ~space[:-1]) | unknown[1:] | unknown[:-1]
        plain = np.where(space, 32, points)
        ascii_pair = (plain[1:] < 128) & (plain[:-1] < 128)
        at = np.flatnonzero(ascii_pair)
        reset[1 + at] |= self.apart[plain[at], plain[at + 1]]
        starts = np.flatnonzero(reset[:-1])
        data = np.frombuffer(joined.encode("utf-8"), np.uint8)
        byte_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        bounds = byte_at[np.append(starts, len(points))].astype(np.int64)
        chunks = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        ).dictionary_encode()
        counts = self._counts(chunks.dictionary.to_pylist())[chunks.indices.to_numpy()]
        scanned = np.concatenate(([0], np.cumsum(counts)))
        return np.diff(scanned[np.searchsorted(starts, text_at)])


def token_counts(docs: DataFrame, model: bytes, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit.

    ``model`` is the content of a model file; its size is fixed. Counts are those of the
    model's library without begin, end or added special tokens; special strings inside texts
    are ordinary text. Null and empty texts have 0 bytes and 0 tokens. Texts are taken whole,
    in time in proportion to their length. Repeated rows give repeated results, an empty
    table none; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType), StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()), StructField("over_limit", BooleanType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches):
        counter = Counter(model)
        for batch in slices(batches, text_col):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            counts = counter.count(texts)
            yield record_batch({
                id_col: batch.column(id_col),
                "n_bytes": [len(t.encode("utf-8")) for t in texts],
                "n_tokens": counts,
                "over_limit": counts > limit,
            }, out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
