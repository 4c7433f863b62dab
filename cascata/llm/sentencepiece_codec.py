"""SentencePiece encoding and decoding by a merge-type prefix table.

A piece model of merge type joins, again and again, the neighbours whose joined piece has the best
score. The last token of the result for a prefix is the same whatever follows within that prefix, so
a table with one token for each prefix holds all results: an automaton lists the pieces that end at a
position, and the one that is pair-compatible with the token stored for the prefix before it is the
last token. The ids are then read off backwards. Two tokens are pair-compatible if merging their
joined text gives back just those two.

Texts are cut where no piece holds the two characters side by side (before white-space marks, before
punctuation behind most characters, at line ends), and results of the parts are remembered. Pieces of
several marks share one score, against which the uniqueness of the last token does not hold, and all
other merges come before them: runs of marks are therefore merged directly. Characters outside the
vocabulary take part in no merge and become byte pieces.

Null and empty texts give no ids and the text "". Texts are processed whole. Extra columns stay as
they are; an output column replaces an input column of its name.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

MARK = "▁"
CUT = "\ud800"  # in no valid text
PARTS_KEPT = 450_000
PAIRS_KEPT = 500_000
#: Slots, a power of two, of the table in which pairs are looked up all at once.
SLOTS = 1 << 20
#: Before these a text is cut where no piece holds the two characters side by side.
PUNCTUATION = ".,;:!?|*%&#$"
#: Characters of texts that are cut into words at once, and of a word that goes with others.
CHARACTERS = 500_000
TOGETHER = 64
_OPEN: dict[str, PieceModel] = {}


class PieceModel:
    """The pieces of a model file and its prefix tables; one for each Python worker."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(self.pieces[i][1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        special = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        special |= set(self.byte_ids.values())
        self.hidden = {i for i in range(size) if sp.is_control(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a white-space mark behind another character")
        if sp.normalize("  ﬁé  x ") != MARK + MARK + " ﬁé" + MARK * 2 + "x" + MARK:
            raise ValueError("only models that leave texts unchanged are supported")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if piece.strip(MARK) or piece == MARK:
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.lengths = np.array([len(p) for p in self.pieces])
        strange = "".join(re.escape(p) for p in self.ids if len(p) == 1)
        pairs = {pair for p in self.ids for pair in zip(p, p[1:])}
        before = {a for a, b in pairs if b in PUNCTUATION} | {MARK}
        held = "".join(map(re.escape, sorted(before)))
        self.whole = re.compile(f"{CUT}(?=[{re.escape(PUNCTUATION)}])(?<=[{held}]{CUT})")
        if "\n" in self.ids:
            raise ValueError("line breaks must not be pieces")
        self.strange = re.compile(f"([^{strange}]+)")
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.shown = [p.replace(MARK, " ") for p in self.pieces]
        self.fits: dict[int, bool] = {}
        self.trees: dict[int, tuple[int, int, bool] | None] = {}
        self.slot_pair, self.slot_fits = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)
        self.parts: dict[str, bytes] = {}
        self.again: set[str] = set()
        self.turn = 0
        self.runs: dict[int, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Direct merging: the best score first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(parts)
            if i >= 0 and j < len(parts) and (s := self.score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= len(parts) or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def halves(self, i: int) -> tuple[int, int, bool] | None:
        """The two tokens of a piece's last merge and whether all its merges come in order of score.

        None for a single character; (-1, -1, False) if merging its characters does not give the piece.
        """
        if i in self.trees:
            return self.trees[i]
        piece, found = self.pieces[i], (-1, -1, False)
        if len(piece) == 1:
            found = None
        elif self.merged(piece) == [piece]:
            at = self.last_cut(piece)
            sides = self.ids[piece[:at]], self.ids[piece[at:]]
            ordered = all(
                (h := self.halves(s)) is None or h[2] and self.score[self.pieces[s]] > self.score[piece]
                for s in sides
            )
            found = *sides, ordered
        self.trees[i] = found
        return found

    def last_cut(self, piece: str) -> int:
        """Where the last merge of a piece joins: the one cut whose sides merge to one token each."""
        for at in range(1, len(piece)):
            left, right = piece[:at], piece[at:]
            if left in self.ids and right in self.ids:
                if self.merged_before(piece) == [left, right]:
                    return at
        raise ValueError(f"no last merge of {piece!r}")

    def merged_before(self, piece: str) -> list[str]:
        kept = self.score.pop(piece)
        try:
            return self.merged(piece)
        finally:
            self.score[piece] = kept

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """A pair is (left + 1) << 32 | right; left -1: nothing or a foreign character stands before.

        Each pair has one slot of a table; what is not there is looked up, or tested, once a call.
        """
        slot = ((pairs * -7046029254386353131) >> 40) & (SLOTS - 1)
        out = self.slot_fits[slot]
        if len(miss := np.flatnonzero(self.slot_pair[slot] != pairs)):
            known = self.fits
            if len(known) > PAIRS_KEPT:
                known.clear()
            new, back = np.unique(pairs[miss], return_inverse=True)
            for pair in new.tolist():
                if pair not in known:
                    known[pair] = self.tested((pair >> 32) - 1, pair & 0xFFFFFFFF)
            fits = np.fromiter(map(known.__getitem__, new.tolist()), bool, len(new))
            out[miss] = fits[back]
            at = ((new * -7046029254386353131) >> 40) & (SLOTS - 1)
            at, first = np.unique(at, return_index=True)
            self.slot_pair[at], self.slot_fits[at] = new[first], fits[first]
        return out

    def tested(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens from the last one back and look at what meets at the border.

        A joined piece of the two that meet would have taken them before the merges that did.
        """
        trees = [self.halves(i) for i in (left, right) if i >= 0]
        if any(t is not None and t[0] < 0 for t in trees):
            return False
        if left < 0:
            return True
        if not all(t is None or t[2] for t in trees):
            pair = [self.pieces[left], self.pieces[right]]
            return self.merged("".join(pair)) == pair
        pieces, score = self.pieces, self.score
        taken_left = taken_right = -float("inf")
        while True:
            joined = score.get(pieces[left] + pieces[right])
            if joined is not None and joined > taken_left and joined >= taken_right:
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and score[pieces[left]] < score[pieces[right]]:
                taken_left, left = score[pieces[left]], a[1]
            else:
                taken_right, right = score[pieces[right]], b[0]

    def known_ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts of vocabulary characters with at most one mark, their first character.

        The texts stand in one long string with a line break between them, which no piece holds. Step t
        fills the tables of all texts for their prefixes of t characters, the longest piece first.
        """
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        found = np.fromiter(
            chain.from_iterable(self.automaton.iter("\n".join(texts))), np.int64
        ).reshape(-1, 2)
        end, piece = found[:, 0] + 1, found[:, 1]
        begin = end - self.lengths[piece]
        local = end - first[np.searchsorted(first, end - 1, side="right") - 1]
        order = np.lexsort((begin, end, local))
        end, piece, begin, local = end[order], piece[order], begin[order], local[order]
        new = np.concatenate([[True], end[1:] != end[:-1]]) if len(end) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        turn = np.arange(len(end)) - np.repeat(starts, np.diff(np.append(starts, len(end))))
        last = np.full(int(size.sum()) + len(texts) + 1, -2, np.int64)
        last[first] = -1
        edges = np.searchsorted(local, np.arange(1, size.max(initial=0) + 2))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if low == high:
                continue
            e, b, i, t = end[low:high], begin[low:high], piece[low:high], turn[low:high]
            for k in range(int(t.max()) + 1):
                at = np.flatnonzero((t == k) & (last[e] == -2) & (last[b] != -2))
                if len(at):
                    left = last[b[at]]
                    at = at[self.compatible((left + 1) << 32 | i[at])]
                    last[e[at]] = i[at]
        # Backwards: token k from the end of every text that has as many.
        at, live, taken = first + size, np.arange(len(texts)), []
        while len(live):
            token = last[at[live]]
            taken.append((live, token))
            at[live] -= self.lengths[token]
            live = live[at[live] > first[live]]
        owner = np.concatenate([x for x, _ in taken])
        token = np.concatenate([x for _, x in taken]).astype(np.int32)
        back = np.repeat(-np.arange(len(taken)), [len(x) for x, _ in taken])
        ids = token[np.lexsort((back, owner))].tobytes()
        edges = np.concatenate([[0], 4 * np.cumsum(np.bincount(owner, minlength=len(texts)))]).tolist()
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]

    def learn(self, parts: list[str]) -> None:
        """Remember the ids of parts."""
        plain, mixed = [], []
        for p in parts:
            (mixed if len(p) > TOGETHER or self.strange.search(p) else plain).append(p)
        if plain:
            self.parts.update(zip(plain, self.known_ids(plain)))
        for part in mixed:
            out = []
            for k, run in enumerate(self.strange.split(part)):
                if k % 2:
                    out.append(np.array([self.byte_ids[b] for b in run.encode()], np.int32).tobytes())
                elif run:
                    out += self.known_ids([run])
            self.parts[part] = b"".join(out)

    def run(self, length: int) -> bytes:
        if length not in self.runs:
            if len(self.runs) > 10_000:
                self.runs.clear()
            ids = [self.ids[p] for p in self.merged(MARK * length)]
            self.runs[length] = np.array(ids, dtype=np.int32).tobytes()
        return self.runs[length]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers, one after another."""
        out, start = [], 0
        while start < len(texts):
            stop, room = start, CHARACTERS
            while stop < len(texts) and (stop == start or room > 0):
                room -= len(texts[stop])
                stop += 1
            whole = [self.apart(t) for t in texts[start:stop]]
            cut = [w.split(CUT) if w else [] for w in whole]
            if len(self.parts) > PARTS_KEPT:
                # Parts seen again since the last time stay; most parts come once.
                self.parts, self.again = {p: self.parts[p] for p in self.again}, set()
            flat = list(chain.from_iterable(cut))
            ids = list(map(self.parts.get, flat))
            new = [k for k, found in enumerate(ids) if found is None]
            if self.turn % 4 == 0:
                self.again.update(p for p, found in zip(flat, ids) if found is not None)
            self.turn += 1
            if new:
                self.learn(list({flat[k] for k in new}))
                for k in new:
                    ids[k] = self.parts[flat[k]]
            at, twice = 0, MARK + CUT + MARK
            for text, parts in zip(whole, cut):
                end = at + len(parts)
                out.append(self.with_runs(parts, ids[at:end]) if twice in text else b"".join(ids[at:end]))
                at = end
            start = stop
        return out

    def apart(self, text: str) -> str:
        """The text with a cut wherever no piece can lie across: before marks, some punctuation, at line ends."""
        if not text:
            return ""
        marked = MARK + text.replace(" ", MARK)
        marked = marked.replace(MARK, CUT + MARK)[1:].replace("\n", f"{CUT}\n{CUT}")
        for p in PUNCTUATION:
            marked = marked.replace(p, CUT + p)
        return self.whole.sub("", marked).replace(CUT + CUT, CUT).removesuffix(CUT)

    def with_runs(self, parts: list[str], found: list[bytes]) -> bytes:
        """As the plain join, but marks that stand together are merged as one run."""
        out, marks = [], 0
        alone = np.int32(self.ids[MARK]).tobytes()
        for part, ids in zip(parts, found):
            if part[:1] == MARK and ids[:4] == alone:
                marks, ids = marks + 1, ids[4:]
            elif part[:1] == MARK and marks:
                out.append(self.run(marks))
                marks = 0
            if ids:
                if marks:
                    out.append(self.run(marks))
                    marks = 0
                out.append(ids)
        if marks:
            out.append(self.run(marks))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, without the mark put before the text; bytes that are no UTF-8 become U+FFFD."""
        out, held, first, byte_of, shown = [], bytearray(), True, self.byte_of, self.shown
        for i in ids:
            if i in byte_of:
                held.append(byte_of[i])
                first = False
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i in self.hidden:
                continue
            piece = shown[i]
            out.append(piece[1:] if first and piece[:1] == " " else piece)
            first = False
        if held:
            out.append(_utf8(bytes(held)))
        return "".join(out)


def _utf8(data: bytes) -> str:
    """Every byte that is part of no character becomes a U+FFFD of its own."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def opened(model: bytes) -> PieceModel:
    key = hashlib.sha256(model).hexdigest()
    if key not in _OPEN:
        _OPEN[key] = PieceModel(model)
    return _OPEN[key]


def read_model(path: str) -> bytes:
    """The vocabulary file, read by the driver; it travels with the functions (half a megabyte)."""
    with open(path, "rb") as file:
        return file.read()


#: Texts that are encoded at a time, whatever the size of an Arrow batch.
ROWS = 256


def id_lists(codec: PieceModel, texts: pa.Array) -> pa.Array:
    parts = codec.encode(texts.to_pylist())
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))


def texts_of(codec: PieceModel, ids: pa.Array) -> pa.Array:
    flat, edges = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    return pa.array([codec.decode(flat[a:b].tolist()) for a, b in zip(edges[:-1], edges[1:])], pa.string())


def sliced(texts: pa.Array, make, kind: pa.DataType) -> pa.Array:
    found = [make(texts.slice(at, ROWS)) for at in range(0, len(texts), ROWS)]
    return pa.concat_arrays(found) if found else pa.array([], kind)


def encoder(model: bytes):
    @F.arrow_udf(ArrayType(IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        return sliced(texts, lambda part: id_lists(opened(model), part), pa.list_(pa.int32()))

    return encode


def encoder_and_decoder(model: bytes):
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def both(part: pa.Array) -> pa.Array:
        ids = id_lists(opened(model), part)
        return pa.StructArray.from_arrays([ids, texts_of(opened(model), ids)], names=["ids", "decoded"])

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def encode_and_decode(texts: pa.Array) -> pa.Array:
        return sliced(texts, both, kind)

    return encode_and_decode


def decoder(model: bytes):
    @F.arrow_udf(StringType())
    def decode(ids: pa.Array) -> pa.Array:
        return texts_of(opened(model), pa.concat_arrays([ids]))

    return decode


def encode_column(text: Column, model: bytes) -> Column:
    return encoder(model)(F.coalesce(text, F.lit("")))


def coded_column(text: Column, model: bytes) -> Column:
    """Ids, and the text decoded from them, in one pass through one worker."""
    return encoder_and_decoder(model)(F.coalesce(text, F.lit("")))


def decode_column(ids: Column, model: bytes) -> Column:
    """Null ids give the text ""."""
    return decoder(model)(F.coalesce(ids, F.array().cast("array<int>")))


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of a text column."""
    return df.withColumn(ids, encode_column(F.col(text), read_model(model_path)))


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of a column of ids."""
    return df.withColumn(text, decode_column(F.col(ids), read_model(model_path)))
