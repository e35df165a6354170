"""SentencePiece encoding and decoding of merge-type (BPE) models, exactly as the library does both.

The merge rules give every text one encoding: start from single characters and keep joining the
adjacent pair whose joined piece scores best (leftmost of equals) until no pair is a piece. A
sequence of pieces is that encoding if and only if the rules, run on each two neighbours alone, give
back these two (the first merge across a border would otherwise also happen in the pair alone). So a
text is encoded by backtracking: take the longest piece that starts here, found by an Aho-Corasick search
that runs on until it meets an earlier one; keep it if it is compatible with the piece before it, judged by re-merging the two;
else try the next shorter piece; where none fits, mark the place in a bitfield and go back one piece.
Every prefix of a text has one encoding, so a marked place never has to be tried again.

Two adjacent characters that stand together in no piece always part two pieces. Texts are therefore
cut before each run of word marks and around characters that no longer piece holds, and encodings of
short cuts are kept in a bounded table. Longer cuts are encoded in one go, whatever their length.

Rules: a null text stays null in :func:`encoded` and :func:`decoded` (the registered query takes null
as empty); an empty text has no ids but the end id; repeated rows and ids are independent rows; other
columns pass through, and one that has the name of the result is replaced; empty tables give empty
tables. Models that are not BPE with byte fallback and the identity normaliser raise ``ValueError``.
"""

from __future__ import annotations

import gc
import re
from collections import defaultdict
from functools import cached_property, lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.store import small_batches

MARK = "▁"        # stands for a space inside pieces
KEPT_CUTS = 1 << 18    # encodings of short cuts a worker keeps
KEPT_PAIRS = 1 << 18   # compatibility answers a worker keeps
SHORT = 48             # characters of a cut whose encoding is kept
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values of the model format


class _Cuts(dict):
    """Encodings of short cuts, made when first asked for."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, cut: str) -> tuple:
        ids = tuple(self.encode(cut))
        if len(cut) <= SHORT:
            if len(self) >= KEPT_CUTS:
                self.clear()
            self[cut] = ids
        return ids


def _letters() -> str:
    """A character class of all letters up to U+FFFF (a bitmap once compiled)."""
    at = [k for k in range(1 << 16) if chr(k).isalpha()]
    starts = [k for i, k in enumerate(at) if not i or at[i - 1] < k - 1]
    ends = [k for i, k in enumerate(at) if i + 1 == len(at) or at[i + 1] > k + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


LETTERS = _letters()


def _cut_pattern(inside: set[str]) -> re.Pattern:
    """Cuts of a text between characters that stand side by side in no piece: before a run of marks,
    around characters that no longer piece holds, and behind a run of letters. ``inside`` has all pairs
    of neighbours in pieces; the few that join a letter to what is none keep such places whole."""
    if any(a != MARK == b for a, b in inside):
        return re.compile(r".+", re.S)
    solo = "".join(re.escape(c) for c in map(chr, range(128)) if not c.isalpha() and not any(c in p for p in inside))
    letter, behind = re.compile(f"[{LETTERS}]"), {}
    for a, b in sorted(inside):
        if letter.match(a) and not letter.match(b):
            behind[b] = behind.get(b, "") + re.escape(a)
    joined = "".join(f"(?:(?<=[{a}]){re.escape(b)}[^{MARK}{solo}]*)?" for b, a in behind.items())
    word, one = f"[{LETTERS}]+{joined}", f"|[{solo}]" if solo else ""
    return re.compile(f"{MARK}*{word}{one}|{MARK}*[^{MARK}{solo}{LETTERS}]+(?:{word})?|{MARK}+")


class Pieces:
    """The vocabulary of one model."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if train.model_type != 2 or not train.byte_fallback or train.treat_whitespace_as_suffix:
            raise ValueError("only merge-type models with byte fallback are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models whose normaliser leaves texts as they are are supported")
        kinds = {p.type for p in proto.pieces}
        if not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.dummy = norm.add_dummy_prefix
        self.end = train.eos_id
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        by_byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte = [by_byte[b] for b in range(256)]
        self.raw = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL
                    else train.unk_surface.encode() if p.type == UNKNOWN else p.piece.replace(MARK, " ").encode()
                    for p in proto.pieces]
        self.control = np.array([p.type == CONTROL for p in proto.pieces])
        self.is_byte = [p.type == BYTE for p in proto.pieces]
        self.marked = [p.type == NORMAL and p.piece.startswith(MARK) for p in proto.pieces]

        self.cuts = _Cuts(self._encode_cut)
        self.pairs: dict[str, dict[str, bool]] = defaultdict(dict)  # answers of compatible()
        self.answers = 0
        self.histories: dict[str, tuple | None] = {}
        self.prefix: dict[str, str] = {}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for piece in self.id:
            made.add_word(piece, piece)
        made.make_automaton()
        return made

    @cached_property
    def cut(self) -> re.Pattern:
        return _cut_pattern({p[i:i + 2] for p in self.id for i in range(len(p) - 1)})

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """The encoding of a short text by the merge rules themselves, and each merge: its score, and the
        first and the last part just before it."""
        parts, done = list(text), []
        scores = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best = max((s for s in scores if s is not None), default=None)
            if best is None:
                return parts, done
            done.append((best, parts[0], parts[-1]))
            at = scores.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            for i in (at - 1, at):
                if 0 <= i < len(scores):
                    scores[i] = self.score.get(parts[i] + parts[i + 1])

    def history(self, piece: str) -> tuple[list[float], list[str], list[str]] | None:
        """Scores of the merges that make ``piece`` alone, its first and last part before each and at the
        end; None if the rules do not make it one piece."""
        if piece not in self.histories:
            if len(self.histories) >= KEPT_PAIRS:
                self.histories.clear()
            parts, done = self.merges(piece)
            self.histories[piece] = None if len(parts) > 1 else (
                [s for s, _, _ in done], [h for _, h, _ in done] + [piece], [t for _, _, t in done] + [piece])
        return self.histories[piece]

    def compatible(self, left: str, right: str) -> bool:
        """Whether two pieces stay these two when merged anew; ``left`` is empty at a text's start."""
        if self.answers >= KEPT_PAIRS:
            self.pairs.clear()
            self.answers = 0
        self.answers += 1
        known = self.pairs[left][right] = self._remerge(left, right)
        return known

    def _remerge(self, left: str, right: str) -> bool:
        """Replay the merges of both pieces in the order in which the rules would do them side by side
        (best score first, leftmost of equals); a merge across their border must never come first."""
        a, b = self.history(left) if left else ([], [""], [""]), self.history(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            one = a[0][i] if i < len(a[0]) else None
            two = b[0][j] if j < len(b[0]) else None
            across = self.score.get(a[2][i] + b[1][j]) if left else None
            if across is not None and (one is None or across > one) and (two is None or across >= two):
                return False
            if one is None and two is None:
                return True
            if two is None or one is not None and one >= two:
                i += 1
            else:
                j += 1

    def shorter(self, piece: str) -> str:
        """The next shorter piece that ``piece`` starts with; empty if there is none."""
        known = self.prefix.get(piece)
        if known is None:  # pieces and single characters only
            n = next((n for n in range(len(piece) - 1, 1, -1) if piece[:n] in self.id), min(1, len(piece) - 1))
            known = piece[:n]
            if len(piece) > 1:  # so it is a piece: their number bounds the table
                self.prefix[piece] = known
        return known

    def split(self, text: str) -> list[str]:
        """The pieces of a text by backtracking (characters without a piece stand alone)."""
        n = len(text)
        longest: dict[int, str] = {}  # where a search came by: the longest piece that starts there, else the character
        search = self.automaton.iter_long

        def start(at: int) -> str:
            for last, piece in search(text, at):  # leftmost and longest, one behind the other
                first = last - len(piece) + 1
                if first in longest:  # from here on an earlier search has gone
                    break
                longest[first] = piece
            return longest.setdefault(at, text[at])

        out: list[str] = []
        failed = None  # a bit for each place, from the first failure on
        at, piece = 0, start(0) if n else ""
        answers = self.pairs[""]
        while at < n:
            while piece:
                fits = answers.get(piece)
                if fits is None:
                    fits = self.compatible(out[-1] if out else "", piece)
                if fits:
                    to = at + len(piece)
                    if not failed or not failed[to >> 3] >> (to & 7) & 1:
                        break
                piece = self.shorter(piece)
            if piece:
                out.append(piece)
                at = to
            else:
                failed = failed or bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= len(last)
            answers = self.pairs[out[-1] if out else ""]
            if not piece:
                piece = self.shorter(last)
            elif at < n:
                piece = longest.get(at) or start(at)
        return out

    def _encode_cut(self, cut: str) -> list[int]:
        parts = self.split(cut)
        try:
            return [self.id[p] for p in parts]
        except KeyError:  # characters without a piece become their bytes
            return [i for p in parts for i in ([self.id[p]] if p in self.id else [self.byte[b] for b in p.encode()])]

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = text.replace(" ", MARK)
        cuts = self.cut.findall(MARK + text if self.dummy else text)
        return list(chain.from_iterable(map(self.cuts.__getitem__, cuts)))

    def decode(self, ids: list[int] | np.ndarray) -> str:
        at = np.asarray(ids, dtype=np.int64)
        ids = at.tolist()
        first = next((i for i in ids if self.raw[i]), None)
        drop = first is not None and self.dummy and self.marked[first]
        if not self.control[at[:-1]].any():  # control ids inside a text part the byte pieces beside them
            try:
                return b"".join(map(self.raw.__getitem__, ids))[drop:].decode()
            except UnicodeDecodeError:
                pass
        return self._decode_broken(ids)[drop:]

    def _decode_broken(self, ids: list[int]) -> str:
        """Runs of byte pieces one by one: each byte that is no part of a character becomes U+FFFD."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.raw[i]
                continue
            while run:
                size = next((n for n in (1, 2, 3, 4) if _is_character(bytes(run[:n]))), 0)
                out.append(run[:size].decode() if size else "\ufffd")
                del run[:size or 1]
            if i is not None:
                out.append(self.raw[i].decode())
        return "".join(out)


def _is_character(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def loaded(model: bytes) -> Pieces:
    return Pieces(model)


def read_model(path: str) -> bytes:
    """The model file, read once where the job is planned; workers get its bytes."""
    with open(path, "rb") as f:
        return f.read()


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    """An Arrow list column; no Python object per id."""
    sizes = np.array([0] + [0 if r is None else len(r) for r in rows], dtype=np.int64)
    flat = np.concatenate([r for r in rows if r is not None] or [np.zeros(0, np.int32)])
    missing = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(sizes.cumsum().astype(np.int32)), pa.array(flat, pa.int32()), mask=missing)


def encoded(docs: DataFrame, model: bytes, text: str = "text", into: str = "ids", end: bool = True) -> DataFrame:
    """``docs`` with the ids of ``text`` (array<int>), the model's end id last if ``end``."""
    small_batches(docs.sparkSession, unset=True)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one vocabulary file, about 0.5 MB

    @F.arrow_udf("array<int>")
    def make(texts: pa.Array) -> pa.Array:
        pieces = loaded(shared.value)
        tail = [pieces.end] if end else []
        gc.disable()  # nothing made here refers to itself, and the tables are long to walk
        try:
            return _lists([None if t is None else np.array(pieces.encode(t) + tail, dtype=np.int32)
                           for t in (x.as_py() for x in texts)])
        finally:
            gc.enable()

    # Not declared deterministic: a column used twice would else be made twice.
    return docs.withColumn(into, make.asNondeterministic()(F.col(text).cast("string")))


def decoded(docs: DataFrame, model: bytes, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids``, as the library's ``decode(ids)`` gives it."""
    small_batches(docs.sparkSession, unset=True)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def make(rows: pa.Array) -> pa.Array:
        pieces = loaded(shared.value)
        at, flat = rows.offsets.to_pylist(), rows.values.to_numpy(zero_copy_only=False)
        return pa.array([pieces.decode(flat[a:b]) if known else None for a, b, known in
                         zip(at, at[1:], rows.is_valid().to_pylist())], pa.string())

    return docs.withColumn(into, make.asNondeterministic()(F.col(ids).cast("array<int>")))
