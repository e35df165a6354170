"""Secret scans by a linear-chain conditional random field over tokens.

Base spans come from three fixed patterns and always stay. Around every token that is long and mixed
enough to be a secret, a CRF tags tokens B (a secret begins), I (inside) or O from their shape, their
neighbouring words and features of the file, decoded by Viterbi; tagged runs that overlap no base
span are added (kind ``crf``). Tags B and I are only allowed on such tokens, so text without any is all
O and needs no decoding.

The CRF trains on texts whose base spans are the labels (secrets the patterns know teach shapes and
contexts), with features of the pattern's own keyword hidden at random so that other contexts count. At
most ``max_train`` texts that hold candidates, taken by hash, train it: a documented bound.

Spans are in code points, end exclusive. Defined cases: null text counts as empty: no spans,
``base_sha256`` of nothing. Repeated rows and null ids give a row each. Without training texts the CRF
adds nothing. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.store import small_batches, written
from shopflow.llm.text import lean, slices

MAX_TRAIN = 3000
BUCKETS = 1 << 14
EPOCHS = 4
CONTEXT = 3
LEAST_LENGTH = 12

# Fixed patterns: kind, pattern, shortest length (of group 2 for assign).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KEYWORDS = ("passw", "secret", "token", "api")      # every assign match holds one of these
KINDS = ("assign", "access", "hex")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+|[^\sA-Za-z0-9+/_=-]")
O, B, I = 0, 1, 2

_BYTE = np.arange(256)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_RUN = _DIGIT | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | np.isin(_BYTE, list(b"+/_=-"))
_HEX = _DIGIT | ((_BYTE >= 97) & (_BYTE <= 102))


def base_spans(text: str, all_hex: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if all_hex:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return sorted(out)


def _runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a mask, broken at text boundaries."""
    m = np.zeros(len(mask) + 1, dtype=np.int8)
    m[:-1] = mask
    first = np.flatnonzero((m[:-1] == 1) & (np.concatenate(([0], m[:-2])) == 0)) if len(mask) else off[:0]
    last = np.flatnonzero((m[:-1] == 1) & (m[1:] == 0)) + 1 if len(mask) else off[:0]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(mask))]
    inner = inner[mask[inner] & mask[inner - 1]] if len(inner) else inner
    return np.sort(np.concatenate([first, inner])), np.sort(np.concatenate([last, inner]))


def flags(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text of a slice: whether it holds a candidate token, and a hex run of base length."""
    rows = len(off) - 1
    out = []
    for mask, least, digit in ((_RUN[data], LEAST_LENGTH, True), (_HEX[data], HEX_LEAST, False)):
        a, b = _runs(mask, off)
        ok = b - a >= least
        if digit:
            d = np.concatenate(([0], np.cumsum(_DIGIT[data])))
            ok &= d[b] > d[a]
        hit = np.zeros(rows, dtype=bool)
        hit[np.searchsorted(off, a[ok], side="right") - 1] = True
        out.append(hit)
    return out[0], out[1]


def is_candidate(token: str) -> bool:
    return len(token) >= LEAST_LENGTH and any("0" <= c <= "9" for c in token)


def _h(s: str) -> int:
    return zlib.crc32(s.encode()) % BUCKETS


def _shape(t: str) -> list[str]:
    kinds = "".join(k for k, on in (("d", any("0" <= c <= "9" for c in t)), ("l", any("a" <= c <= "z" for c in t)),
                                    ("u", any("A" <= c <= "Z" for c in t)), ("s", any(c in "+/_=-" for c in t))) if on)
    digits = sum("0" <= c <= "9" for c in t)
    hexed = all(c in "0123456789abcdefABCDEF" for c in t)
    return [f"kind={kinds}", f"len={min(len(t), 64) // 4}", f"hex={hexed}", f"digits={10 * digits // max(1, len(t))}",
            f"distinct={10 * len(set(t)) // max(1, min(len(t), 36))}", f"kind={kinds}|hex={hexed}|len={min(len(t), 64) // 8}"]


def _word(t: str) -> str:
    return t.lower() if len(t) <= LEAST_LENGTH else "long" + ("+d" if any("0" <= c <= "9" for c in t) else "")


def token_features(tokens: list[str], i: int, file: list[str], hide: bool = False) -> list[int]:
    """Hashed features of token i. ``hide`` leaves the words around it out."""
    f = ["bias", *file]
    if is_candidate(tokens[i]):
        f += _shape(tokens[i])
    else:
        f.append("plain")
    if not hide:
        f += [f"w{d:+d}={_word(tokens[i + d])}" for d in (-3, -2, -1, 1, 2) if 0 <= i + d < len(tokens)]
    return [_h(x) for x in f]


def _file(text: str, n: int, candidates: int) -> list[str]:
    lines = text.count("\n") + 1
    return [f"file.lines={min(6, lines.bit_length())}", f"file.density={min(6, (64 * candidates // max(1, n)))}"]


def windows(text: str) -> Iterator[tuple[list[tuple[int, int]], list[str], list[int]]]:
    """(token spans, tokens, file features) around candidates; overlapping contexts are one window."""
    found = [(m.start(), m.end(), m.group()) for m in TOKEN.finditer(text)]
    at = [k for k, t in enumerate(found) if is_candidate(t[2])]
    file = _file(text, len(found), len(at))
    k = 0
    while k < len(at):
        first, last = max(0, at[k] - CONTEXT), at[k] + CONTEXT
        while k + 1 < len(at) and at[k + 1] - CONTEXT <= last:
            k += 1
            last = at[k] + CONTEXT
        part = found[first:last + 1]
        yield [(a, b) for a, b, _ in part], [t for _, _, t in part], file
        k += 1


def _scores(w: np.ndarray, tokens: list[str], file: list[str], hide: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    feats = [np.array(token_features(tokens, i, file, hide)) for i in range(len(tokens))]
    e = np.stack([w[f].sum(axis=0) for f in feats])
    for i, t in enumerate(tokens):
        if not is_candidate(t):
            e[i, B] = e[i, I] = -1e9
    return e, feats


def viterbi(e: np.ndarray, trans: np.ndarray) -> list[int]:
    back = np.zeros(e.shape, dtype=np.int64)
    s = e[0].copy()
    s[I] = -1e9
    for i in range(1, len(e)):
        all_ = s[:, None] + trans
        back[i] = all_.argmax(axis=0)
        s = all_.max(axis=0) + e[i]
    tags = [int(s.argmax())]
    for i in range(len(e) - 1, 0, -1):
        tags.append(int(back[i][tags[-1]]))
    return tags[::-1]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis)
    return m + np.log(np.exp(x - np.expand_dims(m, axis)).sum(axis=axis))


def marginals(e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag marginals and summed transition marginals by forward-backward."""
    n = len(e)
    a, b = np.zeros_like(e), np.zeros_like(e)
    a[0] = e[0] + np.array([0, 0, -1e9])
    for i in range(1, n):
        a[i] = _lse(a[i - 1][:, None] + trans, 0) + e[i]
    for i in range(n - 2, -1, -1):
        b[i] = _lse(trans + (e[i + 1] + b[i + 1])[None], 1)
    z = _lse(a[-1], 0)
    pair = np.zeros((3, 3))
    for i in range(1, n):
        pair += np.exp(a[i - 1][:, None] + trans + (e[i] + b[i])[None] - z)
    return np.exp(a + b - z), pair


def train(texts: list[str], epochs: int = EPOCHS, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (bucket, tag) and transitions, by AdaGrad on the conditional likelihood."""
    w, trans = np.zeros((BUCKETS, 3)), np.zeros((3, 3))
    trans[O, I] = -1e9
    gw, gt = np.full((BUCKETS, 3), 1e-2), np.full((3, 3), 1e-2)
    data = []
    for t in texts:
        spans = [(a, b) for a, k, b in base_spans(t)]
        for places, tokens, file in windows(t):
            tags = np.zeros(len(tokens), dtype=np.int64)
            for i, (a, b) in enumerate(places):
                if is_candidate(tokens[i]) and any(x <= a and b <= y for x, y in spans):
                    tags[i] = I if i and tags[i - 1] else B
            data.append((tokens, file, tags))
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            tokens, file, tags = data[k]
            e, feats = _scores(w, tokens, file, hide=rng.random() < 0.3)
            p, pair = marginals(e, trans)
            p[np.arange(len(tags)), tags] -= 1
            for i, f in enumerate(feats):
                gw[f] += p[i] ** 2
                w[f] -= rate * p[i] / np.sqrt(gw[f])
            for i in range(1, len(tags)):
                pair[tags[i - 1], tags[i]] -= 1
            pair[O, I] = 0
            gt += pair ** 2
            trans -= rate * pair / np.sqrt(gt)
    return w, trans


def crf_spans(text: str, w: np.ndarray, trans: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for places, tokens, file in windows(text):
        tags = viterbi(_scores(w, tokens, file)[0], trans)
        for (a, b), t in zip(places, tags):
            if t == B:
                out.append((a, b))
            elif t == I and out:
                out[-1] = (out[-1][0], b)
    return out


def _sample(max_train: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for first, _, data, off in slices(b.column(1)):
                cand, hexed = flags(data, off)
                keep.append(np.flatnonzero(cand | hexed) + first)
            k = pa.array(np.concatenate(keep) if keep else np.zeros(0, dtype=np.int64))
            yield pa.record_batch([b.column(0).take(k), b.column(2).take(k)], names=["doc_id", "h"])

    return run


def fit(docs: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """The CRF from at most ``max_train`` texts with candidates, the smallest by hash."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.xxhash64("text").alias("h"))
    ids = keyed.mapInArrow(lean(_sample(max_train)), "doc_id long, h long").select("h").distinct().orderBy("h").limit(max_train)
    rows = keyed.join(F.broadcast(written(ids, "sample")), "h").dropDuplicates(["h"]).select("h", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        texts = pa.Table.from_batches(got).sort_by("h").column("text").to_pylist()
        w, trans = train([t or "" for t in texts])
        at = np.flatnonzero(np.abs(w).sum(axis=1))
        yield pa.record_batch([pa.array(np.concatenate([at, [-1, -2, -3]])),
                               pa.array(np.concatenate([w[at], trans]).tolist(), pa.list_(pa.float64()))], names=["at", "w"])

    model = rows.repartition(1).mapInArrow(lean(run), "at long, w array<double>").collect()  # at most BUCKETS + 3 rows
    w, trans = np.zeros((BUCKETS, 3)), np.zeros((3, 3))
    w[:, B] = -1.0  # without training everything is outside
    for at, row in model:
        if at >= 0:
            w[at] = row
        else:
            trans[-1 - at] = row
    if model:
        w[:, B][~np.isin(np.arange(BUCKETS), [r[0] for r in model])] = 0.0
    return w, trans


def _scan(model_b):
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, trans = model_b.value
        for b in batches:
            n = b.num_rows
            counts = np.zeros((3, n), dtype=np.int64)
            sha, spans, added = [empty] * n, [""] * n, np.zeros(n, dtype=np.int64)
            col = b.column(1)
            for first, rows, data, off in slices(col):
                cand, hexed = flags(data, off)
                for r in range(first, first + rows):
                    text = col[r].as_py() or ""
                    base = base_spans(text, bool(hexed[r - first]))
                    more = []
                    if cand[r - first]:
                        ends = np.array([(a, e) for a, _, e in base], dtype=np.int64).reshape(-1, 2)
                        more = [(a, 3, e) for a, e in crf_spans(text, w, trans)
                                if not ((ends[:, 0] < e) & (a < ends[:, 1])).any()]
                    if base:
                        sha[r] = hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in base).encode()).hexdigest()
                        for _, k, _ in base:
                            counts[k, r] += 1
                    if base or more:
                        spans[r] = ",".join(f"{(*KINDS, 'crf')[k]}:{a}:{e}" for a, k, e in sorted(base + more))
                        added[r] = len(more)
            yield pa.record_batch([b.column(0), *[pa.array(c) for c in counts], pa.array(sha), pa.array(spans), pa.array(added)],
                                  names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"])

    return run


def scan(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf) per row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    model_b = docs.sparkSession.sparkContext.broadcast(fit(docs, max_train))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(lean(_scan(model_b)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                    "spans string, n_crf long")
