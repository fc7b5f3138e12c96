"""Operator 1: personal data, by rules and by a character BiLSTM-CRF.

Rules give the *base* spans (email, ip, card, phone).  A character-level
bidirectional LSTM with CRF transitions, trained in numpy on a bounded,
hash-ordered sample of labelled windows, adds spans that the rules miss
(spaced or re-punctuated forms; not "name [at] example [dot] com").  Its windows overlap by half; every
window is decoded alone.  Where a span is cut by a window's edge, the window is
decoded again with ``SIDES`` characters more on both sides, until the span is
whole; so a span is found wherever it lies on the grid, up to the last of
``SIDES`` in length.  One weighted interval schedule over the whole document
then picks the best non-overlapping spans.

An added span holds a digit or ``@`` outside every base span, overlaps no base
span, passes its kind's check (digits, Luhn, parts) and has a mean posterior of
``MIN_POSTERIOR``.  A window without such a character cannot give an added
span, so it is not run: the result is the same as running all
(``every_window=True``, tests/llm).

No shuffle, no group: documents stay in their scan partition and windows are
scored in blocks of ``BLOCK``.  Edge cases: null and empty text have no spans;
a null id stays null; repeated rows are reported each; very long texts are
scanned whole in linear time; with no labelled span in the sample the model
adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastry.llm.common import id_and_text

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 600  # labelled sample: documents, and windows of each
TRAIN_WINDOWS = 6
HIDDEN = 16
EPOCHS = 8
WINDOW = 64
STRIDE = 32
BLOCK = 2048
#: Characters added on both sides of a window that cuts a span, step by step.
SIDES = (64, 256, 1024)
MIN_POSTERIOR = 0.9
N_CLASSES = 130  # ASCII, other, padding
N_TAGS = 1 + 2 * len(KINDS)  # outside, begin of each kind, inside of each kind

SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)

Span = tuple[str, int, int]

# Each finds the leftmost matches of the rule in linear time: a digit run is
# taken whole, and an email's local part is looked up backwards from its "@".
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _octets(s: str) -> bool:
    parts = [p.lstrip("0") for p in re.findall("[0-9]+", s)]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        before = text[end:at]
        local = len(before) - len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if local else None
        if m:
            yield "email", at - local, m.end()
            end = m.end()
        else:
            end = at + 1
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """The rules' spans, by start, then kind as listed."""
    if not text or not ANCHOR.search(text):
        return []
    found = list(_emails(text))
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if _octets(m[0])]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# ---- the network ------------------------------------------------------------


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(codes < 128, codes, 128).astype(np.int64)


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def init(seed: int = 42) -> dict[str, np.ndarray]:
    r, h = np.random.RandomState(seed), HIDDEN
    p = {}
    for d in "fb":  # forward, backward
        p[f"W{d}"] = r.normal(0, 0.3, (N_CLASSES, 4 * h))
        p[f"U{d}"] = r.normal(0, 0.3, (h, 4 * h))
        p[f"b{d}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
    p["O"], p["o"] = r.normal(0, 0.3, (2 * h, N_TAGS)), np.zeros(N_TAGS)
    p["T"], p["S"] = np.zeros((N_TAGS, N_TAGS)), np.zeros(N_TAGS)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _lstm(x: np.ndarray, p: dict, d: str, keep: list | None) -> np.ndarray:
    """x: (time, batch) classes.  Returns hidden states (time, batch, HIDDEN)."""
    n = HIDDEN
    h = c = np.zeros((x.shape[1], n), np.float32)
    out = np.empty((*x.shape, n), np.float32)
    for t in range(len(x)):
        z = p[f"W{d}"][x[t]] + h @ p[f"U{d}"] + p[f"b{d}"]
        s, g = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
        before, h_before = c, h
        c = s[:, n : 2 * n] * c + s[:, :n] * g
        tc = np.tanh(c)
        h = out[t] = s[:, 2 * n :] * tc
        if keep is not None:
            keep.append((x[t], h_before, before, s, g, tc))
    return out


def _lstm_back(dh_out: np.ndarray, kept: list, p: dict, d: str, grad: dict) -> None:
    n = HIDDEN
    dh = dc = np.zeros(dh_out.shape[1:], np.float32)
    steps = []
    for t in reversed(range(len(kept))):
        x, h_before, c_before, s, g, tc = kept[t]
        dh = dh + dh_out[t]
        i, f, o = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o),
                             dc * i * (1 - g * g)], 1)
        steps.append((x, h_before, dz))
        dh, dc = dz @ p[f"U{d}"].T, dc * f
    x, h_before, dz = (np.concatenate(s) for s in zip(*steps, strict=True))
    grad[f"W{d}"] += np.eye(N_CLASSES, dtype=np.float32)[x].T @ dz
    grad[f"U{d}"] += h_before.T @ dz
    grad[f"b{d}"] += dz.sum(0)


def emissions(x: np.ndarray, p: dict, kept: dict | None = None) -> np.ndarray:
    """x: (batch, time) classes.  Tag scores (time, batch, tags)."""
    xt = np.ascontiguousarray(x.T)
    kf, kb = ([], []) if kept is not None else (None, None)
    h = np.concatenate([_lstm(xt, p, "f", kf), _lstm(xt[::-1], p, "b", kb)[::-1]], 2)
    if kept is not None:
        kept.update(f=kf, b=kb, h=h)
    return h @ p["O"] + p["o"]


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def crf(e: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward: log partition (batch), tag marginals (time, batch,
    tags) and expected transitions (tags, tags)."""
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0] + p["S"]
    for t in range(1, len(e)):
        alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + p["T"], 1) + e[t]
    for t in reversed(range(len(e) - 1)):
        beta[t] = _logsumexp(p["T"] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _logsumexp(alpha[-1], 1)
    marginals = np.exp(alpha + beta - z[None, :, None])
    pairs = np.zeros_like(p["T"])
    for t in range(len(e) - 1):
        pairs += np.exp(alpha[t][:, :, None] + p["T"] + (e[t + 1] + beta[t + 1])[:, None, :] - z[:, None, None]).sum(0)
    return z, marginals, pairs


def viterbi(e: np.ndarray, p: dict) -> np.ndarray:
    """Best tags (batch, time)."""
    score, back = e[0] + p["S"], []
    for t in range(1, len(e)):
        s = score[:, :, None] + p["T"]
        back.append(s.argmax(1))
        score = s.max(1) + e[t]
    tags = [score.argmax(1)]
    for b in reversed(back):
        tags.append(np.take_along_axis(b, tags[-1][:, None], 1)[:, 0])
    return np.stack(tags[::-1], 1)


def loss_and_gradient(x: np.ndarray, y: np.ndarray, p: dict) -> tuple[float, dict]:
    """Mean negative log-likelihood of the tags ``y`` (batch, time)."""
    kept: dict = {}
    e = emissions(x, p, kept)
    z, marginals, pairs = crf(e, p)
    yt, n = y.T, len(x)
    gold = np.take_along_axis(e, yt[:, :, None], 2).sum() + p["S"][yt[0]].sum() + p["T"][yt[:-1], yt[1:]].sum()
    de = marginals.copy()
    np.put_along_axis(de, yt[:, :, None], np.take_along_axis(de, yt[:, :, None], 2) - 1, 2)
    de /= n
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    seen = np.zeros_like(p["T"])
    np.add.at(seen, (yt[:-1], yt[1:]), 1)
    grad["T"], grad["S"] = ((pairs - seen) / n).astype(np.float32), de[0].sum(0)
    grad["O"], grad["o"] = np.tensordot(kept["h"], de, ([0, 1], [0, 1])), de.sum((0, 1))
    dh = de @ p["O"].T
    _lstm_back(dh[:, :, :HIDDEN], kept["f"], p, "f", grad)
    _lstm_back(dh[::-1, :, HIDDEN:], kept["b"], p, "b", grad)
    return float((z.sum() - gold) / n), grad


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.02) -> dict:
    """Adam over shuffled batches; the same windows give the same weights."""
    p, r = init(), np.random.RandomState(7)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(w) for k, w in p.items()}
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(x))
        for k in range(0, len(x), batch):
            step += 1
            _, g = loss_and_gradient(x[order[k : k + batch]], y[order[k : k + batch]], p)
            norm = np.sqrt(sum(float((w * w).sum()) for w in g.values()))
            for name in p:
                w = g[name] * min(1.0, 5 / max(norm, 1e-9))
                m[name] = 0.9 * m[name] + 0.1 * w
                v[name] = 0.99 * v[name] + 0.01 * w * w
                p[name] -= (rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)).astype(
                    np.float32
                )
    return p


# ---- labelled windows ---------------------------------------------------------


def _rewritten(kind: str, s: str) -> list[str]:
    """Forms of a labelled value that the rules do not match."""
    if kind == "email":
        return [s.replace("@", " @ "), s.replace("@", "@ ")]
    if kind == "ip":
        return [s.replace(".", "[.]"), s.replace(".", " . ")]
    if kind == "card":
        d = _digits(s)
        return [".".join(d[i : i + 4] for i in range(0, len(d), 4)), "/".join(d[i : i + 4] for i in range(0, len(d), 4))]
    d = _digits(s)
    area, rest = d[-10:-7], d[-7:]
    return [f"({area}) {rest[:3]}-{rest[3:]}", f"{area}-{rest[:3]}-{rest[3:]}", f"{area}.{rest[:3]}.{rest[3:]}"]


def labelled_windows(text: str, limit: int) -> list[tuple[str, list[Span]]]:
    """(window text, spans in it) around the base spans and around other
    digits, plus each window with its values rewritten.  A value that runs over
    the window's end is labelled up to there."""
    spans = base_spans(text)
    out = []
    places = [s for _, s, _ in spans]
    others = [m.start() for m in ANCHOR.finditer(text) if not any(s <= m.start() < e for _, s, e in spans)]
    for at in [*places[:limit], *others[:: max(1, len(others) // 2)][:2]]:
        lo = max(0, at - STRIDE // 2)
        if any(s < lo < e for _, s, e in spans):
            continue
        inside = [(k, s - lo, e - lo) for k, s, e in spans if lo <= s < lo + WINDOW]
        piece = text[lo : lo + max([WINDOW, *[e for _, _, e in inside]])]
        out.append((piece[:WINDOW], [(k, s, min(e, WINDOW)) for k, s, e in inside]))
        for way in range(3 if inside else 0):
            new, marks, end = "", [], 0
            for k, s, e in inside:
                if s < end:
                    continue
                forms = _rewritten(k, piece[s:e])
                new += piece[end:s]
                marks.append((k, len(new), len(new) + len(forms[way % len(forms)])))
                new += forms[way % len(forms)]
                end = e
            new += piece[end:]
            out.append((new[:WINDOW], [(k, s, min(e, WINDOW)) for k, s, e in marks if s < WINDOW]))
    return out


def encode_windows(windows: list[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    x = np.full((len(windows), WINDOW), N_CLASSES - 1, np.int64)
    y = np.zeros((len(windows), WINDOW), np.int64)
    for i, (text, spans) in enumerate(windows):
        x[i, : len(text)] = classes(text)
        for kind, s, e in spans:
            k = 1 + KINDS.index(kind)
            y[i, s:e] = k + len(KINDS)
            y[i, s] = k
    return x, y


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> dict | None:
    """Train on the ``train_docs`` distinct texts with a digit or ``@`` that come
    first by hash: at most ``train_docs * (TRAIN_WINDOWS + 2) * 4`` short windows
    reach the driver.  Only hashes are ranked; texts are read for the chosen."""
    some = id_and_text(df, id_col, text_col).where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    last = some.select("h").distinct().orderBy("h").limit(train_docs).agg(F.max("h")).first()[0]
    if last is None:
        return None
    sample = some.where(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [w for t in batch.column("text") for w in labelled_windows(t.as_py(), TRAIN_WINDOWS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in got], pa.string()), pa.array([joined(s) for _, s in got], pa.string())],
                names=["w", "s"],
            )

    rows = sorted((r.w, r.s) for r in sample.mapInArrow(windows, "w string, s string").collect())
    got = [(w, [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in s.split(",") if x)]) for w, s in rows]
    if not any(s for _, s in got):
        return None
    return train(*encode_windows(got))


# ---- finding --------------------------------------------------------------------


def _accepted(kind: str, s: str) -> bool:
    digits = _digits(s)
    if kind == "email":
        left, _, right = s.partition("@")
        return bool(re.search(r"[A-Za-z0-9._%+-]\s?$", left) and re.match(r"\s?[A-Za-z0-9-]+\.[A-Za-z0-9]", right))
    if kind == "ip":
        return _octets(s)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def _window_starts(text: str, base: list[Span], every_window: bool) -> list[int]:
    last = max(0, len(text) - 1) // STRIDE
    if every_window:
        return list(range(0, last + 1))
    starts, k = set(), 0
    by_end = sorted((s, e) for _, s, e in base)
    for m in ANCHOR.finditer(text):
        a = m.start()
        while k < len(by_end) and by_end[k][1] <= a:
            k += 1
        if k < len(by_end) and any(s <= a < e for s, e in by_end[k : k + len(KINDS)]):
            continue
        starts.add(a // STRIDE)
        if a >= STRIDE:
            starts.add(a // STRIDE - 1)
    return sorted(starts)


def _schedule(found: list[tuple[float, Span]]) -> list[Span]:
    """The non-overlapping spans of the greatest total score; ties to the
    earlier span, then the longer."""
    found = sorted(set(found), key=lambda f: (f[1][2], f[1][1], _order(f[1]), -f[0]))
    ends = [f[1][2] for f in found]
    best: list[float] = [0.0]
    taken: list[bool] = []
    link: list[int] = []
    for score, (_, s, _) in found:
        j = int(np.searchsorted(ends, s, "right"))
        j = min(j, len(taken))
        take = best[j] + score
        taken.append(take > best[-1])
        link.append(j)
        best.append(max(best[-1], take))
    out, i = [], len(found)
    while i:
        if taken[i - 1]:
            out.append(found[i - 1][1])
            i = link[i - 1]
        else:
            i -= 1
    return out[::-1]


def _spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the tag sequence."""
    out, k, n = [], 0, len(KINDS)
    while k < len(tags):
        if tags[k]:
            kind = (tags[k] - 1) % n
            e = k + 1
            while e < len(tags) and tags[e] == kind + 1 + n:
                e += 1
            out.append((int(kind), k, e))
            k = e
        else:
            k += 1
    return out


def added_spans(
    docs: list[str], base: list[list[Span]], model: dict | None, every_window: bool = False
) -> list[list[Span]]:
    """Spans the model adds to each document."""
    found: list[list[tuple[float, Span]]] = [[] for _ in docs]
    if model is None:
        return [[] for _ in docs]
    sides = (0, *SIDES)
    queues: list[list[tuple[int, int]]] = [[] for _ in sides]
    # pieces of one length at a time, so no other piece changes the padding
    blocks = [max(1, BLOCK * WINDOW // (WINDOW + 2 * side)) for side in sides]

    def run(step: int) -> None:
        queue, side = queues[step][:], sides[step]
        queues[step].clear()
        size = WINDOW + 2 * side
        x = np.full((len(queue), size), N_CLASSES - 1, np.int64)
        for i, (d, k) in enumerate(queue):
            lo = max(0, k * STRIDE - side)
            piece = classes(docs[d][lo : lo + size])
            x[i, : len(piece)] = piece
        e = emissions(x, model)
        tags = viterbi(e, model)
        some = np.flatnonzero(tags.any(1))
        if len(some):
            _, marginals, _ = crf(e[:, some], model)
        for j, i in enumerate(some):
            d, k = queue[i]
            at, text = k * STRIDE, docs[d]
            lo, cut = max(0, at - side), False
            for kind, s, t in _spans_of(tags[i]):
                if lo + t <= at or lo + s >= at + WINDOW or lo + t > len(text):
                    continue  # another window's, or padding
                if (s == 0 and lo) or (t == size and lo + t < len(text)):
                    cut = True  # by the edge: decoded again in a wider piece
                    continue
                while t > s and text[lo + t - 1].isspace():
                    t -= 1
                value = text[lo + s : lo + t]
                free = all(b <= lo + s or a >= lo + t for _, a, b in base[d])
                # with a digit or "@" in the window itself, so that a window without one need not be run
                if not free or not ANCHOR.search(text, max(at, lo + s), min(at + WINDOW, lo + t)):
                    continue
                if not _accepted(KINDS[kind], value):
                    continue
                sure = float(marginals[np.arange(s, t), j, tags[i][s:t]].mean())
                if sure >= MIN_POSTERIOR:
                    found[d].append((round(sure, 3) * (t - s), (KINDS[kind], lo + s, lo + t)))
            if cut and step < len(SIDES):
                queues[step + 1].append((d, k))
                if len(queues[step + 1]) >= blocks[step + 1]:
                    run(step + 1)

    for d, text in enumerate(docs):
        for k in _window_starts(text, base[d], every_window):
            queues[0].append((d, k))
            if len(queues[0]) >= blocks[0]:
                run(0)
    for step, queue in enumerate(queues):
        if queue:
            run(step)
    return [_schedule(f) if f else [] for f in found]


def _column_spans(column: pa.Array, model: dict | None) -> tuple[list[str], list[list[Span]], list[list[Span]]]:
    docs = [v or "" for v in column.to_pylist()]
    base = [base_spans(t) for t in docs]
    return docs, base, added_spans(docs, base, model)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row per document: base counts and digest, all spans, added count."""
    model = df.sparkSession.sparkContext.broadcast(fit(df, id_col, text_col, train_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                _, base, added = _column_spans(batch.column("text"), model.value)
                counts = [pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64()) for kind in KINDS]
                every = [sorted(b + a, key=_order) for b, a in zip(base, added, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *counts,
                     pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                     pa.array([joined(s) for s in every], pa.string()),
                     pa.array([len(a) for a in added], pa.int64())],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
                )

    return id_and_text(df, id_col, text_col).mapInArrow(run, SCHEMA)


def masked(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind in brackets; of overlapping spans the
    covered stretch is replaced once, under the first one's kind."""
    out, end = [], 0
    for kind, s, e in sorted(spans, key=_order):
        if s >= end:
            out += [text[end:s], f"[{kind.upper()}]"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def mask(df: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``df`` with all found spans masked in ``text_col`` (null
    stays null); the other columns as they were."""
    model = df.sparkSession.sparkContext.broadcast(
        fit(df.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")), train_docs=train_docs)
    )
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                docs, base, added = _column_spans(batch.column(at), model.value)
                valid = batch.column(at).is_valid().to_pylist()
                new = [masked(t, b + a) if v else None for t, b, a, v in zip(docs, base, added, valid, strict=True)]
                columns = list(batch.columns)
                columns[at] = pa.array(new, batch.column(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(run, df.schema)
