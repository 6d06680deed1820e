"""Personal data: pattern rules, extended by a skip-chain conditional random field.

Base rules find emails, IP addresses, card numbers (Luhn) and phone numbers.
The field then labels the document's suspicious tokens (those with a digit or
``@``): chain potentials tie neighbouring ones, skip potentials tie repeated or
similar ones wherever they stand (same text, same digits, same last digits, same
mailbox), each to the next occurrence.  Loopy sum-product message passing, run
until the messages settle, gives marginals, with base spans as given labels; tokens outside them whose label is
surer than ``sure`` are added, neighbours of one label joined to one span.  So a number written once in full
and later without its prefix, or an address cut short, is found too.

The field is trained here: by gradient ascent on the labels that the base rules
give to a bounded, seeded sample of documents with suspicious tokens
(``train_docs`` documents of at most ``train_chars`` characters; the bound is the
sample's only limit).  Rules and field then run over every whole text.

Defined results
* null or empty text: no spans; sha256 of the empty string;
* repeated rows are judged alike; an empty table gives no rows;
* overlapping spans of different kinds all stay; equal starts are ordered by kind;
* texts of any length are scanned whole, in time linear in their length;
* other input columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import slices, table

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
LABELS = len(KINDS) + 1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, so the look-behind changes no result.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_SUSPICIOUS = re.compile(r"[0-9@]")
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_EDGE = ".,;:!?\"'()[]{}<>|"

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    """Check sum of a card number."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules, by start, then kind."""
    out: list[Span] = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if 14 <= len(d := _NOT_DIGITS.sub("", m.group())) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out



# --- the field ------------------------------------------------------------------------


def suspicious(text: str) -> list[tuple[int, int]]:
    """(start, end) of the words with a digit or ``@``, edge punctuation cut off."""
    out, done = [], 0
    m = _SUSPICIOUS.search(text)
    while m:
        start = m.start()
        while start > done and text[start - 1] not in _BLANKS:
            start -= 1
        stop = _BLANK.search(text, m.end())
        end = done = stop.start() if stop else len(text)
        word = text[start:end]
        left = len(word) - len(word.lstrip(_EDGE))
        right = len(word.rstrip(_EDGE))
        if left < right:
            out.append((start + left, start + right))
        m = _SUSPICIOUS.search(text, end)
    return out


def features(token: str) -> list[int]:
    """Indices of the binary features of a token."""
    digits = _NOT_DIGITS.sub("", token)
    n = len(digits)
    f = [0, 1 + min(n, 20)]
    letters = any(c.isalpha() for c in token)
    if "@" in token:
        f.append(22)
        left, _, right = token.partition("@")
        f.append(23 if left and "." in right.strip(".") else 24)
    f.append(25 if letters else 26)
    dots = token.count(".")
    f.append(27 + min(dots, 4))
    if token.startswith("+"):
        f.append(32)
    if "(" in token or ")" in token:
        f.append(33)
    if "-" in token:
        f.append(34)
    if n >= 14:
        f.append(35 if n <= 19 and luhn(digits) else 36)
    if dots == 3 and not letters:
        parts = token.split(".")
        f.append(37 if all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts) else 38)
    if re.fullmatch(r"[0-9]{3}-[0-9]{4}", token):
        f.append(39)
    if n and n == len(token):
        f.append(40)
    return f


FEATURES = 41
SKIPS = 4  # same text, same digits, same last seven digits, same mailbox
#: Skip potentials start from, and are drawn towards, this much for equal labels; equal
#: digits or mailboxes say more than equal text, which may be a short number.
AGREE = (1.5, 4.0, 4.0, 4.0)
#: Score of a label that a base span has already given to a token.
GIVEN = 30.0
#: Change of a log message below which it counts as settled.
SETTLED = 1e-4


def keys(token: str) -> list[tuple[int, str]]:
    """(kind of similarity, key), strongest first: equal keys share a skip edge."""
    digits = _NOT_DIGITS.sub("", token)
    out = []
    if len(digits) >= 6:
        out.append((1, digits))
    if len(digits) >= 7:
        out.append((2, digits[-7:]))
    if "@" in token:
        out.append((3, token.lower().partition("@")[0]))
    return [*out, (0, token.lower())]


def graph(text: str) -> tuple[list[tuple[int, int]], list[list[int]], list[tuple[int, int, int]]]:
    """Tokens, their features, and edges (i, j, type): type 0 chains, 1.. skips."""
    tokens = suspicious(text)
    feats, edges, last = [], [], {}
    for i, (s, e) in enumerate(tokens):
        word = text[s:e]
        feats.append(features(word))
        if i and s - tokens[i - 1][1] <= 4 and "\n" not in text[tokens[i - 1][1]:s]:
            edges.append((i - 1, i, 0))
        seen = set()
        for kind, key in keys(word):
            j = last.get((kind, key))
            if j is not None and j not in seen:
                seen.add(j)
                edges.append((j, i, 1 + kind))
            last[kind, key] = i
    return tokens, feats, edges


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def beliefs(unary: np.ndarray, edges: np.ndarray, pair: np.ndarray, rounds: int | None = 12, damp: float = 0.3):
    """Loopy sum-product over a graph (or many graphs side by side).

    unary (nodes, labels); edges (m, 3) of i, j, type; pair (types, labels,
    labels).  Returns log node marginals and edge marginals; exact on trees of
    diameter up to ``rounds`` without damping.  With ``rounds`` None messages run
    until none changes by more than ``SETTLED``, however far they have to go; only
    messages next to a change are sent again.
    """
    n, m = len(unary), len(edges)
    if not m:
        return unary - _log_sum(unary, 1)[:, None], np.zeros((0, *pair.shape[1:]))
    src = np.concatenate([edges[:, 0], edges[:, 1]])
    dst = np.concatenate([edges[:, 1], edges[:, 0]])
    w = pair[edges[:, 2]]
    w = np.concatenate([w, w.transpose(0, 2, 1)])  # (edge, label at src, label at dst)
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    msg = np.zeros((2 * m, unary.shape[1]))
    if rounds is None:
        msg = _settled(unary, src, dst, w, back, damp)
    for _ in range(rounds or 0):
        total = unary.copy()
        np.add.at(total, dst, msg)
        out = _log_sum((total[src] - msg[back])[:, :, None] + w, 1)
        out -= _log_sum(out, 1)[:, None]
        msg = damp * msg + (1 - damp) * out
    total = unary.copy()
    np.add.at(total, dst, msg)
    first, second = total[src[:m]] - msg[back[:m]], total[dst[:m]] - msg[:m]
    both = first[:, :, None] + w[:m] + second[:, None, :]
    both = np.exp(both - _log_sum(both.reshape(m, -1), 1)[:, None, None])
    return total - _log_sum(total, 1)[:, None], both


def _settled(unary: np.ndarray, src: np.ndarray, dst: np.ndarray, w: np.ndarray, back: np.ndarray,
             damp: float) -> np.ndarray:
    """Messages of all directed edges once they have stopped changing.

    A message crosses any graph in fewer steps than it has nodes; loops that had
    not settled long after that end there.
    """
    msg, total = np.zeros((len(src), unary.shape[1])), unary.copy()
    send = np.arange(len(src))
    for _ in range(4 * len(unary) + 100):
        out = _log_sum((total[src[send]] - msg[back[send]])[:, :, None] + w[send], 1)
        step = (1 - damp) * (out - _log_sum(out, 1)[:, None] - msg[send])
        msg[send] += step
        np.add.at(total, dst[send], step)
        changed = send[np.abs(step).max(1) > SETTLED]
        if not len(changed):
            break
        near = np.zeros(len(unary), bool)
        near[dst[changed]] = True
        again = near[src]
        again[changed] = True
        send = np.flatnonzero(again)
    return msg


class Field:
    """Weights of the skip-chain field."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray):
        self.unary, self.pair = unary, pair

    def scores(self, feats: list[list[int]]) -> np.ndarray:
        return np.array([self.unary[f].sum(0) for f in feats]) if feats else np.zeros((0, LABELS))


def gold(tokens: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """Labels that the base spans give to the tokens."""
    out, k = [], 0
    for s, e in tokens:
        while k < len(spans) and spans[k][2] <= s:
            k += 1
        hit = next((c for a, c, b in spans[k:k + 4] if a < e and s < b), OTHER)
        out.append(hit)
    return out


def fit(texts: list[str], steps: int = 60, rate: float = 0.5, l2: float = 0.02) -> Field:
    """Gradient ascent on the (Bethe) likelihood of the base rules' labels.

    All documents are one graph of separate parts, so each step is one batched
    message passing; step sizes adapt per weight.
    """
    feats, labels, edges = [], [], []
    for text in texts:
        tokens, f, e = graph(text)
        edges += [(i + len(feats), j + len(feats), t) for i, j, t in e]
        feats += f
        labels += gold(tokens, base_spans(text))
    unary = np.zeros((FEATURES, LABELS))
    prior = np.zeros((1 + SKIPS, LABELS, LABELS))
    prior[1:] = np.array(AGREE)[:, None, None] * np.eye(LABELS)
    pair = prior.copy()
    if not feats:
        unary[0, OTHER] = 5.0
        return Field(unary, pair)
    x = np.zeros((len(feats), FEATURES))
    for i, f in enumerate(feats):
        x[i, f] = 1
    y = np.eye(LABELS)[labels]
    e = np.array(edges, dtype=np.int64).reshape(-1, 3)
    seen_pair = np.zeros_like(pair)
    labels = np.array(labels)
    np.add.at(seen_pair, (e[:, 2], labels[e[:, 0]], labels[e[:, 1]]), 1)
    g_u, g_p = np.full_like(unary, 1e-8), np.full_like(pair, 1e-8)
    for _ in range(steps):
        node, both = beliefs(x @ unary, e, pair)
        d_u = x.T @ (y - np.exp(node)) / len(x) - l2 * unary / 10
        d_p = seen_pair.copy()
        np.subtract.at(d_p, e[:, 2], both)
        d_p = d_p / max(1, len(e)) - l2 * (pair - prior) / 10
        g_u += d_u ** 2
        g_p += d_p ** 2
        unary += rate * d_u / np.sqrt(g_u)
        pair += rate * d_p / np.sqrt(g_p)
    return Field(unary, pair)


def added_spans(texts: list[str], base: list[list[Span]], field: Field, sure: float) -> list[list[Span]]:
    """Spans that the field adds to each text."""
    parts, feats, edges, given_labels = [], [], [], []
    for text, given in zip(texts, base):
        tokens, f, e = graph(text) if text else ([], [], [])
        at = len(feats)
        parts.append((at, tokens))
        given_labels += gold(tokens, given)
        edges += [(i + at, j + at, t) for i, j, t in e]
        feats += f
    if not feats:
        return [[] for _ in texts]
    unary, known = field.scores(feats), np.array(given_labels)
    hit = np.flatnonzero(known != OTHER)
    unary[hit, known[hit]] += GIVEN
    node, _ = beliefs(unary, np.array(edges, dtype=np.int64).reshape(-1, 3), field.pair, rounds=None)
    best, p = node.argmax(1), np.exp(node.max(1))
    out = []
    for (at, tokens), text, given in zip(parts, texts, base):
        own: list[Span] = []
        last = -2
        ends = sorted((s, e) for s, _, e in given)
        k = 0
        for i, (s, e) in enumerate(tokens):
            while k < len(ends) and ends[k][1] <= s:
                k += 1
            inside = any(a < e and s < b for a, b in ends[k:k + 4])
            label = int(best[at + i])
            if label == OTHER or p[at + i] < sure or inside:
                continue
            if own and last == i - 1 and own[-1][1] == label and s - own[-1][2] <= 4:
                own[-1] = (own[-1][0], label, e)
            else:
                own.append((s, label, e))
            last = i
        out.append([x for x in own if _enough(text[x[0]:x[2]], x[1])])
    return out


def _enough(part: str, kind: int) -> bool:
    """An added span must hold what makes its kind personal: a mailbox, or seven digits."""
    return "@" in part[1:-1] if kind == 0 else len(_NOT_DIGITS.sub("", part)) >= 7


# --- the Spark side -------------------------------------------------------------------


def train_field(docs: DataFrame, train_docs: int = 400, train_chars: int = 20_000, seed: int = 5) -> Field:
    """Fit on the ``train_docs`` distinct texts with a digit or ``@`` whose hashes are least.

    Texts of more than ``train_chars`` characters don't train.  Only such texts count, each
    once, so rare personal data or many copies of a text leave the field no smaller; hashes
    are chosen first, so no other text moves.
    """
    d = docs.select("text", F.xxhash64(F.lit(seed), "text").alias("h")).where(
        F.col("text").rlike("[0-9@]") & (F.length("text") <= train_chars))
    least = [r["h"] for r in d.select("h").distinct().orderBy("h").limit(train_docs).collect()]
    if not least:
        return fit([])
    wanted = docs.sparkSession.createDataFrame([(h,) for h in least], "h bigint")
    rows = d.join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(F.min("text").alias("text")).collect()
    return fit([r["text"] for r in sorted(rows, key=lambda r: (r["h"], r["text"]))])


def find(docs: DataFrame, field: Field | None = None, sure: float = 0.95) -> DataFrame:
    """doc_id, base and added array<struct(kind, start, end)> of every document (doc_id, text)."""
    field = field or train_field(docs)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def column(lists: list[list[Span]]) -> pa.Array:
            return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in lists], span)

        for part in slices(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), column(base), column(added_spans(texts, base, shared.value, sure))],
                ["doc_id", "base", "added"])

    one = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, f"doc_id bigint, base {one}, added {one}")


def redact_text(text: str, spans: list[Span]) -> str:
    """Replace every span by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for s, k, e in sorted(spans):
        if s < at:
            at = max(at, e)
            continue
        out += [text[at:s], f"[{KINDS[k]}]"]
        at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field | None = None, sure: float = 0.95) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``[kind]``; null stays null."""
    field = field or train_field(docs)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(at).to_pylist()
            whole = [t or "" for t in texts]
            base = [base_spans(t) for t in whole]
            more = added_spans(whole, base, shared.value, sure)
            new = [None if t is None else redact_text(t, b + a) for t, b, a in zip(texts, base, more)]
            cols = list(part.columns)
            cols[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(cols, part.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base digest and all spans of every document."""
    found = find(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def text(c):
        return F.array_join(F.transform(c, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    order = F.array(*[F.lit(k) for k in KINDS])
    every = F.transform(F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(
        x["start"].alias("start"), F.array_position(order, x["kind"]).alias("k"), x["end"].alias("end"),
        x["kind"].alias("kind")))), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"),
                                                       x["end"].alias("end")))
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(text("base"), 256).alias("base_sha256"),
                        text(every).alias("spans"), F.size("added").cast("bigint").alias("n_added"))
