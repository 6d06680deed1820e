"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text's tokens are the runs of letters, digits and non-ASCII characters, A-Z
lower-cased.  A token enters the network twice: as a word (its hashed embedding)
and as characters (the mean of the embeddings of its hashed character trigrams,
the token's borders included).  Windows of ``width`` tokens start every
``width // 2`` tokens and at the last ``width``, so neighbours overlap by half and
every token is read.  In a window one gated recurrent layer reads forwards, one
backwards; attention weighs the joined states, and their weighted mean gives the
window's logit.  A text's score is that of its highest window.

Training: a bounded sample of labelled texts outside the held-out fold
(``per_class`` texts of either label at most, equal texts once, chosen by a hash of
their text), on the driver, in numpy with exact gradients and Adam.  Only the highest
window of a text learns from its label, after a first pass in which all do.  The
sum of the two classes' losses is balanced to ``prior``, so the score does not
depend on how many of each were drawn.  The network has a fixed size (about 0.4 MB)
and is broadcast.

Scoring: no shuffle; a task cuts its texts into windows, in blocks of bounded
size, so a very long text is many blocks and never one tensor.

Defined results
* null or empty text, or one without tokens: one window holding a blank token; its
  score is what the network gives that;
* fold: crc32 of the id's decimal text modulo 3 is 1; a null id is not held out;
* repeated rows are scored each, alike; a tie of windows changes nothing;
* a label that is null or that contradicts another of the same doc_id: the greatest counts;
* without texts of both labels nothing can be learnt: every score is 0.5;
* an empty table gives no rows; other columns (lang, source, ...) are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import slices, table

#: 1 for scores at or above it.
THRESHOLD = 0.7
#: Windows scored at once.
BLOCK = 512
_CACHE = 200_000
_SEPARATE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
                  for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; one blank if none."""
    return (text or "").encode("utf-8", "replace").translate(_SEPARATE).split() or [b" "]


def window_starts(n: int, width: int) -> list[int]:
    """Starts of the windows over n tokens: every half window, and the last ``width``."""
    if n <= width:
        return [0]
    starts = list(range(0, n - width, max(1, width // 2)))
    return [*starts, n - width]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Weights: embeddings of words and of trigrams, a gated layer per direction, attention, output."""

    width: int
    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, width: int, words: int, grams: int, dim: int, hidden: int, seed: int) -> Network:
        r = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (r.standard_normal(shape) * scale).astype(np.float32)

        p = {"word": normal(words, dim, scale=0.1), "gram": normal(grams, dim, scale=0.1),
             "att": normal(2 * hidden, hidden, scale=0.3), "att_v": normal(hidden, scale=0.3),
             "out": normal(2 * hidden, scale=0.3), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            p |= {f"w{d}": normal(2 * dim, 3 * hidden, scale=0.4), f"u{d}": normal(hidden, 3 * hidden, scale=0.3),
                  f"c{d}": np.zeros(3 * hidden, np.float32)}
        return cls(width, p)

    # --- inputs ---------------------------------------------------------------

    def parts(self, vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the tokens' word embeddings, rows of their trigrams' embeddings in one list,
        and each token's start in it (every token has a trigram: its borders count)."""
        n, grams, starts = len(self.p["gram"]), [], []
        for t in vocabulary:
            whole = b"<" + t + b">"
            starts.append(len(grams))
            grams += [zlib.crc32(whole[k:k + 3]) for k in range(len(whole) - 2)]
        words = np.array([zlib.crc32(t) for t in vocabulary], dtype=np.int64) % len(self.p["word"])
        return words, np.array(grams, dtype=np.int64) % n, np.array(starts, dtype=np.int64)

    def inputs(self, parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """One input row per token: its word's embedding beside the mean of its trigrams'."""
        words, grams, starts = parts
        lengths = np.diff(np.append(starts, len(grams)))
        chars = np.add.reduceat(self.p["gram"][grams], starts) / lengths[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][words], chars], axis=1)

    # --- forwards -------------------------------------------------------------

    def gates(self, rows: np.ndarray) -> np.ndarray:
        """What each token's input row adds to the gates: forwards, then backwards (token, 6 hidden)."""
        p = self.p
        return np.concatenate([rows @ p["wf"] + p["cf"], rows @ p["wb"] + p["cb"]], axis=1)

    def _layer(self, x: np.ndarray, mask: np.ndarray, d: str, trail: list | None) -> np.ndarray:
        """States (time, hidden, window) of one direction from its input gates (time, 3 hidden,
        window), which are overwritten."""
        u = np.ascontiguousarray(self.p[f"u{d}"].T)
        h = u.shape[1]
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        states = np.empty((len(x), h, x.shape[2]), np.float32)
        now = np.zeros((h, x.shape[2]), np.float32)
        for t in steps:
            back = u @ now
            zr, c, back_c = x[t, :2 * h], x[t, 2 * h:], back[2 * h:]
            zr += back[:2 * h]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:h], zr[h:]
            c += r * back_c
            np.tanh(c, out=c)
            if trail is not None:
                trail.append((t, now, z, r, c, back_c))
            new = states[t]
            np.subtract(c, now, out=new)
            new *= z
            new *= mask[t]
            new += now
            now = new
        return states

    def forward(self, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logit per window; ``at`` (time, window) are rows of ``gates``."""
        p = self.p
        x = np.ascontiguousarray(gates[at].transpose(0, 2, 1))
        half = x.shape[1] // 2
        trails = ([], []) if keep else (None, None)
        f = self._layer(x[:, :half], mask, "f", trails[0])
        b = self._layer(x[:, half:], mask, "b", trails[1])
        h = f.shape[1]
        a = np.tanh(p["att"][:h].T @ f + p["att"][h:].T @ b)
        s = np.where(mask > 0, p["att_v"] @ a, np.float32(-1e9))
        e = np.exp(s - s.max(0))
        weight = e / e.sum(0)
        pooled = np.concatenate([(weight[:, None] * f).sum(0), (weight[:, None] * b).sum(0)])
        logit = p["out"] @ pooled + p["bias"][0]
        return logit, (f, b, a, weight, pooled, *trails)

    # --- backwards ------------------------------------------------------------

    def _layer_back(self, d_states: np.ndarray, mask: np.ndarray, trail: list, d: str, g: dict) -> np.ndarray:
        u = self.p[f"u{d}"]
        h = u.shape[0]
        d_gates = np.zeros((len(d_states), 3 * h, d_states.shape[2]), np.float32)
        later = np.zeros(d_states.shape[1:], np.float32)
        for t, now, z, r, c, back_c in reversed(trail):
            dh, m = later + d_states[t], mask[t]
            dz = dh * m * (c - now) * z * (1 - z)
            dc = dh * m * z * (1 - c * c)
            dr = dc * back_c * r * (1 - r)
            d_gates[t, :h], d_gates[t, h:2 * h], d_gates[t, 2 * h:] = dz, dr, dc
            d_back = np.concatenate([dz, dr, dc * r])
            g[f"u{d}"] += now @ d_back.T
            later = dh * (1 - m * z) + u @ d_back
        return d_gates

    def gradients(self, vocabulary: list[bytes], at: np.ndarray, mask: np.ndarray, d_logit) -> tuple[np.ndarray, dict]:
        """(logits, gradients) of a loss whose derivative by the logits is ``d_logit(logits)``."""
        p = self.p
        parts = self.parts(vocabulary)
        rows = self.inputs(parts)
        logit, (f, b, a, weight, pooled, trail_f, trail_b) = self.forward(self.gates(rows), at, mask, keep=True)
        states = np.concatenate([f, b], axis=1)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        dl = d_logit(logit).astype(np.float32)
        g["out"], g["bias"] = pooled @ dl, np.array([dl.sum()], np.float32)
        d_pooled = p["out"][:, None] * dl
        d_weight = (states * d_pooled).sum(1)
        ds = weight * (d_weight - (weight * d_weight).sum(0))
        g["att_v"] = np.einsum("tw,thw->h", ds, a)
        da = ds[:, None] * p["att_v"][:, None] * (1 - a * a)
        g["att"] = np.einsum("tsw,thw->sh", states, da, optimize=True)
        d_states = weight[:, None] * d_pooled + p["att"] @ da
        h = p["uf"].shape[0]
        d_rows = np.zeros_like(rows)
        order = np.argsort(at, axis=None, kind="stable")
        first = np.searchsorted(at.ravel()[order], np.arange(len(rows)))
        for d, part, trail in (("f", d_states[:, :h], trail_f), ("b", d_states[:, h:], trail_b)):
            d_gates = self._layer_back(part, mask, trail, d, g).transpose(0, 2, 1).reshape(-1, 3 * h)
            by_row = np.add.reduceat(d_gates[order], first)
            g[f"c{d}"] = by_row.sum(0)
            g[f"w{d}"] = rows.T @ by_row
            d_rows += by_row @ p[f"w{d}"].T
        dim = p["word"].shape[1]
        words, grams, starts = parts
        lengths = np.diff(np.append(starts, len(grams)))
        np.add.at(g["word"], words, d_rows[:, :dim])
        np.add.at(g["gram"], grams, np.repeat(d_rows[:, dim:] / lengths[:, None].astype(np.float32), lengths, axis=0))
        return logit, g


def tensors(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(at, mask), both (time, window), of windows of a list of token rows; past its end a window
    repeats its last token under a mask of 0."""
    step = np.arange(int(lengths.max()))[:, None]
    return flat[starts + np.minimum(step, lengths - 1)], (step < lengths).astype(np.float32)


def fit(texts: list[str | None], labels: list[int], width: int = 32, words: int = 4096, grams: int = 2048,
        dim: int = 8, hidden: int = 8, epochs: int = 6, rate: float = 0.01, prior: float = 0.3,
        steps: int = 120, windows_per_text: int = 24, batch: int = 48, seed: int = 13) -> Network | None:
    """A network for the labelled texts; None unless both labels occur.

    ``epochs`` passes over the texts, more if they are few and give less than ``steps``
    steps; ``windows_per_text`` windows of a text, drawn anew in each pass, learn at most.
    """
    y = np.array(labels, dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return None
    net = Network.new(width, words, grams, dim, hidden, seed)
    r = np.random.default_rng(seed)
    tokened = [tokens(t) for t in texts]
    share = {1.0: prior / y.mean(), 0.0: (1 - prior) / (1 - y.mean())}
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    epochs = max(epochs, -(-steps // -(-len(y) // batch)))
    for epoch in range(epochs):
        order = r.permutation(len(y))
        for b in range(0, len(order), batch):
            vocabulary: dict[bytes, int] = {}
            flat, begins, lengths, owner = [], [], [], []
            for k in order[b:b + batch]:
                starts = window_starts(len(tokened[k]), width)
                if len(starts) > windows_per_text:
                    starts = [starts[i] for i in sorted(r.choice(len(starts), windows_per_text, replace=False))]
                for s in starts:
                    begins.append(len(flat))
                    flat += [vocabulary.setdefault(t, len(vocabulary)) for t in tokened[k][s:s + width]]
                    lengths.append(len(flat) - begins[-1])
                    owner.append(k)
            own = np.array(owner)
            weight = np.array([share[float(v)] for v in y[own]], dtype=np.float32)
            each = np.bincount(own, minlength=len(y))[own]

            def d_logit(logit: np.ndarray) -> np.ndarray:
                d = (_sigmoid(logit) - y[own]) * weight
                if epoch == 0:
                    return d / each / batch
                by = np.lexsort((-logit, own))
                top = by[np.concatenate([[True], own[by][1:] != own[by][:-1]])]
                out = np.zeros_like(d)
                out[top] = d[top] / batch
                return out

            _, g = net.gradients(list(vocabulary), *tensors(
                np.array(flat), np.array(begins), np.array(lengths)), d_logit)
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            for k, v in g.items():
                v = v / max(1.0, size)
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                net.p[k] -= (rate / (1 + 3 * epoch / epochs)) * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
    return net


class Scorer:
    """Scores texts by a network; remembers the gate inputs of the tokens it has met."""

    def __init__(self, net: Network):
        self.net = net
        self.row: dict[bytes, int] = {}
        self.gates = np.zeros((0, 6 * net.p["uf"].shape[0]), np.float32)

    def _rows(self, own: list[bytes]) -> np.ndarray:
        found = list(map(self.row.get, own))
        if None in found:
            new = list(dict.fromkeys(t for t, k in zip(own, found) if k is None))
            for k, t in enumerate(new, len(self.row)):
                self.row[t] = k
            need = len(self.row)
            if need > len(self.gates):
                more = np.zeros((max(need, 2 * len(self.gates)), self.gates.shape[1]), np.float32)
                more[:len(self.gates)] = self.gates
                self.gates = more
            self.gates[need - len(new):need] = self.net.gates(self.net.inputs(self.net.parts(new)))
            found = list(map(self.row.__getitem__, own))
        return np.array(found, dtype=np.int64)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The score of every text."""
        width = self.net.width
        if len(self.row) > _CACHE:
            self.row, self.gates = {}, self.gates[:0]
        own = [tokens(t) for t in texts]
        sizes = np.array([len(t) for t in own])
        flat = self._rows([t for part in own for t in part])
        begins, lengths, owner = [], [], []
        at = 0
        for k, n in enumerate(sizes.tolist()):
            starts = window_starts(n, width)
            begins += [at + s for s in starts]
            lengths += [min(n, width)] * len(starts)
            owner += [k] * len(starts)
            at += n
        begins, lengths, owner = np.array(begins), np.array(lengths), np.array(owner)
        logits = np.empty(len(begins))
        by_size = np.argsort(lengths, kind="stable")
        for part in (by_size[k:k + BLOCK] for k in range(0, len(by_size), BLOCK)):
            place, mask = tensors(flat, begins[part], lengths[part])
            names, place = np.unique(place, return_inverse=True)
            logits[part] = self.net.forward(self.gates[names], place.reshape(mask.shape), mask)[0]
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, logits)
        return _sigmoid(best)


# --- the Spark side -----------------------------------------------------------


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 3; 0 for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = 600, seed: int = 13) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` distinct texts of either label outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).where(
        "_toxic in (0, 1)").groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    d = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").where(
        (fold_of(F.col("_id")) != 1) & F.col("text").isNotNull())
    # Texts are hashed where they are read: only ids and hashes meet the labels.
    own = d.select("_id", F.xxhash64(F.lit(seed), "text").alias("_h")).join(known, "_id").groupBy("_h", "_toxic").agg(
        F.min("_id").alias("_id"))
    chosen = None
    for label in (0, 1):
        part = own.where(F.col("_toxic") == label).orderBy("_h", "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most two ids per text and label sampled: read their texts again.
    few = chosen.select("_id", "_toxic", "_h").collect()
    if not few:
        return []
    ids = docs.sparkSession.createDataFrame([(r["_id"],) for r in few], "_id bigint").distinct()
    texts = d.join(F.broadcast(ids), "_id", "left_semi").groupBy("_id", F.xxhash64(F.lit(seed), "text").alias("_h")).agg(
        F.first("text").alias("text")).collect()
    by = {(r["_id"], r["_h"]): r["text"] for r in texts}
    return [(by[r["_id"], r["_h"]], r["_toxic"]) for r in sorted(few, key=lambda r: (r["_h"], r["_toxic"], r["_id"]))]


def score(docs: DataFrame, labels: DataFrame, per_class: int = 600, net: Network | None = None,
          threshold: float = THRESHOLD, **training) -> DataFrame:
    """doc_id, held_out, score, predicted, n_windows for every row of ``docs`` (doc_id, text)."""
    if net is None:
        drawn = sample(docs, labels, per_class)
        net = fit([t for t, _ in drawn], [y for _, y in drawn], **training)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        scorer = Scorer(own) if own else None
        for part in slices(batches):
            texts = part.column(1).to_pylist()
            values = scorer.scores(texts) if scorer else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(values, pa.float64())],
                                             ["doc_id", "held_out", "score"])

    d = docs.select(F.col("doc_id").cast("bigint"), "text", (fold_of(F.col("doc_id")) == 1).alias("held_out"))
    out = d.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return out.select("*", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; learn from labels outside the held-out fold."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels", spread=False))
