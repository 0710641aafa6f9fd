"""Language identification by a bidirectional gated recurrent network over bytes.

A lower-cased text is cut at character borders into segments of about SEGMENT
bytes, blanks and all, and CONTEXT bytes of its neighbours are read with each.
One recurrent layer reads these bytes forwards and one backwards; at every byte
a softmax over both states gives language probabilities.  A document's are the
mean over all its bytes, a character's label is that of its last byte.  Equal
segments are worked out once.

The network is trained in numpy by backpropagation through time, on a bounded
sample of the segments of each language's documents, cut by the same function.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import WordCache, crc32_fold, filter_texts, forgets, map_slices, picked

HIDDEN = 24
SEGMENT, CONTEXT = 256, 16
#: Most documents (about) and segments of a language to learn from.
TRAIN_DOCS, TRAIN_SEGMENTS = 1_000, 500
BATCH, EPOCHS, LEAST_STEPS, RATE, SEED = 32, 6, 60, 0.01, 11
#: Segments worked out at a time, steps whose states are held for the output layer, segments remembered by a worker.
TOGETHER, BLOCK, REMEMBERED = 512, 4, 40_000
UNDETERMINED = "und"
#: ``accept`` rejects no document by its score, only those without a determined language.
LEAST_SCORE = 0.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class Layer:
    """One direction: update and reset gates and a candidate state."""

    def __init__(self, params: dict[str, np.ndarray], name: str):
        self.inputs, self.recurrent = params[f"{name}_in"], params[f"{name}_re"]

    def forward(self, data: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States at every step (steps, batch, HIDDEN); what BPTT needs, if ``keep``."""
        steps, n = data.shape
        h, out, kept = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32), []
        for t in range(steps):
            x, u = self.inputs[data[t]], h @ self.recurrent
            gates = sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            inner = u[:, 2 * HIDDEN :]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * inner)
            m = mask[t][:, None]
            if keep:
                kept.append((h, z, r, inner, c, m))
            h = np.where(m, c + z * (h - c), h)
            out[t] = h
        return out, kept

    def backward(self, data: np.ndarray, kept: list, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the input table and the recurrent matrix, from those of all states."""
        d_in, d_re = np.zeros_like(self.inputs), np.zeros_like(self.recurrent)
        dh = np.zeros_like(grads[0])
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, inner, c, m = kept[t]
            dh = dh + grads[t]
            d = np.where(m, dh, 0)
            dc = d * (1 - z) * (1 - c * c)
            dz = d * (h - c) * z * (1 - z)
            dr = dc * inner * r * (1 - r)
            dx = np.concatenate([dz, dr, dc], axis=1)
            du = np.concatenate([dz, dr, dc * r], axis=1)
            np.add.at(d_in, data[t], dx)
            d_re += h.T @ du
            dh = np.where(m, d * z + du @ self.recurrent.T, dh)
        return d_in, d_re


def initial(languages: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    params = {f"{d}_in": draw(256, 3 * HIDDEN, scale=0.3) for d in ("ahead", "back")}
    params |= {f"{d}_re": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5) for d in ("ahead", "back")}
    return params | {"out": draw(2 * HIDDEN, languages, scale=0.1), "bias": np.zeros(languages, np.float32)}


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes by step, where they are, and the step each one has in reverse order."""
    sizes = np.array([len(w) for w in words])
    steps = int(sizes.max())
    data = np.frombuffer(b"".join(w.ljust(steps, b"\0") for w in words), np.uint8).reshape(len(words), steps).T
    at = np.arange(steps)[:, None]
    return data, at < sizes, np.where(at < sizes, sizes - 1 - at, at)


def network(params: dict[str, np.ndarray], words: list[bytes], keep: bool = False) -> tuple:
    """Probabilities at every byte (steps, batch, languages), the mask, and what BPTT needs."""
    data, mask, flip = padded(words)
    turned = np.take_along_axis(data, flip, 0)
    ahead, kept_a = Layer(params, "ahead").forward(data, mask, keep)
    back, kept_b = Layer(params, "back").forward(turned, mask, keep)
    states = np.concatenate([ahead, np.take_along_axis(back, flip[:, :, None], 0)], axis=2)
    logits = states @ params["out"] + params["bias"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    return p, mask, (data, turned, flip, states, kept_a, kept_b)


def gradients(params: dict[str, np.ndarray], words: list[bytes], labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over the bytes, weighted by word, and its gradients."""
    p, mask, (data, turned, flip, states, kept_a, kept_b) = network(params, words, True)
    share = (mask * weights).astype(np.float32)
    share /= share.sum()
    picked_p = np.take_along_axis(p, np.broadcast_to(labels[None, :, None], (*mask.shape, 1)), 2)[:, :, 0]
    loss = float(-(share * np.log(picked_p + 1e-9)).sum())
    d = p.copy()
    np.put_along_axis(d, np.broadcast_to(labels[None, :, None], (*mask.shape, 1)), (picked_p - 1)[:, :, None], 2)
    d *= share[:, :, None]
    d_states = d @ params["out"].T
    d_back = np.take_along_axis(d_states[:, :, HIDDEN:], flip[:, :, None], 0)
    grads = {"out": np.tensordot(states, d, ((0, 1), (0, 1))), "bias": d.sum((0, 1))}
    grads["ahead_in"], grads["ahead_re"] = Layer(params, "ahead").backward(data, kept_a, d_states[:, :, :HIDDEN])
    grads["back_in"], grads["back_re"] = Layer(params, "back").backward(turned, kept_b, d_back)
    return loss, grads


def train(words: list[tuple[bytes, int, int]], languages: int) -> dict[str, np.ndarray]:
    """Parameters from (word, language, count), by Adam; rarer words weigh by the root of their count."""
    params = initial(languages)
    mean = {k: np.zeros_like(v) for k, v in params.items()}
    spread = {k: np.zeros_like(v) for k, v in params.items()}
    rng, step = np.random.default_rng(SEED), 0
    text = [w for w, _, _ in words]
    label = np.array([y for _, y, _ in words])
    weight = np.sqrt(np.array([n for _, _, n in words], np.float32))
    batches = -(-len(words) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    total = epochs * batches
    for _ in range(epochs):
        order = rng.permutation(len(words))
        for start in range(0, len(words), BATCH):
            rows = order[start : start + BATCH]
            _, grads = gradients(params, [text[i] for i in rows], label[rows], weight[rows])
            step += 1
            rate = RATE * (1 - step / (total + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                spread[k] += 0.001 * (g * g - spread[k])
                params[k] -= (rate * mean[k] / (np.sqrt(spread[k]) + 1e-8)).astype(np.float32)
    return params


def lean(params: dict[str, np.ndarray], words: list[bytes], read: np.ndarray | None = None) -> np.ndarray:
    """The probabilities of ``network`` (steps, batch, languages), for words in order of falling ``read``.

    Each direction reads that many bytes of a word, from the end where it starts (all, if not
    given); probabilities are right where both have read.  Both directions go side by side, the
    words still read at a step are the first ones, and a gate's values lie together, as one
    language's probabilities do: what is taken over them runs over whole arrays.
    """
    data, mask, flip = padded(words)
    sizes, n = mask.sum(0), len(words)
    read = sizes if read is None else read
    steps = int(read[0])
    active = (np.arange(steps)[:, None] < read).sum(1).tolist()
    both = np.stack([data[:steps], np.take_along_axis(data, flip[:steps], 0)], 1).astype(np.intp)
    both[:, 1] += 256  # the tables of the two directions stand one below the other

    # A gate is (tanh(x / 2) + 1) / 2: the halves are taken into the weights.
    update_in, reset_in, inner_in = (np.concatenate([params[f"{d}_in"][:, k : k + HIDDEN] for d in ("ahead", "back")]) for k in range(0, 3 * HIDDEN, HIDDEN))
    update_in, reset_in = update_in * np.float32(0.5), reset_in * np.float32(0.5)
    recurrent = np.stack([[params[f"{d}_re"][:, k : k + HIDDEN] for d in ("ahead", "back")] for k in range(0, 3 * HIDDEN, HIDDEN)]) * np.float32(0.5)
    out = params["out"].reshape(2, HIDDEN, -1)

    parts = np.empty((2, steps, n, out.shape[2]), np.float32)
    states, h = np.zeros((BLOCK, 2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
    room, m = [np.empty(k * h.size, np.float32) for k in (3, 1, 1)], 0
    for first in range(0, steps, BLOCK):
        for t in range(first, min(first + BLOCK, steps)):
            if active[t] != m:
                m = active[t]
                h, size = h[:, :m], 2 * m * HIDDEN
                u, x, d = (r[: len(r) // (2 * n * HIDDEN) * size].reshape(-1, 2, m, HIDDEN) for r in room)
                gates, (z, r, c), x, d = u[:2], u, x[0], d[0]
            at = both[t, :, :m]
            np.matmul(h, recurrent, out=u)
            update_in.take(at, 0, x, "clip")
            z += x
            reset_in.take(at, 0, x, "clip")
            r += x
            np.tanh(gates, out=gates)
            gates += 1
            c *= r
            inner_in.take(at, 0, x, "clip")
            c += x
            np.tanh(c, out=c)
            np.subtract(h, c, out=d)
            d *= z
            d *= np.float32(0.5)
            h = states[t - first, :, :m]
            np.add(c, d, out=h)
        np.matmul(states[: t + 1 - first], out, out=parts[:, first : t + 1].transpose(1, 0, 2, 3))
    ahead, back = parts.transpose(0, 3, 1, 2)
    logits = np.zeros((out.shape[2], *data.shape), np.float32)
    np.add(ahead, params["bias"][:, None, None], out=logits[:, :steps])
    # What was read backwards is turned round, for all words of one size together.
    edges = np.flatnonzero(np.diff(sizes) | np.diff(read)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), n], strict=True):
        logits[:, sizes[a] - read[a] : sizes[a], a:b] += back[:, : read[a], a:b][:, ::-1]
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits.transpose(1, 2, 0)


def likeliest(p: np.ndarray) -> np.ndarray:
    """The first language of the greatest probability at every byte (steps, batch)."""
    best, top = np.zeros(p.shape[:2], np.uint16), p[:, :, 0].copy()
    for k in range(1, p.shape[2]):
        np.copyto(best, k, where=p[:, :, k] > top)
        np.maximum(top, p[:, :, k], out=top)
    return best


def lowered(text: str) -> str:
    """Lower-cased character by character, so that positions stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def cut(data: bytes) -> list[tuple[int, int, int, int]]:
    """(first, begin, end, last) of every segment, at character borders: begin to end is its own, the rest context."""

    def border(k: int) -> int:
        while 0 < k < len(data) and data[k] & 0xC0 == 0x80:
            k -= 1
        return max(0, min(k, len(data)))

    ends = [border(k) for k in range(0, len(data), SEGMENT)] + [len(data)]
    return [(border(a - CONTEXT), a, b, border(b + CONTEXT)) for a, b in zip(ends, ends[1:], strict=False)]


def segments(text: str) -> list[bytes]:
    """The bytes of every segment, with its context; surrogates alone, which UTF-8 hasn't, as '?'."""
    data = lowered(text).encode(errors="replace")
    return [data[first:last] for first, _, _, last in cut(data)]


class Identifier:
    """Trained parameters and the outcomes of segments met so far."""

    def __init__(self, params: dict[str, np.ndarray], languages: list[str]):
        self.params, self.languages = params, languages
        self.row = WordCache(REMEMBERED)

    def learn(self, wanted: set[tuple[bytes, int, int]]) -> dict:
        """Sums of the probabilities over a segment's own bytes, and the best language at each of them.

        The context behind a segment doesn't change what is read forwards in it, nor does the
        context before it what is read backwards.
        """
        reads = lambda w: max(w[2], len(w[0]) - w[1])
        fresh = sorted((w for w in wanted if w not in self.row), key=lambda w: (-reads(w), -len(w[0]), w))
        known = {w: self.row[w] for w in wanted if w in self.row}
        for start in range(0, len(fresh), TOGETHER):
            part = fresh[start : start + TOGETHER]
            p = lean(self.params, [w for w, _, _ in part], np.array([reads(w) for w in part]))
            best = likeliest(p).T.copy()
            begin, end, step = np.array([a for _, a, _ in part]), np.array([b for _, _, b in part]), np.arange(len(p))[:, None]
            p *= ((begin <= step) & (step < end))[:, :, None]
            sums = p.sum(0)
            for i, (w, a, b) in enumerate(part):
                known[w, a, b] = sums[i].copy(), best[i, a:b].copy()
        self.row.make_room(len(fresh))
        self.row.update((w, known[w]) for w in fresh[: self.row.limit])
        return known

    def work_out(self, texts: list[str | None]) -> list[tuple[bytes, list] | None]:
        """Bytes and outcomes of the segments of every text; None for those without a letter."""
        out, wanted = [], set()
        for t in texts:
            if not t or not self.languages or not any(map(str.isalpha, t)):
                out.append(None)
                continue
            data = lowered(t).encode(errors="replace")
            keys = [(data[first:last], a - first, b - first) for first, a, b, last in cut(data)]
            wanted.update(keys)
            out.append((data, keys))
        known = self.learn(wanted)
        return [x and (x[0], [known[k] for k in x[1]]) for x in out]

    def total(self, found: tuple[bytes, list] | None) -> tuple[str, float]:
        if not found:
            return UNDETERMINED, 0.0
        pooled = np.sum([sums for sums, _ in found[1]], axis=0, dtype=np.float64)
        best = int(pooled.argmax())
        return self.languages[best], float(min(1.0, pooled[best] / len(found[0])))

    def runs(self, found: tuple[bytes, list] | None) -> list[dict]:
        """start, end (in code points) and lang of runs of characters with one label."""
        if not found:
            return []
        data = np.frombuffer(found[0] + b" ", np.uint8)
        last = (data[1:] & 0xC0) != 0x80  # where a character ends
        labels = np.concatenate([best for _, best in found[1]])[last]
        edges = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
        return [{"start": a, "end": b, "lang": self.languages[labels[a]]} for a, b in zip(edges, edges[1:], strict=False)]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        return [self.total(x) for x in self.work_out(texts)]


def sampled_segments(docs: DataFrame) -> list[tuple[str, bytes, int]]:
    """(lang, segment, count) from about TRAIN_DOCS documents of each language, chosen by a hash of the id."""
    learnt = picked(docs, doc_id="doc_id", text="text", lang="lang").where(
        (crc32_fold("doc_id", 4) != 2) & F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    scale = 1 << 30
    share = learnt.groupBy("lang").agg((F.lit(float(scale * TRAIN_DOCS)) / F.count(F.lit(1))).alias("below"))
    some = learnt.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(scale)) < F.col("below"))
    schema = T.StructType().add("lang", "string").add("segments", T.ArrayType(T.BinaryType()))
    parts = map_slices(some.select("lang", "text"), lambda rows: [rows["lang"], [segments(t) for t in rows["text"]]], schema)
    counted = parts.select("lang", F.explode("segments").alias("segment")).groupBy("lang", "segment").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("segment"), "segment"))
    top = counted.withColumn("_rank", rank).where(F.col("_rank") <= TRAIN_SEGMENTS).orderBy("lang", "_rank")
    return [(r.lang, bytes(r.segment), r.n) for r in top.collect()]  # bounded: TRAIN_SEGMENTS for each language


def fit(docs: DataFrame) -> tuple[dict[str, np.ndarray], list[str]]:
    """Network and languages learnt from rows whose crc32 fold isn't 2."""
    words = sampled_segments(docs)
    languages = sorted({lang for lang, _, _ in words})
    rows = [(w, languages.index(lang), n) for lang, w, n in words]
    return (train(rows, len(languages)) if rows else {}), languages


POSITIONS = T.ArrayType(T.StructType().add("start", "long").add("end", "long").add("lang", "string"))


def predict(df: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, positions of every row; ``und``, 0 and none for a null text or one without a letter.

    ``positions``: start, end (in code points) and lang of runs of characters with the same label.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType().add("doc_id", df.schema[id_col].dataType).add("lang_pred", "string").add("score", "double").add("positions", POSITIONS)

    def run(rows: dict[str, list]) -> list[list]:
        reader = identifier(shared.value)
        outcomes = reader.work_out(rows["text"])
        found = [reader.total(x) for x in outcomes]
        return [rows["doc_id"], [x for x, _ in found], [s for _, s in found], [reader.runs(x) for x in outcomes]]

    return map_slices(picked(df, doc_id=id_col, text=text_col), run, schema)


_latest: list = []
forgets.append(_latest.clear)


def identifier(model: tuple) -> Identifier:
    """This worker's identifier for a model; what it has learnt stays between slices."""
    if not _latest or _latest[0] is not model:
        _latest[:] = [model, Identifier(*model)]
    return _latest[1]


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, positions of every document."""
    return predict(docs, fit(docs)).select(
        "doc_id", F.coalesce(crc32_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "positions"
    )


def accept(docs: DataFrame) -> DataFrame:
    """The documents whose language is determined, whatever its score, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def keep(texts: list[str | None]) -> list[bool]:
        return [lang != UNDETERMINED for lang, _ in identifier(shared.value).predict(texts)]

    return filter_texts(docs, keep)
