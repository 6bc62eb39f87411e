"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads windows of bytes in both directions and labels every position; a document's probabilities are the
mean over all its positions. It is fitted by backpropagation through time on a bounded sample of labelled documents and
then labels whole texts in Arrow batches, many windows side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.llm.common import BATCH_BYTES, map_batches

UNKNOWN = "und"
PREDICTIONS = "doc_id long, held_out boolean, lang_pred string, score double"
LANES = 8192


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class ByteTagger:
    """Two gated recurrent layers, one in each direction, and a linear layer on both.

    Each byte has its row of gate inputs, so the input layer is a table; ``hidden`` units a direction.
    """

    def __init__(self, languages: list[str], hidden: int = 8, window: int = 64, seed: int = 7):
        self.languages, self.hidden, self.window = languages, hidden, window
        rng = np.random.default_rng(seed)
        self.weights: dict[str, np.ndarray] = {"bias": np.zeros(len(languages), np.float32)}
        for d in ("f", "b"):
            self.weights[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.weights[f"h{d}"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
            self.weights[f"o{d}"] = rng.normal(0, hidden**-0.5, (hidden, len(languages))).astype(np.float32)

    # Training

    def forward(self, d: str, data: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each step of ``data`` (steps, rows), and what the way back needs."""
        k, wx, wh = self.hidden, self.weights[f"x{d}"], self.weights[f"h{d}"]
        h = np.zeros((data.shape[1], k), np.float32)
        states, kept = np.empty((*data.shape, k), np.float32), []
        for t, byte in enumerate(data):
            x, u = wx[byte], h @ wh
            gates = sigmoid(x[:, : 2 * k] + u[:, : 2 * k])
            z, r, un = gates[:, :k], gates[:, k:], u[:, 2 * k :]
            n = np.tanh(x[:, 2 * k :] + r * un)
            kept.append((h, z, r, n, un))
            h = n + z * (h - n)
            states[t] = h
        return states, kept

    def backward(self, d: str, data: np.ndarray, kept: list, dstates: np.ndarray, grads: dict) -> None:
        k, wh = self.hidden, self.weights[f"h{d}"]
        dh, inputs = np.zeros_like(kept[0][0]), np.empty((*data.shape, 3 * k), np.float32)
        grads[f"h{d}"] = np.zeros_like(wh)
        for t in range(len(data) - 1, -1, -1):
            h, z, r, n, un = kept[t]
            dh = dh + dstates[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz, dr = dh * (h - n) * z * (1 - z), dn * un * r * (1 - r)
            inputs[t] = np.concatenate((dz, dr, dn), axis=1)
            du = np.concatenate((dz, dr, dn * r), axis=1)
            grads[f"h{d}"] += h.T @ du
            dh = dh * z + du @ wh.T
        grads[f"x{d}"] = np.zeros_like(self.weights[f"x{d}"])
        np.add.at(grads[f"x{d}"], data.ravel(), inputs.reshape(-1, 3 * k))

    def gradients(self, data: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the positions in ``mask`` and its gradients, by backpropagation through time."""
        w = self.weights
        ahead, kept_f = self.forward("f", data)
        back, kept_b = self.forward("b", data[::-1])
        back = back[::-1]
        logits = ahead @ w["of"] + back @ w["ob"] + w["bias"]
        p = np.exp(logits - logits.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        total = mask.sum()
        chosen = np.take_along_axis(p, np.broadcast_to(labels[None, :, None], (*data.shape, 1)), -1)[..., 0]
        loss = float(-(np.log(chosen + 1e-12) * mask).sum() / total)
        dlogits = p
        dlogits[:, np.arange(len(labels)), labels] -= 1
        dlogits *= (mask / total)[..., None]
        flat = dlogits.reshape(-1, len(self.languages))
        grads = {"bias": flat.sum(0)}
        for d, states in (("f", ahead), ("b", back)):
            grads[f"o{d}"] = states.reshape(-1, self.hidden).T @ flat
        self.backward("f", data, kept_f, dlogits @ w["of"].T, grads)
        self.backward("b", data[::-1], kept_b, (dlogits @ w["ob"].T)[::-1], grads)
        return loss, grads

    def fit(self, windows: list[bytes], labels: list[str], steps: int = 240, rows: int = 192, rate: float = 0.02) -> ByteTagger:
        rng = np.random.default_rng(11)
        data, mask = self.lanes(windows)
        label = np.array([self.languages.index(x) for x in labels])
        of = [np.flatnonzero(label == k) for k in range(len(self.languages))]
        of = [x for x in of if x.size]
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            take = np.concatenate([rng.choice(x, -(-rows // len(of))) for x in of])  # languages weigh alike
            _, grads = self.gradients(data[:, take], label[take], mask[:, take])
            speed = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                fair = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - speed * fair).astype(np.float32)
        return self

    # Labelling

    def lanes(self, windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Windows as columns of bytes, filled up with zeros, and which positions are real."""
        data = np.frombuffer(b"".join(w.ljust(self.window, b"\0") for w in windows), np.uint8)
        size = np.array([len(w) for w in windows])
        return data.reshape(-1, self.window).T, (np.arange(self.window)[:, None] < size).astype(np.float32)

    def states(self, d: str, data: np.ndarray) -> Iterable[np.ndarray]:
        """As ``forward``, one step after another, each gate in arrays of its own and without what training keeps."""
        k = self.hidden
        half = np.array([0.5, 0.5, 1.0], np.float32)  # for sigmoids by tanh
        wx = [np.ascontiguousarray(self.weights[f"x{d}"][:, g * k : (g + 1) * k] * half[g]) for g in range(3)]
        wh = [np.ascontiguousarray(self.weights[f"h{d}"][:, g * k : (g + 1) * k] * half[g]) for g in range(3)]
        h = np.zeros((data.shape[1], k), np.float32)
        for byte in data:
            z, r, n = (np.take(x, byte, axis=0) for x in wx)
            z += h @ wh[0]
            r += h @ wh[1]
            np.tanh(z, out=z)
            np.tanh(r, out=r)
            u = h @ wh[2]
            r += 1
            r *= 0.5
            u *= r
            n += u
            np.tanh(n, out=n)
            z += 1
            z *= 0.5
            h = h - n
            h *= z
            h += n
            yield h

    def window_scores(self, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Summed probabilities of the positions of each window (rows, languages)."""
        w, steps = self.weights, len(data)
        back = np.empty((*data.shape, len(self.languages)), np.float32)
        for t, h in enumerate(self.states("b", data[::-1])):
            np.matmul(h, w["ob"], out=back[steps - 1 - t])
        total = np.zeros((data.shape[1], len(self.languages)), np.float32)
        for t, h in enumerate(self.states("f", data)):
            p = h @ w["of"]
            p += back[t]
            p += w["bias"]
            np.exp(p, out=p)  # both layers are bounded by their weights
            p *= (mask[t] / p.sum(1))[:, None]
            total += p
        return total

    def score(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities of each text's positions (texts, languages); windows of many texts run side by side."""
        out = np.zeros((len(texts), len(self.languages)))
        size = np.zeros(len(texts))
        owner, windows = [], []

        def flush() -> None:
            if windows:
                np.add.at(out, owner, self.window_scores(*self.lanes(windows)))
                owner.clear()
                windows.clear()

        for i, text in enumerate(texts):
            data = text.encode()
            size[i] = len(data)
            for at in range(0, len(data), self.window):
                owner.append(i)
                windows.append(data[at : at + self.window])
                if len(windows) == LANES:
                    flush()
        flush()
        return out / np.maximum(size, 1)[:, None]


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def training_windows(docs: DataFrame, per_language: int = 500, windows: int = 6, chars: int = 64) -> list[tuple[str, str]]:
    """(language, passage) of at most about ``per_language`` labelled documents a language, ``windows`` passages each.

    This bounded sample is all that the model is fitted on; which documents and where in them is decided by hashes.
    """
    usable = docs.filter(~held_out() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) / float(1 << 20)
    last = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    starts = [F.pmod(F.xxhash64("doc_id", F.lit(2 + k)), last) + 1 for k in range(windows)]
    taken = usable.filter(draw < share[F.col("lang")]).select(
        "lang", F.explode(F.array(*[F.substr("text", s.cast("int"), F.lit(chars)) for s in starts])).alias("passage")
    )
    most = 2 * windows * per_language * len(counts)
    # An id that many rows share may bring more than that; which passages are taken is still decided by hashes.
    first = taken.orderBy(F.xxhash64("lang", "passage"), "lang", "passage").limit(most)
    return sorted((r["lang"], r["passage"]) for r in first.collect())


def fit_languages(docs: DataFrame, per_language: int = 500, hidden: int = 8, window: int = 64) -> ByteTagger | None:
    """A model from the labelled documents outside the held-out quarter; None if there are none."""
    sample = training_windows(docs, per_language, chars=window)
    if not sample:
        return None
    model = ByteTagger(sorted({lang for lang, _ in sample}), hidden, window)
    return model.fit([passage.encode()[:window] for _, passage in sample], [lang for lang, _ in sample])


def predictions(model: ByteTagger | None, texts: list[str | None], batch_chars: int) -> Iterable[tuple[str, float]]:
    """Language and score of each text, labelled in runs of about ``batch_chars`` characters."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end] or "") <= batch_chars):
            chars += len(texts[end] or "")
            end += 1
        read = [t if model and t and any(map(str.isalpha, t)) else "" for t in texts[at:end]]
        scores = model.score(read) if model else np.zeros((len(read), 1))
        for text, row in zip(read, scores, strict=True):
            best = int(row.argmax())
            yield (model.languages[best], min(1.0, float(row[best]))) if text else (UNKNOWN, 0.0)
        at = end


def identify(docs: DataFrame, model: ByteTagger | None, batch_chars: int = 8_000_000) -> DataFrame:
    """Predict a language for each row of ``docs(doc_id, text)`` from its whole text.

    ``und`` with score 0 where the text is null or has no letter, or nothing could be learned.
    """

    def make() -> Callable[[dict], Iterable[dict]]:
        def step(batch: dict) -> Iterable[dict]:
            found = list(predictions(model, batch.pop("text"), batch_chars))
            yield batch | {"lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

        return step

    return map_batches(docs.select("doc_id", "text", held_out().alias("held_out")), make, PREDICTIONS)


def accepted(docs: DataFrame, model: ByteTagger | None, least: float = 0.3, batch_chars: int = 8_000_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known with a score of at least ``least``.

    Texts in one language score far above it; what has no letters or fits no language goes. Without a model all stay.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def make() -> Callable[[dict], Iterable[dict]]:
        def step(batch: dict) -> Iterable[dict]:
            found = predictions(model, batch["text"], batch_chars)
            keep = [k for k, (lang, score) in enumerate(found) if lang != UNKNOWN and score >= least]
            yield {c: [values[k] for k in keep] for c, values in batch.items()}

        return step

    return map_batches(docs, make, ddl, BATCH_BYTES) if model else docs
