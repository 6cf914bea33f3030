"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. A passage is encoded from
its characters and words: shares of character classes, word lengths, repetition,
and a random projection of its bag of words. A learned layer turns this into a
passage representation; gated attention weighs the passages of a document; the
weighted sum is scored. Only documents have labels: attention learns by itself
which passages decide.

The model is fitted with gradient descent in numpy on a bounded sample: at most
``SAMPLE`` labelled documents, those with the least hash of their id, each with
at most ``SAMPLE_PASSAGES`` passages (a longer document is left out of the
sample, never cut). It has a few thousand weights, which the scoring tasks get
with their code. Every document is scored over all of its passages.

Defined results: a null or empty text is a bag of one empty passage and gets a
score like any other; labels other than 0 and 1 are left out; several labels of
one document count by their mean, rounded; with labels of one kind only, or
none, every score is the share of label 1, or one half. An id with several texts
is learned from the least of them; repeated rows get equal scores. An empty table
has no scores; a text of any length is scored over all its passages, which one
task holds; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm import shingles
from orderlens.llm.arrow import by_rows
from orderlens.llm.common import text_or_empty

PASSAGE = 64
SAMPLE = 3000
SAMPLE_PASSAGES = 256
FOLDS = 5
THRESHOLD = 0.3

PROJECTED = 48
HIDDEN = 24
ATTENTION = 12
EPOCHS = 40
BAGS = 128
RATE = 0.01
DECAY = 1e-4

# Classes of bytes: blank, lower case, upper case, digit, sentence mark,
# symbol, line break, part of a character beyond ASCII.
CLASSES = 8
_CLASS = np.array(
    [
        7 if b >= 0x80
        else 6 if b == 0x0A
        else 0 if b <= 0x20
        else 1 if 0x61 <= b <= 0x7A
        else 2 if 0x41 <= b <= 0x5A
        else 3 if 0x30 <= b <= 0x39
        else 4 if chr(b) in ".,;:'\"?()-"
        else 5
        for b in range(256)
    ],
    np.int64,
)
FEATURES = CLASSES + 6 + PROJECTED


def passages(text: str | None) -> np.ndarray:
    """The features of every passage, one row each."""
    hashes, lengths, stops = shingles.word_spans(text or "")
    if not len(hashes):
        return np.zeros((1, FEATURES), np.float32)
    raw = np.frombuffer((text or "").encode(), np.uint8)
    firsts = np.arange(0, len(hashes), PASSAGE)
    count = np.diff(np.append(firsts, len(hashes))).astype(np.float64)
    n = len(firsts)
    # A passage reaches from the end of the one before to its own last word.
    borders = np.append(stops[firsts[1:] - 1], len(raw)) if n > 1 else np.array([len(raw)])
    owner = np.repeat(np.arange(n), np.diff(np.append(0, borders)))
    classes = np.bincount(owner * CLASSES + _CLASS[raw], minlength=n * CLASSES)
    classes = classes.reshape(n, CLASSES) / np.maximum(1, np.diff(np.append(0, borders)))[:, None]

    def mean(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.float64), firsts) / count

    place = np.arange(len(hashes)) // PASSAGE
    pairs = np.unique(shingles.mixed(hashes + place.astype(np.uint64)))
    distinct = len(pairs) / len(hashes)
    same = np.zeros(len(hashes))
    same[1:] = hashes[1:] == hashes[:-1]
    size = mean(lengths)
    spread = np.sqrt(np.maximum(0, mean(lengths.astype(np.float64) ** 2) - size**2))
    whole = len(np.unique(hashes)) / len(hashes)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8)[:, : PROJECTED // 8], axis=1)
    projected = np.add.reduceat(bits, firsts, axis=0, dtype=np.int32) / count[:, None] - 0.5
    return np.column_stack(
        [
            classes,
            size / 8,
            spread / 4,
            mean(same),
            np.full(n, distinct),
            np.full(n, whole),
            np.log1p(count) / 4,
            projected,
        ]
    ).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights of the encoder layer, the gated attention and the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def _forward(self, x: np.ndarray, firsts: np.ndarray, bag: np.ndarray) -> dict:
        w = self.weights
        hidden = np.tanh(x @ w["W"] + w["b"])
        said, gate = np.tanh(hidden @ w["V"]), _sigmoid(hidden @ w["U"])
        energy = (said * gate) @ w["a"]
        energy = np.exp(energy - np.maximum.reduceat(energy, firsts)[bag])
        attention = energy / np.add.reduceat(energy, firsts)[bag]
        pooled = np.add.reduceat(attention[:, None] * hidden, firsts, axis=0)
        score = _sigmoid(pooled @ w["c"] + w["d"][0])
        return {
            "hidden": hidden, "said": said, "gate": gate,
            "attention": attention, "pooled": pooled, "score": score,
        }

    def score(self, features: np.ndarray) -> tuple[float, np.ndarray]:
        """The score of one bag and the attention of its passages."""
        if self.constant is not None:
            return self.constant, np.full(len(features), 1 / len(features))
        x = (features - self.mean) / self.scale
        out = self._forward(x, np.array([0]), np.zeros(len(x), np.int64))
        return float(out["score"][0]), out["attention"]

    def _gradients(self, x, firsts, bag, label) -> dict:
        w = self.weights
        f = self._forward(x, firsts, bag)
        hidden, said, gate, attention = f["hidden"], f["said"], f["gate"], f["attention"]
        error = (f["score"] - label) / len(label)
        to_pooled = (error[:, None] * w["c"])[bag]
        through = (hidden * to_pooled).sum(axis=1)
        to_energy = attention * (
            through - np.add.reduceat(attention * through, firsts)[bag]
        )
        to_product = to_energy[:, None] * w["a"]
        to_said = to_product * gate * (1 - said**2)
        to_gate = to_product * said * gate * (1 - gate)
        to_hidden = attention[:, None] * to_pooled + to_said @ w["V"].T + to_gate @ w["U"].T
        to_input = to_hidden * (1 - hidden**2)
        return {
            "W": x.T @ to_input,
            "b": to_input.sum(axis=0),
            "V": hidden.T @ to_said,
            "U": hidden.T @ to_gate,
            "a": (said * gate).T @ to_energy,
            "c": f["pooled"].T @ error,
            "d": np.array([error.sum()]),
        }


def fit(bags: list[np.ndarray], labels: list[int], seed: int = 7) -> Model:
    """Fit a model to bags of passages and their labels; the same input gives the same model."""
    nothing = np.zeros(FEATURES)
    if len(set(labels)) < 2:
        share = float(np.mean(labels)) if labels else 0.5
        return Model(nothing, nothing + 1, {}, share)
    rng = np.random.default_rng(seed)
    everything = np.concatenate(bags).astype(np.float64)
    mean, scale = everything.mean(axis=0), everything.std(axis=0) + 1e-3
    sizes = {"W": (FEATURES, HIDDEN), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION)}
    weights = {k: rng.normal(0, s[0] ** -0.5, s) for k, s in sizes.items()}
    weights |= {
        "b": np.zeros(HIDDEN),
        "a": rng.normal(0, ATTENTION**-0.5, ATTENTION),
        "c": rng.normal(0, HIDDEN**-0.5, HIDDEN),
        "d": np.zeros(1),
    }
    model = Model(mean, scale, weights)
    scaled = [(b - mean) / scale for b in bags]
    target = np.array(labels, np.float64)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BAGS):
            chosen = order[at : at + BAGS]
            lengths = np.array([len(scaled[k]) for k in chosen])
            firsts = np.cumsum(lengths) - lengths
            bag = np.repeat(np.arange(len(chosen)), lengths)
            x = np.concatenate([scaled[k] for k in chosen])
            step += 1
            for k, g in model._gradients(x, firsts, bag, target[chosen]).items():
                g = g + DECAY * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def held_out(key: Column) -> Column:
    """Whether labels of this document must not be learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """Fit a model to at most ``sample`` labelled documents outside the held-out fold."""
    named = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"))
    usable = named.filter(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    chosen = (
        usable.groupBy("id")
        .agg(F.round(F.avg("label")).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    rows = docs.select(F.col(f"`{key}`").alias("id"), text_or_empty(text).alias("text"))
    # The sample is bounded, so it is sent to the scan of the documents. An id may
    # have any number of rows; one text stands for it.
    found = (
        rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    )

    def make():
        def work(found: Iterator[dict]) -> Iterator[dict]:
            for row in found:
                features = passages(row["text"])
                if len(features) <= SAMPLE_PASSAGES:
                    yield {
                        "id": str(row["id"]),
                        "label": row["label"],
                        "passages": features.tobytes(),
                    }

        return work

    schema = "id string, label int, passages binary"
    collected = by_rows(found.select("id", "text", "label"), make, schema).toPandas()
    collected = collected.sort_values("id")
    bags = [np.frombuffer(p, np.float32).reshape(-1, FEATURES) for p in collected["passages"]]
    return fit(bags, [int(x) for x in collected["label"]])


def score(
    docs: DataFrame,
    model: Model,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Key, whether held out, score, prediction and the passage with most attention."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def work(rows: Iterator[dict]) -> Iterator[dict]:
            for row in rows:
                value, attention = model.score(passages(row[text]))
                yield {
                    key: row[key],
                    "score": value,
                    "predicted": int(value >= threshold),
                    "n_passages": len(attention),
                    "top_passage": int(np.argmax(attention)),
                }

        return work

    schema = f"`{key}` {kind}, score double, predicted int, n_passages int, top_passage int"
    scored = by_rows(docs.select(key, text), make, schema)
    return scored.withColumn("held_out", held_out(F.col(f"`{key}`")))
