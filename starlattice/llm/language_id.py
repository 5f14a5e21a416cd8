"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows that one language gives to training and calibration, in expectation.
SAMPLE_ROWS = 1000
BUCKETS = 1 << 15
WIDTH = 16
ORDERS = (2, 3, 4)
UNKNOWN = "und"
# Right predictions on calibration texts that may fall below the least score, and below the least share of known subwords.
LOST = 0.001
# One in this many sampled rows calibrates and does not train.
_CALIBRATION = 5
# Texts are turned into subwords this many bytes at a time.
_CHUNK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")

_KEPT = np.full(256, 0x20, np.uint8)
_KEPT[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEPT[0x80:] = np.arange(0x80, 0x100)


def subwords(text: str) -> list[np.ndarray]:
    """Buckets of the byte n-grams inside words and at their edges, for each order; the whole text."""
    data = _KEPT[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    found = []
    for order in ORDERS:
        count = len(data) - order + 1
        if count <= 0:
            continue
        hashed = np.full(count, order, np.uint32)
        for i in range(order):
            hashed *= np.uint32(0x01000193)
            hashed ^= data[i : i + count]
        hashed *= np.uint32(0x9E3779B1)
        space = data == 0x20
        inside = np.ones(count, bool)
        for i in range(1, order - 1):
            inside &= ~space[i : i + count]
        if order == 2:
            inside &= ~(space[:count] & space[1:])
        found.append((hashed[inside] >> np.uint32(32 - int(BUCKETS).bit_length() + 1)).astype(np.int64))
    return found


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(-1, keepdims=True))
    return p / p.sum(-1, keepdims=True)


@dataclass(frozen=True)
class Model:
    """Language scores of each bucket (the embeddings times the softmax weights), calibrated."""

    languages: tuple[str, ...]
    scores: np.ndarray  # buckets x (languages, whether training saw the bucket)
    temperature: float
    threshold: float  # lower calibrated scores are rejected
    least_seen: float  # so are texts with a lower share of subwords that training saw

    def evidence(self, text: str) -> np.ndarray:
        """Mean language scores of the text's subwords, and the share of them that training saw."""
        total, count = np.zeros(len(self.languages) + 1), 0
        for start in range(0, max(1, len(text)), _CHUNK):
            for found in subwords(text[start : start + _CHUNK]):
                total += np.bincount(found, minlength=BUCKETS)[:BUCKETS] @ self.scores if len(found) > 4096 else self.scores[found].sum(0)
                count += len(found)
        return total / max(count, 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score from 0 to 1, and whether the score is too low to be relied on."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        found = self.evidence(text)
        p = _softmax(found[:-1] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold or found[-1] < self.least_seen)


def learnable() -> Column:
    """Rows outside the held-out quarter of ids; a null id is not learned from."""
    return F.coalesce(~held_out(), F.lit(False))


def held_out() -> Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> pd.DataFrame:
    """About `rows` learnable labelled texts of each language, by a hash of the id: lang, text, calibrates."""
    labelled = docs.select("doc_id", "text", "lang").where(learnable() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return pd.DataFrame({"lang": [], "text": [], "calibrates": []})
    # The share of each language's hash range that holds about `rows` rows.
    bound = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(rows / n)) for lang, n in sorted(counts.items())])
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    calibrates = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(_CALIBRATION)) == 0
    chosen = labelled.where(place < bound).select("doc_id", "lang", "text", calibrates.alias("calibrates"))
    return chosen.toPandas().sort_values(["doc_id", "text"], ignore_index=True)


def _pieces(texts: list[str], rng: np.random.Generator) -> list[str]:
    """A random stretch of 20 to 300 characters of each text, so that short texts are learned too."""
    cut = []
    for text in texts:
        length = int(rng.integers(20, 300))
        start = int(rng.integers(0, max(1, len(text) - length)))
        cut.append(text[start : start + length])
    return cut


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    bags = []
    for text in texts:
        found = subwords(text)
        ids, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        bags.append((ids.astype(np.uint16), (counts / max(1, counts.sum())).astype(np.float32)))
    return bags


def train(rows: pd.DataFrame, *, epochs: int = 4, batch: int = 64, rate: float = 0.5, seed: int = 0) -> Model:
    """Fits embeddings and softmax by stochastic gradient descent, then temperature and rejection threshold.

    At most one in a thousand (`LOST`) right predictions on calibration texts falls below
    the threshold, and as many below the least share of known subwords; both are these
    quantiles as they come. Texts without letters, which are rejected anyway, do not
    calibrate. Without labelled rows the model knows no language.
    """
    languages = tuple(sorted(rows["lang"].unique()))
    if not languages:
        return Model((), np.zeros((BUCKETS, 1), np.float32), 1.0, 0.0, 0.0)
    rng = np.random.default_rng(seed)
    target = rows["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy()
    calibrates = rows["calibrates"].to_numpy(bool) & (len(rows) > 4 * len(languages))
    texts = rows["text"].tolist()

    def examples(chosen: np.ndarray) -> tuple[list[str], np.ndarray]:
        own = [texts[i] for i in np.flatnonzero(chosen)]
        return own + _pieces(own, rng), np.concatenate([target[chosen], target[chosen]])

    learned, wanted = examples(~calibrates)
    bags = _bags(learned)
    embedding = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = np.zeros((WIDTH, len(languages)), np.float32)
    steps, step = epochs * -(-len(bags) // batch), 0
    counts = np.zeros((batch, BUCKETS), np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), batch):
            picked = order[start : start + batch]
            counts[:] = 0
            for row, i in enumerate(picked):
                counts[row, bags[i][0]] = bags[i][1]
            used = counts[: len(picked)]
            hidden = used @ embedding
            p = _softmax(hidden @ softmax)
            p[np.arange(len(picked)), wanted[picked]] -= 1
            now = rate * (1 - step / steps)
            back = p @ softmax.T
            softmax -= now * (hidden.T @ p)
            embedding -= now * (used.T @ back)
            step += 1
    # Buckets that no example used say nothing about a language.
    seen = np.zeros(BUCKETS, bool)
    for ids, _ in bags:
        seen[ids] = True
    scores = np.column_stack([np.where(seen[:, None], embedding @ softmax, 0), seen]).astype(np.float32)

    held, right = examples(calibrates if calibrates.any() else ~calibrates)
    lettered = np.array([has_letter(text) for text in held], bool)
    raw = Model(languages, scores, 1.0, 0.0, 0.0)
    if not lettered.any():
        return raw
    # The sums of `predict` itself, so that equal texts do not fall below by rounding.
    found, right = np.array([raw.evidence(held[i]) for i in np.flatnonzero(lettered)]), right[lettered]
    best = (np.inf, 1.0)
    for temperature in np.geomspace(0.05, 20, 60).tolist():
        own = _softmax(found[:, :-1] / temperature)[np.arange(len(right)), right]
        best = min(best, (float(-np.log(np.maximum(own, 1e-30)).mean()), temperature))
    p = _softmax(found[:, :-1] / best[1])
    good = p.argmax(1) == right
    low = lambda values: float(np.quantile(values, LOST, method="lower")) if len(values) else 0.0
    return Model(languages, scores, best[1], low(p.max(1)[good]), low(found[good, -1]))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Adds `language` (lang_pred, score, rejected) to every row, from its whole text alone.

    Null texts and texts without letters are `und` with score 0, rejected; so is
    everything if the model knows no language. Repeated rows get equal results; a
    column named language is replaced; other columns stay. No rows: no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [held.value.predict(text) for text in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    return docs.withColumn("language", language("text"))
