"""Language identification by a small convolutional network over bytes.

Bytes are embedded, filters of several widths run over them, the strongest answer of each
filter in a window of fixed length is kept, and a softmax layer names the language. The
network is trained in numpy on the driver, from a bounded sample of labelled texts; it is
applied to all windows of a text in batches, and the text gets their mean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import LOWER, aside, blocks, fields, hand_back, map_arrow, read, text_bytes

#: Bytes of a window.
WINDOW = 128
#: Labelled texts of each language the network learns from at most, and windows of each text.
TEXTS_PER_LANGUAGE = 500
WINDOWS_PER_TEXT = 3
WIDTHS = (2, 3, 5)
FILTERS = 16
EMBEDDING = 6
EPOCHS = 10
#: What the network calls text in no language, where it learns that too, and the mean probability of
#: it from which on a text is rejected.
NOISE = "\0noise"
NOISE_SCORE = 0.95
#: What a text without any letter, or a null, is said to be.
UNDETERMINED = "und"
_BATCH = 64
#: Windows that are worked on at once.
_WINDOWS = 4096


class Network:
    """Embedding, filters with max pooling, and a softmax layer."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.weights = {"embedding": rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)}
        self.weights["embedding"][0] = 0
        for w in WIDTHS:
            self.weights[f"filter{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype(np.float32)
            self.weights[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.weights["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.weights["out_bias"] = np.zeros(len(languages), np.float32)

    def _pooled(self, windows: np.ndarray, places: bool = False):
        """The strongest answer of every filter, and where it was found."""
        held = self.weights["embedding"][windows]
        n, found, at = windows.shape[1], [], []
        for w in WIDTHS:
            columns = np.concatenate([held[:, j : n - w + 1 + j] for j in range(w)], axis=2)
            answers = columns.reshape(-1, w * EMBEDDING) @ self.weights[f"filter{w}"]
            answers = answers.reshape(len(windows), n - w + 1, FILTERS)
            if places:
                at.append(answers.argmax(axis=1))
            found.append(answers.max(axis=1) + self.weights[f"bias{w}"])
        return np.maximum(np.concatenate(found, axis=1), 0), at

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        x = pooled @ self.weights["out"] + self.weights["out_bias"]
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    def predict(self, windows: np.ndarray) -> np.ndarray:
        """A probability of each language for each window."""
        parts = [self._softmax(self._pooled(windows[i : i + 512])[0]) for i in range(0, len(windows), 512)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def _gradients(self, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        pooled, at = self._pooled(windows, places=True)
        error = self._softmax(pooled)
        error[np.arange(len(labels)), labels] -= 1
        error *= (weight / weight.sum())[:, None]
        grown = {"out": pooled.T @ error, "out_bias": error.sum(axis=0), "embedding": np.zeros_like(self.weights["embedding"])}
        back = (error @ self.weights["out"].T) * (pooled > 0)
        rows = np.arange(len(windows))[:, None, None]
        for i, w in enumerate(WIDTHS):
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            seen = windows[rows, at[i][:, :, None] + np.arange(w)]
            columns = self.weights["embedding"][seen].reshape(len(windows), FILTERS, -1)
            grown[f"filter{w}"] = np.einsum("bf,bfk->kf", own, columns)
            grown[f"bias{w}"] = own.sum(axis=0)
            spread = own[:, :, None] * self.weights[f"filter{w}"].T[None]
            np.add.at(grown["embedding"], seen.reshape(-1), spread.reshape(-1, EMBEDDING))
        grown["embedding"][0] = 0
        return grown

    def fit(self, windows: np.ndarray, labels: np.ndarray, seed: int = 7) -> Network:
        """Adam on batches of random cuts of the windows; every language weighs the same."""
        rng = np.random.default_rng(seed)
        weight = 1.0 / np.maximum(np.bincount(labels, minlength=len(self.languages)), 1)[labels]
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, steps = 0, EPOCHS * -(-len(windows) // _BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), _BATCH):
                own = order[lo : lo + _BATCH]
                batch = windows[own].copy()
                size = rng.integers(12, 2 * WINDOW, len(own))  # short texts are to be known too
                batch[np.arange(WINDOW)[None] >= size[:, None]] = 0
                step += 1
                rate = 0.01 * (1 - 0.9 * step / steps)
                for k, g in self._gradients(batch, labels[own], weight[own].astype(np.float32)).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.01 * (g * g - square[k])
                    self.weights[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def window_ends(offsets: np.ndarray) -> np.ndarray:
    """How many windows each text of a block and all before it have."""
    return np.cumsum(-(-np.diff(offsets) // WINDOW))


def windows_of(data: np.ndarray, offsets: np.ndarray, lo: int = 0, hi: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Windows lo to hi (all) of a block of texts, zeros behind a short text, and the text of each.

    A text is cut from its start; its last window ends with the text.
    """
    sizes, ends = np.diff(offsets), window_ends(offsets)
    number = np.arange(lo, ends[-1] if hi is None and len(ends) else hi or 0)
    if not len(number):
        return np.zeros((0, WINDOW), np.uint8), number
    text = np.searchsorted(ends, number, "right")
    number -= np.where(text > 0, ends[text - 1], 0)
    start = np.minimum(number * WINDOW, np.maximum(sizes[text] - WINDOW, 0))
    at = (offsets[:-1][text] + start)[:, None] + np.arange(WINDOW)
    inside = start[:, None] + np.arange(WINDOW) < sizes[text][:, None]
    return np.where(inside, LOWER[data[np.minimum(at, len(data) - 1)]], 0).astype(np.uint8), text


def _labelled_sample(docs: DataFrame, learn: Column) -> DataFrame:
    """Up to TEXTS_PER_LANGUAGE texts of each language, those of the lowest hash."""
    known = docs.where(learn & F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return known.select("lang", "text").limit(0)
    # a first cut by hash leaves about twice what is needed, so the ranking stays small
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (2 * TEXTS_PER_LANGUAGE + 50) / n))])
    rank = F.xxhash64(F.lit("fit"), F.col("doc_id"), "text")
    cut = known.where((F.pmod(rank, F.lit(1_000_000)) / 1e6) < share[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("_rank", "text")
    first = cut.withColumn("_rank", rank).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= TEXTS_PER_LANGUAGE)
    parts = [F.substring("text", F.pmod(F.xxhash64(F.lit(i), "_rank"), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))).cast("int") + 1, F.lit(WINDOW)) for i in range(WINDOWS_PER_TEXT)]
    return first.select("lang", "_n", F.array(*parts).alias("parts"))


def noise_of(windows: np.ndarray, seed: int = 11) -> np.ndarray:
    """As many windows of noise: in turn the same characters in random order, and random ASCII.

    Order is drawn over whole characters, so the bytes of one stay together.
    """
    rng = np.random.default_rng(seed)
    out = np.zeros_like(windows)
    for i, window in enumerate(windows):
        size = int((window > 0).sum())
        if i % 2:
            own = LOWER[rng.integers(33, 127, size).astype(np.uint8)]
        else:
            starts = np.flatnonzero(window[:size] & 0xC0 != 0x80)
            parts = np.split(window[:size], starts[starts > 0])
            own = np.concatenate([parts[j] for j in rng.permutation(len(parts))]) if parts else window[:size]
        out[i, :size] = own
    return out


def train(docs: DataFrame, learn: Column, noise: bool = False) -> Network | None:
    """A network from labelled documents where ``learn`` holds; None if there are none.

    With ``noise`` it has one more class, ``NOISE``, learned from the same windows out of order
    and from random characters.
    """
    rows = _labelled_sample(docs, learn).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["_n"]))
    languages = sorted({r["lang"] for r in rows})
    texts = [(languages.index(r["lang"]), part.encode()[:WINDOW]) for r in rows for part in r["parts"] if part]
    windows = np.zeros((len(texts), WINDOW), np.uint8)
    for i, (_, part) in enumerate(texts):
        windows[i, : len(part)] = LOWER[np.frombuffer(part, np.uint8)]
    labels = np.array([label for label, _ in texts])
    if noise:
        windows = np.concatenate([windows, noise_of(windows)])
        labels = np.concatenate([labels, np.full(len(labels), len(languages))])
        languages = [*languages, NOISE]
    return Network(languages).fit(windows, labels)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole text alone.

    ``score`` is the mean probability over the windows, 0 for ``und``: a null, an empty text or
    one without letters, and every text if there was nothing to learn from. Columns of these
    names are replaced; repeated rows are judged alike.
    """
    docs = docs.drop("lang_pred", "score")
    held = docs.sparkSession.sparkContext.broadcast(network)
    ascii_letters = np.zeros(256, bool)
    ascii_letters[65:91] = ascii_letters[97:123] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from predicted(held.value, batches)
        finally:
            hand_back()

    def predicted(network_: Network | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            names, scores = [], []
            for lo, hi in blocks(offsets):
                own = offsets[lo : hi + 1]
                letters = np.concatenate(([0], np.cumsum(ascii_letters[data[own[0] : own[-1]]])))[own - own[0]]
                for i in range(lo, hi):
                    full = letters[i + 1 - lo] > letters[i - lo]
                    full = full or any(x.isalpha() for x in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
                    names.append("" if full and network_ is not None else UNDETERMINED)
                    scores.append(0.0)
                if network_ is None:
                    continue
                total = np.zeros((hi - lo, len(network_.languages)))
                count = np.zeros(hi - lo)
                # a very long text is worked on in parts
                ends = window_ends(own)
                for a in range(0, int(ends[-1]), _WINDOWS):
                    windows, text = windows_of(data, own, a, min(a + _WINDOWS, int(ends[-1])))
                    np.add.at(total, text, network_.predict(windows))
                    count += np.bincount(text, minlength=hi - lo)
                mean = total / np.maximum(count, 1)[:, None]
                best = mean.argmax(axis=1)
                for i in range(hi - lo):
                    if not names[lo + i]:
                        names[lo + i], scores[lo + i] = network_.languages[best[i]], min(1.0, float(mean[i, best[i]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return map_arrow(docs, run, ", ".join([*fields(docs), "lang_pred string, score double"]))


def held_out(remainder: int, modulus: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def identified(docs: DataFrame, noise_score: float = NOISE_SCORE) -> DataFrame:
    """The documents in some language, with their own columns. A text goes that is ``und``, or
    whose windows are noise to the network with a mean probability of ``noise_score`` or more; a
    text of several languages, or one that is partly noise, stays.

    The network learns from the labelled documents that ``op7`` learns from and from noise made of
    them; without any, every text with a letter stays. Repeated rows are judged alike; an empty
    table stays empty, and columns named as those of ``predict`` are kept as they are.
    """
    network = train(docs, ~held_out(2, 4), noise=True)
    if network is None:
        return docs.where(F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)))
    rows, own_columns = aside(docs, "lang_pred", "score")
    noise = (F.col("lang_pred") == NOISE) & (F.col("score") >= noise_score)
    return own_columns(predict(rows, network).where((F.col("lang_pred") != UNDETERMINED) & ~noise))


def op7_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = train(docs, ~held_out(2, 4))
    return predict(docs.select("doc_id", held_out(2, 4).alias("held_out"), "text"), network).drop("text")
