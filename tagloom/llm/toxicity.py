"""Toxicity scores from a bidirectional gated recurrent network with attention, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.arrays import slices, utf8, window_hashes, word_hashes, words_of

TOXIC_ROWS, OTHER_ROWS = 800, 1600
LEARNED_BYTES = 1 << 17  # of one text in the sample
WINDOW, STRIDE = 32, 12
DIM, HIDDEN, ATTEND = 16, 8, 8
WORD_BUCKETS, GRAM_BUCKETS, GRAMS = 1 << 14, 1 << 15, (3, 4, 5)
UPDATES, BATCH, RATE = 450, 64, 8e-3
THRESHOLD = 0.3
#: What op1 and the pipeline score without labels of both kinds: nothing is known to be toxic.
UNKNOWN = 0.0

_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(97, 123), *range(128, 256)]] = False


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Texts:
    """The words of several texts as windows of word numbers, and what each distinct word consists of.

    Words are runs of letters, in lower case.  A distinct word has a bucket
    and, through its character n-grams (with marks at both ends), a bag of
    gram buckets.  Windows of ``WINDOW`` words start every ``STRIDE`` words,
    the last one at the end of its text, so they overlap and cover it all, and
    any ``WINDOW - STRIDE + 1`` words in a row lie whole in one of them; a
    shorter text is one window, padded with word 0, which stands for nothing.
    """

    def __init__(self, column: pa.Array):
        data, offsets = utf8(pc.utf8_lower(column.cast(pa.large_string())))
        starts, ends, before = words_of(data, offsets, _NO_LETTER)
        hashes = word_hashes(data, starts, ends)
        distinct, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        self.buckets = np.concatenate([[0], (distinct % np.uint64(WORD_BUCKETS - 1)).astype(np.int64) + 1])
        lengths = ends[first] - starts[first]
        begins = np.concatenate([[0], np.cumsum(lengths + 2)])
        spelled = np.full(begins[-1], 60, np.uint8)
        spelled[begins[1:] - 1] = 62
        inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        spelled[np.repeat(begins[:-1] + 1, lengths) + inner] = data[np.repeat(starts[first], lengths) + inner]
        byte = word_hashes(spelled, np.arange(len(spelled)), np.arange(len(spelled)) + 1)
        # every place of a spelled word begins one gram of each size that ends in the word
        left = np.repeat(begins[1:], lengths + 2) - np.arange(begins[-1])
        codes = np.full((len(spelled), len(GRAMS)), -1, np.int32)
        for k, n in enumerate(GRAMS):
            hashed = window_hashes(byte, n)
            codes[: len(hashed), k] = np.where(left[: len(hashed)] >= n, hashed & np.uint64(GRAM_BUCKETS - 1), -1)
        held = codes >= 0
        self.gram_codes = codes[held]
        per_place = np.concatenate([[0], np.cumsum(held.sum(1))])
        self.gram_begins = np.concatenate([[0], per_place[begins]])
        words = np.diff(before)
        counts = np.maximum(0, -(-(words - WINDOW) // STRIDE)) + 1
        self.text = np.repeat(np.arange(len(words)), counts)
        turn = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.minimum(turn * STRIDE, np.maximum(0, words - WINDOW)[self.text])
        self.length = np.minimum(words[self.text], WINDOW)
        place = before[:-1][self.text] + at
        self.first_window = np.cumsum(counts) - counts
        self._place, self._number = place, np.append(number + 1, np.zeros(WINDOW, np.int64)).astype(np.int32)

    def windows(self, which: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (time by window) and whether each stands for a word."""
        steps = np.arange(WINDOW)[:, None]
        real = steps < self.length[which]
        return np.where(real, self._number[self._place[which] + steps], 0), real


def fresh_model(seed: int = 11) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)

    def near_zero(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    return {
        "words": near_zero(WORD_BUCKETS, DIM, scale=0.1), "grams": near_zero(GRAM_BUCKETS, DIM, scale=0.3),
        "in": near_zero(DIM, 6 * HIDDEN, scale=DIM**-0.5), "in_bias": np.zeros(6 * HIDDEN, np.float32),
        "forth": near_zero(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), "back": near_zero(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "att": near_zero(2 * HIDDEN, ATTEND, scale=0.3), "att_bias": np.zeros(ATTEND, np.float32), "att_out": near_zero(ATTEND, scale=0.3),
        "out": near_zero(2 * HIDDEN, scale=0.3), "bias": np.full(1, -1.0, np.float32),
    }


def grams_of(texts: Texts, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram buckets of the given words, one word's after the other, where each word's begin, and their numbers."""
    low, count = texts.gram_begins[words], texts.gram_begins[words + 1] - texts.gram_begins[words]
    ends = np.cumsum(count)
    return texts.gram_codes[np.arange(int(count.sum())) + np.repeat(low - (ends - count), count)], ends - count, count


def word_inputs(model: dict[str, np.ndarray], texts: Texts, words: np.ndarray) -> np.ndarray:
    """A vector for each of the given words: its own plus the mean of its character n-grams'; zeros for word 0."""
    out = model["words"][texts.buckets[words]]
    grams = np.ascontiguousarray(model["grams"].T)
    for at in range(0, len(words), 1 << 13):
        codes, begins, count = grams_of(texts, words[at : at + (1 << 13)])
        has = np.flatnonzero(count)
        if len(has):
            summed = np.add.reduceat(np.take(grams, codes, axis=1), begins[has], axis=1)
            out[at + has] += summed.T / (count[has, None] + 1).astype(np.float32)
    out[words == 0] = 0
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def recur(gates: np.ndarray, weights: np.ndarray, real: np.ndarray, reverse: bool, trace: list | None = None) -> np.ndarray:
    """States of a gated recurrent layer for inputs (time, window, 3 * hidden); padded steps keep the state."""
    steps, count, _ = gates.shape
    states, state = np.zeros((steps, count, HIDDEN), np.float32), np.zeros((count, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        own = state @ weights
        both = _sigmoid(gates[t, :, : 2 * HIDDEN] + own[:, : 2 * HIDDEN])
        update, reset = both[:, :HIDDEN], both[:, HIDDEN:]
        new = np.tanh(gates[t, :, 2 * HIDDEN :] + reset * own[:, 2 * HIDDEN :])
        moved = update * (new - state)
        if not real[t].all():
            moved *= real[t][:, None]
        if trace is not None:
            trace.append((t, state, update, reset, new, own[:, 2 * HIDDEN :]))
        state = state + moved
        states[t] = state
    return states


def attend(model: dict[str, np.ndarray], states: np.ndarray, real: np.ndarray):
    hidden = np.tanh(states @ model["att"] + model["att_bias"])
    marks = np.where(real, hidden @ model["att_out"], -1e9)
    marks = np.exp(marks - marks.max(0)) * real
    share = marks / np.maximum(marks.sum(0), 1e-9)
    pooled = np.einsum("tn,tnh->nh", share, states)
    return hidden, share, pooled


def window_logits(model: dict[str, np.ndarray], texts: Texts, run: int = 2048) -> np.ndarray:
    """The logit of every window of the texts."""
    projected = word_inputs(model, texts, np.arange(len(texts.buckets))) @ model["in"] + model["in_bias"]
    forth, back = np.ascontiguousarray(projected[:, : 3 * HIDDEN]), np.ascontiguousarray(projected[:, 3 * HIDDEN :])
    out = np.empty(len(texts.text), np.float32)
    order = np.argsort(texts.length, kind="stable")
    for at in range(0, len(order), run):
        own = order[at : at + run]
        numbers, real = texts.windows(own)
        used = max(1, int(texts.length[own].max()))
        numbers, real = numbers[:used], real[:used]
        states = np.concatenate(
            [recur(forth[numbers], model["forth"], real, False), recur(back[numbers], model["back"], real, True)], 2
        )
        out[own] = attend(model, states, real)[2] @ model["out"] + model["bias"]
    return out


def _recur_back(gates: np.ndarray, weights: np.ndarray, real: np.ndarray, trace: list, slope: np.ndarray):
    into, into_weights = np.zeros_like(gates), np.zeros_like(weights)
    carried = np.zeros(slope.shape[1:], np.float32)
    for t, state, update, reset, new, own in reversed(trace):
        total = slope[t] + carried
        live = total * real[t][:, None]
        d_new = live * update * (1 - new * new)
        d_update = live * (new - state) * update * (1 - update)
        d_reset = d_new * own * reset * (1 - reset)
        into[t] = np.concatenate([d_update, d_reset, d_new], 1)
        inner = np.concatenate([d_update, d_reset, d_new * reset], 1)
        into_weights += state.T @ inner
        carried = total - live * update + inner @ weights.T
    return into, into_weights


def slopes(model: dict[str, np.ndarray], texts: Texts, which: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss over some windows, by propagation through time."""
    numbers, real = texts.windows(which)
    used, numbers = np.unique(numbers, return_inverse=True)
    vectors = word_inputs(model, texts, used)
    gates = (vectors @ model["in"] + model["in_bias"])[numbers]
    traces: tuple[list, list] = ([], [])
    forth = recur(gates[..., : 3 * HIDDEN], model["forth"], real, False, traces[0])
    back = recur(gates[..., 3 * HIDDEN :], model["back"], real, True, traces[1])
    states = np.concatenate([forth, back], 2)
    hidden, share, pooled = attend(model, states, real)
    error = (_sigmoid(pooled @ model["out"] + model["bias"]) - labels).astype(np.float32) / len(which)
    out = {"out": pooled.T @ error, "bias": error.sum(keepdims=True)}
    d_pooled = error[:, None] * model["out"]
    d_share = np.einsum("nh,tnh->tn", d_pooled, states)
    d_states = share[..., None] * d_pooled
    d_marks = share * (d_share - (share * d_share).sum(0))
    out["att_out"] = np.einsum("tn,tna->a", d_marks, hidden)
    d_hidden = d_marks[..., None] * model["att_out"] * (1 - hidden * hidden)
    out["att"] = np.einsum("tnh,tna->ha", states, d_hidden)
    out["att_bias"] = d_hidden.sum((0, 1))
    d_states += d_hidden @ model["att"].T
    d_forth, out["forth"] = _recur_back(gates[..., : 3 * HIDDEN], model["forth"], real, traces[0], d_states[..., :HIDDEN])
    d_back, out["back"] = _recur_back(gates[..., 3 * HIDDEN :], model["back"], real, traces[1], d_states[..., HIDDEN:])
    d_gates = np.concatenate([d_forth, d_back], 2).reshape(-1, 6 * HIDDEN)
    out["in_bias"] = d_gates.sum(0)
    summed = np.zeros((len(used), 6 * HIDDEN), np.float32)
    np.add.at(summed, numbers.ravel(), d_gates)
    summed[used == 0] = 0
    out["in"] = vectors.T @ summed
    d_words = summed @ model["in"].T
    out["words"] = np.zeros_like(model["words"])
    np.add.at(out["words"], texts.buckets[used], d_words)
    codes, _, count = grams_of(texts, used)
    out["grams"] = np.zeros_like(model["grams"])
    np.add.at(out["grams"], codes, np.repeat(d_words / (count[:, None] + 1).astype(np.float32), count, axis=0))
    return out


def trained(column: pa.Array, labels: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Fit the network to labelled texts.

    A text is as toxic as its worst window.  Each epoch scores all windows and
    learns from the highest of every text and from one more of those that are
    not toxic; Adam sets the step sizes.  The number of updates is fixed, so a
    small sample is gone through more often.
    """
    model, texts = fresh_model(seed), Texts(column)
    random = np.random.default_rng(seed)
    labels = labels.astype(np.float32)
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    last = np.append(texts.first_window[1:], len(texts.text))
    windows = last - texts.first_window
    clean, step, epoch = np.flatnonzero(labels == 0), 0, -1
    while step < UPDATES:
        epoch += 1
        if epoch:
            logits = window_logits(model, texts)
            high = np.maximum.reduceat(logits, texts.first_window)
            best = np.flatnonzero(logits == high[texts.text])
            worst = best[np.unique(texts.text[best], return_index=True)[1]]
        else:
            worst = texts.first_window + (random.random(len(windows)) * windows).astype(np.int64)
        more = texts.first_window[clean] + (random.random(len(clean)) * windows[clean]).astype(np.int64)
        # a long toxic text has mostly harmless windows: the first epochs learn from short ones
        few = windows <= 4 * (epoch + 1) if epoch < 3 else np.ones(len(windows), bool)
        chosen = np.concatenate([worst[few], more])
        random.shuffle(chosen)
        for at in range(0, len(chosen), BATCH):
            own = chosen[at : at + BATCH]
            rate, step = RATE * max(0.05, 1 - step / UPDATES), step + 1
            for name, slope in slopes(model, texts, own, labels[texts.text[own]]).items():
                mean[name] += 0.1 * (slope - mean[name])
                square[name] += 0.001 * (slope * slope - square[name])
                model[name] -= rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-7)
    return model


def sample_rows(docs: DataFrame, labels: DataFrame, toxic_rows: int, other_rows: int, most_bytes: int = LEARNED_BYTES) -> DataFrame:
    """Whole labelled texts to learn from, ``text, toxic`` in one sorted partition: at most so many toxic and other rows, those with the smallest hashes of their ids.

    Of these, texts of more than ``most_bytes`` are left out, so that the
    sample is bounded by bytes as well.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(toxic_rows).union(known.where("toxic = 0").orderBy(*order).limit(other_rows))
    short = F.octet_length("text") <= most_bytes  # null is not
    rows = docs.select("doc_id", "text").where(short).join(chosen.hint("broadcast"), "doc_id")
    return rows.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "toxic")


def sample_of(docs: DataFrame, labels: DataFrame, toxic_rows: int, other_rows: int, most_bytes: int = LEARNED_BYTES) -> tuple[pa.Array, np.ndarray]:
    """The rows of ``sample_rows`` brought here, to be looked at or for ``trained``."""
    rows = sample_rows(docs, labels, toxic_rows, other_rows, most_bytes).toArrow()
    return rows.column("text").combine_chunks(), rows.column("toxic").to_numpy()


def fitted(sample: DataFrame) -> dict[str, np.ndarray] | None:
    """The network trained on ``text, toxic`` in one task; without both kinds there is nothing to learn and no network.

    The texts and the work on them stay off the driver, which gets the weights alone.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if not rows:
            return
        read = pa.Table.from_batches(rows).combine_chunks()
        known = read.column("toxic").to_numpy()
        if 0 < known.sum() < len(known):
            model = trained(read.column("text").combine_chunks(), known)
            yield pa.RecordBatch.from_pydict({"name": list(model), "shape": [list(v.shape) for v in model.values()], "weights": [v.tobytes() for v in model.values()]})

    weights = sample.mapInArrow(fit, "name string, shape array<long>, weights binary").collect()
    return {r["name"]: np.frombuffer(r["weights"], np.float32).reshape(r["shape"]).copy() for r in weights} or None


def score(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS, column: str = "score",
    unknown: float | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` and ``column``, the probability that the text is toxic.

    A column of that name is replaced.

    The network is trained in one task on a bounded sample of whole
    labelled texts (``toxic_rows`` and ``other_rows``, each of at most
    ``LEARNED_BYTES``; labels of held-out rows are never used) and sent to the tasks; its size is fixed.  Every text is
    scored by all its overlapping windows and counts as its worst one.  Scores
    depend on the text alone, and training is the same in each run.

    Null, empty and letterless texts get the score of an empty window.
    Without labelled rows of both kinds there is nothing to learn, and every
    score is ``unknown``, or 0.5 if that is not given.  A label row with nulls or other values is not used.
    """
    docs = docs.drop(column)
    model = fitted(sample_rows(docs, labels, toxic_rows, other_rows))
    if model is None:
        return docs.withColumn(column, F.lit(0.5 if unknown is None else float(unknown)))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, limit=1 << 20):
                found = Texts(cut.column("text"))
                logits = window_logits(shipped.value, found)
                scores = _sigmoid(np.maximum.reduceat(logits, found.first_window).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*cut.columns, pa.array(scores)], [*cut.schema.names, column])

    return docs.mapInArrow(predict, docs.schema.simpleString()[7:-1] + f",{column}:double")
