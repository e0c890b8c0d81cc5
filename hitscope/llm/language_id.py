"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers of a few units read each stretch of bytes in either
direction; a linear layer on both labels every byte position, and a document's
probabilities are the mean over all positions of its whole text. The network is
trained here, in numpy, by back-propagation through time, on a bounded sample.
Gates and states use x / (1 + |x|) in place of the exponential functions, which
numpy evaluates several times slower.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hitscope.llm.common import concatenated_ranges, id_and_text, id_bucket, row_slices, utf8

UNDETERMINED = "und"
#: Bytes of a stretch that is read from a zero state, and of text in work at once.
STRETCH, _BYTES = 128, 1 << 19


@dataclass
class Network:
    """Per direction: byte tables (256, 3H) of update, reset and candidate, and recurrent weights (H, 3H)."""

    languages: list[str]
    tables: list[np.ndarray]
    recurrent: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(y: np.ndarray) -> np.ndarray:
    """Derivative of x / (1 + |x|) from its value."""
    return (1 - np.abs(y)) ** 2


def new_network(languages: list[str], units: int, rng: np.random.Generator) -> Network:
    scale = lambda *shape: (rng.normal(size=shape) * 0.4).astype(np.float32)
    return Network(
        languages,
        [scale(256, 3 * units) for _ in range(2)],
        [scale(units, 3 * units) for _ in range(2)],
        scale(2 * units, len(languages)),
        np.zeros(len(languages), np.float32),
    )


def _forward_training(table, recurrent, x):
    """States (T+1, B, H) and what the way back needs; x: (T, B) bytes."""
    h_units = recurrent.shape[0]
    h = np.zeros((x.shape[1], h_units), np.float32)
    states, steps = [h], []
    for row in x:
        inputs = table[row]
        gates = _soft(inputs[:, : 2 * h_units] + h @ recurrent[:, : 2 * h_units])
        z, r = (gates[:, :h_units] + 1) / 2, (gates[:, h_units:] + 1) / 2
        side = h @ recurrent[:, 2 * h_units :]
        n = _soft(inputs[:, 2 * h_units :] + r * side)
        steps.append((gates, z, r, side, n))
        h = h + z * (n - h)
        states.append(h)
    return np.stack(states), steps


def _backward_training(table, recurrent, x, states, steps, grad_states):
    """Gradients of the table and the recurrent weights by back-propagation through time."""
    units = recurrent.shape[0]
    grad_table, grad_recurrent = np.zeros_like(table), np.zeros_like(recurrent)
    carried = np.zeros_like(states[0])
    for t in range(len(steps) - 1, -1, -1):
        gates, z, r, side, n = steps[t]
        h = states[t]
        total = carried + grad_states[t]
        pre_n = total * z * _slope(n)
        pre_z = total * (n - h) * _slope(gates[:, :units]) / 2
        pre_r = pre_n * side * _slope(gates[:, units:]) / 2
        grad_side = pre_n * r
        pre = np.concatenate([pre_z, pre_r, pre_n], axis=1)
        np.add.at(grad_table, x[t], pre)
        back = np.concatenate([pre_z, pre_r, grad_side], axis=1)
        grad_recurrent += h.T @ back
        carried = total * (1 - z) + back @ recurrent.T
    return grad_table, grad_recurrent


def train_network(
    samples: list[bytes], labels: np.ndarray, languages: list[str], units: int = 8, steps: int = 260, batch: int = 160, seed: int = 7
) -> Network:
    """Fit by Adam on stretches of *samples*; labels index *languages*. Every position has the label of its text."""
    rng = np.random.default_rng(seed)
    net = new_network(languages, units, rng)
    params = [*net.tables, *net.recurrent, net.out, net.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        chosen = rng.integers(0, len(samples), batch)
        length = 64
        x = np.full((length, batch), 32, np.uint8)
        for column, i in enumerate(chosen.tolist()):
            text = samples[i]
            start = int(rng.integers(0, max(1, len(text) - length + 1)))
            part = text[start : start + length]
            x[: len(part), column] = np.frombuffer(part, np.uint8)
        ways = [x, x[::-1]]
        passes = [_forward_training(net.tables[d], net.recurrent[d], ways[d]) for d in range(2)]
        both = np.concatenate([passes[0][0][1:], passes[1][0][1:][::-1]], axis=2)
        logits = both @ net.out + net.bias
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        prob[:, np.arange(batch), labels[chosen]] -= 1
        prob /= length * batch
        flat = prob.reshape(-1, len(languages))
        grad_both = (prob @ net.out.T).astype(np.float32)
        grads = []
        for d in range(2):
            own = grad_both[:, :, d * units : (d + 1) * units]
            grads.append(
                _backward_training(net.tables[d], net.recurrent[d], ways[d], *passes[d], own if d == 0 else own[::-1])
            )
        all_grads = [grads[0][0], grads[1][0], grads[0][1], grads[1][1], both.reshape(-1, 2 * units).T @ flat, flat.sum(axis=0)]
        rate = 0.03 * min(1.0, step / 20) * (1 - step / (steps + 1)) + 0.001
        for p, g, m, v in zip(params, all_grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def _states(table: np.ndarray, recurrent: np.ndarray, x: np.ndarray) -> Iterator[np.ndarray]:
    """The state (B, H) after each row of x (T, B), one after another in the same array."""
    units = recurrent.shape[0]
    tables = [np.ascontiguousarray(table[:, i * units : (i + 1) * units]) for i in range(3)]
    weights = [np.ascontiguousarray(recurrent[:, i * units : (i + 1) * units]) for i in range(3)]
    h = np.zeros((x.shape[1], units), np.float32)
    z, r, n, side = (np.empty_like(h) for _ in range(4))

    def soft(a):
        np.abs(a, out=side)
        np.add(side, 1, out=side)
        np.divide(a, side, out=a)

    for row in x:
        for gate, table_, weight in ((z, tables[0], weights[0]), (r, tables[1], weights[1])):
            np.matmul(h, weight, out=gate)
            np.take(table_, row, axis=0, out=side, mode="clip")
            gate += side
            soft(gate)
            gate += 1
            gate *= 0.5
        np.matmul(h, weights[2], out=n)
        n *= r
        np.take(tables[2], row, axis=0, out=side, mode="clip")
        n += side
        soft(n)
        n -= h
        n *= z
        h += n
        yield h


def document_probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities over all byte positions of each document, (documents, languages); 0 for empty ones."""
    lengths = np.diff(offsets)
    pieces = -(-lengths // STRETCH)
    document = np.repeat(np.arange(len(lengths)), pieces)
    starts = concatenated_ranges(np.zeros(len(lengths), np.int64), pieces) * STRETCH + offsets[:-1][document]
    sizes = np.minimum(STRETCH, offsets[1:][document] - starts)
    totals = np.zeros((len(lengths), len(net.languages)))
    if not len(starts):
        return totals
    at = np.arange(STRETCH)[:, None]
    x = data[np.minimum(starts + at, len(data) - 1)].astype(np.intp)
    real = at < sizes
    x[~real] = 32
    units = net.recurrent[0].shape[0]
    # Only the states of the way back are kept.
    behind = np.empty((STRETCH, len(starts), units), np.float32)
    for t, state in enumerate(_states(net.tables[1], net.recurrent[1], x[::-1])):
        behind[STRETCH - 1 - t] = state
    sums = np.zeros((len(starts), len(net.languages)), np.float32)
    logits, back = np.empty_like(sums), np.empty_like(sums)
    for t, state in enumerate(_states(net.tables[0], net.recurrent[0], x)):
        np.matmul(state, net.out[:units], out=logits)
        np.matmul(behind[t], net.out[units:], out=back)
        logits += back
        logits += net.bias
        np.exp(logits, out=logits)  # states are within -1 and 1, so logits are small
        logits *= (real[t] / logits.sum(axis=1))[:, None]
        sums += logits
    for k in range(sums.shape[1]):
        totals[:, k] = np.bincount(document, sums[:, k], len(lengths))
    return totals / np.maximum(lengths, 1)[:, None]


#: Languages whose sample may be gathered: at most this many times *per_language* texts of *chars* characters.
MAX_LANGUAGES = 1000


def training_sample(docs: DataFrame, per_language: int = 400, chars: int = 600) -> list:
    """At most *per_language* distinct texts ``(lang, text)`` of every language.

    Documents whose crc32(id) is divisible by 5 are left out. Which documents,
    and where in a text its *chars* characters start, follow from a hash of the text
    alone. The languages' counts of distinct texts, all of them over all documents, set how many
    hashes pass, so that the sample has a bounded size before it is gathered. No language is
    left out; more than MAX_LANGUAGES of them are a ValueError.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (id_bucket(F.col("doc_id"), 5) != 0))
    hashed = labelled.select("lang", "text", F.xxhash64("text").alias("h"))
    # Copies of a text are one text: they share a hash, and must not stand for several.
    texts = hashed.select("lang", "h").distinct()
    counts = texts.groupBy("lang").agg(F.count("*").alias("texts"))
    found = counts.count()
    if found > MAX_LANGUAGES:
        raise ValueError(f"{found} languages; the sample of more than {MAX_LANGUAGES} is not bounded")
    passing = F.pmod("h", F.lit(1 << 20)) <= F.least(F.lit(1.0), 3.0 * per_language / F.col("texts")) * (1 << 20)
    few = texts.join(F.broadcast(counts), "lang").filter(passing)
    ranked = few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    chosen = ranked.filter(F.col("place") <= per_language).select("lang", "h", "place")
    start = F.pmod(F.shiftright("h", 20), F.greatest(F.char_length("text") - chars, F.lit(1))).cast("int")
    picked = hashed.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "place", F.substring("text", start + 1, F.lit(chars)).alias("text"))
    return picked.groupBy("lang", "place").agg(F.min("text").alias("text")).orderBy("lang", "place").select("lang", "text").collect()


def train(docs: DataFrame, per_language: int = 400, units: int = 8) -> Network:
    """The network for the languages of *docs*; without a labelled document it knows none."""
    rows = training_sample(docs, per_language)
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return new_network([], units, np.random.default_rng(0))
    groups = {k: [r["text"].encode() for r in rows if r["lang"] == k] for k in languages}
    most = max(map(len, groups.values()))
    samples, labels = [], []
    for k, language in enumerate(languages):  # rare languages are repeated, so that all weigh the same
        own = groups[language]
        samples += [own[i % len(own)] for i in range(most)]
        labels += [k] * most
    return train_network(samples, np.array(labels), languages, units)


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, text, has_letter, lang_pred, score`` of each row's whole text (NULL text: empty).

    ``und`` with score 0 where the text is NULL, empty or without a letter, or no
    language was learnt. Rows are judged one by one: repeats and NULL ids stay.
    """

    def run(batches):
        names = np.array([*net.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            best, score = _judge(net, batch.column("text"), batch.column("has_letter"))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
            )

    read = id_and_text(docs).withColumn("has_letter", _has_letter())
    return read.mapInArrow(run, "doc_id long, lang_pred string, score double")


def _has_letter():
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def _judge(net: Network, texts: pa.Array, has_letter: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of the language of each text (one beyond the last: undetermined), and its score."""
    data, offsets = utf8(texts)
    letters = has_letter.to_numpy(zero_copy_only=False).astype(bool)
    best = np.full(len(texts), len(net.languages))
    score = np.zeros(len(texts))
    if net.languages:
        for start, stop in row_slices(offsets, _BYTES):
            for low, high, sums in _long_rows(net, data, offsets, start, stop):
                best[low:high], score[low:high] = sums.argmax(axis=1), sums.max(axis=1)
    best[~letters], score[~letters] = len(net.languages), 0.0
    return best, np.clip(score, 0, 1)


def _long_rows(net, data, offsets, start, stop):
    """Probabilities of a slice of rows; one very long row is summed part by part."""
    size = int(offsets[stop] - offsets[start])
    if size <= 2 * _BYTES:
        part = offsets[start : stop + 1]
        yield start, stop, document_probabilities(net, data[part[0] : part[-1]], part - part[0])
        return
    step = _BYTES // STRETCH * STRETCH
    total = np.zeros((1, len(net.languages)))
    for low in range(int(offsets[start]), int(offsets[stop]), step):
        part = data[low : min(low + step, int(offsets[stop]))]
        total += document_probabilities(net, part, np.array([0, len(part)])) * len(part)
    yield start, stop, total / size


def language_id(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, by a network trained on the labelled, not held out ones."""
    found = identify(docs, train(docs))
    return found.select("doc_id", (id_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.4) -> DataFrame:
    """*docs*, unchanged, without those whose language is undetermined or scores less than *min_score*.

    With more than four languages the least score falls with their number, as the probabilities that a wrong guess would have do.
    If no language can be learnt from *docs*, all are kept that have a letter. Only texts are sent to
    Python workers; the rows they belong to stay where they are.
    """
    net = train(docs)
    least = min(min_score, 4 * min_score / max(1, len(net.languages)))

    @F.arrow_udf("boolean")
    def identified(texts: pa.Array, has_letter: pa.Array) -> pa.Array:
        if not net.languages:
            return has_letter
        best, score = _judge(net, texts, has_letter)
        return pa.array((score >= least) & (best < len(net.languages)))

    return docs.filter(identified(F.coalesce("text", F.lit("")), _has_letter()))
