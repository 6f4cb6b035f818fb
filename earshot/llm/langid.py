"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in segments of bytes, forwards and backwards, gives every
position a probability for each language, and a document the mean over its positions.
It is trained here, in numpy, by backpropagation through time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import free_names, read_documents, released, remainder

FOLDS = 5
UNKNOWN = "und"
HIDDEN = 12
SEGMENT = 128  # bytes that one pass of the network reads
BATCH = 2048  # segments at a time
# Training sees at most so many labelled rows, evenly over the languages, and of each a
# stretch of this many characters from a seeded place.  This bounds what the driver gathers.
SAMPLE_ROWS = 4_000
STRETCH = 128
STEPS, STEP_SEGMENTS, RATE = 500, 64, 0.02
SEED = 11
LETTER = re.compile(r"[^\W\d_]")
# The pipeline rejects documents below this pooled probability.
MIN_SCORE = 0.4


@dataclass
class Network:
    """``inputs[d]`` (3H x 256) has a column per byte value; rows are update, reset, candidate."""

    langs: list[str]
    inputs: list[np.ndarray]
    states: list[np.ndarray]  # 3H x H
    outputs: list[np.ndarray]  # C x H
    bias: np.ndarray  # C
    # Which bytes began a character in training; none are told apart where it is not known.
    seen: np.ndarray | None = None

    def arrays(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, *self.outputs, self.bias]


def new_network(langs: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.normal(size=shape) * scale).astype(np.float32)

    return Network(
        langs,
        [normal(3 * hidden, 256, scale=0.3) for _ in range(2)],
        [normal(3 * hidden, hidden, scale=hidden**-0.5) for _ in range(2)],
        [normal(len(langs), hidden, scale=hidden**-0.5) for _ in range(2)],
        np.zeros(len(langs), np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _pass(inputs, states, data, mask, keep=False):
    """One direction over ``data`` (T x N bytes, already in reading order).

    Yields the state after each position (H x N); with ``keep`` also what the way back
    needs.  A masked position leaves the state at zero.
    """
    hidden = states.shape[1]
    n = data.shape[1]
    h = np.zeros((hidden, n), np.float32)
    g, x = np.empty((3 * hidden, n), np.float32), np.empty((3 * hidden, n), np.float32)
    for at in range(len(data)):
        np.take(inputs, data[at], axis=1, out=x, mode="clip")
        np.dot(states, h, out=g)
        x[: 2 * hidden] += g[: 2 * hidden]
        gates = _sigmoid(x[: 2 * hidden])
        update, reset = gates[:hidden], gates[hidden:]
        candidate = g[2 * hidden :] * reset
        candidate += x[2 * hidden :]
        np.tanh(candidate, out=candidate)
        before = h
        h = h - candidate
        h *= update
        h += candidate
        if mask is not None:
            h *= mask[at]
        if keep:
            yield h, (before, update.copy(), reset.copy(), candidate, g[2 * hidden :].copy())
        else:
            yield h, None


def probabilities(net: Network, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Language probabilities of every position: T x C x N; masked positions are zero."""
    length, n = data.shape
    out = np.empty((length, len(net.langs), n), np.float32)
    for at, (h, _) in enumerate(_pass(net.inputs[0], net.states[0], data, None)):
        np.dot(net.outputs[0], h, out=out[at])
    # From the end, a segment's padding comes first; the mask keeps it out of the state.
    back = _pass(net.inputs[1], net.states[1], data[::-1], mask[::-1])
    for at, (h, _) in zip(range(length - 1, -1, -1), back, strict=True):
        p = out[at]
        p += net.outputs[1] @ h
        p += net.bias[:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p *= mask[at] / p.sum(axis=0)
    return out


def train(
    net: Network, data: np.ndarray, mask: np.ndarray, labels: np.ndarray, steps: int = STEPS
) -> None:
    """Fit in place: Adam on the mean cross-entropy of all positions of a batch."""
    rng = np.random.default_rng(SEED)
    params = net.arrays()
    moment = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        some = rng.integers(0, data.shape[1], min(STEP_SEGMENTS, data.shape[1]))
        grads = _gradients(net, data[:, some], mask[:, some], labels[some])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        rate = RATE * (1 - 0.9 * step / steps)
        for p, g, m, s in zip(params, grads, moment, square, strict=True):
            g *= scale
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)


def _gradients(net, data, mask, labels) -> list[np.ndarray]:
    length, n = data.shape
    ways = []
    for way, (seen, seen_mask) in enumerate(((data, mask), (data[::-1], mask[::-1]))):
        ways.append(list(_pass(net.inputs[way], net.states[way], seen, seen_mask, keep=True)))
    d_out = [np.zeros_like(w) for w in net.outputs]
    d_bias = np.zeros_like(net.bias)
    into: list[list] = [[None] * length, [None] * length]
    total = max(mask.sum(), 1)
    for at in range(length):
        forward, backward = ways[0][at][0], ways[1][length - 1 - at][0]
        logits = net.outputs[0] @ forward + net.outputs[1] @ backward + net.bias[:, None]
        logits -= logits.max(axis=0)
        p = np.exp(logits)
        p /= p.sum(axis=0)
        p[labels, np.arange(n)] -= 1
        p *= mask[at] / total
        d_bias += p.sum(axis=1)
        d_out[0] += p @ forward.T
        d_out[1] += p @ backward.T
        into[0][at] = net.outputs[0].T @ p
        into[1][length - 1 - at] = net.outputs[1].T @ p
    d_in, d_state = [], []
    for way, (seen, seen_mask) in enumerate(((data, mask), (data[::-1], mask[::-1]))):
        a, b = _back(net.inputs[way], net.states[way], seen, seen_mask, ways[way], into[way])
        d_in.append(a)
        d_state.append(b)
    return [*d_in, *d_state, *d_out, d_bias]


def _back(inputs, states, data, mask, kept, into) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of one direction, from the last position it read to the first."""
    hidden = states.shape[1]
    d_in, d_state = np.zeros_like(inputs).T.copy(), np.zeros_like(states)
    d_h = np.zeros_like(kept[0][0])
    for at in range(len(data) - 1, -1, -1):
        before, update, reset, candidate, inner = kept[at][1]
        d_h = (d_h + into[at]) * mask[at]
        d_candidate = d_h * (1 - update) * (1 - candidate * candidate)
        d_update = d_h * (before - candidate) * update * (1 - update)
        d_reset = d_candidate * inner * reset * (1 - reset)
        d_gates = np.concatenate([d_update, d_reset, d_candidate])
        np.add.at(d_in, data[at], d_gates.T)
        d_gates[2 * hidden :] *= reset
        d_state += d_gates @ before.T
        d_h = d_h * update + states.T @ d_gates
    return d_in.T, d_state


def segments(texts: list[bytes], length: int = SEGMENT) -> tuple[np.ndarray, ...]:
    """Texts cut into rows of ``length`` bytes: rows, mask, and each text's first row."""
    padded = b"".join([t + bytes(-len(t) % length) for t in texts])
    rows = np.frombuffer(padded, np.uint8).reshape(-1, length)
    sizes = np.array([len(t) for t in texts])
    counts = -(-sizes // length)
    firsts = np.cumsum(counts) - counts
    used = np.full(len(rows), length)
    last = (firsts + counts - 1)[counts > 0]
    used[last] = sizes[counts > 0] - (counts[counts > 0] - 1) * length
    return rows, used, firsts, sizes


def pooled(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: mean probabilities over its positions, and the share of each label (C x texts).

    A position's label is the language that has more than half of its probability.
    """
    rows, used, firsts, sizes = segments(texts)
    sums = np.zeros((2, len(net.langs), len(rows) + 1))
    for at in range(0, len(rows), BATCH):
        data = np.ascontiguousarray(rows[at : at + BATCH].T)
        mask = (np.arange(SEGMENT)[:, None] < used[at : at + BATCH]).astype(np.float32)
        p = probabilities(net, data, mask)
        sums[0, :, at : at + data.shape[1]] = p.sum(axis=0)
        sums[1, :, at : at + data.shape[1]] = np.count_nonzero(p > 0.5, axis=0)
    both = np.add.reduceat(sums, firsts, axis=2) if len(texts) else sums[:, :, :0]
    both[:, :, sizes == 0] = 0
    both /= np.maximum(sizes, 1)
    return both[0], both[1]


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """``lang, stretch`` of at most ``rows`` training rows, as even over languages as they allow."""
    labelled = docs.where(
        (remainder(F.col("doc_id"), FOLDS) != 0) & F.col("lang").isNotNull()
    ).select("doc_id", "lang", "text")
    counts = {  # one row per language
        row["lang"]: row["n"]
        for row in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not counts:
        return []
    share = F.element_at(
        F.create_map(*[F.lit(v) for pair in counts.items() for v in pair]), F.col("lang")
    )
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 52)) / float(1 << 52)
    turn = draw * share
    room = F.greatest(F.lit(1), F.char_length("text") - STRETCH + 1)
    place = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), room).cast("int") + 1
    drawn = (
        labelled.withColumn("turn", turn)
        .where(F.col("turn") < 2 * rows / len(counts))
        .select("turn", "doc_id", "lang", F.substring("text", place, F.lit(STRETCH)).alias("part"))
        .where(F.col("part").rlike(r"\p{L}"))
        .orderBy("turn", "doc_id", "part")
        .limit(rows)
    )
    return [(row["lang"], row["part"]) for row in drawn.collect()]


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, steps: int = STEPS) -> Network | None:
    """A network for the languages of the training rows; None when there are none."""
    drawn = sample(docs, rows)
    if not drawn:
        return None
    langs = sorted({lang for lang, _ in drawn})
    net = new_network(langs)
    # Some stretches are shortened and some put in capitals, as short texts and shouting are.
    parts = [part[: 8 + i % 40] if i % 4 == 2 else part for i, (_, part) in enumerate(drawn)]
    texts = [(p.upper() if i % 8 == 1 else p).encode() for i, p in enumerate(parts)]
    cut, used, firsts, _ = segments(texts)
    number = np.zeros(len(cut), np.int64)
    number[firsts] = 1
    labels = np.array([langs.index(lang) for lang, _ in drawn])[np.cumsum(number) - 1]
    mask = (np.arange(SEGMENT)[:, None] < used).astype(np.float32)
    train(net, np.ascontiguousarray(cut.T), mask, labels, steps)
    net.seen = beginnings(texts)
    return net


def beginnings(texts: list[bytes]) -> np.ndarray:
    """Which byte values begin a character of the texts; all that are ASCII count as if they did."""
    seen = np.zeros(256, bool)
    seen[:128] = True
    for text in texts:
        seen[np.unique(_leads(text))] = True
    return seen


def _leads(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return data[data & 0xC0 != 0x80]


def familiar(net: Network, text: bytes) -> float:
    """The share of characters that begin as some character of the training texts did.

    The network has learned nothing of a script that it never read and says anything of it.
    """
    if net.seen is None or text.isascii():
        return 1.0
    return float(net.seen[_leads(text)].mean())


def predict(docs: DataFrame, net: Network | None, *names: str) -> DataFrame:
    """``docs`` and three columns: language, mean probability, share of positions so labelled.

    The probability counts for the characters that look :func:`familiar` alone, as if the others
    spoke for no language.
    Only ``text`` is read.  Null text, text without a letter, and any text when nothing
    was learned give ``und`` with 0.
    """
    lang, score, share = names or ("lang_pred", "score", "position_share")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in released(batches):
            for at in range(0, len(whole), 512):  # bounds the memory, not the work
                batch = whole.slice(at, 512)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                known = [bool(net and LETTER.search(t)) for t in texts]
                found = [(UNKNOWN, 0.0, 0.0)] * len(texts)
                asked = [i for i, k in enumerate(known) if k]
                if asked:
                    data = [texts[i].encode() for i in asked]
                    mean, labelled = pooled(net, data)
                    mean *= np.array([familiar(net, d) for d in data])
                    best = mean.argmax(axis=0)
                    for place, (i, b) in enumerate(zip(asked, best.tolist(), strict=True)):
                        found[i] = (
                            net.langs[b],
                            min(1.0, float(mean[b, place])),
                            float(labelled[b, place]),
                        )
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *[pa.array(c) for c in columns]],
                    [*batch.schema.names, lang, score, share],
                )

    schema = docs.select(
        "*",
        F.lit("").alias(lang),
        F.lit(0.0).alias(score),
        F.lit(0.0).alias(share),
    ).schema
    for field in schema.fields:
        field.nullable = True
    return docs.mapInArrow(run, schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    docs = read_documents(spark, sf_dir).select("doc_id", "lang", "text")
    found = predict(docs.select("doc_id", "text"), fit(docs))
    return found.select(
        "doc_id",
        (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "lang_pred",
        "score",
        "position_share",
    )


def in_known_language(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or less sure than ``min_score``."""
    names = free_names(docs.columns, "lang_pred", "score", "position_share")
    found = predict(docs, fit(docs.select("doc_id", "lang", "text")), *names)
    sure = (F.col(f"`{names[0]}`") != UNKNOWN) & (F.col(f"`{names[1]}`") >= min_score)
    return found.where(sure).select(*[F.col(f"`{c}`") for c in docs.columns])
