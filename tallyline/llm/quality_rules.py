"""Quality rules: counts over whole texts, and a hashed n-gram logistic regression, calibrated, against fixed thresholds.

The counts are of words, their code points, symbols, repeated lines and words in repeated runs of five; a text of fewer
than 10 words, or with more than a fifth of its words in repeated runs, fails whatever the model says.

The model sees words, pairs of neighbouring words and runs of three and four bytes, hashed into ``BUCKETS`` places per
kind, each as its share of the text's n-grams of that kind. It is fitted on at most ``SAMPLE_ROWS`` labelled rows of each
value with ``SAMPLE_ENTRIES`` shares together (three in four of them; the rest calibrate the probability), never on rows whose crc32(id) mod 4 is 2. Scoring
sums weights over slices of Arrow batches.

Null and empty texts have zero counts and fail. Without labelled rows of both kinds the model keeps everything. Columns
named as results are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.blocks import _BASE, _RANDOM, EXACT, mix, word_spans, span_hashes, text_slices, tidy
from tallyline.llm.labelled import fit_logistic, labelled_sample, probability
from tallyline.llm.line_chunks import lines_of
from tallyline.llm.tables import add_text_columns, fields, table
from tallyline.session import saved

BUCKETS = 1 << 16
KINDS = 4
SAMPLE_ROWS = 2000
#: N-gram shares, 8 bytes each, that one task fits on at most (or one text's).
SAMPLE_ENTRIES = 1 << 23
KEEP = 0.5
LEAST_WORDS = 10
MOST_REPEATED = 20
RUN = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags)]
    return total[at[1:]] - total[at[:-1]]


def rule_counts(data: np.ndarray, at: np.ndarray):
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text; and the words themselves."""
    n = len(at) - 1
    starts, ends = word_spans(data, at)
    hashes = span_hashes(data, starts, ends, EXACT)
    owner = np.searchsorted(at, starts, "right") - 1
    words = np.bincount(owner, minlength=n)
    reach = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    chars = np.bincount(owner, reach[ends] - reach[starts], minlength=n).astype(np.int64)
    symbols = _per_text(_SYMBOL[data], at)

    a, b, line_owner, line_words = lines_of(data, at)
    full = line_words > 0
    salt = mix(line_owner[full].astype(np.uint64) + np.uint64(1))
    _, first = np.unique(span_hashes(data, a[full], b[full], _RANDOM) + salt, return_index=True)
    lines = np.bincount(line_owner[full], minlength=n) - np.bincount(line_owner[full][first], minlength=n)

    repeated = np.zeros(n, np.int64)
    if len(hashes) >= RUN:
        runs = np.zeros(len(hashes) - RUN + 1, np.uint64)
        for j in range(RUN):
            runs = mix(runs + hashes[j : j + len(runs)])
        runs += mix(owner[: len(runs)].astype(np.uint64) + np.uint64(1))
        whole = np.flatnonzero(owner[RUN - 1 :] == owner[: len(runs)])
        _, which, times = np.unique(runs[whole], return_inverse=True, return_counts=True)
        twice = whole[times[which] > 1]
        cover = np.zeros(len(hashes) + 1, np.int64)
        cover[twice] += 1
        cover[twice + RUN] -= 1  # a window starts once at a place, and so ends once
        repeated = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=n)
    return (words, chars, symbols, lines, repeated), (hashes, owner)


def ngrams(data: np.ndarray, at: np.ndarray, hashes: np.ndarray, owner: np.ndarray):
    """For each kind of n-gram the bucket and the text number of every one."""
    def bucket(h):
        return (mix(h) >> np.uint64(48)).astype(np.int64)

    yield bucket(hashes + np.uint64(1)), owner
    pair = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else owner
    yield bucket(hashes[pair] * np.uint64(3) + hashes[pair + 1] * np.uint64(_BASE)), owner[pair]
    values = _RANDOM[data]
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for width in (3, 4):
        if len(data) < width:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        h = np.full(len(data) - width + 1, width, np.uint64)
        for j in range(width):
            h *= np.uint64(_BASE)
            h += values[j : j + len(h)]
        inside = text[width - 1 :] == text[: len(h)]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        yield (h >> np.uint64(48)).astype(np.int64)[inside], text[: len(h)][inside]


def margins(weights: np.ndarray, data: np.ndarray, at: np.ndarray, words=None) -> np.ndarray:
    """The sum over kinds of the mean weight of a text's n-grams; a kind without any adds nothing."""
    hashes, owner = words if words is not None else _words(data, at)
    total = np.zeros(len(at) - 1)
    for k, (place, text) in enumerate(ngrams(data, at, hashes, owner)):
        n = np.bincount(text, minlength=len(total))
        total += np.bincount(text, weights[k * BUCKETS + place], minlength=len(total)) / np.maximum(n, 1)
    return total


def _words(data, at):
    starts, ends = word_spans(data, at)
    return span_hashes(data, starts, ends, EXACT), np.searchsorted(at, starts, "right") - 1


def _vectors(sample: DataFrame) -> DataFrame:
    """``order``, ``id``, ``label``, ``entries`` and the shares of all n-grams of each text: columns and values as bytes."""

    def run(batches):
        for batch in tidy(batches):
            columns, values = [], []
            for _, data, at in text_slices(batch.column(3)):
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    own, shares = _vector(data[a:b])
                    columns.append(own.tobytes())
                    values.append(shares.tobytes())
            sizes = pa.array([len(c) // 4 for c in columns], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], sizes, pa.array(columns, pa.binary()), pa.array(values, pa.binary())],
                names=["order", "id", "label", "entries", "columns", "weights"],
            )

    kind = sample.schema["id"].dataType.simpleString()
    schema = f"order long, id {kind}, label int, entries long, columns binary, weights binary"
    return sample.select("order", "id", "label", "text").mapInArrow(run, schema)


def _vector(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and shares of the n-grams of one text."""
    at, columns, values = np.array([0, len(data)]), [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
    for k, (place, _) in enumerate(ngrams(data, at, *_words(data, at))):
        own, times = np.unique(place, return_counts=True)
        columns.append((own + k * BUCKETS).astype(np.int32))
        values.append((times / max(len(place), 1)).astype(np.float32))
    return np.concatenate(columns), np.concatenate(values)


def fit_weights(rows, columns, values, labels: np.ndarray, rounds: int = 60, rate: float = 0.5) -> np.ndarray:
    """Logistic regression by full passes with a step per weight that shrinks as gradients add up (Adagrad)."""
    weights, squares = np.zeros(KINDS * BUCKETS), np.full(KINDS * BUCKETS, 1e-12)
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    for _ in range(rounds):
        z = np.bincount(rows, weights[columns] * values, minlength=len(labels))
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * share
        gradient = np.bincount(columns, error[rows] * values, minlength=len(weights)) + 1e-9 * weights
        squares += gradient**2
        weights -= rate * gradient / np.sqrt(squares)
    return weights


def fit_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """Weights and calibration, or None if one value of ``labels.quality`` has no row to learn from.

    One task fits them, on numbers alone: of the sampled rows, in order of a hash of their ids, as many as have
    ``SAMPLE_ENTRIES`` n-gram shares together. The driver gets the weights.
    """
    sample = saved(_vectors(labelled_sample(docs, labels, SAMPLE_ROWS, "quality", doc_id, text)), "vectors")
    total, last = 0, None
    for r in sample.select("order", "id", "entries").orderBy("order", "id").collect():
        total += r["entries"]
        if total > SAMPLE_ENTRIES and last is not None:
            break
        last = r["order"]
    chosen = sample.where(F.col("order") <= F.lit(last).cast("long"))

    def fit(batches):
        rows = list(batches)
        if not sum(len(b) for b in rows):
            return
        rows = pa.Table.from_batches(rows)
        y = rows.column("label").to_numpy().astype(float)
        part = np.arange(len(y)) % 4 == 3
        if any(len(np.unique(y[p])) < 2 for p in (part, ~part)):
            part[:] = False
            if len(np.unique(y)) < 2:
                return
        owner = np.repeat(np.arange(len(y), dtype=np.int32), rows.column("entries").to_numpy())
        columns = np.frombuffer(b"".join(rows.column("columns").to_pylist()), np.int32)
        values = np.frombuffer(b"".join(rows.column("weights").to_pylist()), np.float32)
        learnt = ~part[owner]
        number = np.cumsum(~part) - 1
        weights = fit_weights(number[owner[learnt]], columns[learnt], values[learnt], y[~part])
        scores = np.bincount(owner, weights[columns] * values, minlength=len(y))
        check = part if part.any() else ~part
        # both kinds count alike in the sample; their true shares do not enter, as the thresholds are fixed
        calibration = fit_logistic(scores[check][:, None], y[check])
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype(np.float32).tobytes()]), pa.array([calibration.tobytes()])], names=["weights", "calibration"]
        )

    one = chosen.repartition(1).sortWithinPartitions("order", "id").select("label", "entries", "columns", "weights")
    found = one.mapInArrow(fit, "weights binary, calibration binary").collect()
    if not found:
        return None
    return np.frombuffer(found[0]["weights"], np.float32), np.frombuffer(found[0]["calibration"], np.float64)


def apply_rules(docs: DataFrame, model, text: str = "text", keep: float = KEEP, drop_text: bool = False) -> DataFrame:
    """Adds the counts, ``base_failed``, ``quality`` (the probability of label 1) and ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def maker():
        own = shared.value

        def compute(data, at):
            counts, words = rule_counts(data, at)
            n_words, repeated = counts[0], counts[4]
            failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
            if own is None:
                quality = np.ones(len(at) - 1)
            else:
                quality = probability(own[1], margins(own[0], data, at, words)[:, None])
            return [*counts, failed, quality, ~failed & (quality >= keep)]

        return compute

    named = fields(
        n_words="long", word_chars="long", n_symbols="long", n_dup_lines="long", n_repeat_words="long",
        base_failed="boolean", quality="double", kept="boolean",
    )
    return add_text_columns(docs, text, named, maker, drop_text)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs, fit_rules(docs, table(spark, sf_dir, "labels")), drop_text=True)
