"""Text quality by compression: which of two zstandard dictionaries, of good or of bad text, explains a text better.

One dictionary is trained on passages of labelled good texts, one on passages of bad ones, from at most
``DICTIONARY_ROWS`` rows each, one passage of up to ``PASSAGE`` characters per row at a place that its id's hash picks.
A whole text is compressed with either, in stretches of ``STRETCH`` bytes, each from the dictionary alone, so that long texts
lean on it as much as short ones. The difference of the two sizes over the length says which kind it is. Texts that
repeat themselves are short with either, so the share that the good dictionary leaves is a second input. A logistic
regression on at most ``CALIBRATION_ROWS`` other labelled rows of each kind turns the two into a probability.

Rows whose crc32(id) mod 4 is 2 are never learnt from. Null and empty texts have a score like any other (both sizes are the
empty frame's). Without labelled rows of both kinds every score is 0.5. Columns named as results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.labelled import fit_logistic, id_remainder, labelled_sample, probability
from tallyline.llm.tables import add_text_columns, fields, table

DICTIONARY_ROWS = 3000
CALIBRATION_ROWS = 4000
PASSAGE = 4000
DICTIONARY_BYTES = 112_640
LEVEL = 3
STRETCH = 2048
THRESHOLD = 0.7
#: Added to every length, so that the frame's own bytes weigh little in short texts.
SLACK = 16


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    raw: bool


def _dictionary(samples: list[bytes]) -> tuple[bytes, bool]:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes(), False
    except zstandard.ZstdError:  # too little text to train on
        return b"\n".join(samples)[-DICTIONARY_BYTES:], True


def _compressors(model: QualityModel):
    import zstandard

    kind = zstandard.DICT_TYPE_RAWCONTENT if model.raw else zstandard.DICT_TYPE_FULLDICT
    out = []
    for content in (model.good, model.bad):
        parts = zstandard.ZstdCompressionDict(content, dict_type=kind)
        parts.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(
            dict_data=parts, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress)
    return out


def _inputs(model: QualityModel):
    """A function of bytes and offsets: the two inputs of the score for each text."""
    good, bad = _compressors(model)

    def sizes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        raw, cuts = memoryview(data.tobytes()), at.tolist()
        both = np.zeros((len(cuts) - 1, 2))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            parts = [raw[x : min(x + STRETCH, b)] for x in range(a, max(b, a + 1), STRETCH)]
            both[i] = sum(len(good(p)) for p in parts), sum(len(bad(p)) for p in parts)
        length = np.diff(at) + SLACK
        return np.c_[(both[:, 1] - both[:, 0]) / length, both[:, 0] / length]

    return sizes


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> QualityModel | None:
    """A model of ``labels.quality``, or None if one of its values has no row to learn from."""
    sample = labelled_sample(docs, labels, DICTIONARY_ROWS + CALIBRATION_ROWS, "quality", doc_id, text)
    share = DICTIONARY_ROWS / (DICTIONARY_ROWS + CALIBRATION_ROWS)
    for_dictionary = F.pmod(F.xxhash64("order"), F.lit(1000)) < int(1000 * share)
    place = F.pmod(F.xxhash64("order", F.lit(1)), F.greatest(F.length("text") - PASSAGE + 1, F.lit(1)))
    passages = (
        sample.where(for_dictionary)
        .select("label", F.substring("text", (place + 1).cast("int"), F.lit(PASSAGE)).alias("passage"))
        .collect()
    )  # at most 2 * (DICTIONARY_ROWS + CALIBRATION_ROWS) passages
    by_label = {k: sorted(r["passage"].encode() for r in passages if r["label"] == k) for k in (0, 1)}
    if not (by_label[0] and by_label[1]):
        return None
    (good, raw), (bad, raw_bad) = _dictionary(by_label[1]), _dictionary(by_label[0])
    if raw != raw_bad:  # dictionaries of one kind, else their headers weigh differently
        good, bad, raw = *(b"\n".join(by_label[k])[-DICTIONARY_BYTES:] for k in (1, 0)), True
    model = QualityModel(good, bad, (), raw)

    def maker():
        measure = _inputs(model)
        return lambda data, at: list(measure(data, at).T)

    others = add_text_columns(sample.where(~for_dictionary), "text", fields(x0="double", x1="double"), maker)
    rows = others.select("label", "x0", "x1").orderBy("x0", "x1", "label").collect()  # numbers of a bounded sample
    y = np.array([r["label"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return QualityModel(good, bad, (0.0, 40.0, 0.0), raw)
    weights = fit_logistic(np.array([(r["x0"], r["x1"]) for r in rows]), y)
    return QualityModel(good, bad, tuple(weights.tolist()), raw)


def score_quality(
    docs: DataFrame, model: QualityModel | None, text: str = "text", threshold: float = THRESHOLD, drop_text: bool = False
) -> DataFrame:
    """Adds ``score`` (the probability of label 1) and ``predicted`` (1 if it reaches ``threshold``)."""

    def maker():
        if model is None:
            return lambda data, at: [np.full(len(at) - 1, 0.5), np.full(len(at) - 1, 0.5 >= threshold, np.int32)]
        measure, weights = _inputs(model), np.array(model.weights)

        def compute(data, at):
            score = probability(weights, measure(data, at))
            return [score, (score >= threshold).astype(np.int32)]

        return compute

    return add_text_columns(docs, text, fields(score="double", predicted="int"), maker, drop_text)


def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    return score_quality(docs, model, drop_text=True).select("doc_id", held_out.alias("held_out"), "score", "predicted")
