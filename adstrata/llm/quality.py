"""Quality scores from compression: which of two zstandard dictionaries shortens a text more.

One dictionary is trained on text labelled good, one on text labelled bad. A text is cut into pieces
of `PIECE` bytes, so that the dictionaries matter throughout a long text, and every piece is
compressed with both. The difference of the two sizes over their sum is the text's main feature; the
same difference of its worst piece, the difference weakened for short texts, and the better size over
the plain size (a repetitive text is short under either dictionary) come beside it. A logistic
regression over these, fitted on rows that no dictionary has seen, makes them a calibrated score.

Fitting reads at most `sample_rows` labelled rows, those with the smallest hashes of their ids, and
takes at most `lines` lines of at most `PIECE` bytes for each dictionary (the fit's documented
bounds; half of the sampled rows build dictionaries, the others calibrate). Lines that stand in more
than one sampled row are left out of the dictionaries: a passage that many documents share says
nothing about their quality. Scoring is one narrow pass over all whole texts.

Nulls: a null text is empty; an empty text has sizes of zero and scores as the regression's bias
does, which is low. Rows keep their number, order of columns and ids, null or repeated. Several
labels of one id count as good if all are; null labels and labels without id are ignored. Without
rows of both labels the score is the share of good labels, 0.5 without any. A table without rows gives
a table without rows; columns of other names pass through `scored`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .toxicity import crc_of_id, fit_logistic

SAMPLE_ROWS = 20_000
LINES = 30_000
PIECE = 1024
DICTIONARY = 32_768
LEVEL = 3
SHORT = 200
#: Scales that bring the features to comparable sizes, so one ridge serves all.
SCALES = np.array([1.0, 10.0, 5.0, 10.0, 10.0])


def pieces_of(data: bytes, size: int = PIECE) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


def build_dictionary(lines: list[str], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; the lines themselves where there is too little text to train on."""
    samples, held, length = [], [], 0
    for line in lines:
        held.append(line.encode("utf-8", "surrogatepass"))
        length += len(held[-1]) + 1
        if length >= PIECE:
            samples.append(b"\n".join(held))
            held, length = [], 0
    if held:
        samples.append(b"\n".join(held))
    # Training wants many samples and several times the dictionary's size.
    size = min(size, sum(map(len, samples)) // 8)
    if len(samples) >= 16 and size >= 1024:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"\n".join(samples)[:DICTIONARY]


class Measure:
    """The two compressors of a task, and the features of a text."""

    def __init__(self, good: bytes, bad: bytes, level: int = LEVEL):
        self.good, self.bad = self._compressor(good, level), self._compressor(bad, level)
        self.empty = len(self.good.compress(b"")), len(self.bad.compress(b""))

    @staticmethod
    def _compressor(data: bytes, level: int) -> zstandard.ZstdCompressor:
        options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if not data:
            return zstandard.ZstdCompressor(**options)
        known = zstandard.ZstdCompressionDict(data)
        known.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=known, **options)

    def features(self, text: str | None) -> list[float]:
        data = (text or "").encode("utf-8", "surrogatepass")
        good = bad = 0
        worst = 1.0
        for piece in pieces_of(data):
            g = len(self.good.compress(piece)) - self.empty[0]
            b = len(self.bad.compress(piece)) - self.empty[1]
            good, bad = good + g, bad + b
            if len(piece) > SHORT or len(data) <= PIECE:
                worst = min(worst, (b - g) / max(b + g, 1))
        difference = (bad - good) / max(bad + good, 1)
        return [
            1.0, difference, min(good, bad) / max(len(data), 1), worst if data else 0.0,
            difference * min(1.0, len(data) / SHORT),
        ]


@dataclass
class Model:
    good: bytes
    bad: bytes
    beta: np.ndarray | None
    share: float

    def score(self, values: list[float]) -> float:
        if self.beta is None:
            return self.share
        return float(1 / (1 + np.exp(-np.clip(float(np.dot(np.array(values) * SCALES, self.beta)), -30, 30))))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct lines of every row, long ones in pieces."""
    for batch in batches:
        out: dict[str, list] = {"number": [], "good": [], "at": [], "line": []}
        for number, good, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            cut = [line[i : i + PIECE // 4] for line in (text or "").split("\n") for i in range(0, len(line), PIECE // 4)]
            for at, line in enumerate(dict.fromkeys(cut)):
                for name, value in zip(out, (number, good, at, line), strict=True):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, pa.schema(
            [("number", pa.int64()), ("good", pa.int32()), ("at", pa.int32()), ("line", pa.string())]
        ))


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, lines: int = LINES, dictionary: int = DICTIONARY,
) -> Model:
    """Dictionaries and weights from labelled rows (doc_id, quality) of documents (doc_id, text)."""
    labels = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id").agg(F.min((F.col("quality") == 1).cast("int")).alias("good"))
    )
    n = labels.count()
    number = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    labels = labels.withColumn("number", number)
    if n > sample_rows:
        # The hash leaves a few more than wanted; the smallest hashes of them are the sample.
        labels = labels.where(F.col("number") < int((1 << 40) * min(1.0, 1.1 * sample_rows / n)))
        labels = labels.orderBy("number", "doc_id").limit(sample_rows)
    # At most `sample_rows` rows of three numbers.
    sample = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("number", "good", "text")
    for_dictionary = F.col("number") % 2 == 0
    found = (
        sample.where(for_dictionary)
        .mapInArrow(_lines, "number long, good int, at int, line string")
        .groupBy("line")
        .agg(F.count("*").alias("n"), F.min("number").alias("number"), F.min("good").alias("good"), F.min("at").alias("at"))
        .where("n = 1")
        .drop("n")
        .cache()
    )
    dictionaries = []
    for good in (1, 0):
        rows = found.where(F.col("good") == good).orderBy("number", "at", "line").limit(lines).collect()
        dictionaries.append(build_dictionary([r["line"] for r in rows], dictionary))
    found.unpersist()
    model = Model(*dictionaries, None, 0.5)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Measure(model.good, model.bad)
        for batch in batches:
            rows = [sizes.features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["good", "x"])

    rows = (
        sample.where(~for_dictionary).mapInArrow(measure, "good int, x array<double>")
        .groupBy("good", "x").count().orderBy("good", "x").collect()
    )
    y, weights = np.array([float(r["good"]) for r in rows]), np.array([float(r["count"]) for r in rows])
    if len(rows):
        model.share = float(np.average(y, weights=weights))
    if len(set(y)) == 2:
        model.beta = fit_logistic(np.array([r["x"] for r in rows]) * SCALES, y, weights)
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "__score") -> DataFrame:
    """The given rows and columns with the score in a column of its own."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Measure(model.good, model.bad)
        for batch in batches:
            scores = [model.score(sizes.features(t.as_py())) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{out}` double")


def report(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, **options) -> DataFrame:
    """Scores of all documents by a model that never saw the held-out rows' labels."""
    model = fit(docs, labels.where(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) != 0), **options)
    result = scored(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) == 0, F.lit(False))
    return result.select(
        "doc_id", held_out.alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"),
    )
