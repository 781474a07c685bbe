"""Toxicity scores from a learned lexicon, matched with errors, and the context of every match.

The lexicon holds words and word beginnings that stand mostly in texts labelled toxic; it lives in a
trie. Unknown words are looked up by walking the trie together with a Levenshtein automaton of the
word (a bit-parallel one, states are places in the word, one mask per number of errors), so
misspelled terms are found without comparing terms one by one. Each match gets a weight from its
window: quotation marks around it or a word of reporting lower it, an address of the reader raises
it. A logistic regression over these sums gives the score.

Learning uses at most `sample_rows` labelled rows, taken by hash of the document id (the fit's
documented bound; the rows are the only ones whose labels are read). Scoring is one narrow pass over
all whole texts with the lexicon (at most `lexicon_terms` terms) in the task.

Nulls: a null text is empty; an empty text has no match and scores as such a text does. Rows keep
their number and their ids, null or repeated. Several labels of one id count as toxic if one is;
null labels and labels without id are ignored. Without both labels the score is 0 for a text without
match and 1 with one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RAW_WORD, words_of

SAMPLE_ROWS = 20_000
LEXICON_TERMS = 5_000
STEMS = (4, 5, 6)
MIN_FUZZY = 5
SPAN = 6
#: Words of the window that report someone else's words, and that address the reader.
REPORTS = frozenset(
    "said says say called calls wrote quote quoted quotes word words term terms cited sagte nannte schrieb zitat"
    " dit appelle cite mot dijo dice llama palabra".split()
)
ADDRESSES = frozenset("you your yours youre u ur du dich dir dein tu te toi vous ton tes usted tus".split())
QUOTES = frozenset("\"'“”„«»‘’`")
N_FEATURES = 7


class Trie:
    """Terms as nested dictionaries; the empty key marks a term's end."""

    def __init__(self, terms: Iterable[str]):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = term

    def within(self, word: str, errors: int = 1) -> str | None:
        """A term at most `errors` edits away: intersection of trie and Levenshtein automaton."""
        places: dict[str, int] = {}
        for i, c in enumerate(word):
            places[c] = places.get(c, 0) | 1 << i
        accept = 1 << len(word)
        full = (accept << 1) - 1
        start, masks = [], 1
        for _ in range(errors + 1):
            start.append(masks)
            masks = (masks | masks << 1) & full
        work = [(self.root, start)]
        while work:
            node, state = work.pop()
            if "" in node and state[errors] & accept:
                return node[""]
            for c, below in node.items():
                if not c:
                    continue
                fits, after, before = places.get(c, 0), [], 0
                for e, mask in enumerate(state):
                    now = (mask & fits) << 1
                    if e:
                        # an extra letter in the term, another letter, or a letter too many in the word
                        now |= state[e - 1] | state[e - 1] << 1 | before << 1
                    before = now & full
                    after.append(before)
                if after[errors]:
                    work.append((below, after))
        return None


class Lexicon:
    """Matches single words: 1 a term, 2 a word with a toxic beginning, 3 a misspelled term, 0 none.

    `spellings` are the learned words that a beginning covers; only misspellings of them need them.
    """

    def __init__(self, words: Iterable[str], stems: Iterable[str], spellings: Iterable[str] = ()):
        self.words, self.stems = frozenset(words), frozenset(stems)
        long = sorted(w for w in self.words.union(spellings) if len(w) >= MIN_FUZZY)
        self.trie = Trie(long)
        # One edit leaves the first or the second half of a term as it is.
        self.heads = frozenset(w[: len(w) // 2] for w in long)
        self.tails = frozenset(w[len(w) // 2 :] for w in long)
        self.stem_sizes = sorted({len(x) for x in self.stems})
        self.clean: set[bytes] = set()
        self.toxic: dict[bytes, int] = {}

    def kinds(self, words: set[bytes]) -> dict[bytes, int]:
        """The words that match, with their kind; words seen before are only looked up."""
        if len(self.clean) >= 500_000:
            self.clean.clear()
        for word in words.difference(self.clean):
            if word not in self.toxic:
                kind = self._kind(word.decode("utf-8", "surrogatepass"))
                if kind:
                    self.toxic[word] = kind
                else:
                    self.clean.add(word)
        return {w: self.toxic[w] for w in words if w in self.toxic} if not self.toxic.keys().isdisjoint(words) else {}

    def _kind(self, word: str) -> int:
        if word in self.words:
            return 1
        for size in self.stem_sizes:
            if word[:size] in self.stems:
                return 2
        n = len(word)
        if n < MIN_FUZZY - 1:
            return 0
        # Halves of terms one letter shorter, as long and one letter longer than the word.
        heads, tails = self.heads, self.tails
        half = n // 2
        if (
            word[:half] in heads or word[half:] in tails
            or word[: (n - 1) // 2] in heads or word[: (n + 1) // 2] in heads
            or word[(n - 1) // 2 + 1 :] in tails or word[(n + 1) // 2 - 1 :] in tails
        ):
            return 3 if self.trie.within(word) else 0
        return 0


def context_weight(text: str, places: list[tuple[int, int]], at: int) -> tuple[float, bool]:
    """Weight of the match at word `at`, and whether it stands in quotation."""
    first, last = max(0, at - SPAN), min(len(places) - 1, at + SPAN)
    before = text[places[first][0] : places[at][0]]
    after = text[places[at][1] : places[last][1] + 1]
    near = {w.decode("utf-8", "surrogatepass") for w in words_of(before) + words_of(after)}
    marks = sum(c in QUOTES for c in before if c != "'"), sum(c in QUOTES for c in after if c != "'")
    quoted = bool(marks[0] % 2 and marks[1]) or bool(near & REPORTS)
    addressed = bool(near & ADDRESSES)
    return (0.3 if quoted else 1.0) + (0.5 if addressed else 0.0), quoted and not addressed


def features(lexicon: Lexicon, text: str | None) -> list[float]:
    """Sums of match weights per kind, quoted share, density and a bias."""
    words = words_of(text)
    toxic = lexicon.kinds(set(words))
    if not toxic:
        return [1.0] + [0.0] * (N_FEATURES - 1)
    places = [m.span() for m in RAW_WORD.finditer(text)]
    sums, n, quoted = [0.0, 0.0, 0.0], 0, 0
    for at, word in enumerate(words):
        kind = toxic.get(word)
        if kind:
            weight, is_quoted = context_weight(text, places, at)
            sums[kind - 1] += weight
            n += 1
            quoted += is_quoted
    # Dense places count alike in short and long texts.
    return [1.0, *np.log1p(sums).tolist(), 1.0, quoted / n, min(1.0, 20.0 * n / len(words))]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of words and beginnings in toxic and other texts."""
    for batch in batches:
        toxic, other = Counter(), Counter()
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w.decode("utf-8", "surrogatepass") for w in set(words_of(text))}
            terms = {f"w{w}" for w in words}
            terms |= {f"s{w[:n]}" for w in words for n in STEMS if len(w) >= n}
            (toxic if label else other).update(terms)
        names = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_pydict(
            {"term": names, "toxic": [toxic[t] for t in names], "other": [other[t] for t in names]},
            pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("other", pa.int64())]),
        )


def without_repeats(terms: dict[str, int]) -> tuple[list[str], list[str], list[str]]:
    """Words and beginnings, each spelling kept once, and the words left to a beginning.

    A beginning that one word makes up is that word; other words that begin so are left to it, and so
    are longer beginnings.
    """
    words = {t[1:]: n for t, n in terms.items() if t[0] == "w"}
    stems = {t[1:]: n for t, n in terms.items() if t[0] == "s"}
    most = Counter()
    for word, n in words.items():
        for length in STEMS:
            if len(word) >= length:
                most[word[:length]] = max(most[word[:length]], n)
    real = {s for s, n in stems.items() if most[s] < 0.8 * n}
    begins = lambda text, lengths: any(text[:n] in real for n in lengths if n <= len(text))
    kept = sorted(s for s in real if not begins(s, range(min(STEMS), len(s))))
    covered = {w for w in words if begins(w, STEMS)}
    return sorted(words.keys() - covered), kept, sorted(covered)


class Model:
    def __init__(self, words: list[str], stems: list[str], beta: np.ndarray | None, spellings: Iterable[str] = ()):
        self.words, self.stems, self.beta, self.spellings = words, stems, beta, list(spellings)

    def lexicon(self) -> Lexicon:
        return Lexicon(self.words, self.stems, self.spellings)

    def score(self, values: list[float]) -> float:
        if self.beta is None:
            return float(values[4] > 0)
        return float(1 / (1 + np.exp(-np.clip(float(np.dot(values, self.beta)), -30, 30))))


def crc_of_id(column: F.Column) -> F.Column:
    return F.crc32(column.cast("string").cast("binary"))


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, lexicon_terms: int = LEXICON_TERMS,
    min_support: int = 5, min_share: float = 0.5, z: float = 2.0,
) -> Model:
    """Lexicon and weights from labelled rows (doc_id, toxic) of documents (doc_id, text)."""
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = labels.count()
    if n > sample_rows:
        # The hash leaves a few more than wanted; the smallest hashes of them are the sample.
        share = int((1 << 30) * min(1.0, 1.1 * sample_rows / n))
        number = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
        labels = labels.where(number < share).orderBy(number, "doc_id").limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select(F.col("toxic").cast("int").alias("toxic"), "text")
    counts = (
        sample.mapInArrow(_terms, "term string, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
        .where(F.col("t") >= min_support)
    )
    # Wilson's lower bound of the share of toxic texts among those with the term.
    m, share = F.col("t") + F.col("o"), F.col("t") / (F.col("t") + F.col("o"))
    low = (share + z * z / (2 * m) - z * F.sqrt(share * (1 - share) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    best = counts.select("term", "t", low.alias("low")).where(F.col("low") >= min_share).orderBy(F.desc("t"), "term").limit(lexicon_terms)
    words, stems, spellings = without_repeats({r["term"]: r["t"] for r in best.collect()})
    model = Model(words, stems, None, spellings)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for batch in batches:
            rows = [features(lexicon, t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "x"])

    rows = sample.mapInArrow(measure, "toxic int, x array<double>").groupBy("toxic", "x").count().orderBy("toxic", "x").collect()
    y = np.array([float(r["toxic"]) for r in rows])
    if len(set(y)) == 2:
        weights = np.array([r["count"] for r in rows], float)
        x = np.array([r["x"] for r in rows])
        model.beta = fit_logistic(x, y, weights)
    return model


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 0.01, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression of weighted rows by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (y - p)) - ridge * beta
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        move = np.linalg.solve(hessian, gradient)
        beta += np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-8:
            break
    return beta


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The given rows and columns with `__score`."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for batch in batches:
            scores = [model.score(features(lexicon, t.as_py())) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "__score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, __score double")


def report(docs: DataFrame, labels: DataFrame, folds: int = 5, **options) -> DataFrame:
    """Scores of all documents by a model that never saw the held-out rows' labels."""
    model = fit(docs, labels.where(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) != 0), **options)
    result = scored(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) == 0, F.lit(False))
    return result.select(
        "doc_id", held_out.alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows that score below the threshold, columns unchanged."""
    model = fit(docs, labels, **options)
    return scored(docs, model).where(F.col("__score") < threshold).select(*docs.columns)
