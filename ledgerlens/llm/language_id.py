"""Language identification in two levels: family first, then the languages inside it.

Features are relative frequencies of hashed letter trigrams of the whole text (lower case, everything but letters as one
space).  Linear support vector machines decide: one against the rest for each family, one against one for each pair of
languages of a family, whose votes (then summed margins) choose the language.

Machines are fitted on a bounded sample of labelled texts, drawn per language by a hash of the key: FIT_ROWS texts in all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.common import BATCH_BYTES, add_columns, slices, worker_state

DIMENSIONS = 4_096
FIT_ROWS = 2_000  # sampled texts over all languages; each gives one vector of DIMENSIONS floats
BLOCK = 1 << 20  # characters looked at together
DOCS = 512  # texts whose counts are held together
UNDETERMINED = "und"

# Families of languages by their codes.  A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu", "baltic": "lt lv", "turkic": "az kk ky tr uz", "semitic": "am ar he mt",
    "indo-iranian": "bn fa gu hi mr ne pa ps sd ur", "dravidian": "kn ml ta te", "sinitic": "zh yue", "celtic": "br cy ga gd",
    "austronesian": "id jv ms tl",
}


def family_of(language: str) -> str:
    return next((f for f, codes in FAMILIES.items() if language in codes.split()), language)


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return worker_state("letters", lambda: np.array([chr(i).isalpha() for i in range(0x110000)]))


def trigram_counts(texts: list[str | None], letters: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams, a row per text.  A text is looked at in blocks, so its length is not bounded."""
    counts = np.zeros((len(texts), DIMENSIONS), np.int64)
    # every text stands between spaces, and no trigram spans two texts
    lowered = [" " + (t or "").lower() + " " for t in texts]
    ends = np.cumsum([len(t) for t in lowered])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), "<u4")
    for start in range(0, len(points), BLOCK):
        first = max(0, start - 2)  # two characters again, so that no trigram is lost between blocks
        block = points[first:start + BLOCK].astype(np.int64)
        row = np.searchsorted(ends, np.arange(first, first + len(block)), side="right")
        block[~letters[block]] = 32
        a, b, c = block[:-2], block[1:-1], block[2:]
        word = (b != 32) & (row[:-2] == row[2:])  # a trigram is named by its middle, which is a letter
        hashed = ((a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) >> 7) % DIMENSIONS
        counts += np.bincount(row[1:-1][word] * DIMENSIONS + hashed[word], minlength=counts.size).reshape(counts.shape)
    return counts


@dataclass(frozen=True)
class LanguageModel:
    """Weights (DIMENSIONS + 1 rows, the last for the intercept) of the family and the pair machines."""
    families: list[str]
    family_weights: np.ndarray
    languages: dict[str, list[str]]
    pair_weights: dict[str, np.ndarray]

    def decide(self, counts: np.ndarray) -> tuple[list[str], list[float]]:
        """Language and score of each row of counts.  The score is the product of the logistic margins that decided."""
        x = vectors(counts)
        sure = lambda margin: 1 / (1 + np.exp(-math.log(19) * np.clip(margin, -200, 200)))  # noqa: E731  margin 1: 0.95
        family = x @ self.family_weights
        chosen = family.argmax(axis=1)
        score = sure(family.max(axis=1))
        out = np.empty(len(x), object)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            names = self.languages[name]
            if not len(rows):
                continue
            if len(names) == 1:
                out[rows] = names[0]
                continue
            margins = x[rows] @ self.pair_weights[name]
            votes, sums = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
            least = np.full((len(rows), len(names)), np.inf)
            for m, (i, j) in zip(margins.T, combinations(range(len(names)), 2)):
                votes[:, i] += m >= 0
                votes[:, j] += m < 0
                for k, signed in ((i, m), (j, -m)):
                    sums[:, k] += signed
                    least[:, k] = np.minimum(least[:, k], signed)
            best = (votes + 1e-6 * np.tanh(sums)).argmax(axis=1)
            out[rows] = np.array(names, object)[best]
            score[rows] *= sure(least[np.arange(len(rows)), best])
        return out.tolist(), score.tolist()


def vectors(counts: np.ndarray) -> np.ndarray:
    """Root of the relative frequencies (unit length) and a constant."""
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    out = np.ones((len(counts), counts.shape[1] + 1))
    share = np.divide(counts, total, out=out[:, :-1])
    np.sqrt(share, out=share)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None, cost: float = 10.0, rounds: int = 30,
               seed: int = 42) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss, classes weighted to equal sums, by dual coordinate descent.

    `y` are the marks (1 or -1) of the given rows of `x`, by default of all; no part of `x` is copied.
    """
    rows = np.arange(len(x)) if rows is None else rows
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    diagonal = share / cost  # 1 / (2 C_i) with C_i = cost / (2 share)
    squares = np.array([x[r] @ x[r] for r in rows]) + diagonal
    alpha, w = np.zeros(len(rows)), np.zeros(x.shape[1])
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in random.permutation(len(rows)):
            own = x[rows[i]]
            new = max(0.0, alpha[i] - (y[i] * (own @ w) - 1 + diagonal[i] * alpha[i]) / squares[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * own
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def fit_model(languages: list[str], x: np.ndarray) -> LanguageModel:
    """Machines for labelled vectors; at least one row is needed."""
    family = np.array([family_of(n) for n in languages])
    label, families = np.array(languages), sorted(set(family))
    if len(families) == 1:
        tops = np.zeros((x.shape[1], 1))
        tops[-1] = 1.0  # the only family, with margin 1
    else:
        tops = np.stack([linear_svm(x, np.where(family == f, 1.0, -1.0)) for f in families], axis=1)
    members = {f: sorted(set(label[family == f])) for f in families}
    pairs = {}
    for f, names in members.items():
        machines = []
        for a, b in combinations(names, 2):
            rows = np.flatnonzero((label == a) | (label == b))
            machines.append(linear_svm(x, np.where(label[rows] == a, 1.0, -1.0), rows))
        if machines:
            pairs[f] = np.stack(machines, axis=1)
    return LanguageModel(families, tops, members, pairs)


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", rows: int = FIT_ROWS,
        seed: int = 42) -> LanguageModel:
    """Fit on (key, text, language).  Rows without a language or a letter are left out; if none is left, the model
    answers `und` for every text.

    Each language gives about rows / languages texts, those whose hashed key is below the share this needs; very short
    tables give all their rows.
    """
    known = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(language).alias("language")).where(
        "language is not null and text is not null")
    sizes = known.groupBy("language").count().collect()  # one row per language
    if not sizes:
        return fit_model([UNDETERMINED], np.zeros((1, DIMENSIONS + 1)))
    each = max(1, rows // len(sizes))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 30))
    limit = F.create_map(*[c for r in sizes for c in (F.lit(r["language"]), F.lit(int((1 << 30) * min(1.0, each / r["count"]))))])
    sample = known.where(draw < limit[F.col("language")]).select("language", "text")
    schema = pa.schema([("language", pa.string()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES // 4):
                for start in range(0, batch.num_rows, DOCS):
                    part = batch.slice(start, DOCS)
                    counts = trigram_counts(part.column("text").to_pylist(), letters)
                    good = counts.sum(axis=1) > 0
                    names = [n for n, g in zip(part.column("language").to_pylist(), good) if g]
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(
                        [_packed(c) for c in counts[good]], pa.binary())], schema=schema)

    # at most about 1.3 * rows (a hash draw) sparse vectors of up to DIMENSIONS places, ordered so that a fit repeats
    found = sample.mapInArrow(count, "language string, counts binary").limit(2 * rows + 1_000).toArrow()
    pairs = sorted(zip(found.column("language").to_pylist(), found.column("counts").to_pylist()))
    del found
    if not pairs:
        return fit_model([UNDETERMINED], np.zeros((1, DIMENSIONS + 1)))
    x = np.ones((len(pairs), DIMENSIONS + 1), np.float32)  # one matrix, filled row by row, as `vectors` makes it
    x[:, :-1] = 0
    for row, (_, packed) in zip(x, pairs):
        cells = np.frombuffer(packed, "<u4").reshape(2, -1)
        row[cells[0]] = np.sqrt(cells[1].astype(np.float32) / np.float32(cells[1].sum()))
    return fit_model([p[0] for p in pairs], x)


def _packed(counts: np.ndarray) -> bytes:
    places = np.flatnonzero(counts)
    return np.stack([places, counts[places]]).astype("<u4").tobytes()


def predict(df: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` with `lang_pred` and `score` (0 to 1) of each whole text; `und` and 0 for NULL or a text without a letter.

    Rows are not moved; input columns with these names are replaced.  `keep` names the columns of `df` that come back.
    """
    return add_columns(df, text, "lang_pred string, score double", _predictor(model), keep=keep)


def _predictor(model: LanguageModel) -> Callable:
    def make():
        letters = _letters()

        def work(texts: list[str | None]) -> list[list]:
            names, scores = [], []
            for start in range(0, len(texts), DOCS):
                counts = trigram_counts(texts[start:start + DOCS], letters)
                decided, sure = model.decide(counts)
                for total, name, s in zip(counts.sum(axis=1).tolist(), decided, sure):
                    names.append(name if total else UNDETERMINED)
                    scores.append(float(s) if total and name != UNDETERMINED else 0.0)
            return [names, scores]
        return work
    return make


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of the key as text leaves no remainder; a NULL key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds == 0
