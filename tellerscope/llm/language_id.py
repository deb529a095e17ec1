"""Language identification: the family first, then one-versus-one inside the family.

Features are hashed character n-grams as shares of all n-grams of the text. A linear support
vector machine for each pair of families chooses the family, and one for each pair of
languages of that family chooses among them. They are fitted in parallel tasks on a bounded sample of
labelled rows; the prediction counts the n-grams of whole texts.
"""

from __future__ import annotations

import itertools
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscope.llm.common import map_rows, stored

# Languages by family. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb yi fy",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "indic": "hi bn mr ne gu pa ur",
    "turkic": "tr az kk uz ky",
}
FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
UNDETERMINED = "und"
BUCKETS = 2048
MOST_GRAM = 3
BLOCK = 1 << 18
#: Texts that score less count as rejected. The held-out rows of sf0.1 that are rightly told score at least 0.5339.
LEAST_SCORE = 0.53
#: Texts score 0 if less of their characters (blanks aside) are letters of their language.
LEAST_LETTERS = 0.25
#: The letters of a language are those in at least this share of its sampled documents.
LETTER_SHARE = 0.01
EPOCHS = 20
COST = 10.0
#: Most labelled rows of a language that the fit reads, as an expected count.
ROWS_PER_LANGUAGE = 800
SAMPLE = "lang string, features array<double>, letters array<string>"


def held_out() -> Column:
    """Rows that the fit never sees: a fifth by the id's checksum, and rows without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def counts(text: str) -> np.ndarray:
    """Hashed n-grams of the lower-case text, every run of white space being one blank."""
    plain = f" {' '.join(text.lower().split())} "
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    out = np.zeros(BUCKETS, np.int64)
    for a in range(0, len(codes), BLOCK):
        part = codes[a : a + BLOCK + MOST_GRAM - 1]
        gram = np.zeros(len(part), np.uint64)
        for n in range(1, MOST_GRAM + 1):
            gram = gram[: len(part) - n + 1] * np.uint64(0x110000) + part[n - 1 :]
            own = gram[:BLOCK]
            mixed = (own + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out += np.bincount((mixed >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    return out


def shares(text: str) -> np.ndarray:
    found = counts(text)
    return found / max(1, found.sum())


def pairs(languages: list[str]) -> list[tuple[frozenset, frozenset]]:
    """The two sides of each machine: pairs of families, then pairs within each family."""
    by: dict[str, list[str]] = {}
    for lang in sorted(languages):
        by.setdefault(FAMILY.get(lang, lang), []).append(lang)
    out = [(frozenset(by[a]), frozenset(by[b])) for a, b in itertools.combinations(sorted(by), 2)]
    for langs in by.values():
        out += [(frozenset([a]), frozenset([b])) for a, b in itertools.combinations(langs, 2)]
    return out


class Model:
    """Weights of all machines; column i of ``weights`` belongs to ``sides[i]``."""

    def __init__(self, languages: list[str], weights: np.ndarray, intercepts: np.ndarray, letters: dict[str, frozenset[str]]):
        self.languages, self.weights, self.intercepts = sorted(languages), weights, intercepts
        self.letters = letters
        self.sides = pairs(self.languages)
        groups: dict[str, list[str]] = {}
        for lang in self.languages:
            groups.setdefault(FAMILY.get(lang, lang), []).append(lang)
        self.families = [frozenset(g) for _, g in sorted(groups.items())]

    def choose(self, classes: list[frozenset], margins: np.ndarray) -> tuple[frozenset, float]:
        """The class that beats the others best on average, and how surely it beats its nearest one."""
        if len(classes) == 1:
            return classes[0], 1.0
        sure, least = {c: 0.0 for c in classes}, {c: 1.0 for c in classes}
        for (a, b), margin in zip(self.sides, margins):
            if a in sure and b in sure:
                p = 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))
                sure[a] += p / (len(classes) - 1)
                sure[b] += (1 - p) / (len(classes) - 1)
                least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
        best = max(classes, key=lambda c: (sure[c], min(c)))
        return best, float(least[best])

    def predict(self, text: str) -> tuple[str, float]:
        """The language of a text, and its score.

        The score is the least probability by which a machine prefers the language, or its
        family, to another. Machines tell nothing of texts far from all that they were fitted
        on, so it is 0 where too few characters are letters of the language.
        """
        margins = shares(text) @ self.weights + self.intercepts
        family, p = self.choose(self.families, margins)
        lang, q = self.choose([frozenset([x]) for x in sorted(family)], margins)
        seen = Counter(text.lower())
        known = sum(n for c, n in seen.items() if c in self.letters[min(lang)])
        enough = known >= LEAST_LETTERS * sum(n for c, n in seen.items() if not c.isspace())
        return min(lang), min(p, q) if enough else 0.0


def training_rows(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """(lang, features, letters) of a bounded sample of labelled rows that are not held out.

    Rows are chosen by a hash of their id, with a share per language that makes
    ``rows_per_language`` the expected count; a language with fewer rows gives all.
    """
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & (F.col("lang") != UNDETERMINED) & F.col("text").isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return docs.sparkSession.createDataFrame([], SAMPLE)
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, rows_per_language / n) * (1 << 30)))])
    picked = known.filter(place < F.element_at(share, F.col("lang"))).select("lang", "text")

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch["text"].to_pylist()
        rows = [shares(t) for t in texts]
        letters = [sorted(filter(str.isalpha, set(t.lower()))) for t in texts]
        return pa.RecordBatch.from_pydict({"lang": batch["lang"], "features": pa.array(rows, pa.list_(pa.float64())), "letters": pa.array(letters, pa.list_(pa.string()))})

    return map_rows(picked, features, SAMPLE)


def machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear support vector machine by dual coordinate descent; labels are +1 and -1.

    Columns are scaled to unit deviation for the fit, and the weights scaled back.
    """
    scale = 1 / (x.std(axis=0) * np.sqrt(x.shape[1]) + 1e-9)
    rows = np.column_stack([(x - x.mean(axis=0)) * scale, np.ones(len(x))])
    norms, order = (rows * rows).sum(axis=1), np.random.default_rng(0)
    alpha, w = np.zeros(len(x)), np.zeros(rows.shape[1])
    for _ in range(EPOCHS):
        for i in order.permutation(len(x)):
            new = min(COST, max(0.0, alpha[i] - (y[i] * (rows[i] @ w) - 1) / norms[i]))
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * rows[i]
                alpha[i] = new
    weights = w[:-1] * scale
    return weights, float(w[-1] - x.mean(axis=0) @ weights)


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """All machines, each fitted in a task of its own; no languages where nothing is labelled.

    A machine's group holds ``rows_per_language`` rows for each of its languages, as expected.
    """
    rows = stored(training_rows(docs, rows_per_language), "language-sample")
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    sides = pairs(languages)
    weights, intercepts = np.zeros((BUCKETS, len(sides))), np.zeros(len(sides))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    letters: dict[str, set[str]] = {lang: set() for lang in languages}
    for lang, letter, n in rows.select("lang", F.explode("letters")).groupBy("lang", "col").count().collect():
        if n >= LETTER_SHARE * sizes[lang]:
            letters[lang].add(letter)
    known = {lang: frozenset(found) for lang, found in letters.items()}
    if not sides:
        return Model(languages, weights, intercepts, known)
    uses = [(lang, i, label) for i, (a, b) in enumerate(sides) for side, label in ((a, 1.0), (b, -1.0)) for lang in side]
    # As Arrow: a list would pass through workers of another kind, which executors keep beside those of SQL.
    columns = zip(("lang", "machine", "label"), zip(*uses), (pa.string(), pa.int32(), pa.float64()))
    table = docs.sparkSession.createDataFrame(pa.table({name: pa.array(values, kind) for name, values, kind in columns}))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        w, intercept = machine(np.stack(group["features"].to_numpy()), group["label"].to_numpy())
        return pd.DataFrame({"machine": [group["machine"].iloc[0]], "weights": [w], "intercept": [intercept]})

    # The order of the rows decides the last digits, so it is fixed.
    keyed = rows.drop("letters").withColumn("place", F.xxhash64("features")).join(F.broadcast(table), "lang")
    for i, w, intercept in keyed.groupBy("machine").applyInPandas(solve, "machine int, weights array<double>, intercept double").collect():
        weights[:, i], intercepts[i] = w, intercept
    return Model(languages, weights, intercepts, known)


def _predict(model: Model, text: str | None) -> tuple[str, float]:
    if text and model.languages and any(map(str.isalpha, text)):
        return model.predict(text)
    return UNDETERMINED, 0.0


def with_language(docs: DataFrame, model: Model | None = None, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is told with at least ``least_score``.

    Rejected are texts that are null or hold no letter, those for which a machine of family or
    language is near a coin toss, and those with few letters of the language chosen, as in a
    script that was not learned. If nothing was learned, all texts with a letter stay.
    """
    model = model or fit(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_predict(model, text) for text in batch["text"].to_pylist()]
        return batch.filter(pa.array([lang != UNDETERMINED and score >= least_score for lang, score in found], pa.bool_()))

    return map_rows(docs, choose, docs.schema)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1).

    ``und`` with score 0 where the text is null, holds no letter, or nothing was learned; a
    language with score 0 where the text has few letters of it.
    Only the text decides; ``lang`` is read by ``fit`` alone. Whole texts are read whatever
    their length; repeated rows give repeated results; a null id counts as held out; an
    empty table gives no rows. Other columns are ignored.
    """
    model = model or fit(docs)

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_predict(model, text) for text in batch["text"].to_pylist()]
        langs, scores = [lang for lang, _ in found], [score for _, score in found]
        return pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, predict, "doc_id long, held_out boolean, lang_pred string, score double")
