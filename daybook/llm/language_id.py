"""Language ID by hierarchical discrimination.

A text is first given a language family, then a language within it. Each
decision is one-versus-one between classes: linear support vector machines
(squared hinge loss) over the shares of hashed letter bigrams and trigrams of
the whole text, trained here on labelled rows.

Training takes at most ``MAX_ROWS`` documents of each language, those of the
smallest hash of their id: the filter on that hash leaves about this many
before anything is shuffled. Only their hashed counts reach the driver, at
most ``DIM`` numbers a document. Prediction reads every text whole, on the
executors, with no shuffle.

Cases: a null text, or one without a letter, is ``und`` with score 0, and so is
every text if no labelled row was given; a language outside ``FAMILIES`` is a
family of its own; a single class is predicted for all; rows that share an id
are separate rows; a null id trains as any other; texts may be of any length;
extra columns are not read; more than ``MAX_LANGUAGES`` labels are an error, as
the machines are one for each pair of a decision.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches, by_bytes, fresh, in_arrow, table
from daybook.llm.source_mix import uniform

# Families of closely related languages, by ISO code.
FAMILIES = {
    "germanic": ["en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb"],
    "romance": ["fr", "es", "pt", "it", "ca", "ro", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
}
UNKNOWN = "und"
#: Labelled documents of each language that training takes at most.
MAX_ROWS = 600
MAX_LANGUAGES = 200
#: Hashed features: one half for bigrams, one for trigrams.
DIM = 8192
#: Slope of the logistic curve that maps a margin to a share of belief.
SLOPE = 2.0
#: Bytes of text that a worker takes apart at a time, or one longer text.
STEP_BYTES = 1 << 20

_WORD = re.compile(r"[^\W\d_]+")


def _text_of_letters(text: str | None) -> str:
    """Lower-case words between single blanks, two blanks at the end."""
    words = _WORD.findall(text.lower()) if text else []
    return f" {' '.join(words)}  " if words else ""


def _grams(text: str) -> np.ndarray:
    """Hashed bigrams and trigrams of prepared texts: (2, characters - 2)."""
    a = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    two = a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA77)
    three = two * np.uint32(0xC2B2AE3D) + a[2:] * np.uint32(0x27D4EB2F)
    half = DIM // 2
    mixed = [x ^ (x >> np.uint32(15)) for x in (two, three)]
    return np.stack([(x * np.uint32(0x2C1B3C6D) >> np.uint32(20)) % half + k * half for k, x in enumerate(mixed)])


def features(text: str | None) -> np.ndarray:
    """Counts of hashed grams."""
    prepared = _text_of_letters(text)
    return np.bincount(_grams(prepared).ravel(), minlength=DIM) if prepared else np.zeros(DIM, int)


def _svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Weights and bias of a linear SVM of squared hinge loss, by accelerated
    gradient steps; both classes weigh the same."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(x.dtype)
    rate = 1 / (2 * (weight * (np.einsum("ij,ij->i", x, x) + 1)).sum() + ridge)
    w = v = np.zeros(x.shape[1] + 1, x.dtype)
    for k in range(steps):
        pull = weight * y * np.maximum(0, 1 - y * (x @ v[:-1] + v[-1]))
        new = v - rate * (ridge * v - 2 * np.append(x.T @ pull, pull.sum()))
        v, w = new + k / (k + 3) * (new - w), new
    return w


class Model:
    """Decisions: lists of (name, [(i, j, weights, bias)], classes); the first is
    over families, then one for each family of several languages."""

    def __init__(self, labels: list[str], x: np.ndarray, families: dict[str, list[str]] = FAMILIES):
        of = {lang: family for family, langs in families.items() for lang in langs}
        langs = sorted(set(labels))
        self.families: dict[str, list[str]] = {}
        for lang in langs:
            self.families.setdefault(of.get(lang, lang), []).append(lang)
        lab = np.array(labels, dtype=object)
        self.scale = 1.0
        if len(x):
            # In place: the counts are the largest thing on the driver.
            x /= np.maximum(x.sum(1, keepdims=True), 1)
            self.scale = float(1 / np.sqrt(np.einsum("ij,ij->i", x, x).mean()))
            x *= np.float32(self.scale)
        fam = np.array([of.get(a, a) for a in labels], dtype=object)
        self.machines: list[np.ndarray] = []
        self.top = self._train(sorted(self.families), fam, x)
        self.within = {f: self._train(ls, lab, x) for f, ls in self.families.items()}

    def _train(self, classes: list[str], labels: np.ndarray, x: np.ndarray):
        pairs = []
        for i, j in itertools.combinations(range(len(classes)), 2):
            a, b = labels == classes[i], labels == classes[j]
            rows = a | b
            pairs.append((i, j, len(self.machines)))
            self.machines.append(_svm(x if rows.all() else x[rows], np.where(a[rows], 1, -1).astype(np.float32)))
        return classes, pairs

    def _decide(self, node, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winning class of each text and its mean belief against the others."""
        classes, pairs = node
        if len(classes) == 1:
            return np.zeros(margins.shape[1], int), np.ones(margins.shape[1])
        belief = np.zeros((len(classes), margins.shape[1]))
        for i, j, m in pairs:
            p = 1 / (1 + np.exp(-SLOPE * np.clip(margins[m], -50, 50)))
            belief[i] += p
            belief[j] += 1 - p
        best = belief.argmax(0)
        return best, belief[best, np.arange(len(best))] / (len(classes) - 1)

    def lowest_scores(self) -> dict[str, float]:
        """The least score each language can have. The mean beliefs of a decision
        sum to half its classes, so the winner has a half at least; a decision of
        one class is certain."""
        top = 0.5 if len(self.families) > 1 else 1.0
        return {lang: top * (0.5 if len(langs) > 1 else 1.0) for langs in self.families.values() for lang in langs}

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        prepared = [_text_of_letters(t) for t in texts]
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        some = [k for k, t in enumerate(prepared) if t]
        if not some or not self.families:
            return langs, scores
        sizes = np.array([len(prepared[k]) for k in some])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        # Texts start with a blank and end with two: no gram mixes the letters of two.
        grams = _grams("".join(prepared[k] for k in some) + "  ")
        margins = np.zeros((len(self.machines), len(some)))
        for m, w in enumerate(self.machines):
            total = sum(np.add.reduceat(w[g], starts, dtype=np.float64) for g in grams)
            margins[m] = total / (2 * sizes) * self.scale + w[-1]
        names = sorted(self.families)
        family, sure = self._decide(self.top, margins)
        for f, name in enumerate(names):
            best, part = self._decide(self.within[name], margins)
            for at in np.flatnonzero(family == f):
                langs[some[at]] = self.families[name][best[at]]
                scores[some[at]] = sure[at] * part[at]
        return langs, scores


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, places of the counts that are not 0, these counts) of (label, text); one text's ``DIM`` counts are held."""
    for b in batches:
        at, n = [], []
        for text in b.column(1).to_pylist():
            found = features(text)
            places = np.flatnonzero(found)
            at.append(places.astype(np.uint16).tobytes())
            n.append(found[places].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.binary()), pa.array(n, pa.binary())], ["label", "at", "n"])


def train(labelled: DataFrame, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          families: dict[str, list[str]] = FAMILIES, max_rows: int = MAX_ROWS) -> Model:
    """A model of at most ``max_rows`` documents of each label of ``labelled``."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).alias("label"),
                           F.col(text_col).alias("text")).where("label IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    if not counts:
        return Model([], np.zeros((0, DIM)), families)
    # Half as many again as are wanted, so that too few are as good as never left.
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["label"], min(1.0, 1.5 * max_rows / r["count"]))))
    key = uniform(F.lit("train"), F.coalesce(F.col("id"), F.lit("null")))
    order = Window.partitionBy("label").orderBy("key", F.md5("text"))
    sample = (rows.withColumn("key", key).where(F.col("key") < F.element_at(share, F.col("label")))
              .withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_rows).select("label", "text"))

    got = in_arrow(sample, _counted, "label string, at binary, n binary").collect()
    got = sorted((r for r in got if r["at"]), key=lambda r: (r["label"], bytes(r["at"]), bytes(r["n"])))
    x = np.zeros((len(got), DIM), np.float32)
    for row, r in zip(x, got):
        row[np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["n"], np.float32)
    return Model([r["label"] for r in got], x, families)


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """``docs`` with the language and its score; where ``docs`` has columns of these
    names, the new ones are the last two all the same (see ``fresh``). Only texts go
    to Python."""
    found, lang, score = fresh(docs, "found", lang_col, score_col)
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("lang string, score double")
    def language(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for part in by_bytes(texts, STEP_BYTES):
            one, two = model.predict(part.to_pylist())
            langs += one
            scores.append(two)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))],
                                          ["lang", "score"])

    return (docs.withColumn(found, language(F.col(f"`{text_col}`")))
            .select(*(F.col(f"`{c}`") for c in docs.columns), F.col(f"{found}.lang").alias(lang), F.col(f"{found}.score").alias(score)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def train_on_documents(docs: DataFrame) -> Model:
    return train(docs.where(F.coalesce(~held_out(), F.lit(True))))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), train_on_documents(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
