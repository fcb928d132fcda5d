"""Toxicity classifier that is held to equal scores when identity terms are swapped."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import labelled_sample, small_batches, written

# Interchangeable identity terms in English, French, German and Spanish; the first of each group is neutral.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys", "wives", "husbands"),
    ("person", "woman", "man", "girl", "boy", "wife", "husband"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("believer", "christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("human", "black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("adult", "gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual"),
    ("resident", "immigrant", "refugee", "foreigner", "citizen", "native"),
    ("individual", "disabled", "deaf", "blind", "elderly", "young", "old"),
    ("personnes", "femmes", "hommes", "filles", "garçons", "épouses", "maris"),
    ("croyants", "chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("humain", "noir", "blanc", "asiatique", "africain", "européen", "arabe", "autochtone"),
    ("adulte", "homosexuel", "lesbienne", "bisexuel", "transgenre", "hétérosexuel"),
    ("résident", "immigré", "réfugié", "étranger", "citoyen"),
    ("menschen", "frauen", "männer", "mädchen", "jungen", "ehefrauen", "ehemänner"),
    ("gläubige", "christen", "muslime", "juden", "buddhisten", "atheisten"),
    ("menschlich", "schwarz", "weiß", "asiatisch", "afrikanisch", "europäisch", "arabisch"),
    ("erwachsen", "schwul", "lesbisch", "bisexuell", "heterosexuell"),
    ("einwohner", "einwanderer", "flüchtling", "ausländer", "bürger"),
    ("personas", "mujeres", "hombres", "niñas", "niños", "esposas", "maridos"),
    ("creyentes", "cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("humano", "negro", "blanco", "asiático", "africano", "europeo", "árabe", "indígena"),
    ("adulto", "homosexual", "lesbiana", "transgénero"),
    ("residente", "inmigrante", "refugiado", "extranjero", "ciudadano"),
)

_WORD = re.compile(r"\w+")
#: Words whose contexts are counted at most, places that contexts are hashed to, and words in a derived group at most.
NEUTRAL, PLACES, GROUP = 96, 512, 6

Groups = Sequence[Sequence[str]]


def others(groups: Groups) -> dict[str, list[str]]:
    """For each term what it may be swapped with; a term of several groups belongs to the first."""
    out: dict[str, list[str]] = {}
    for group in groups:
        for term in group:
            out.setdefault(term, [t for t in group if t != term])
    return out


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def swapped(words: list[str], seed: str, swaps: dict[str, list[str]]) -> list[str] | None:
    """The words with every term replaced by another of its group; None if there is none."""
    if not any(w in swaps for w in words):
        return None
    chance = random.Random(seed)
    return [chance.choice(swaps[w]) if w in swaps else w for w in words]


def alike_in_context(contexts: dict[str, np.ndarray], least: float) -> list[list[str]]:
    """Groups of words whose contexts have a cosine of at least this; each word is in one group at most."""
    names = sorted(contexts)
    if not names:
        return []
    x = np.array([contexts[w] for w in names], float)
    x = np.log1p(x) / np.maximum(np.linalg.norm(np.log1p(x), axis=1, keepdims=True), 1e-9)
    near = x @ x.T
    left = np.ones(len(names), bool)
    out = []
    for i in range(len(names)):
        if left[i]:
            at = [int(j) for j in np.argsort(-near[i], kind="stable") if left[j] and near[i, j] >= least][:GROUP]
            if len(at) > 1:
                left[at] = False
                out.append([names[j] for j in at])
    return out


def features_of(words: list[str]) -> Counter:
    """Counts of whole words and of their first four and five letters."""
    counts: Counter = Counter()
    for w, n in Counter(words).items():
        counts["w:" + w] += n
        if len(w) > 4:
            counts["4:" + w[:4]] += n
        if len(w) > 5:
            counts["5:" + w[:5]] += n
    return counts


@dataclass(frozen=True)
class ToxicityModel:
    """A weight for each chosen feature; a feature adds its weight times log(1 + count). With the swap groups of the fit and how many texts had any."""

    weights: dict[str, float]
    bias: float
    groups: tuple[tuple[str, ...], ...] = ()
    swapped_texts: int = 0

    def scores(self, texts: pd.Series) -> np.ndarray:
        tables = {k: {f[2:]: (f, w) for f, w in self.weights.items() if f[0] == k} for k in "w45"}
        whole, four, five = tables["w"], tables["4"], tables["5"]
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            found: Counter = Counter()
            for w, n in Counter(words_of(text)).items():
                if w in whole:
                    found[whole[w]] += n
                if len(w) > 4 and w[:4] in four:
                    found[four[w[:4]]] += n
                if len(w) > 5 and w[:5] in five:
                    found[five[w[:5]]] += n
            out[i] = self.bias + sum(weight * np.log1p(n) for (_, weight), n in found.items())
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit_regularised(x: np.ndarray, y: np.ndarray, weight: np.ndarray, changes: np.ndarray, ridge: float, penalty: float, rounds: int = 40) -> np.ndarray:
    """Newton steps for logistic regression plus penalty times the mean squared score change of the swaps."""
    held = ridge * np.eye(x.shape[1])
    held[0, 0] = 1e-6
    if len(changes):
        held += penalty * changes.T @ changes / len(changes) * len(x)
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + held, x.T @ (weight * (p - y)) + held @ b)
        b -= step
        if np.abs(step).max() < 1e-6:
            break
    return b


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        by: tuple[Counter, Counter] = (Counter(), Counter())
        for label, text in zip(batch["label"], batch["text"], strict=True):
            by[label].update(features_of(words_of(text)).keys())
        rows = [(f, by[1][f], by[0][f]) for f in by[0].keys() | by[1].keys()]
        yield pd.DataFrame(rows, columns=["feature", "toxic", "clean"])


def _contexts(terms: list[str]):
    """Counts of the words beside each of the terms, hashed to PLACES places."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = set(terms)
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                words = words_of(text)
                for i, w in enumerate(words):
                    if w in wanted:
                        for side, at in (("<", i - 1), (">", i + 1)):
                            if 0 <= at < len(words):
                                seen[w, zlib.crc32((side + words[at]).encode("utf-8", "surrogatepass")) % PLACES] += 1
        yield pd.DataFrame([(w, p, n) for (w, p), n in seen.items()], columns=["word", "place", "n"])

    return count


def neutral_groups(texts: DataFrame, counted: DataFrame, n: dict[int, int], least_texts: int = 10, least_cosine: float = 0.5) -> list[list[str]]:
    """Swap groups found in labelled texts: words that both classes use at like rates, and in like contexts.

    Of the NEUTRAL most frequent words (least_texts texts of each class, rates within a factor of 1.5) those whose
    neighbouring words agree are interchangeable mentions, whatever the language; a score must not hang on which is used.
    """
    rates = (F.col("toxic") / n[1]) / (F.col("clean") / n[0])
    even = counted.filter(F.col("feature").startswith("w:") & (F.col("toxic") >= least_texts) & (F.col("clean") >= least_texts) & rates.between(1 / 1.5, 1.5))
    terms = [r["feature"][2:] for r in even.orderBy(F.desc(F.col("toxic") + F.col("clean")), "feature").limit(NEUTRAL).collect()]
    rows = texts.mapInPandas(_contexts(terms), "word string, place int, n long").groupBy("word", "place").agg(F.sum("n").alias("n")).collect()  # NEUTRAL * PLACES at most
    contexts = {w: np.zeros(PLACES) for w in terms}
    for r in rows:
        contexts[r["word"]][r["place"]] = r["n"]
    return alike_in_context(contexts, least_cosine)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    learn: Column | None = None,
    per_class: int = 2000,
    max_features: int = 500,
    ridge: float = 0.1,
    penalty: float = 1.0,
    seed: int = 5,
) -> ToxicityModel:
    """Learns word and prefix weights from labelled texts, with identity terms swapped in copies of them.

    The sample is bounded: at most per_class labelled ids of each class (smallest seeded hash), each distinct text
    once; it is written and read once from docs. The max_features features that tell the classes apart best (G test,
    five texts at least) and all features of swapped terms get weights. Terms are IDENTITY_TERMS and the groups that
    neutral_groups() finds in the sample; score changes under swaps are penalised. Class weights restore the class
    shares of all labelled rows. Without two classes of text the model scores every text alike. learn: which label rows
    may be used (a condition on doc_id).
    """
    small_batches(docs.sparkSession)
    learn = F.lit(True) if learn is None else learn
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn)
    shares = {int(r["k"]): r["n"] for r in usable.groupBy(F.col(label).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()}
    sample = labelled_sample(labels, label, learn, per_class, seed)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")  # 2 * per_class ids at most
    texts = written(texts, "toxicity-sample")
    counted = texts.mapInPandas(_count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = {int(r["label"]): r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return ToxicityModel({}, 30.0 if n.get(1) else -30.0 if n else 0.0)
    counted = written(counted, "toxicity-counts")
    groups = [*IDENTITY_TERMS, *neutral_groups(texts, counted, n)]
    swaps = others(groups)

    def g(seen: str, of: int) -> Column:
        part = (F.col("toxic") + F.col("clean")) * of / (n[0] + n[1])
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) / part)).otherwise(0.0)

    odd = g("toxic", n[1]) + g("clean", n[0])
    terms = sorted(f for w in swaps for f in features_of([w]))
    strong = counted.filter("toxic + clean >= 5").withColumn("g", odd).orderBy(F.desc("g"), "feature").limit(max_features)
    chosen = sorted({r["feature"] for r in strong.collect()} | {r["feature"] for r in counted.filter(F.col("feature").isin(terms)).collect()})
    place = {f: i + 1 for i, f in enumerate(chosen)}

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def sparse(words: list[str]) -> dict[int, float]:
            return {place[f]: float(np.log1p(c)) for f, c in features_of(words).items() if f in place}

        for batch in batches:
            rows = []
            for doc_id, y, text in zip(batch["doc_id"], batch["label"], batch["text"], strict=True):
                words = words_of(text)
                x = sparse(words)
                other = swapped(words, f"{seed}:{doc_id}", swaps)
                y_swapped = x if other is None else sparse(other)
                change = {k: x.get(k, 0.0) - y_swapped.get(k, 0.0) for k in x.keys() | y_swapped.keys() if x.get(k) != y_swapped.get(k)}
                rows.append((doc_id, y, hash_of(text), list(x), list(x.values()), list(change), list(change.values())))
            yield pd.DataFrame(rows, columns=["doc_id", "y", "same", "k", "v", "ck", "cv"])

    rows = texts.mapInPandas(vectors, "doc_id long, y int, same string, k array<int>, v array<double>, ck array<int>, cv array<double>").collect()
    once = {(r["same"], r["y"]): r for r in sorted(rows, key=lambda r: (r["doc_id"], r["same"]), reverse=True)}
    rows = sorted(once.values(), key=lambda r: (r["doc_id"], r["same"]))
    x = np.zeros((len(rows), len(place) + 1))
    x[:, 0] = 1
    changes = []
    for i, r in enumerate(rows):
        x[i, r["k"]] = r["v"]
        if r["ck"]:
            changes.append(np.zeros(len(place) + 1))
            changes[-1][r["ck"]] = r["cv"]
    y = np.array([r["y"] for r in rows], dtype=float)
    total = sum(shares.values())
    weight = np.array([shares[int(k)] / total / (y == k).mean() for k in y])
    b = fit_regularised(x, y, weight, np.array(changes).reshape(len(changes), x.shape[1]), ridge, penalty)
    return ToxicityModel({f: float(b[i]) for f, i in place.items()}, float(b[0]), tuple(map(tuple, groups)), len(changes))


def swap_gap(model: ToxicityModel, texts: Sequence[str | None], seed: str = "gap") -> tuple[int, float]:
    """How many of the texts have terms to swap, and the mean change of their log odds when they are swapped."""
    swaps = others(model.groups)
    pairs = [(" ".join(w), " ".join(o)) for i, w in enumerate(map(words_of, texts)) if (o := swapped(w, f"{seed}:{i}", swaps)) is not None]
    if not pairs:
        return 0, 0.0
    odds = [np.log(p / (1 - p)) for p in (np.clip(model.scores(pd.Series(side)), 1e-12, 1 - 1e-12) for side in zip(*pairs, strict=True))]
    return len(pairs), float(np.abs(odds[0] - odds[1]).mean())


def hash_of(text: str | None) -> str:
    """A short digest by which equal texts are found."""
    return hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _score_udf(docs: DataFrame, model: ToxicityModel):
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(batch))

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """Adds score (0 to 1, higher: more likely toxic) and predicted (1 from the threshold on) to every row of docs.

    Null texts score as empty ones; repeated rows score alike; an empty table gives an empty result. Columns of docs
    named score or predicted are replaced.
    """
    score = _score_udf(docs, model)
    return docs.withColumn("score", score(text)).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame, learn: Column | None = None, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that the classifier does not call toxic, with the columns of docs."""
    model = fit_toxicity(docs, labels, learn=learn)
    return docs.filter(_score_udf(docs, model)("text") < threshold)
