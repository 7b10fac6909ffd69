"""Operator 1, toxicity: a counterfactually regularised linear classifier.

Identity terms in labelled texts are swapped for other terms of their group; into a labelled text without any, two terms
of one group are put in turn, and both texts are compared with each other and with the bare one. The change of score that this makes
is penalised beside the logistic loss, so that neutral mentions of a group do not raise a score, be it by the terms
themselves or by what they share with other words; the features of identity terms are in the model however few texts hold them.
Weights are sparse (L1) over words and word beginnings. Trained on the driver by accelerated proximal
gradient on at most max_rows labelled rows (the documented bound); every text is scored whole. The model tells how many
counterfactual pairs it was fitted with, the share of them that differ in its features, and the mean squared change of score that they have left.

Defined cases: a null or empty text gets the score of the bias; without labelled rows, or with one class
alone, the score is the share of toxic labels (0 without any); rows that repeat are scored alike; an empty
table gives an empty table; input columns called score or predicted are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame

from .features import Change, Sparse, WordIndicators, collected, fold, score, sigmoid, training_sample

#: Groups of identity terms (single words, in any case) that stand for each other in counterfactuals; a parameter of train().
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("girls", "boys"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrants", "refugees", "citizens"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
    # German
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("schwule", "lesben", "heterosexuelle", "bisexuelle", "transsexuelle"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch", "atheistisch"),
    ("schwarze", "weiße", "asiaten"),
    ("afrikaner", "europäer", "amerikaner", "mexikaner", "chinesen", "inder", "türken"),
    ("einwanderer", "flüchtlinge", "staatsbürger"),
    ("behinderte", "blinde", "gehörlose"),
    # French
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("filles", "garçons"),
    ("gays", "lesbiennes", "hétérosexuels", "bisexuels", "transgenres"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("noirs", "blancs", "asiatiques"),
    ("africains", "européens", "américains", "mexicains", "chinois", "indiens", "arabes"),
    ("immigrés", "réfugiés", "citoyens"),
    ("handicapés", "aveugles", "sourds"),
    # Spanish
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("niñas", "niños"),
    ("homosexuales", "lesbianas", "heterosexuales", "bisexuales", "transexuales"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("negros", "blancos", "asiáticos"),
    ("africanos", "europeos", "americanos", "mexicanos", "chinos", "indios", "árabes"),
    ("inmigrantes", "refugiados", "ciudadanos"),
    ("discapacitados", "ciegos", "sordos"),
)


@dataclass
class ToxicityModel:
    weights: dict[int, float]
    bias: float
    pairs: int = 0
    change: float = 0.0
    filled: float = 0.0


WORD = re.compile(r"\w+")


def counterfactuals(groups: tuple[tuple[str, ...], ...]):
    """A function that gives the pairs of texts whose scores should agree.

    The text and all its identity terms moved on by one in their group, and back by one; for a text without terms, two neighbours of one
    group put in turn between its words, group and place by a hash of the text: each with the text, and one with the other.
    """
    swap = swapper(groups)

    def pairs(text: str) -> list[tuple[str, str]]:
        if swapped := swap(text):
            return [(text, other) for other in swapped]
        draw = crc32(text.encode("utf-8", "surrogatepass"))
        group, words = groups[draw % len(groups)], text.split(" ")
        at, first = draw // 997 % (len(words) + 1), draw // 89 % len(group)
        one, two = (" ".join([*words[:at], group[(first + k) % len(group)], *words[at:]]) for k in (0, 1))
        return [(text, one), (text, two), (one, two)]

    return pairs


def swapper(groups: tuple[tuple[str, ...], ...]):
    """A function that moves all identity terms of a text on by one, and back by one; nothing for a text without any.

    A word is a term if both are equal when case-folded.
    """
    where = {term.casefold(): (group, i) for group in groups for i, term in enumerate(group)}
    if not all(WORD.fullmatch(term) for group in groups for term in group):
        raise ValueError("identity terms are single words")

    def swapped(text: str, step: int) -> str:
        def other(m: re.Match) -> str:
            group, i = where.get(m[0].casefold(), ((m[0],), -step))
            return group[(i + step) % len(group)]

        return WORD.sub(other, text)

    return lambda text: [swapped(text, 1), swapped(text, -1)] if any(w.casefold() in where for w in WORD.findall(text)) else []


def term_features(groups: tuple[tuple[str, ...], ...]) -> np.ndarray:
    """The features of all identity terms."""
    features = WordIndicators()
    return np.unique(np.concatenate([np.empty(0, np.int64), *(features(term) for group in groups for term in group)]))


def fit(rows: list[np.ndarray], y: np.ndarray, changes: list[list[Change]], l1: float = 1e-3, counterfactual: float = 1.0, min_rows: int = 4, steps: int = 200, keep: np.ndarray | None = None) -> ToxicityModel:
    """Minimise mean class-balanced logistic loss + counterfactual / 2 * mean squared score change + l1 * |w|.

    changes: for each row its counterfactual pairs, as the features that the second text has more and those it lacks. keep:
    features that are in the model whatever their count.
    """
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return ToxicityModel({}, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    x = Sparse(rows, WordIndicators.size, min_rows, keep=keep)
    pairs = [c for own in changes for c in own]
    more, less = (Sparse([c[k] for c in pairs], WordIndicators.size, columns=x.columns) for k in (0, 1))
    n, m = len(y), max(1, len(pairs))
    filled = float(np.mean(more.filled() | less.filled())) if pairs else 0.0
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))  # both classes count alike
    change_of = lambda w: more.dot(w) - less.dot(w)

    def penalty_slope(w: np.ndarray) -> np.ndarray:
        change = counterfactual / m * change_of(w)
        return more.back(change) - less.back(change)

    v = np.ones(len(x.columns))
    for _ in range(12):  # the largest curvature, for the step
        v /= np.linalg.norm(v) or 1
        v = 0.25 / n * x.back(weight * x.dot(v)) + penalty_slope(v)
        top = np.linalg.norm(v)
    step = 1 / (1.1 * top + 0.25)
    w = ahead = np.zeros(len(x.columns))
    bias = bias_ahead = 0.0
    t = 1.0
    for _ in range(steps):
        r = weight * (sigmoid(x.dot(ahead) + bias_ahead) - y) / n
        z = ahead - step * (x.back(r) + penalty_slope(ahead))
        new = np.sign(z) * np.maximum(np.abs(z) - step * l1, 0)
        new_bias = bias_ahead - step * r.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, bias_ahead = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    used = np.flatnonzero(w)
    left = float(np.mean(change_of(w) ** 2)) if pairs else 0.0
    return ToxicityModel(dict(zip(x.columns[used].tolist(), w[used].tolist(), strict=True)), float(bias), len(pairs), left, filled)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000, folds: int = 5, held_out: int = 0, groups=IDENTITY_GROUPS, **options) -> ToxicityModel:
    """Fit on at most max_rows labelled rows outside the held-out fold of crc32(doc_id)."""
    from pyspark.sql import functions as F

    sample = training_sample(docs, labels, "toxic", fold(F.col("doc_id"), folds) != held_out, max_rows)
    return fit(*collected(sample, WordIndicators, counterfactuals(groups)), **{"keep": term_features(groups), **options})


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Adds score (0 to 1, higher: toxic) and predicted (1 if score >= 0.5)."""
    return score(docs, WordIndicators, model.weights, model.bias, 1.0, text_col, ("score", "predicted"))
