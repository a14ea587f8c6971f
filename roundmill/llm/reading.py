"""Reading level of each English document by a familiar-word formula.

The familiar words are those that most English documents of the corpus hold. A text's difficulty is read
from the share of its words outside the list, taken at several lengths of the list, and from the mean
length of its sentences (logarithm). A multinomial logistic model fitted on labelled documents turns these
figures into a level.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundmill.runtime import collect_bounded, cut

LIST_SIZES = (25, 50, 75, 100, 150, 200, 250, 300, 350, 400, 450, 500, 600, 800)
LEVELS = 4
LEAST_WORDS = 40
LABELLED_ROWS = 4000  # the model is fitted on about this many labelled documents, drawn by a hash of doc_id
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?]+[\"”’')\]]*(?:\s|$)")
# Function words of English, and of languages it is told from.
ENGLISH = frozenset("the of and to in a is for that its has with by from as are it on will at was which an be this have or not but they their were had who when".split())
OTHERS = frozenset("der die das und ein eine einen im mit nach für dem den el la los las un una con del y le les et des du dans pour este se por al sur au aux trotz pese".split())


def is_english(words: list[str]) -> bool:
    """At least LEAST_WORDS words, enough English function words and more than twice those of other languages."""
    n = len(words)
    if n < LEAST_WORDS:
        return False
    own = sum(w in ENGLISH for w in words)
    return own > 0.08 * n and own > 2 * sum(w in OTHERS for w in words)


def sentence_count(text: str) -> int:
    """Sentences end at a full stop, question or exclamation mark before white space, lines without one at their end."""
    return max(1, sum(1 for line in text.splitlines() for part in _END.split(line) if part and not part.isspace()))


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """English documents per word, summed over the batch before anything is shuffled."""
    for batch in batches:
        counts: Counter = Counter()
        for text in batch["text"]:
            words = _WORD.findall(text.lower())
            if is_english(words):
                counts.update(set(words))
        yield pd.DataFrame(list(counts.items()), columns=["word", "n"])


def familiar_words(documents: DataFrame, size: int = LIST_SIZES[-1]) -> list[str]:
    """The words that most English documents hold, by document frequency over the whole corpus, ties in code point order."""
    counts = documents.select("text").where("text is not null").mapInPandas(_document_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in collect_bounded(counts.orderBy(F.desc("n"), "word").limit(size), size, "familiar words")]


def text_figures(documents: DataFrame, familiar: list[str]) -> DataFrame:
    """(doc_id, n_words, figures) of each English document of at least LEAST_WORDS words."""
    box = documents.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(familiar)})
    edges = np.array(LIST_SIZES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = box.value.get
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = _WORD.findall(text.lower())
                if is_english(words):
                    ranks = np.array([place(w, 1 << 30) for w in words])
                    bands = np.bincount(np.searchsorted(edges, ranks, "right"), minlength=len(edges) + 1)
                    outside = bands[::-1].cumsum()[::-1][1:] / len(words)
                    rows.append((doc_id, len(words), [float(np.log(len(words) / sentence_count(text))), *map(float, outside)]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "figures"])

    return documents.select("doc_id", "text").where("text is not null and doc_id is not null").mapInPandas(run, "doc_id long, n_words int, figures array<double>")


def fit_levels(x: np.ndarray, y: np.ndarray, *, rounds: int = 1500, decay: float = 1e-3, rate: float = 0.5) -> dict:
    """Multinomial logistic model; y holds levels from 1. Without rows every text is of level 2."""
    if not len(x):
        k = 1 + len(LIST_SIZES)
        w = np.zeros((k + 1, LEVELS))
        w[-1, 1] = 1
        return {"mean": np.zeros(k), "sd": np.ones(k), "w": w}
    mean, sd = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / sd, np.ones(len(x))]
    goal = np.eye(LEVELS)[y - 1]
    w, seen = np.zeros((z.shape[1], LEVELS)), np.full((z.shape[1], LEVELS), 1e-8)
    for _ in range(rounds):
        p = np.exp(z @ w - (z @ w).max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = z.T @ (p - goal) / len(z) + decay * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return {"mean": mean, "sd": sd, "w": w}


def predict_levels(model: dict, x: np.ndarray) -> np.ndarray:
    return (np.c_[(x - model["mean"]) / model["sd"], np.ones(len(x))] @ model["w"]).argmax(1) + 1


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, unfamiliar, reader_level) of each document in English, whatever its ``lang`` says, with at least
    LEAST_WORDS words; ``unfamiliar`` is the share of words outside the whole list.

    Null, empty, short and foreign texts give no row, nor do rows without an id. Labels outside 1 to 4 and labels of other documents are
    left out; without labels all texts get level 2. Repeated rows are rated each; an empty table gives no row.
    """
    figures = cut(text_figures(documents, familiar_words(documents)))
    good = labels.where(f"reader_level between 1 and {LEVELS} and doc_id is not null").select("doc_id", "reader_level")
    parts = max(1, good.count() // LABELLED_ROWS)
    some = good.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == 0)
    rows = collect_bounded(some.join(figures, "doc_id").select("figures", "reader_level"), 3 * LABELLED_ROWS, "labelled documents")
    model = fit_levels(np.array([r["figures"] for r in rows]), np.array([r["reader_level"] for r in rows], int))

    @F.pandas_udf(T.IntegerType())
    def level(x: pd.Series) -> pd.Series:
        return pd.Series(predict_levels(model, np.stack(x.to_numpy())) if len(x) else [], dtype="int32")

    return figures.select("doc_id", "n_words", F.round(F.element_at("figures", -1), 4).alias("unfamiliar"), level("figures").alias("reader_level"))
