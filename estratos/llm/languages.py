"""Operator 5: language identification by multilingual mixture inference.

For each learned language the whole labelled corpus gives counts of letter trigrams. A document is a mixture of
languages: expectation-maximisation estimates the proportions from the trigram likelihoods, and the set of languages is
the one with the best likelihood after a penalty for each language beyond the first.

A trigram is three folded bytes, kept as they are and never hashed, so different trigrams have different counts in any
script. Folding leaves 155 bytes, so a language has at most 155^3 (3.7 million) counts however many documents there
are; only those that occur are stored, and that table is all that tasks receive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos.llm.arrow_text import chunks
from estratos.llm.common import held_out, read

#: Log-likelihood a further language has to gain for each doubling of the number of trigrams; trigrams that overlap
#: are not independent, so this is above the half that independent observations would take.
PENALTY = 4.0
ROUNDS = 12
#: What is added to each count of a trigram that any language has.
SMOOTHING = 0.5
#: Counts that a task holds before it passes them on.
HELD_COUNTS = 1 << 20

# Letters stay (A-Z in lower case), every byte beyond ASCII stays, all other bytes count as one blank.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray) -> np.ndarray:
    """Each trigram of the folded bytes as a number of 24 bits, with one blank before and after and for runs of blanks."""
    folded = _FOLD[data]
    blank = folded == 0x20
    folded = folded[~(blank & np.concatenate(([True], blank[:-1])))]
    if len(folded) and folded[-1] == 0x20:
        folded = folded[:-1]
    if not len(folded):
        return np.zeros(0, dtype=np.int64)
    folded = np.concatenate(([0x20], folded, [0x20])).astype(np.int64)
    return (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number: dict[str, int] = {}
    keys = counts = np.zeros(0, dtype=np.int64)  # a key is the number of a language, then a trigram

    def held() -> pa.RecordBatch:
        names = pa.array(list(number), pa.string())
        return pa.record_batch(
            [names.take(pa.array(keys >> 24)), pa.array((keys & 0xFFFFFF).astype(np.int32)), pa.array(counts)],
            names=["lang", "trigram", "n"],
        )

    for batch in batches:
        langs = [number.setdefault(lang, len(number)) for lang in batch.column(1).to_pylist()]
        for chunk in chunks(batch.column(0)):
            found = [
                trigrams(chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]]) | (langs[chunk.first + i] << 24)
                for i in range(len(chunk.bounds) - 1)
            ]
            own, n = np.unique(np.concatenate(found), return_counts=True)
            keys, place = np.unique(np.concatenate((keys, own)), return_inverse=True)
            total = np.zeros(len(keys), dtype=np.int64)
            np.add.at(total, place, np.concatenate((counts, n)))
            counts = total
            if len(keys) > HELD_COUNTS:
                yield held()
                keys = counts = np.zeros(0, dtype=np.int64)
    if len(keys):
        yield held()


class Mixture:
    """Trigram probabilities of each language, stored where a trigram occurs, and the inference for one document."""

    def __init__(self, langs: list[str], trigram: np.ndarray, lang: np.ndarray, n: np.ndarray):
        """`n` occurrences of `trigram` in the language with number `lang`; each pair stands once."""
        self.langs = langs
        order = np.argsort(trigram, kind="stable")
        self.known, first = np.unique(trigram[order], return_index=True)
        self.begin = np.append(first, len(order))
        total = np.bincount(lang, weights=n, minlength=len(langs)) + SMOOTHING * len(self.known)
        self.lang = lang[order]
        self.value = (n[order] + SMOOTHING) / total[self.lang]
        self.absent = SMOOTHING / np.maximum(total, SMOOTHING)

    def _likelihood(self, trigram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these trigrams any language has, and the probability of those in each language."""
        at = np.minimum(np.searchsorted(self.known, trigram), len(self.known) - 1)
        known = self.known[at] == trigram
        at = at[known]
        length = self.begin[at + 1] - self.begin[at]
        row = np.repeat(np.arange(len(at)), length)
        flat = np.arange(len(row)) + np.repeat(self.begin[at] - (np.cumsum(length) - length), length)
        out = np.tile(self.absent, (len(at), 1))
        out[row, self.lang[flat]] = self.value[flat]
        return known, out

    def _proportions(self, likelihood: np.ndarray, counts: np.ndarray, start: np.ndarray) -> np.ndarray:
        share, total = start / start.sum(), counts.sum()
        for _ in range(ROUNDS):
            weight = counts / (likelihood @ share)
            share = share * (weight @ likelihood) / total
        return share

    def infer(self, found: np.ndarray) -> dict[str, float]:
        """The languages of a document with their proportions; empty if there is no trigram or no language.

        A trigram that no language has says nothing; if there is no other, all languages have equal proportions.
        """
        if not len(found) or not self.langs:
            return {}
        trigram, counts = np.unique(found, return_counts=True)
        known, likelihood = self._likelihood(trigram)
        counts = counts[known]
        if not len(counts):
            return dict.fromkeys(self.langs, 1 / len(self.langs))
        single = counts @ np.log(likelihood)
        best = int(single.argmax())
        chosen, shares, value = [best], np.ones(1), single[best]
        if len(self.langs) > 1:
            everything = self._proportions(likelihood, counts, np.ones(len(self.langs)))
            order = [best, *(int(j) for j in np.argsort(-everything) if j != best)]
            for size in range(2, len(order) + 1):
                members = order[:size]
                part = likelihood[:, members]
                share = self._proportions(part, counts, np.maximum(everything[members], 1e-3))
                gained = counts @ np.log(part @ share) - PENALTY * (size - 1) * np.log2(counts.sum() + 1)
                if gained <= value:
                    break
                chosen, shares, value = members, share, gained
        return {self.langs[j]: float(s) for j, s in zip(chosen, shares, strict=True)}


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Mixture:
    """The model of all rows that have a language; texts without letters and null texts add nothing.

    What passes the driver are the summed counts: at most 155^3 rows for each language.
    """
    labelled = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counted = labelled.mapInArrow(_count, "lang string, trigram int, n bigint")
    table = counted.groupBy("lang", "trigram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(table["lang"].unique())
    number = table["lang"].map({name: i for i, name in enumerate(langs)})
    columns = [column.to_numpy(dtype=np.int64) for column in (table["trigram"], number, table["n"])]
    return Mixture(langs, *columns)


def identify(docs: DataFrame, model: Mixture, text: str = "text") -> DataFrame:
    """The columns of `docs` but the text, then `lang_pred`, `score` and `mixture`.

    `lang_pred` is the language with the largest proportion (ties: the first by name), `score` its proportion and
    `mixture` all proportions. A null text or one without a letter, and any text where nothing was learned, is `und`
    with score 0 and an empty mixture. Columns that have these names already are replaced.
    """
    added = ("lang_pred", "score", "mixture")
    kept = [name for name in docs.columns if name not in (text, *added)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(0), []
            for chunk in chunks(texts):
                for i in range(len(chunk.bounds) - 1):
                    data = chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]]
                    own = bool(((_FOLD[data] != 0x20) & (data < 128)).any()) or any(
                        map(str.isalpha, data.tobytes().decode("utf-8", "ignore"))
                    )
                    found.append(model.infer(trigrams(data)) if own else {})
            pred = [max(sorted(m), key=m.get) if m else "und" for m in found]
            yield pa.record_batch(
                [
                    *batch.columns[1:],
                    pa.array(pred, pa.string()),
                    pa.array([min(1.0, m.get(p, 0.0)) for m, p in zip(found, pred, strict=True)], pa.float64()),
                    pa.array([sorted(m.items()) for m in found], pa.map_(pa.string(), pa.float64())),
                ],
                names=[*kept, *added],
            )

    chosen = docs.select(F.col(f"`{text}`"), *[F.col(f"`{name}`") for name in kept])
    schema = chosen.select(*[F.col(f"`{name}`") for name in kept]).schema
    schema = schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())
    schema = schema.add("mixture", T.MapType(T.StringType(), T.DoubleType()))
    return chosen.mapInArrow(score, schema)


def op5_mixture_languages(spark, sf_dir: str) -> DataFrame:
    """The language of every whole document; learned from all labelled documents outside fold 2 of 4."""
    docs = read(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out("doc_id", 4, 2)).select("text", "lang"))
    chosen = docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "text")
    return identify(chosen, model).select("doc_id", "held_out", "lang_pred", "score")
